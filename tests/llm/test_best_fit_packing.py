import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import best_fit_packing as q

PATH = P.path("word_bpe_49k.json")


def check_packing(rows, capacity):
    """Sequences are gapless and not overfull; returns their number and the least there can be."""
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by), -(-sum(r["length"] for r in rows) // capacity)


def test_query(ready, sf, texts):
    from ledgerline.llm.queries import REGISTRY

    library = Tokenizer.from_file(PATH)
    rows = [r.asDict() for r in REGISTRY["op6_best_fit_packing"](ready, sf).collect()]
    found = {(r["doc_id"], r["piece"]): r for r in rows}
    n = 0
    for doc_id, text in texts.items():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            r = found[doc_id, piece]
            assert (r["start"], r["length"], r["ids_crc32"]) == (start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
            n += 1
    assert n == len(rows)
    used, least = check_packing(rows, 4096)
    assert used <= 1.03 * least + 1


def test_word_ids_equal_the_library():
    library, ids_of = Tokenizer.from_file(PATH), q.WordIds(PATH)
    texts = ["", " ", "Don't  STOP\nit's", "a<|endoftext|>b <|endoftext|> <|startoftext|>c", "é x y", "!!! ...a", "日本 語"] * 2
    for text, data in zip(texts, ids_of.of([t.encode() for t in texts])):
        assert np.frombuffer(data, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_words_remembered_take_little_memory():
    chance, ids_of = random.Random(3), q.WordIds(PATH)
    texts = [" ".join("".join(chance.choices("abcdefghij", k=9)) for _ in range(40_000)) for _ in range(8)]
    tracemalloc.start()
    for text in texts:
        ids_of.of([text.encode()])
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held + ids_of.words.nbytes + ids_of.ids.nbytes < 48e6


def test_long_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(q, "_REMEMBERED_BYTES", 2000)
    library, ids_of = Tokenizer.from_file(PATH), q.WordIds(PATH)
    for i in range(8):
        texts = [f"a{i} " + f"{'xy' * 200}{k % 3}, b" for k in range(5)] + ["", "a b a"]
        for text, data in zip(texts, ids_of.of([t.encode() for t in texts])):
            assert np.frombuffer(data, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(ids_of.words) < 12


def test_words_are_looked_up_once_and_may_be_forgotten(monkeypatch):
    monkeypatch.setattr(q, "_REMEMBERED", 20)
    library, ids_of = Tokenizer.from_file(PATH), q.WordIds(PATH)
    chance = random.Random(7)
    for _ in range(8):
        texts = ["".join(chance.choices("abZÉé .,;!'1\n", k=chance.randrange(60))) for _ in range(40)]
        found = ids_of.of([t.encode() for t in texts])
        assert [np.frombuffer(f, "<u4").tolist() for f in found] == [
            library.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids_of.of([]) == [] and ids_of.of([b"", b" "]) == [b"", b""]


@pytest.mark.parametrize("seed", [1, 2])
def test_evolution_keeps_pieces(seed):
    chance = random.Random(seed)
    lengths = [chance.randrange(1, 100) for _ in range(300)]
    best = q.evolve(lengths, 100, [], chance)
    assert sorted(i for g in best.groups for i in g) == list(range(300))
    assert all(sum(lengths[i] for i in g) + r == 100 and r >= 0 for g, r in zip(best.groups, best.room))
    plain = q.Packing(lengths, 100).best_fit(q._by_length(list(range(300)), lengths))
    assert best.fitness() >= plain.fitness()


def test_cells_and_odd_rows(ready, docs):
    chance = random.Random(4)
    rows = [(i, " ".join(["a"] * chance.randrange(0, 90))) for i in range(150)] + [(None, None), (None, None), (1, "b " * 500), (1, "")]
    parts = q.pieces(docs(rows), PATH, capacity=64, with_ids=True)
    assert sum(r["length"] for r in parts.collect()) == sum(len(r["ids"]) for r in parts.collect())
    packed = [r.asDict() for r in q.pack(parts.drop("ids"), capacity=64, cell_rows=16).collect()]
    assert len(packed) == parts.count()
    used, least = check_packing(packed, 64)
    assert used <= 1.15 * least + 2
    assert q.pack(q.pieces(docs([]), PATH)).count() == 0


def test_letters_of_any_kind_are_split_many_at_once(monkeypatch):
    library, ids_of, alone = Tokenizer.from_file(PATH), q.WordIds(PATH), []
    monkeypatch.setattr(ids_of, "_split", lambda word, own=ids_of._split: alone.append(word) or own(word))
    words = [f"Übé{chr(0x3b1 + i % 16)}{'abcdefghij'[i // 60]}{end}" for i in range(600) for end in ("", ".", "!")]
    data = ids_of.of([" ".join(words).encode()])[0]
    assert np.frombuffer(data, "<u4").tolist() == library.encode(" ".join(words), add_special_tokens=False).ids
    assert not alone
    odd = ["ΟΔΟΣ", "áb", "ȩ́", "ͅx", "ǅ", "İi", "ﬁ", "日本。", "é's", "x\u0085y", "é<|endoftext|>é", "Ɤa", "é²."]
    for text in [*odd, " ".join([*odd, *words])]:
        assert np.frombuffer(ids_of.of([text.encode()])[0], "<u4").tolist() == \
            library.encode(text, add_special_tokens=False).ids
    assert len(ids_of.of([b"\xff\xc3 \xc3\xa9\xff"])[0]) > 0
