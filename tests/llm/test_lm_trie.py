import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import lm_trie as q
from ledgerline.llm.elias_fano import EliasFano, _select


@pytest.mark.parametrize("top, n", [(1, 1), (10, 40), (1000, 50), (1 << 40, 3000), ((1 << 62) + 5, 500), (70, 5000)])
def test_elias_fano(top, n):
    chance = np.random.default_rng(n)
    values = np.sort(chance.integers(0, top, n))
    made = EliasFano.of(values)
    assert (made.get(np.arange(n)) == values).all()
    asked = np.concatenate([values, values + 1, chance.integers(0, top, 200), [0, top, top + 9]])
    index, equal = made.successor(asked)
    assert (index == np.searchsorted(values, asked)).all()
    assert (equal == np.isin(asked, values)).all()
    assert EliasFano.of(values[:0]).successor(asked)[0].tolist() == [0] * len(asked)
    assert (made.all() == values).all()


def test_select():
    chance = np.random.default_rng(3)
    words = chance.integers(1, 1 << 64, 300, dtype=np.uint64)
    for word in [*words.tolist(), (1 << 64) - 1, 1, 1 << 63]:
        places = [i for i in range(64) if word >> i & 1]
        assert _select(np.full(len(places), word, np.uint64), np.arange(len(places))).tolist() == places


def test_sent_counts_are_close_to_what_their_spread_needs():
    chance = np.random.default_rng(4)
    for top, most in ((1 << 30, 2.6), (1 << 48, 4.9), (1 << 62, 6.7)):
        keys = np.unique(chance.integers(0, top, 100_000))
        counts = chance.integers(1, 4, len(keys))
        counts[::1000] = chance.integers(250, 1 << 40, len(counts[::1000]))
        blob = q._packed(keys, counts)
        assert len(blob) < most * len(keys)
        back = q._unpacked(blob)
        assert (back[0] == keys).all() and (back[1] == counts).all()


def test_contexts_of_a_shard_lie_together():
    level = q.Level(starts=np.array([0, 40, 40, 100]), heavy=np.array([50]), heavy_counts=np.array([9]))
    contexts = np.array([0, 39, 40, 50, 50, 99, 100, 900])
    found = level.shard_of(contexts, np.arange(8), 4)
    assert found[[0, 1, 2, 5, 6, 7]].tolist() == [0, 0, 2, 2, 3, 3]


def test_words_are_those_of_a_split_of_bytes():
    texts = [b" a B\x0b\x0cc\t\r\n d ", b"", b"  ", b"x", "É Ünï A B\u0085c\xa0d".encode(), b"\xff Bad \x1c z\x00 Q"]
    words, lengths = q.words_of(pa.array([b"left out", *texts], pa.binary()).slice(1), lower=True)
    assert words.to_pylist() == [w for t in texts for w in t.lower().split()]
    assert lengths.tolist() == [len(t.split()) for t in texts]


def brute(rows, order, min_count, discount):
    """The model by its definition, over dictionaries."""
    words = [[*t.encode().lower().split(), b"\n"] for _, t in rows]
    uni = Counter(w for ws in words for w in ws)
    n, ones, twos = sum(uni.values()), sum(c == 1 for c in uni.values()), sum(c == 2 for c in uni.values())
    d1 = min(0.9, ones / (ones + 2 * twos)) if ones else 0.0
    grams = [Counter() for _ in range(order + 1)]
    kept = {(w,) for w in uni}
    for size in range(2, order + 1):
        for ws in words:
            padded = [b"\n", *ws]
            for i in range(1, len(padded)):
                if i - size + 1 >= 0:
                    gram = tuple(padded[i - size + 1 : i + 1])
                    if gram[:-1] in kept and (size == 2 or i - size + 1 >= 0):
                        grams[size][gram] += 1
        kept = {g for g, c in grams[size].items() if c >= min_count}

    def probability(gram):
        if len(gram) == 1:
            c = uni.get(gram[0], 0)
            return (c - d1) / n if c else max(d1 * len(uni) / n, 1e-12)
        lower, context = probability(gram[1:]), gram[:-1]
        follow = {g: c for g, c in grams[len(gram)].items() if g[:-1] == context}
        total = sum(follow.values())
        mass = sum(c - discount for c in follow.values() if c >= min_count)
        own = follow.get(gram, 0)
        if not total:
            return lower
        return (own - discount) / total * (own >= min_count) + (1 - mass / total) * lower
    return uni, n, probability


@pytest.mark.parametrize("order", [2, 3])
def test_scores_against_brute_force(docs, order):
    chance = random.Random(order)
    rows = [(i, " ".join(chance.choice("a b c d e f g hh ii jj".split()) for _ in range(chance.randrange(30)))) for i in range(60)]
    rows += [(100, "A unseen B"), (101, ""), (105, "zz " * 400)]
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 7 != 2]
    uni, n, probability = brute(train, order, 2, 0.75)
    for shard_tokens in (3_000_000, 20):
        found = {r["doc_id"]: r for r in q.scored(docs(rows), order=order, shard_tokens=shard_tokens).collect()}
        for doc_id, text in rows:
            r, words = found[doc_id], [*text.encode().lower().split(), b"\n"]
            assert r["held_out"] == (zlib.crc32(str(doc_id).encode()) % 7 == 2) and r["train_tokens"] == n
            assert (r["n_tokens"], r["n_known"]) == (len(words), sum(w in uni for w in words))
            base = sum(math.log10((uni.get(w, 0) + 1) / (n + len(uni) + 1)) for w in words)
            assert abs(r["base_score"] - base) < 1e-6
            padded, total = [b"\n", *words], 0.0
            for i in range(1, len(padded)):
                total += math.log10(probability(tuple(padded[max(0, i - order + 1) : i + 1])))
            assert abs(r["score"] - total) < 2e-3 * len(words), (doc_id, r["score"], total)


def test_better_than_base_on_held_out_texts(ready):
    from ledgerline.llm.queries import REGISTRY

    rows = REGISTRY["op9_lm_trie"](ready, "/root/testdata/sf0.01").where("held_out").collect()
    assert rows and sum(r["score"] for r in rows) > 1.05 * sum(r["base_score"] for r in rows)


def test_registered_query_has_three_word_contexts_and_all_pairs(ready, tmp_path):
    from ledgerline.llm.queries import REGISTRY

    chance = random.Random(9)
    rows = [(i, " ".join(chance.choice("a b c d e f g hh ii jj".split()) for _ in range(chance.randrange(30)))) for i in range(40)]
    ready.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    _, _, probability = brute([r for r in rows if zlib.crc32(str(r[0]).encode()) % 7 != 2], 3, 1, 0.75)
    found = {r["doc_id"]: r["score"] for r in REGISTRY["op9_lm_trie"](ready, str(tmp_path)).collect()}
    for doc_id, text in rows:
        padded = [b"\n", *text.encode().split(), b"\n"]
        total = sum(math.log10(probability(tuple(padded[max(0, i - 2) : i + 1]))) for i in range(1, len(padded)))
        assert abs(found[doc_id] - total) < 2e-3 * len(padded)


def test_odd_rows(docs):
    rows = q.scored(docs([(None, None), (None, "a"), (1, "a a"), (1, "a a"), (2, "b" * 10_000)])).collect()
    assert len(rows) == 5 and all(r["score"] <= 0 and math.isfinite(r["score"]) for r in rows)
    assert q.scored(docs([])).count() == 0
    alone = q.scored(docs([(next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2), "x y")])).collect()
    assert alone[0]["train_tokens"] == 0 and alone[0]["n_known"] == 0


def test_a_place_among_many_numbers_is_guessed(monkeypatch):
    chance = np.random.default_rng(8)
    values = np.unique(np.concatenate([chance.integers(0, 1 << 20, 60_000), chance.integers(1 << 20, 1 << 36, 60_000)]))
    asked, made, read = np.arange(0, 1 << 20, 7), EliasFano.of(values), []
    monkeypatch.setattr(EliasFano, "_low", lambda self, index, own=EliasFano._low: read.append(len(index)) or own(self, index))
    index, equal = made.successor(asked)
    assert (index == np.searchsorted(values, asked)).all() and (equal == np.isin(asked, values)).all()
    assert sum(read) < 8 * len(asked)  # halving 60,000 takes 16


def test_the_number_behind_another():
    for values in (np.array([0, 1 << 40, 1 << 41]), np.arange(500), np.zeros(3, np.int64), np.cumsum(np.arange(3000) ** 3)):
        here, behind = EliasFano.of(values).get_two(np.arange(len(values) - 1))
        assert (here == values[:-1]).all() and (behind == values[1:]).all()


def test_words_are_looked_up_once(docs, monkeypatch):
    read = []
    monkeypatch.setattr(q, "map_batches", lambda df, fn, schema, own=q.map_batches: read.append(df.columns) or own(df, fn, schema))
    rows = [(i, f"a b c{i % 5} unseen{i}") for i in range(30)] + [(None, None), (40, "")]
    assert q.scored(docs(rows), order=3).count() == len(rows)
    assert sum("b" in columns for columns in read) == 2  # words are counted, then numbered


def test_stored_numbers():
    trie = q.Trie(q.Level(), 9, 9, 0.0)
    tokens, begins = np.array([3, -1, 8, 0, 0]), np.array([0, 2, 3])
    for trie.n_words in (9, 1 << 33):
        found = trie.stored_numbers(tokens, begins)
        assert [len(f) // (4 if trie.n_words == 9 else 8) for f in found.to_pylist()] == [2, 1, 2]
        assert [a.tolist() for a in trie.read_numbers(found)] == [tokens.tolist(), begins.tolist()]
        assert [a.tolist() for a in trie.read_numbers(found[1:])] == [[8, 0, 0], [0, 1]]
