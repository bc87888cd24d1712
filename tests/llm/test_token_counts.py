import random

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerline.llm import token_counts as q

PATH = P.path("word_bpe_49k.json")
ODD = ["", " ", "a", "Don't stop", "I'LL we'Re", "<|endoftext|>x<|startoftext|> <|endoftext|", "ΣΑΣ ς", "İstanbul", "é x",
       "x y\x1cz", "１２3 ¼", "a" * 3000, "!!!???...", "日本語", "😀👍🏽", "́ a", "</w> a</w>b", "KK", "ﬁ"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def slow(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def whole(made, text):
    return made.total(made.state_map(text.encode()))


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(library, text):
    assert whole(q.compiled(PATH), text) == slow(library, text)


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs", "Cn", "Co"]), max_size=60) | st.text("thinger' s\n", max_size=80))
def test_any_text(text):
    library = Tokenizer.from_file(PATH)
    assert whole(q.compiled(PATH), text) == slow(library, text)


@settings(max_examples=200, deadline=None)
@given(st.text("abé <|endoftx>'s\n", max_size=80), st.integers(1, 7))
def test_chunks_compose(text, size):
    made = q.compiled(PATH)
    maps = [made.state_map(text[i : i + size].encode()) for i in range(0, len(text), size)] or [made.state_map(b"")]
    scanned = made.scan(maps)
    for i, prefix in enumerate(scanned):
        assert made.total(prefix) == whole(made, text[: (i + 1) * size])


def test_query(ready, sf, texts, library):
    from ledgerline.llm.queries import REGISTRY

    rows = REGISTRY["op3_token_counts"](ready, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        n = slow(library, text)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 2048)


def test_small_chunks_and_odd_rows(docs, library):
    chance = random.Random(2)
    rows = list(enumerate(["".join(chance.choice("ab é\n<|endoftext|>") for _ in range(chance.randrange(200))) for _ in range(40)]))
    rows += [(None, None), (1, ""), (1, "x" * 5000), (2, "same same"), (2, "same same")]
    found = q.counted(docs(rows), PATH, chunk=16).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in found) == sorted((str(i), slow(library, t or "")) for i, t in rows)
    assert q.counted(docs([]), PATH).count() == 0


def test_chunks_of_a_long_text_without_blanks_are_joined_in_pairs():
    """What is held while joining stays in proportion to the text."""
    import tracemalloc

    made = q.compiled(PATH)
    maps = [q.StateMap(b"z" * 65_536, 0, b"", False) for _ in range(320)]  # 20 MB without a blank
    tracemalloc.start()
    whole = made.whole(maps)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(whole.head) == 320 * 65_536 and not whole.reset and peak < 4 * len(whole.head)
    mixed = [made.state_map(t) for t in (b"ab", b"c d", b"e", b" f", b"gh i")]
    assert made.whole(mixed) == made.scan(mixed)[-1]
