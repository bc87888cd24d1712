import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.llm import byte_bpe as q

PATH = P.path("byte_bpe_50k.tiktoken")
ODD = ["", " ", "  a", "a  b", "a \n b", "don't  DON'T I'll", "x y \x1c z", "aaaa" * 500, " " * 300, "\n\n\n a", "日本語 テキスト",
       "á é", "1234567 89", "<|endoftext|>", " x   y", "🤦🏼‍♂️ ok", "tab\there ", " end "]


@pytest.fixture(scope="module")
def codec():
    return q.codec(PATH, P.PATTERN)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(codec, library, text):
    ids = codec.encode(text).tolist()
    assert ids == library.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs", "Cn", "Co"]), max_size=60))
def test_any_text(text):
    codec = q.codec(PATH, P.PATTERN)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    assert codec.encode(text).tolist() == library.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.binary(min_size=1, max_size=40) | st.text("abth eing", min_size=1, max_size=60).map(str.encode))
def test_pieces_equal_the_merges(data):
    codec = q.codec(PATH, P.PATTERN)
    whole = codec.ranks.get(data)
    assert codec.piece(data) == ([whole] if whole is not None else codec.merged(data))


def test_query(ready, sf, texts, library):
    from ledgerline.llm.queries import REGISTRY

    rows = REGISTRY["op2_byte_bpe"](ready, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()


def test_null_and_empty(ready, docs):
    rows = docs([(1, None), (None, ""), (2, "a")]).select(q.encode(F.col("text"), PATH, P.PATTERN).alias("ids"))
    assert sorted(len(r["ids"]) for r in rows.collect()) == [0, 0, 1]
    assert rows.select(q.decode(F.lit(None).cast("array<int>"), PATH, P.PATTERN).alias("d")).first()["d"] == b""


def test_remembered_words_are_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(q, "_GENERATION", 20_000)
    small = q.Codec.from_file(PATH, P.PATTERN)
    plain = q.Codec.from_file(PATH, P.PATTERN)
    rng = random.Random(2)
    for _ in range(60):
        text = " ".join("".join(rng.choices("abcdeé,.'1", k=rng.randrange(1, 12))) for _ in range(100)) + " " + "z" * 200
        monkeypatch.setattr(q, "_GENERATION", 20_000)
        got = small.encode(text).tolist()
        monkeypatch.setattr(q, "_GENERATION", 1 << 30)
        assert got == plain.encode(text).tolist()
        assert sum(q._ENTRY + len(w) for w in (*small.young, *small.old)) < 50_000
    assert "z" * 200 not in small.young


def test_many_texts_at_once(codec, monkeypatch):
    rng = random.Random(5)
    texts = [*ODD, *("".join(rng.choices("ab ,.\n\té '1", k=rng.randrange(40))) for _ in range(500))]
    asked = []
    monkeypatch.setattr(codec, "piece", lambda data, own=codec.piece: asked.append(data) or own(data))
    ids, at = codec.encode_all(pa.array(["left out", *texts, *["one same wordzq"] * 300])[1:])
    assert asked.count(b" wordzq") <= 1
    for text, a, b in zip(texts, at[:-1], at[1:]):
        assert ids[a:b].tolist() == codec.encode(text).tolist()
    assert codec.decode_all(ids, at).to_pylist()[: len(texts)] == [t.encode() for t in texts]
    assert codec.decode_all(ids[:0], np.zeros(3, np.int64)).to_pylist() == [b"", b""]
    with pytest.raises((KeyError, IndexError)):
        codec.decode_all(np.array([10**6]), np.array([0, 1]))


def test_decoding_in_parts(ready, docs, monkeypatch):
    rows = docs([(i, "word " * (i % 7) + "é") for i in range(50)] + [(60, None), (61, "")])
    monkeypatch.setattr(q, "_TOKENS", 10)
    made = rows.select("text", q.encode(F.col("text"), PATH, P.PATTERN).alias("ids"))
    for r in made.select("text", q.decode(F.col("ids"), PATH, P.PATTERN).alias("d")).collect():
        assert r["d"] == (r["text"] or "").encode()


def test_a_token_taken_back_is_replaced_without_listing_all_tokens(codec, library):
    rng = random.Random(6)
    assert all(codec.shorter[r] == -1 for r, t in codec.tokens.items() if len(t) == 1)
    for _ in range(2000):
        data = bytes(rng.choices(b"aeinrst on", k=rng.randrange(1, 40)))
        assert codec.piece(data) == library._encode_single_piece(data)


def test_pairs_are_judged_without_merging_them_again(codec, monkeypatch):
    rng, standing = random.Random(11), [r for r, t in codec.tokens.items() if codec.merged(t) == [r]]
    often = [r for r in standing if r < 1500]
    pairs = [(rng.choice(some), rng.choice(some)) for some in (standing, often) for _ in range(15_000)]
    wanted = [codec.merged(codec.tokens[a] + codec.tokens[b]) == [a, b] for a, b in pairs]
    assert codec.ordered and 0 < sum(wanted) < len(wanted)
    monkeypatch.setattr(codec, "_parts", None)
    assert [codec._compatible(a, b) for a, b in pairs] == wanted


def test_ranks_that_do_not_grow_are_merged_as_defined():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"abc": 260, b"cd": 270, b"bc": 310, b"dab": 265, b"aa": 280}
    small, rng = q.Codec(ranks, P.PATTERN), random.Random(12)
    assert not small.ordered
    for _ in range(2000):
        data = bytes(rng.choices(b"abcd", k=rng.randrange(1, 12)))
        for a, b in [(x, y) for x in small.merged(data[:3])[-1:] for y in small.merged(data[3:])[:1]]:
            assert small._compatible(a, b) == (small.merged(small.tokens[a] + small.tokens[b]) == [a, b])


def test_the_pattern_runs_over_many_new_words_at_once(library):
    fresh, asked, rng = q.Codec.from_file(PATH, P.PATTERN), [], random.Random(13)
    fresh.split = lambda text, own=fresh.split: asked.append(text) or own(text)
    texts = ["x " + " ".join("".join(rng.choices("abé.,'1\n日", k=9)).strip() or "-" for _ in range(300)) for _ in range(40)]
    ids, at = fresh.encode_all(pa.array(texts))
    for text, a, b in zip(texts, at[:-1], at[1:]):
        assert ids[a:b].tolist() == library.encode_ordinary(text)
    assert len(asked) < 100  # a beginning of each text, and the new words by thousands
