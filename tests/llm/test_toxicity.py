"""The grammar on single sentences, the machine against its parts, and accuracy on rows that were not learned from."""

import random
import zlib

import numpy as np
import pytest

from ledgerline.llm import toxicity as tx

EMPTY = "doc_id bigint, quality int, toxic int, score string"


def matched(text, learned=None):
    found = dict(zip(tx.FEATURES, tx.Scanner(learned or {}).scan(text)))
    return {k for k in tx.KINDS if found[k] > 0}


@pytest.mark.parametrize("text, kinds", [
    ("you are an idiot", {"targeted"}),
    ("what an idiot", {"plain"}),
    ("idiot.", {"plain"}),
    ("he is not an idiot, she is kind", {"negated"}),
    ("she said he is an idiot", {"reported"}),
    ("the word \"idiot\" is old", {"reported"}),
    ("i will kill you", {"threat"}),
    ("i would never kill you", {"weak_threat"}),
    ("kill the process", set()),
    ("he said it. You moron", {"targeted"}),
    ("not bad; idiot", {"plain"}),
    ("Du bist ein Dummkopf, sagte Anna", {"targeted"}),
    ("tu n'es pas un connard", {"negated"}),
    ("eres un idiota", {"plain"}),
    ("idiotic lamp", set()),
    ("the lamp is on the table", set()),
    ("", set()),
])
def test_clauses(text, kinds):
    assert matched(text) == kinds


def test_learned_beginnings_cover_inflected_words():
    learned = {"lowei": 4.0, "loweiß ": 5.0}
    assert matched("der loweischaft", learned) == {"plain"}
    scan = tx.Scanner(learned).scan
    assert scan("loweiß")[tx.FEATURES.index("strongest")] == 5.0
    assert scan("xlowei")[tx.FEATURES.index("strongest")] == 0.0


def test_composed_machine_equals_the_machines_one_after_the_other():
    machines = [tx.Transducer((0,), tx._negation), tx.Transducer((False, False), tx._report), tx.Transducer((False, 0, 0), tx._clause)]
    table, rng = tx.grammar(), random.Random(4)
    for _ in range(200):
        states, row = [m.start for m in machines], 0
        for _ in range(40):
            read = symbol = rng.randrange(tx.STOP + 1)
            for i, m in enumerate(machines):
                states[i], symbol = m.step(states[i], symbol)
            row, out = table[row][read]
            assert out == symbol


def test_long_texts_in_chunks(monkeypatch):
    text = "the old lamp said nothing, you idiot! " * 400 + "x" * 5_000 + " not a moron"
    want = tx.Scanner({}).scan(text)
    monkeypatch.setattr(tx, "CHUNK", 97)
    assert "".join(tx.chunks(text)) == text
    assert tx.Scanner({}).scan(text) == want


def test_nulls_repeats_clashing_columns_and_empty_tables(ready):
    rows = [(1, "you idiot", "a", 1.0, 1), (1, None, "a", 1.0, 1), (None, "a moron", "a", 1.0, 1), (2, "", None, None, 0), (3, "y" * 300_000, "a", 1.0, 0)]
    schema = "doc_id bigint, text string, score string, held_out double, toxic int"
    docs = ready.createDataFrame(rows, schema)
    marks = ready.createDataFrame([(1, 1, 1, "x"), (1, 0, 0, "x"), (None, 1, 1, "x"), (3, 1, None, "x")], EMPTY)
    got = tx.scored(docs, marks).collect()
    assert len(got) == 5 and set(got[0].asDict()) == {"doc_id", "held_out", "score", "predicted"}
    by_text = {(r["doc_id"], round(r["score"], 6)) for r in got}
    assert len(by_text) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert {r["held_out"] for r in got if r["doc_id"] is None} == {False}
    assert tx.scored(docs.limit(0), marks).count() == 0
    assert tx.scored(docs, marks.limit(0)).count() == 5


def test_accuracy_on_rows_held_out(ready):
    """Labels of held-out rows may be anything: they change no score."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (ready.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = tx.scored(docs, labels).toPandas()
    assert (got["held_out"] == [zlib.crc32(str(k).encode()) % 3 == 1 for k in got["doc_id"]]).all()
    known = got.merge(labels.toPandas(), on="doc_id")
    known = known[known["held_out"]]
    toxic = known["toxic"].to_numpy() == 1
    rank = known["score"].rank().to_numpy()
    area = (rank[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    caught = (known["predicted"].to_numpy() == 1)
    assert area > 0.95 and caught[toxic].mean() > 0.8 and caught[~toxic].mean() < 0.01
    assert np.all((known["score"] >= 0.7) == (known["predicted"] == 1))
