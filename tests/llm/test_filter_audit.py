"""The audit against counting every document through every order, one filter after the other."""

from itertools import permutations

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import filter_audit

SCHEMA = "doc_id bigint, text string, source string, mask int, part string, digest string"
LABELS = "doc_id bigint, quality int, toxic int, good boolean"
WORDS = " ".join(f"word{i}" for i in range(200))


def by_hand(rows, labels):
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    docs = []
    for key, text, source in rows:
        text = text or ""
        words = text.encode().split()
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text):
            fails.add("C")
        if set(text) & set("#$%&*|"):
            fails.add("D")
        if key is not None and any(k is not None and k < key and (t or "") == text for k, t, _ in rows):
            fails.add("E")
        docs.append((source or "", key, fails))
    out = {}
    for part in {d[0] for d in docs}:
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = [d for d in docs if d[0] == part]
            everyone = list(left)
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[2]]
                left = [d for d in left if letter not in d[2]]
                failing = [d for d in everyone if letter in d[2]]
                shapley[letter] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(failing) - len(gone), sum(d[2] == {letter} for d in everyone),
                    sum(d[1] in good for d in gone), sum(d[1] in toxic for d in gone), letter]
        for (p, *_), values in out.items():
            if p == part:
                values[-1] = shapley[values[-1]]
    return {k: tuple(v) for k, v in out.items()}


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(k, t, s, -1, "x", "y") for k, t, s in rows], SCHEMA)
    marks = spark.createDataFrame([(*x, True) for x in labels], LABELS)
    got = filter_audit.audit(docs, marks).collect()
    assert len(got) == len({(r["part"], r["filter_order"], r["step"]) for r in got})
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in (*filter_audit.COUNTS, "shapley")) for r in got}


def test_counts_of_every_order_and_clashing_columns(ready):
    rows = [
        (1, WORDS, "a"), (2, WORDS, "a"), (3, WORDS, "b"), (2, WORDS, "a"), (1, WORDS, "b"), (None, WORDS, "a"),
        (None, None, None), (4, None, None), (5, "", ""), (6, "ÄÖÜ 🙂 $ " * 300, "a"), (7, "UPPER " * 250, "b"),
        (8, " \x0b\x0c\x1c short", "a"), (9, WORDS + " #", "a"), (10, "x" * 300_000, "a"), (11, "word " * 60_000, "b"),
    ]
    labels = [(1, 1, 1), (2, 0, 1), (2, 1, 0), (3, 1, None), (7, None, 1), (99, 1, 1), (None, 1, 1), (10, 1, 0)]
    assert audited(ready, rows, labels) == by_hand(rows, labels)


def test_empty_tables(ready):
    assert audited(ready, [], []) == {}
    assert audited(ready, [(1, "a", "s")], []) == by_hand([(1, "a", "s")], [])


@pytest.mark.parametrize("rows", [1, 7, 8, 10**12])
def test_fields_never_run_over(rows):
    counters = filter_audit.PackedCounters(rows)
    for mask in (0, 1, 31):
        fields = counters.unpacked(counters.packed(mask, True, False) * rows)
        assert fields == [int(x) * rows for o in counters.outcomes(mask, True, False) for x in o]


def test_a_hot_text_is_counted_before_it_is_shuffled(ready):
    docs = ready.range(0, 20_000, 1, 8).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit(WORDS)).otherwise(F.concat(F.lit("t "), "id")).alias("text"),
        F.lit("s").alias("source"))
    labels = docs.where("doc_id % 2 = 0").select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    got = filter_audit.audit(docs, labels).where("filter_order = 'EABCD' AND step = 1").first()
    assert (got["kept"], got["removed"], got["unique_fails"]) == (13_334, 6_666, 6_666)
    assert got["good_lost"] == sum(1 for i in range(3, 20_000, 3) if i % 2 == 0)
