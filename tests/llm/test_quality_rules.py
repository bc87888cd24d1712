import random
import re

import numpy as np
import pytest

from ledgerline.llm import quality_rules as q


def slow_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def test_statistics_match_brute_force():
    chance = random.Random(3)
    texts = ["", " \n\t", "é ü x", "a b c d e a b c d e", "one two\none two\n\none two", "a " * 40]
    texts += ["".join(chance.choice(["a ", "b ", "c\n", "## ", "é\t", "\x0b"]) for _ in range(chance.randrange(60))) for _ in range(200)]
    for text in texts:
        assert q.statistics_of(text.encode())[:5] == slow_statistics(text), text


def test_learned_rules_separate():
    chance = np.random.default_rng(1)
    rows = {f: chance.random(900) for f in q.FEATURES}
    bad = (rows["symbol_share"] > 0.8) | ((rows["n_words"] < 0.3) & (rows["upper_share"] > 0.6))
    found = q.cover(rows, bad)
    verdict = np.zeros(900, bool)
    for rule in found.rules:
        verdict |= q._covered(rule, rows, 900)
    assert (verdict & ~bad).sum() <= 9 and (verdict & bad).sum() > 0.9 * bad.sum()


def test_query(ready, sf, texts):
    from ledgerline.llm.queries import REGISTRY

    rows = REGISTRY["op1_quality_rules"](ready, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        s = slow_statistics(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == s
        failed = s[0] < 10 or 100 * s[4] > 20 * s[0]
        assert r["base_failed"] == failed and r["kept"] == (not failed and r["rule"] == 0)


def test_held_out_accuracy(ready):
    """Rules learned on half the labels judge the other half."""
    folder = "/root/testdata/sf0.1"
    docs, labels = ready.read.parquet(f"{folder}/documents.parquet"), ready.read.parquet(f"{folder}/labels.parquet")
    judged = q.judged(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id")
    n = {(r["quality"], r["kept"]): r["count"] for r in judged.where("NOT base_failed").groupBy("quality", "kept").count().collect()}
    assert n.get((0, False), 0) > 0.9 * (n.get((0, False), 0) + n.get((0, True), 0))
    assert n.get((1, False), 0) < 0.01 * n[(1, True)]


@pytest.mark.parametrize("labelled", [[], [(1, 1, 0)], [(1, None, None), (None, 0, 0)]])
def test_odd_rows(ready, docs, labelled):
    table = docs([(1, None), (None, "x"), (2, ""), (2, ""), (3, "a b c d e f g h i j k l m n"), (4, "w" * 100_000)])
    labels = ready.createDataFrame(labelled, "doc_id bigint, quality int, toxic int")
    rows = q.judged(table, labels).collect()
    assert len(rows) == 6 and [r["doc_id"] for r in rows if r["kept"]] == [3]
    kept = q.filtered(table.withColumn("n_words", table.doc_id), labels)
    assert kept.columns == [*table.columns, "n_words"] and [r["doc_id"] for r in kept.collect()] == [3]
    assert q.judged(table.limit(0), labels).count() == 0
