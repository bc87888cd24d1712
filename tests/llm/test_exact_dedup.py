import re
from collections import defaultdict

from pyspark.sql import functions as F

from ledgerline.llm import exact_dedup as q


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((len(text or ""), doc_id))
    out = {}
    for group in groups.values():
        keep = min(group, key=lambda g: (-g[0], g[1]))[1]
        out.update({doc_id: (keep, len(group)) for _, doc_id in group})
    return out


ROWS = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "ab"), (6, "a  b"), (7, "é x"), (8, "éx "), (9, "z" * 50_000), (10, "A b")]


def test_groups(docs):
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in q.duplicates(docs(ROWS)).collect()}
    assert got == expected(ROWS)


def test_collisions_are_found_by_whole_text(docs, texts):
    rows = ROWS + [(100 + i, t) for i, t in texts.items()]
    found = q.duplicates(docs(rows), digest=lambda t: F.substring(q.sha256(t), 1, 1))
    assert {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in found.collect()} == expected(rows)


def test_repeated_rows_and_null_keys(docs):
    rows = q.duplicates(docs([(1, "a"), (1, "a"), (None, "a "), (None, "b")])).collect()
    assert sum(r["kept"] for r in rows) == 2 and len(rows) == 4
    assert sorted((str(r["keep_id"]), r["group_size"]) for r in rows) == [("None", 1), ("None", 3), ("None", 3), ("None", 3)]


def test_kept_only_keeps_columns(docs):
    table = docs(ROWS)
    left = q.kept_only(table)
    assert left.columns == table.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted({k for k, _ in expected(ROWS).values()})
    assert q.kept_only(docs([])).count() == 0


def test_state_goes_on_after_a_restart(ready, docs, root):
    """Two deliveries into one state, as after a restart, give the state of one."""
    folder, state = f"{root}/entries", f"{root}/state"
    for rows in (ROWS[:5], ROWS[5:]):
        q.entries(q.located(docs(rows), "doc_id", "text")).write.mode("append").parquet(folder)
        held = q.absorb(ready, folder, ready.read.parquet(folder).schema, state)
    got = {r["digest"]: (r["n_rows"], ~r["best"]["inverse_key"]) for r in held.collect()}
    assert sorted(got.values()) == sorted({(size, keep) for keep, size in expected(ROWS).values()})


def test_no_python_in_plans(docs):
    plan = q.duplicates(docs(ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
