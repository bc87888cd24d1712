import random
from itertools import combinations

import pytest

from ledgerline.llm import jaccard_join as q


def expected(rows, k, percent):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set())
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            parent[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        known = [x for x in (least.get(top(i)), doc_id) if x is not None]
        least[top(i)] = min(known, default=None)
    return sorted((str(rows[i][0]), len(sets[i]), str(least[top(i)])) for i in range(len(rows)))


def family(chance, n, size, changes):
    base = [f"w{chance.randrange(500)}" for _ in range(size)]
    for _ in range(n):
        own = list(base)
        for _ in range(chance.randrange(changes + 1)):
            own[chance.randrange(size)] = f"x{chance.randrange(10_000)}"
        yield " ".join(own)


@pytest.mark.parametrize("k, percent, seed", [(3, 90, 1), (5, 80, 2), (3, 50, 3)])
def test_against_brute_force(docs, k, percent, seed):
    chance = random.Random(seed)
    texts = [None, "", " \n", "One", "one", "one two", "ONE  two", "one two three", "é è ê ë"]
    for size, n in ((12, 10), (60, 40), (148, 60), (300, 10)):
        texts += family(chance, n, size, 8)
    rows = list(enumerate(texts)) + [(None, "one two three"), (5, "one two"), (5, "z y x w v u t s r q p o n")]
    chance.shuffle(rows)
    found = q.linked_groups(docs(rows), k=k, percent=percent).collect()
    assert sorted((str(r["doc_key"]), r["n"], str(r["component_id"])) for r in found) == expected(rows, k, percent)


def test_one_of_each(docs):
    chance = random.Random(5)
    rows = list(enumerate([*family(chance, 30, 200, 3), None, "", "", "a b", "a b"]))
    table = docs(rows)
    left = q.one_of_each(table)
    groups = {r["doc_key"]: r["component_id"] for r in q.linked_groups(table, k=5, percent=80).collect()}
    assert left.columns == table.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(set(groups.values()))
    assert q.one_of_each(docs([])).count() == 0


def test_rows_with_many_columns_of_their_own_still_link(docs):
    """Texts just above and below the similarity, beside copies that make no column common, and a very long text."""
    chance = random.Random(9)
    base = [f"b{i}" for i in range(402)]
    near = [*base[:390], *(f"n{i}" for i in range(12))]  # 388 of 412 columns
    far = [*base[:370], *(f"f{i}" for i in range(32))]  # 368 of 432 columns
    long = " ".join(f"w{chance.randrange(100_000)}" for _ in range(150_000))
    rows = list(enumerate([" ".join(base), " ".join(near), " ".join(far), long, long + " end", *[" ".join(far)] * 20]))
    found = {r["doc_key"]: r["component_id"] for r in q.linked_groups(docs(rows), k=3, percent=90).collect()}
    assert found == {0: 0, 1: 0, 2: 2, 3: 3, 4: 3, **{i: 2 for i in range(5, 25)}}


def test_clashing_columns_and_no_rows(ready, tmp_path):
    clash = ", ".join(f"'x' AS {name}" for name in ("node", "n", "at", "digest", "short", "component", "component_id", "body", "gram"))
    ready.sql(f"SELECT id AS doc_id, IF(id < 3, 'a b c d e f', CONCAT('t ', id)) AS text, {clash} FROM range(6)").write.parquet(f"{tmp_path}/t")
    table = ready.read.parquet(f"{tmp_path}/t")
    assert sorted(r["component_id"] for r in q.linked_groups(table).collect()) == [0, 0, 0, 3, 4, 5]
    left = q.one_of_each(table)
    assert left.columns == table.columns and sorted(r["doc_id"] for r in left.collect()) == [0, 3, 4, 5]
    assert q.linked_groups(table.where("doc_id < 0")).count() == 0
