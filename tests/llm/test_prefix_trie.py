"""The trie against rebuilding every conversation and walking over all pairs of nodes."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import prefix_trie, running

# columns that clash with names the operator uses inside
SCHEMA = "conv_id bigint, turn bigint, role string, text string, d int, k1 string, digest string, pos double, k int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y", 0.5, 2) for r in rows], SCHEMA)


def by_hand(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, digest, (role, text)))
    said = {c: [x[-1] for x in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in said.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(said.get(c - c % 100, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    out = {}
    for node, convs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        ends = sorted(c for c in convs if len(whole[c]) == len(node))
        out[min(convs), len(node)] = (
            min(members[node[:-1]]) if node else None, len(convs), sum(len(n) == len(node) + 1 for n in below),
            sum(not any(len(m) == len(n) + 1 and m[:len(n)] == n for m in below) for n in below),
            sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
    return out


def nodes(df):
    got = df.collect()
    found = {(r["conv_id"], r["depth"]): tuple(r[c] for c in (
        "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")) for r in got}
    assert len(found) == len(got)
    return found


def conversations(seed, convs, words, longest):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]), rng.choice(words))
            for c in convs for t in range(rng.randint(1, longest))]


@pytest.mark.parametrize("limit", [100_000, 40, 3])
def test_small_tries_however_they_are_cut(ready, limit):
    rows = conversations(limit, [*range(0, 40), *range(300, 330), 199, 256], ["a", "bb", "c c"], 9)
    random.Random(1).shuffle(rows)
    assert nodes(prefix_trie.trie(table(ready, rows), limit=limit)) == by_hand(rows)


def test_nulls_ties_and_long_texts(ready):
    rows = [
        (100, None, None, None), (100, 1, "user", "x" * 300_000), (100, 1, "user", "b"), (100, 1, "user", "b"),
        (101, 2, "user", ""), (101, None, "", "a"), (102, 1, "user", "x" * 300_000), (None, 1, "user", "lost"),
        (103, 1, "user", "b"), (250, 1, None, "donor is missing"), (250, 2, "user", "🙂é"), (2**40, 1, "a", "b"),
    ]
    assert nodes(prefix_trie.trie(table(ready, rows))) == by_hand(rows)


def test_empty(ready):
    assert nodes(prefix_trie.trie(table(ready, []))) == {}


def test_hot_conversation_and_hot_first_turn(ready):
    """One conversation has a third of the turns, one first turn most of the conversations; heavy nodes need two rounds."""
    rows = [(0, t, "user", f"t{t % 7}") for t in range(700)]
    rows += [(c, t, "user", "same" if t < 6 else f"{c % 5}") for c in range(100, 250) for t in range(8)]
    got = nodes(prefix_trie.trie(table(ready, rows).repartition(8), limit=200))
    assert got == by_hand(rows)


def test_totals_of_forests_by_centroids():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randint(1, 60)
        shape = rng.random()
        parent = [-1] + [-1 if rng.random() < 0.1 else (v - 1 if rng.random() < shape else rng.randrange(v)) for v in range(1, n)]
        weights = [[rng.randint(0, 9) for _ in range(n)] for _ in range(2)]
        want = [list(w) for w in weights]
        for v in range(n - 1, 0, -1):
            if parent[v] >= 0:
                for w in want:
                    w[parent[v]] += w[v]
        assert prefix_trie.subtree_totals(parent, weights) == want
    chain = prefix_trie.subtree_totals([-1, *range(99_999)], [[1] * 100_000])
    assert chain == [list(range(100_000, 0, -1))]


def test_running_totals_over_split_groups(ready):
    rng = np.random.default_rng(3)
    keys = np.sort(np.where(rng.random(4_000) < 0.4, 7, rng.integers(0, 30, 4_000)))
    rows = [(int(k), i, int(v)) for i, (k, v) in enumerate(zip(keys, rng.integers(-2**62, 2**62, 4_000)))]
    df = ready.createDataFrame(rows, "g bigint, at bigint, v bigint").repartition(8)
    ready.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = running.running(df.withColumn("one", F.lit(1).cast("bigint")), "g", ["at"],
                              {"n": ("one", running.ADD), "x": ("v", running.XOR)}, "test")
        got = {r["at"]: (r["n"], r["x"]) for r in out.collect()}
    finally:
        ready.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    state = defaultdict(lambda: [0, 0])
    for k, at, v in rows:
        state[k][0] += 1
        state[k][1] ^= v
        assert got[at] == tuple(state[k])
