"""Prefix trie of conversations, rolled up by centroids.

Every conversation is rebuilt from the first turns of its donor and its own later turns. A node of the trie is a
sequence of first turns; it is known by its depth and by two 64-bit numbers, each the exclusive-or of the hashes of
(place, role, text) of its turns, so a node's key follows from running totals and its parent's key from its own. Nodes
come from one grouping of the keys.

What concerns a whole subtree (leaves, saved tokens) is rolled up along the parent edges by *centroid decomposition*: the
centroid of a component is the deepest node with more than half of it at or below it; the component's total below the
centroid is added to every node from there up to the component's top; without the centroid the component falls into
parts of at most half its size, which are split in turn. Every pair of a node and one of its ancestors is separated by
exactly one centroid between them, so the totals are exact, and long chains cost no more rounds than bushy trees.

Components that one task cannot hold are cut first: a node is heavy if the paths below it have more than ``limit`` nodes.
The subtrees below heavy nodes are components of their own, a task holds some of them at a time, and only their totals go
up to the heavy nodes, which are the tree of the next round.

Null role and text count as empty; rows without a conversation are left out; a null turn comes first, equal turns are
ordered by the MD5 of role and text, and equal rows are separate turns. Conversations are whole numbers. One
conversation, or one first turn, may hold any share of the rows; long texts travel as hashes. Columns other than the
four are never looked at. An empty table has no nodes, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_batches, stored
from ledgerline.llm.running import ADD, XOR, running

KEY = ["d", "k1", "k2"]
LIMIT = 100_000  # nodes that a task decomposes at a time
HELD = 20_000  # rows of small components that are decomposed together
COPIED = 100_000  # heavy nodes up to which their table is copied to every task
PACKED = 1_000  # conversations whose numbers travel as one text
HEADS = 5  # a donor gives fewer than six turns


def turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``turn``, digest of role and text, ``chars``: what the trie needs of a turn."""
    said, body = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    return conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"),
        F.md5(F.concat(F.char_length(said).cast("string"), F.lit(":"), said, body)).alias("digest"),
        F.char_length(body).cast("bigint").alias("chars"), F.lit(1).cast("bigint").alias("one"))


def rebuilt(turns_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations after rebuilding: their turns (``conv_id``, ``d`` from 1, ``digest``, ``chars``, ``k``) and one
    row per conversation with its number of turns ``k``."""
    own = running(stored(turns_, "turns"), "conv_id", ["turn", "digest"], {"pos": ("one", ADD)}, "placed")
    convs = own.groupBy("conv_id").agg(F.max("pos").alias("n"))
    donors = convs.where(F.col("conv_id") % 100 == 0).select(F.col("conv_id").alias("donor"), F.least("n", F.lit(HEADS)).alias("heads"))
    wanted = convs.withColumns({"donor": F.col("conv_id") - F.col("conv_id") % 100,
                                "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6})
    plan = wanted.join(donors.hint("merge"), "donor", "left").withColumn("head", F.least("h", F.coalesce("heads", F.lit(0))))
    plan = stored(plan.select("conv_id", "donor", "h", "head", (F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("k")), "plan")
    after = own.join(plan.hint("merge"), "conv_id").where("pos > h").select(
        "conv_id", (F.col("head") + F.col("pos") - F.col("h")).alias("d"), "digest", "chars", "k")
    heads = own.where((F.col("conv_id") % 100 == 0) & (F.col("pos") <= HEADS)).select(
        F.col("conv_id").alias("donor"), F.col("pos").alias("d"), "digest", "chars")
    given = plan.join(heads.hint("merge"), "donor").where("d <= h").select("conv_id", "d", "digest", "chars", "k")
    return after.unionByName(given), plan.select("conv_id", "k")


def paths(turns_: DataFrame) -> DataFrame:
    """A row per conversation and depth, from the root (0): node key ``d``, ``k1``, ``k2``, parent's ``p1``, ``p2``."""
    said, convs = rebuilt(turns_)
    hashed = stored(said.select("conv_id", "d", F.xxhash64("d", "digest").alias("x1"), F.xxhash64("digest", "d").alias("x2"),
                                "chars", "k"), "rebuilt")
    nodes = running(hashed, "conv_id", ["d"], {"k1": ("x1", XOR), "k2": ("x2", XOR)}, "keyed").select(
        "conv_id", *KEY, F.col("k1").bitwiseXOR(F.col("x1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("x2")).alias("p2"), "chars", "k")
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    roots = convs.select("conv_id", *[zero.alias(c) for c in KEY], none.alias("p1"), none.alias("p2"), zero.alias("chars"), "k")
    return stored(nodes.unionByName(roots), "paths")


def subtree_totals(parent: list[int], weights: list[list[int]]) -> list[list[int]]:
    """Sums of each list of weights over the subtree of every node of a forest, by centroid decomposition.

    ``parent`` has the parent's place, -1 for none; parents stand before their children.
    """
    n = len(parent)
    totals, below = [[0] * n for _ in weights], [[0] * n for _ in weights]
    size, part = [0] * n, [None] * n
    trees: dict[int, list[int]] = {}
    for v, p in enumerate(parent):
        part[v] = trees.setdefault(v, []) if p < 0 else part[p]
        part[v].append(v)
    split = list(trees.values())
    while split:
        nodes = split.pop()
        top = nodes[0]
        if len(nodes) == 1:
            for total, weight in zip(totals, weights):
                total[top] += weight[top]
            continue
        for v in nodes:
            size[v] = 1
        for some, weight in zip(below, weights):
            for v in nodes:
                some[v] = weight[v]
            for v in nodes[:0:-1]:
                some[parent[v]] += some[v]
        for v in nodes[:0:-1]:
            size[parent[v]] += size[v]
        half = len(nodes)
        centroid = next(v for v in reversed(nodes) if 2 * size[v] > half)
        for total, some in zip(totals, below):
            share, v = some[centroid], centroid
            total[v] += share
            while v != top:
                v = parent[v]
                total[v] += share
        upper: list[int] = []
        for v in nodes:
            if v == centroid:
                continue
            if v == top:
                part[v] = upper
            elif parent[v] == centroid:
                part[v] = []
                split.append(part[v])
            else:
                part[v] = part[parent[v]]
            part[v].append(v)
        if upper:
            split.append(upper)
    return totals


_NODE = "d bigint, k1 bigint, k2 bigint, p1 bigint, p2 bigint, conv_id bigint, n_convs bigint"
_ROLLED = f"{_NODE}, top boolean, parent_conv_id bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"


def _decomposed(rows: pa.Table) -> pa.RecordBatch:
    """Whole components, parents before children, with their totals."""
    columns = {c: rows.column(c).to_pylist() for c in ("d", "k1", "k2", "p1", "p2", "conv_id", "own", "children", "leaves", "saved", "above")}
    at = {key: v for v, key in enumerate(zip(columns["d"], columns["k1"], columns["k2"]))}
    parent = [at.get((d - 1, p1, p2), -1) for d, p1, p2 in zip(columns["d"], columns["p1"], columns["p2"])]
    children = list(columns["children"])
    for p in parent:
        if p >= 0:
            children[p] += 1
    leaves = [more + (not n) for more, n in zip(columns["leaves"], children)]
    saved = [more + own for more, own in zip(columns["saved"], columns["own"])]
    leaves, saved = subtree_totals(parent, [leaves, saved])
    convs = columns["conv_id"]
    whole = {
        **{c: rows.column(c).combine_chunks() for c in ("d", "k1", "k2", "p1", "p2", "conv_id", "n_convs")},
        "top": pa.array([p < 0 for p in parent]),
        "parent_conv_id": pa.array([above if p < 0 else convs[p] for p, above in zip(parent, columns["above"])], pa.int64()),
        "n_children": pa.array(children, pa.int64()), "n_leaves": pa.array(leaves, pa.int64()), "saved_tokens": pa.array(saved, pa.int64()),
    }
    return pa.RecordBatch.from_pydict(whole)


def _components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts the sorted rows where a component ends, some small components at a time."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        if sum(b.num_rows for b in waiting) < HELD:
            continue
        rows = pa.Table.from_batches(waiting)
        b1, b2 = (rows.column(c).to_numpy() for c in ("b1", "b2"))
        borders = np.flatnonzero((b1[1:] != b1[:-1]) | (b2[1:] != b2[:-1]))
        if len(borders):
            cut = int(borders[-1]) + 1
            yield _decomposed(rows.slice(0, cut))
            waiting = rows.slice(cut).combine_chunks().to_batches()
    if waiting and sum(b.num_rows for b in waiting):
        yield _decomposed(pa.Table.from_batches(waiting))


def _sized() -> list[Column]:
    """Of a node: nodes of all paths at or below it, at least as many as its subtree has; and the first of these paths."""
    return [F.sum(F.col("k") - F.col("d") + 1).alias("size"), F.min("conv_id").alias("path")]


def _rolled(nodes: DataFrame) -> DataFrame:
    """Nodes with their component (``b0``, ``b1``, ``b2``) and what was added from below; ``above`` is known of tops."""
    dealt = nodes.repartition("b1", "b2").sortWithinPartitions("b1", "b2", "b0", "d")
    return stored(map_batches(dealt, _components, _ROLLED), "rolled")


def rolled_up(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The nodes of the paths with ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``parent_conv_id``."""
    nodes = stored(rows.groupBy(*KEY).agg(
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        F.max("chars").alias("chars"), *_sized()), "nodes")
    nodes = nodes.withColumn("own", (F.col("n_convs") - 1) * F.col("chars")).drop("chars").withColumns(
        {c: F.lit(0).cast("bigint") for c in ("children", "leaves", "saved")})
    done = []
    while True:
        heavy = nodes.where(F.col("size") > limit)
        n_heavy = heavy.count()
        if not n_heavy:
            zero = F.lit(0).cast("bigint")
            done.append(_rolled(nodes.withColumns({"b0": zero, "b1": zero, "b2": zero, "above": F.lit(None).cast("bigint")})))
            break
        known = heavy.select(*KEY, F.col("conv_id").alias("heavy"))
        marked = rows.join(F.broadcast(known) if n_heavy <= COPIED else known.hint("merge"), KEY, "left")
        light_d = F.when(F.col("heavy").isNull(), F.col("d"))
        of_path = marked.groupBy(F.col("conv_id").alias("path")).agg(
            F.min(light_d).alias("b0"), F.min_by("k1", light_d).alias("b1"), F.min_by("k2", light_d).alias("b2"),
            F.max_by("heavy", F.when(F.col("heavy").isNotNull(), F.col("d"))).alias("above"))
        light = nodes.where(F.col("size") <= limit).join(of_path.hint("merge"), "path")
        level = _rolled(light)
        done.append(level)
        up = level.where("top").groupBy((F.col("d") - 1).alias("d"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
            F.count("*").alias("_children"), F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved"))
        more = {c: F.col(c) + F.coalesce(f"_{c}", F.lit(0)) for c in ("children", "leaves", "saved")}
        left = heavy.join(up.hint("merge"), KEY, "left").withColumns(more).drop("_children", "_leaves", "_saved")
        if n_heavy <= limit:  # one component
            nodes = stored(left.withColumn("size", F.lit(1).cast("bigint")), "heavy")
            continue
        # the heavy nodes are the trie of the paths to those heavy nodes that have no heavy child
        parents = heavy.select((F.col("d") - 1).alias("d"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).distinct()
        ends = heavy.join(parents.hint("merge"), KEY, "left_anti").select(F.col("path").alias("conv_id"), F.col("d").alias("k"))
        rows = stored(rows.drop("k").join(ends.hint("merge"), "conv_id").where("d <= k"), "heavy-paths")
        nodes = stored(left.drop("size", "path").join(rows.groupBy(*KEY).agg(*_sized()).hint("merge"), KEY), "heavy")
    whole = done[0]
    for level in done[1:]:
        whole = whole.unionByName(level)
    return whole.drop("p1", "p2", "top")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, ids = [batch.column(c).to_numpy() for c in KEY], batch.column("conv_id").to_numpy()
        if not len(ids):
            continue
        new = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        edges = [0, *new.tolist(), len(ids)]
        starts = [s for a, b in zip(edges, edges[1:]) for s in range(a, b, PACKED)]
        ends = [*starts[1:], len(ids)]
        yield pa.record_batch({
            **{c: pa.array(k[starts]) for c, k in zip(KEY, keys)}, "first": pa.array(ids[starts]),
            "ids": pa.array([",".join(map(str, ids[a:b].tolist())) for a, b in zip(starts, ends)])})


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, digest = None, None
    for batch in batches:
        out = []
        for d, k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids"))):
            if (d, k1, k2) == last:
                digest.update(b"," + ids.encode())
                continue
            if last is not None:
                out.append((*last, digest.hexdigest()))
            last, digest = (d, k1, k2), hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_pylist([dict(zip((*KEY, "ends_sha256"), r)) for r in out], _ENDS)
    if last is not None:
        yield pa.RecordBatch.from_pylist([dict(zip((*KEY, "ends_sha256"), (*last, digest.hexdigest())))], _ENDS)


_ENDS = pa.schema([*((c, pa.int64()) for c in KEY), ("ends_sha256", pa.string())])


def end_digests(rows: DataFrame) -> DataFrame:
    """SHA-256 of the conversations that end at a node, ascending, joined by commas; nodes without any are left out.

    Numbers are sorted in ranges, so the ends of one node lie in many tasks; they meet packed, a thousand to a row, and
    are hashed one row after the other.
    """
    ends = stored(rows.where("d = k").select(*KEY, "conv_id"), "ends")
    packed = map_batches(ends.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id"), _packed,
                         "d bigint, k1 bigint, k2 bigint, first bigint, ids string")
    dealt = packed.repartition("k1", "k2").sortWithinPartitions(*KEY, "first")
    return map_batches(dealt, _digests, "d bigint, k1 bigint, k2 bigint, ends_sha256 string")


def trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
         limit: int = LIMIT) -> DataFrame:
    """A row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    rows = paths(turns(conversations, conv, turn, role, text))
    nodes = rolled_up(rows, limit).join(end_digests(rows).hint("merge"), KEY, "left")
    return nodes.select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))
