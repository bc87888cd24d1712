"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Rows of the matrix are distinct sets of n-grams (copies share one), columns are n-grams hashed to 64 bits. Columns that
only one row has cannot add to an overlap, so a row with so many of them that no other can reach the similarity is
discarded before any product. They are counted exactly, by one aggregation over a share of the columns (those of small
hash): ``SPREAD`` times the share of a row that must be lost to miss the similarity.

Among the rows left all columns are counted, and the rows are multiplied in blocks of columns. The first block is each
row's head in one global order, rare columns before frequent ones, so long that rows which link must meet in it; it
gives candidate pairs, and pairs whose sizes or remaining columns cannot reach the bound are discarded there; a row
whose head is full of columns of its own takes no part. For the others overlap
counts are accumulated over the blocks ``CUTS`` of all columns, and after each block the pairs go whose overlap so far
and columns left cannot reach the bound.

Groups of near copies are not expanded into all their pairs. In each column the pair of every row with one pivot row
is taken first; what links becomes one component. Then come the pairs of rows that are still in different components.
Pairs within a component cannot change it, so membership is exact.

Tables that grow with the corpus are merged, never broadcast, so that the plan is the same at any size.

Texts without a word (null too) have no set and link with nothing. Rows with equal keys are rows of their own; a
component's id is its smallest key, null if all are null. A text of any length is one row of the matrix. An empty table
gives an empty one. Columns beside key and text are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import located, map_batches, numbered, stored, utf8, without
from ledgerline.llm.components import components

#: Counted share of the columns, as a multiple of the share of a row's columns that its head has.
SPREAD = 2
#: Ends of the blocks of columns, as eighths of the hashes. The first is small: most pairs that do not link go there.
CUTS = (1, 4, 8)
_PLACE_BITS = 25
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9], np.uint64)


class WordHashes(dict):
    """64-bit hash of a word, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def gram_set(text: bytes, k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the k-word n-grams of a text; of all its words if there are fewer."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < k:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    total = each[: len(words) - k + 1].copy()
    for i in range(1, k):
        total *= _MIX[0]
        total ^= total >> np.uint64(29)
        total += each[i : len(words) - k + 1 + i]
    total ^= total >> np.uint64(32)
    total *= _MIX[1]
    total ^= total >> np.uint64(29)
    return np.unique(total)


def _counted(percent: int) -> int:
    """Columns whose hash is at most this are counted."""
    return min((1 << 64) - 1, SPREAD * (100 - percent) * (1 << 64) // 100)


def _signatures(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [gram_set(text, k, hashes) for text in batch.column("b").to_pylist()]
            digests = [xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None for grams in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_key"), batch.column("at"), pa.array([len(grams) for grams in sets], pa.int64()),
                 pa.array(digests, pa.binary()), pa.array([d and _short(d) for d in digests], pa.int64())],
                ["doc_key", "at", "n", "digest", "short"])
    return run


def _short(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _columns(k: int, percent: int):
    """Counted columns of every text, each with the first half of its set's digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last = WordHashes(), np.uint64(_counted(percent))
        for batch in batches:
            sets = [s for s in (gram_set(text, k, hashes) for text in batch.column("b").to_pylist()) if len(s)]
            sizes = [int(np.searchsorted(grams, last, "right")) for grams in sets]
            if sum(sizes):
                grams = np.concatenate([grams[:size] for grams, size in zip(sets, sizes)]).view(np.int64)
                owners = np.array([_short(xxhash.xxh3_128_digest(whole.tobytes())) for whole in sets], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(np.repeat(owners, sizes))], ["gram", "short"])
    return run


def _able(rows: DataFrame, nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """Nodes without so many columns of their own that no other row can reach the similarity. Copies of a set count as
    one row, whichever tasks they are in. Nodes that share the half digest of another one are kept."""
    columns = map_batches(rows.select(utf8(F.col("body")).alias("b")), _columns(k, percent), "gram bigint, short bigint")
    own = columns.groupBy("gram").agg(F.min("short").alias("short"), F.max("short").alias("other")).where(
        "short = other").groupBy("short").agg(F.count("*").alias("own"))
    alone = nodes.groupBy("short").agg(F.count("*").alias("same"), F.min("n").alias("n")).where("same = 1").join(
        own.hint("merge"), "short").where(F.col("own") >= _needed(percent)).select("short")
    return nodes.join(alone.hint("merge"), "short", "left_anti")


def _needed(percent: int) -> Column:
    """Length of the head of a row of ``n`` columns: rows that link share a column among so many of each."""
    return F.expr(f"n - ({percent} * n + 99) div 100 + 1")


def _sets(k: int, bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, wanted = WordHashes(), np.frombuffer(bits.value, np.uint8)
        ends = np.array([(cut << 61) - 1 for cut in CUTS], np.uint64)
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            batch = batch.filter(pa.array((wanted[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1))
            blocks = [[] for _ in CUTS]
            for text in batch.column("b").to_pylist():
                grams = gram_set(text, k, hashes)
                parts = np.split(grams.view(np.int64), np.searchsorted(grams, ends[:-1], "right"))
                for block, part in zip(blocks, parts):
                    block.append(part)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("at"), *(pa.array(b, longs) for b in blocks)], ["at", *(f"block{i}" for i in range(len(CUTS)))])
    return run


def _sets_of(rows: DataFrame, signed: DataFrame, able: DataFrame, k: int) -> DataFrame:
    """Whole sets of the nodes in ``able``, by blocks. A bitmap of 2**25 places (4 MB, whatever the corpus) tells tasks
    which texts may be asked for, so that few others are taken and no text is shuffled."""
    spark, places = rows.sparkSession, 1 << _PLACE_BITS
    wanted = stored(signed.select(F.col("row_no").alias("node"), F.col("at").alias("place"), "n").join(
        able.select("node").hint("merge"), "node"), "wanted")
    slot = F.pmod(F.xxhash64("place"), F.lit(places))
    blocks = wanted.select(slot.alias("slot")).groupBy(F.shiftright("slot", 15).alias("block")).agg(
        F.bitmap_construct_agg((F.col("slot") % (1 << 15)).cast("int")).alias("bits")).collect()
    size, whole = (1 << 15) // 8, bytearray(places // 8)
    for block in blocks:
        whole[block["block"] * size : (block["block"] + 1) * size] = block["bits"]
    bits = spark.sparkContext.broadcast(bytes(whole))
    names = [f"block{i}" for i in range(len(CUTS))]
    sets = map_batches(
        rows.select("at", F.pmod(F.xxhash64("at"), F.lit(places)).alias("slot"), utf8(F.col("body")).alias("b")),
        _sets(k, bits), "at struct<path:string,row:bigint>, " + ", ".join(f"{name} array<bigint>" for name in names))
    return stored(sets.join(wanted.hint("merge"), F.col("at") == F.col("place")).select("node", "n", *names), "sets")


def _head_columns(sets: DataFrame, percent: int) -> DataFrame:
    """Columns of the heads that at least two rows have, with their position in the row's order (by count, then hash;
    columns of the row alone come first): ``gram``, ``node``, ``n``, ``pos``."""
    columns = sets.select("node", "n", F.explode(F.concat(*(f"block{i}" for i in range(len(CUTS))))).alias("gram"))
    several = stored(columns.groupBy("gram").agg(F.count("*").alias("rows")).where("rows > 1"), "grams")
    shared = columns.join(several.hint("merge"), "gram")
    of_node = Window.partitionBy("node")
    pos = F.col("n") - F.count("*").over(of_node) + F.row_number().over(of_node.orderBy("rows", "gram")) - 1
    return stored(shared.select("gram", "node", "n", pos.alias("pos")).where(F.col("pos") < _needed(percent)), "columns")


def _bounds(percent: int):
    """Pairs that meet in a column at places pos, pos2 and may still link: by their sizes, and by the columns left."""
    n, m = F.col("n"), F.col("n2")
    small, large = F.least(n, m), F.greatest(n, m)
    left = F.least(n - F.col("pos"), m - F.col("pos2"))
    return (100 * small >= percent * large) & ((100 + percent) * left >= percent * (n + m))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int, label: str) -> DataFrame:
    """Pairs of nodes whose whole overlap reaches the similarity: overlap counts are accumulated block by block, and
    pairs go as soon as the columns left, all of them shared, could not reach it."""
    counts = pairs.select("a", "b", *(F.lit(0).cast("long").alias(c) for c in ("overlap", "done_a", "done_b")))
    for i in range(len(CUTS)):
        block = sets.select("node", "n", F.col(f"block{i}").alias("part"))
        of_a = block.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("part").alias("part_a"))
        of_b = block.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("part").alias("part_b"))
        met = counts.join(of_a.hint("merge"), "a").join(of_b.hint("merge"), "b").select(
            "a", "b", "n_a", "n_b",
            (F.col("overlap") + F.size(F.array_intersect("part_a", "part_b"))).alias("overlap"),
            (F.col("done_a") + F.size("part_a")).alias("done_a"), (F.col("done_b") + F.size("part_b")).alias("done_b"))
        most = F.col("overlap") + F.least(F.col("n_a") - F.col("done_a"), F.col("n_b") - F.col("done_b"))
        counts = stored(met.where((100 + percent) * most >= percent * (F.col("n_a") + F.col("n_b"))).drop("n_a", "n_b"), f"{label}-{i}")
    return counts.select("a", "b")


def linked_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 3, percent: int = 90) -> DataFrame:
    """One row per document: ``doc_key``, its locator ``at``, ``n`` (size of its set), ``component`` (a number, null
    without a set) and ``component_id`` (smallest key reached by links)."""
    rows = located(docs, key, text)
    kind = rows.schema["doc_key"].dataType.simpleString()
    signed = numbered(map_batches(
        rows.select("doc_key", "at", utf8(F.col("body")).alias("b")), _signatures(k),
        f"doc_key {kind}, at struct<path:string,row:bigint>, n bigint, digest binary, short bigint"), "signatures")
    nodes = stored(signed.where("n > 0").groupBy("digest").agg(
        F.min("row_no").alias("node"), F.min("doc_key").alias("least"), F.first("n").alias("n"), F.first("short").alias("short")), "nodes")
    sets = _sets_of(rows, signed, _able(rows, nodes, k, percent), k)

    order = F.col("pos") * F.lit(1 << 32) + F.pmod(F.xxhash64("node"), F.lit(1 << 32))
    shared = _head_columns(sets, percent)
    pivots = stored(shared.groupBy("gram").agg(
        F.min_by("node", order).alias("pivot"), F.min_by("n", order).alias("n2"), F.min_by("pos", order).alias("pos2")), "pivots")

    stars = stored(shared.join(pivots.hint("merge"), "gram").where((F.col("node") != F.col("pivot")) & _bounds(percent)).select(
        F.col("node").alias("a"), F.col("pivot").alias("b")).distinct(), "stars")
    found = _linked(stars, sets, percent, "star-links")
    member = components(found, "star")

    placed = stored(shared.join(member.hint("merge"), "node", "left").withColumn("component", F.coalesce("component", "node")), "placed")
    mixed = stored(placed.groupBy("gram").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where(
        "lo < hi").select("gram"), "mixed-grams")
    placed = stored(placed.join(mixed.hint("merge"), "gram", "left_semi"), "mixed")
    main = placed.join(pivots.select("gram", "pivot").hint("merge"), "gram").where("node = pivot").select("gram", "pivot", F.col("component").alias("main"))
    outside = stored(placed.join(stored(main, "mains"), "gram").where("component != main"), "outside")
    other = placed.select(
        "gram", F.col("node").alias("b"), F.col("n").alias("n2"), F.col("pos").alias("pos2"), F.col("component").alias("component2"))
    met = outside.join(other, "gram").where(
        (F.col("component") != F.col("component2")) & (F.col("b") != F.col("pivot")) & (F.col("node") != F.col("pivot"))
        & _bounds(percent) & ((F.col("node") < F.col("b")) | (F.col("component2") == F.col("main"))))
    across = stored(met.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct(), "across")
    links = found.unionByName(_linked(across, sets, percent, "cross-links"))
    member = components(links, "all")

    named = nodes.join(member, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_set = stored(named.join(least, "component").select("digest", "component", "component_id"), "members")
    return signed.select("doc_key", "at", "n", "digest").join(of_set.hint("merge"), "digest", "left").select(
        "doc_key", "at", "n", "component",
        F.when(F.col("component").isNull(), F.col("doc_key")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """``docs``, read from Parquet, with one row of each linked group: the smallest key, then the first locator."""
    rows = stored(linked_groups(docs, key, text, k, percent).where(F.col("component").isNotNull()), "groups")
    smallest = F.col("doc_key").eqNullSafe(F.col("component_id"))
    least = stored(rows.where(smallest), "smallest")  # one row of a group, more only where keys repeat
    first = least.groupBy("component").agg(F.min("at").alias("first"))
    again = least.join(first.hint("merge"), "component").where(F.col("at") != F.col("first"))
    return without(docs, rows.where(~smallest).select("at").unionByName(again.select("at")))
