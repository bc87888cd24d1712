"""Filter interaction audit: what each filter takes away in every order in which the filters could run.

A document is a *mask*: bit i is set where filter i rejects it. For each of the n! orders and each of its n steps a
mask has outcomes of 0 or 1 (kept after the step, removed there, ...). They are the fields of one big integer per mask,
wide enough for the number of documents of the part. The integers of a part are added, once per document, and the sum is
unpacked: one addition counts all n! x n steps. Equal masks are counted first, so that a part, however large, is at most
``2**n`` masks x 4 kinds of labels where it is added up.

Null text counts as empty, a null part as the empty string. Of equal texts the smallest key is the original; rows that
repeat this key with the same text are originals too. A row without a key has no labels, is never a copy and makes none.
A key that is labelled more than once is good (toxic) if any of its labels says so. Keys are whole numbers; very long
texts are read whole, batch by batch; columns other than the named ones are never looked at. An empty table has no parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.common import map_batches, stored, utf8

#: The filters in the order of the mask's bits; the last one, copies, looks at all texts.
FILTERS = "ABCDE"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
SALTS = 1024
_NOT_UPPER = bytes(set(range(256)) - set(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
_NOT_SYMBOL = bytes(set(range(256)) - set(b"#$%&*|"))
_INSIDE = bytes(range(0x80, 0xC0))  # bytes of a code point after its first


def text_mask(data: bytes) -> int:
    """Bits of the filters that look at one text: few words, few different words, many capitals, symbols."""
    words = data.split()
    upper, points = len(data.translate(None, _NOT_UPPER)), len(data.translate(None, _INSIDE))
    return ((len(words) < 200) | (100 * len(set(words)) < 50 * len(words)) << 1
            | (100 * upper > 2 * points) << 2 | bool(data.translate(None, _NOT_SYMBOL)) << 3)


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = {name: batch.column(name) for name in ("doc_key", "part", "digest")}
        masks = [text_mask(t.as_py()) for t in batch.column("body")]
        yield pa.record_batch({**columns, "mask": pa.array(masks, pa.int32())})


class PackedCounters:
    """Fields of ``width`` bits, one for each order, step and count, in one integer per mask."""

    def __init__(self, rows: int, filters: str = FILTERS):
        self.filters, self.width = filters, max(rows, 1).bit_length()
        self.orders = ["".join(p) for p in permutations(filters)]
        self._of: dict[tuple[int, bool, bool], int] = {}

    def outcomes(self, mask: int, good: bool, toxic: bool) -> Iterator[tuple[int, ...]]:
        """The six outcomes of one document for each order and step."""
        for order in self.orders:
            gone = False
            for letter in order:
                bit = 1 << self.filters.index(letter)
                fails = bool(mask & bit)
                removed, redundant = fails and not gone, fails and gone
                gone |= fails
                yield not gone, removed, redundant, mask == bit, removed and good, removed and toxic

    def packed(self, mask: int, good: bool, toxic: bool) -> int:
        key = mask, good, toxic
        if key not in self._of:
            bits = "".join(format(int(x), f"0{self.width}b") for o in self.outcomes(*key) for x in o)
            self._of[key] = int(bits, 2)
        return self._of[key]

    def unpacked(self, total: int) -> list[int]:
        """All fields of a sum of at most ``rows`` integers: none can have run over into its neighbour."""
        fields = len(self.orders) * len(self.filters) * len(COUNTS)
        bits = format(total, f"0{fields * self.width}b")
        return [int(bits[i:i + self.width], 2) for i in range(0, len(bits), self.width)]


def _added(table: pa.Table) -> pa.Table:
    """One part: its masks (at most 128 rows) are packed, added and unpacked."""
    rows = table.to_pylist()
    counters = PackedCounters(sum(r["n"] for r in rows))
    total = sum(counters.packed(r["mask"], r["good"], r["toxic"]) * r["n"] for r in rows)
    fields, steps = counters.unpacked(total), len(FILTERS)
    counts = {name: fields[i::len(COUNTS)] for i, name in enumerate(COUNTS)}
    letters = [letter for order in counters.orders for letter in order]
    shapley = dict.fromkeys(FILTERS, 0)
    for letter, removed in zip(letters, counts["removed"]):
        shapley[letter] += removed
    return pa.table({
        "part": pa.array([rows[0]["part"]] * len(letters), pa.string()),
        "filter_order": [order for order in counters.orders for _ in range(steps)],
        "step": pa.array([*range(1, steps + 1)] * len(counters.orders), pa.int32()),
        **{name: pa.array(values, pa.int64()) for name, values in counts.items()},
        "shapley": pa.array([shapley[letter] for letter in letters], pa.int64()),
    })


def masks(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``doc_key``, ``part``, digest of the text and ``mask`` without the bit of copies, for each row."""
    rows = docs.select(
        F.col(key).cast("bigint").alias("doc_key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        utf8(F.col(text)).alias("body")).withColumn("digest", F.unhex(F.sha2("body", 256)))
    return map_batches(rows, _masks, "doc_key bigint, part string, digest binary, mask int")


def counted_masks(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source",
                  good: str = "quality", toxic: str = "toxic") -> DataFrame:
    """Documents per ``part``, ``mask`` (with the bit of copies), ``good`` and ``toxic``: column ``n``.

    Only keys, parts, digests and masks are shuffled. Equal rows are counted before each shuffle: a text that a third of
    the rows share arrives as one row per task, part and label.
    """
    facts = masks(docs, key, text, part).groupBy("doc_key", "part", "digest", "mask").agg(F.count("*").alias("n"))
    facts = facts.withColumn("salt", F.when(F.col("doc_key").isNull(), F.pmod(F.xxhash64("digest"), F.lit(SALTS))).otherwise(0))
    marks = labels.select(
        F.col(key).cast("bigint").alias("doc_key"), (F.col(good) == 1).alias("good"), (F.col(toxic) == 1).alias("toxic"),
    ).where("doc_key IS NOT NULL AND (good OR toxic)").groupBy("doc_key").agg(
        F.coalesce(F.max("good"), F.lit(False)).alias("good"), F.coalesce(F.max("toxic"), F.lit(False)).alias("toxic"),
    ).withColumn("salt", F.lit(0).cast("bigint"))
    known = facts.join(marks.hint("merge"), ["doc_key", "salt"], "left").withColumns({
        c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    # a key has one row here per part, text and label, so min_by finds all rows of the smallest key
    kinds = known.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_key").alias("first"), F.min_by("n", "doc_key").alias("n_first"),
        F.sum(F.when(F.col("doc_key").isNull(), F.col("n")).otherwise(0)).alias("n_keyless"))
    smallest = F.min("first").over(W.partitionBy("digest"))
    own = F.col("n_keyless") + F.when(F.col("first") == smallest, F.col("n_first")).otherwise(0)
    split = kinds.withColumn("own", own).groupBy("part", "mask", "good", "toxic").agg(
        F.sum("own").alias("own"), F.sum(F.col("n") - F.col("own")).alias("copies"))
    copy_bit = 1 << FILTERS.index("E")
    both = F.array(F.struct("mask", F.col("own").alias("n")),
                   F.struct(F.col("mask").bitwiseOR(copy_bit).alias("mask"), F.col("copies").alias("n")))
    return split.select("part", "good", "toxic", F.inline(both)).where("n > 0")


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source",
          good: str = "quality", toxic: str = "toxic") -> DataFrame:
    """The counts of every part, order and step; ``shapley`` adds up what the step's filter removes in all orders."""
    counts = stored(counted_masks(docs, labels, key, text, part, good, toxic), "masks")
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in (*COUNTS, "shapley"))
    return counts.groupBy("part").applyInArrow(_added, schema)
