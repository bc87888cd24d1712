"""Ordered look-back and look-ahead inside a key, with the groups of hot keys split.

``lag`` over a key puts all rows of that key in one task. Here the rows of a key that has very
many are cut into segments along the order, each segment is a window group of its own, and what
a segment must know of its neighbours is joined to it from a small table. The result is the same
as that of the plain window, and where no key is hot the work is the same too: one shuffle and
one sort, which a look-back and a look-ahead share.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.session import work_dir

_PARTS, _SEG = "_parts", "_seg"


@dataclass(frozen=True)
class GroupLimit:
    """A key with more than ``rows`` rows is split into segments of about that size, however many such keys there are.

    ``broadcast`` is the number of cut points up to which their table is copied to every task; a larger one is joined
    by key. The limits decide on the work only, never on the result.
    """

    rows: int = 2_000_000
    broadcast: int = 100_000


class OrderedGroups:
    """Rows grouped by ``keys`` and ordered by ``order``.

    ``position`` is a number that never falls along ``order`` (for a leading timestamp its
    seconds), NULL first as in the order; rows of equal position stay in one segment. Segments end at quantiles of the
    key's positions, so they hold about equally many rows however the rows are spread over time. Hot keys are found by
    counting ``counted`` (keys and the columns of ``position``), by default the rows themselves. Where those are costly
    to make, a table of about the same keys and times serves as well: it decides on the cuts only. The cuts are stored
    once and read wherever the plan needs them; without hot keys nothing is joined at all.
    ``spread`` names a column that divides the groups further, for rows that need no neighbours.
    """

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], position: Column,
                 limit: GroupLimit = GroupLimit(), counted: DataFrame | None = None,
                 spread: list[str] | None = None):
        self.spread = spread or []
        self.keys, self.order, self.columns = keys, order, df.columns
        at = position.cast("double")
        self.rows = df.withColumns({_PARTS: F.lit(None).cast("int"), _SEG: F.lit(None).cast("int")})
        self.hot = False
        places = (df if counted is None else counted).select(*keys, at.alias("_pos"))
        sizes = places.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit.rows)
        spark = df.sparkSession
        path = work_dir(spark, "hot-keys")
        sizes.withColumn(_PARTS, F.ceil(F.col("_n") / limit.rows).cast("int")).write.parquet(path)
        hot = spark.read.parquet(path)
        found = hot.agg(F.count(F.lit(1)).alias("keys"), F.max(_PARTS).alias("most"), F.sum(_PARTS).alias("cuts")).first()
        if not found.keys:
            return
        self.hot = True
        copied = found.cuts <= limit.broadcast
        cuts_path = work_dir(spark, "cuts")
        same = [F.col(c).eqNullSafe(F.col(f"_hot_{c}")) for c in keys]
        named = hot.select(*[F.col(c).alias(f"_hot_{c}") for c in keys], _PARTS)
        quantiles = [i / found.most for i in range(1, found.most)]
        places.join(F.broadcast(named) if copied else named, same).groupBy(*keys, _PARTS).agg(
            F.percentile_approx("_pos", quantiles, max(10_000, 10 * found.most)).alias("_all")).select(
            *[F.col(c).alias(f"_hot_{c}") for c in keys], F.col(_PARTS).alias("_hot_parts"),
            F.array_distinct(F.transform(
                F.sequence(F.lit(1), F.col(_PARTS) - 1), lambda i: F.get("_all", F.floor(i * found.most / F.col(_PARTS)).cast("int") - 1),
            )).alias("_cuts")).write.parquet(cuts_path)
        cuts = spark.read.parquet(cuts_path)
        earlier = F.coalesce(F.size(F.filter("_cuts", lambda cut: cut < at)), F.lit(0))
        self.rows = df.join(F.broadcast(cuts) if copied else cuts, same, "left").withColumns({
            _PARTS: F.col("_hot_parts"),
            _SEG: F.when(F.col("_hot_parts").isNotNull(), F.when(at.isNull(), 0).otherwise(earlier)),
        }).drop("_cuts", "_hot_parts", *[f"_hot_{c}" for c in keys])

    def _edges(self, state: Column, reverse: bool) -> DataFrame:
        """For each segment of a hot key, the state nearest to it in the segments before (after) it."""
        nearest = F.min_by if reverse else F.max_by
        ordered = F.when(F.col("_state").isNotNull(), F.struct(*self.order))
        outward = W.partitionBy(*self.keys, _PARTS).orderBy(F.desc(_SEG) if reverse else F.asc(_SEG))
        return (
            self.rows.where(F.col(_PARTS).isNotNull())
            .withColumn("_state", state)
            .groupBy(*self.keys, _PARTS, _SEG)
            .agg(nearest("_state", ordered).alias("_own"))
            .withColumn("_edge", F.last("_own", ignorenulls=True).over(
                outward.rowsBetween(W.unboundedPreceding, -1)))
            .drop("_own")
        )

    def _with_edge(self, state: Column, out: str, inside: Column, reverse: bool) -> "OrderedGroups":
        rows = self.rows.withColumn(out, inside)
        if self.hot:
            edges = self._edges(state, reverse).withColumnsRenamed({c: f"_edge_{c}" for c in [*self.keys, _PARTS, _SEG]})
            same = [F.col(c).eqNullSafe(F.col(f"_edge_{c}")) for c in self.keys]
            same += [F.col(c) == F.col(f"_edge_{c}") for c in (_PARTS, _SEG)]
            rows = rows.join(edges, same, "left").withColumn(out, F.coalesce(out, "_edge")).drop(
                "_edge", *[f"_edge_{c}" for c in [*self.keys, _PARTS, _SEG]])
        return self._derive(rows, [*self.columns, out])

    def _window(self) -> W:
        return W.partitionBy(*self.keys, *self.spread, _PARTS, _SEG).orderBy(*self.order)

    def previous(self, state: Column, out: str) -> "OrderedGroups":
        """Add the last non-NULL ``state`` of the earlier rows of the key."""
        before = self._window().rowsBetween(W.unboundedPreceding, -1)
        return self._with_edge(state, out, F.last(state, ignorenulls=True).over(before), False)

    def following(self, state: Column, out: str) -> "OrderedGroups":
        """Add the ``state`` of the next row of the key; ``state`` must not be NULL."""
        return self._with_edge(state, out, F.lead(state).over(self._window()), True)

    def upcoming(self, state: Column, out: str) -> "OrderedGroups":
        """Add the first non-NULL ``state`` of the later rows of the key."""
        back = W.partitionBy(*self.keys, *self.spread, _PARTS, _SEG).orderBy(*[F.desc(c) for c in self.order])
        nearest = F.last(state, ignorenulls=True).over(back.rowsBetween(W.unboundedPreceding, -1))
        return self._with_edge(state, out, nearest, True)

    def where(self, condition: Column) -> "OrderedGroups":
        return self._derive(self.rows.where(condition), self.columns)

    def df(self) -> DataFrame:
        return self.rows.select(*self.columns)

    def _derive(self, rows: DataFrame, columns: list[str]) -> "OrderedGroups":
        other = object.__new__(OrderedGroups)
        other.keys, other.order, other.spread = self.keys, self.order, self.spread
        other.columns, other.rows, other.hot = columns, rows, self.hot
        return other
