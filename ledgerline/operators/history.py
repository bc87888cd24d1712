"""Change application: latest row per key, version history, state as of a date, as-of join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.operators.groups import GroupLimit, OrderedGroups


def position(order: Column, kind: str) -> Column:
    """The number behind a leading order column of type ``timestamp``, ``ntz``, ``date`` or ``number``."""
    if kind == "timestamp":
        return F.unix_micros(order)
    if kind == "ntz":  # by parts: a cast to timestamp would depend on the session zone
        clock = F.hour(order) * 3600 + F.minute(order) * 60 + F.second(order)
        return F.unix_date(order.cast("date")).cast("bigint") * 86400 + clock
    if kind == "date":
        return F.unix_date(order)
    return order.cast("double")


def latest(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The last row of each key.

    The filter on ``row_number`` lets Spark keep one row per key before the shuffle as well, so
    copies of one key do not travel.
    """
    newest = [F.col(c).desc() if isinstance(c, str) else c.desc() for c in order]
    return (
        df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*newest)))
        .where(F.col("_rn") == 1)
        .drop("_rn")
    )


def versions(df: DataFrame, keys: list[str], order: list[str], tracked: list[str],
             position: Column, valid_from: str | None = None,
             limit: GroupLimit = GroupLimit()) -> DataFrame:
    """Version history: a row per change of the tracked columns.

    Adds ``valid_from``, ``valid_to`` (NULL while current) and ``is_current``. A re-delivery equal
    to the version it follows opens none; the record that opened a version keeps its lineage.
    Keys must not be NULL.
    """
    start = valid_from or order[0]
    groups = OrderedGroups(df, keys, order, position, limit)
    opened = groups.previous(F.struct(*tracked), "_before").where(
        ~F.struct(*tracked).eqNullSafe(F.col("_before"))
    )
    # a one-field struct, so that a NULL start still marks that a later version exists
    closed = opened.following(F.struct(F.col(start).alias("at")), "_next")
    return closed.df().select(
        *df.columns,
        F.col(start).alias("valid_from"),
        F.col("_next.at").alias("valid_to"),
        F.col("_next").isNull().alias("is_current"),
    )


VERSION, ABSORBED = "version", "absorbed"


def versions_and_absorbed(df: DataFrame, keys: list[str], order: list[str], tracked: list[str],
                          position: Column, valid_from: str | None = None,
                          limit: GroupLimit = GroupLimit()) -> DataFrame:
    """All records: those that open a version as :func:`versions` gives them, and those that a version absorbed.

    Column ``kind`` tells them apart. Whatever record comes later, even one that belongs between others, these rows are
    enough to place it: it may split the version it falls into, and the absorbed records after it open the next one.
    """
    start = valid_from or order[0]
    groups = OrderedGroups(df, keys, order, position, limit).previous(F.struct(*tracked), "_before")
    opens = ~F.struct(*tracked).eqNullSafe(F.col("_before"))
    found = groups.upcoming(F.when(opens, F.struct(F.col(start).alias("at"))), "_next")
    return found.df().select(
        *df.columns,
        F.when(opens, F.col(start)).alias("valid_from"),
        F.when(opens, F.col("_next.at")).alias("valid_to"),
        F.when(opens, F.col("_next").isNull()).alias("is_current"),
        F.when(opens, VERSION).otherwise(ABSORBED).alias("kind"),
    )


def state_as_of(df: DataFrame, keys: list[str], order: list[Column | str], day: Column,
                as_of: Column) -> DataFrame:
    """State of every key at the end of ``as_of`` and whether it changed on that day."""
    known = df.where(day <= as_of)
    return latest(known, keys, order).withColumn("changed_today", day == as_of)


def state_as_of_sparse(df: DataFrame, keys: list[str], order: list[str], columns: list[str], day: Column,
                       as_of: Column) -> DataFrame:
    """State of every key at the end of ``as_of`` from records that hold only what changed.

    Each column has its last value that is not NULL, whatever record it came with; NULL if there never was one.
    ``changed_today`` tells whether any record is of that day. One aggregation, so records of one key are folded before
    they are shuffled.
    """
    at = F.struct(*order)
    return df.where(day <= as_of).groupBy(*keys).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in columns],
        F.max(day == as_of).alias("changed_today"))


def as_of_join(facts: DataFrame, dim: DataFrame, keys: list[str], fact_ts: str, dim_ts: str,
               dim_order: list[str], take: list[str], position: Column,
               limit: GroupLimit = GroupLimit(), counted: DataFrame | None = None) -> DataFrame:
    """Each fact with the ``take`` columns of the version in force at its time (NULL if none).

    Facts and versions are merged along the time of the key and every fact takes the last version
    before it, so the work grows with the rows and not with facts times versions. ``position``
    must be written on the column ``_at``; ``counted``, as in :class:`OrderedGroups`, has the keys
    and ``_at``.
    """
    tie = [f"_o{i}" for i in range(len(dim_order))]
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    # facts without a key match nothing; they are divided by task instead of gathering in one group
    facts_side = facts.select(
        *keys, F.col(fact_ts).alias("_at"), F.lit(1).alias("_side"),
        F.when(no_key, F.spark_partition_id()).alias("_spread"), F.struct(*facts.columns).alias("_fact"),
    )
    dim_side = dim.where(~no_key).select(
        *keys, F.col(dim_ts).alias("_at"), F.lit(0).alias("_side"),
        *[F.col(c).alias(t) for c, t in zip(dim_order, tie)],
        F.struct(*take).alias("_version"),
    )
    # a version that starts at the time of a fact is in force for it, hence versions come first
    merged = facts_side.unionByName(dim_side, allowMissingColumns=True)
    groups = OrderedGroups(
        merged, keys, ["_at", "_side", *tie], position, limit, counted, spread=["_spread"])
    matched = groups.previous(F.col("_version"), "_found").where(F.col("_side") == 1)
    return matched.df().select("_fact.*", *[F.col("_found")[c].alias(c) for c in take])
