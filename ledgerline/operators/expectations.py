"""Quality rules: one pass over the rows, drop or warn, quarantine with a reason, counters.

A rule whose predicate is NULL counts as violated. So the rows kept and the rows in quarantine
are a partition of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerline.contracts import Rule


def holds(rule: Rule) -> Column:
    return F.coalesce(F.expr(rule.predicate), F.lit(False))


def failed_names(rules: list[Rule]) -> Column:
    """Names of the violated rules as an array, empty when all hold."""
    return F.array_compact(F.array(*[F.when(~holds(r), F.lit(r.name)) for r in rules]))


def reason(rules: list[Rule]) -> Column:
    """Reason of the first violated drop rule in rank order, NULL for a valid row."""
    ladder = None
    for rule in sorted((r for r in rules if r.drop), key=lambda r: r.rank):
        broken = ~holds(rule)
        ladder = F.when(broken, rule.reason) if ladder is None else ladder.when(broken, rule.reason)
    return ladder if ladder is not None else F.lit(None).cast("string")


def keep(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows that satisfy every drop rule."""
    return df.where(reason(rules).isNull())


def quarantine(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The other rows, with the reason."""
    return df.withColumn("reason", reason(rules)).where(F.col("reason").isNotNull())


def warn(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """All rows, with the violated warn-only rules in ``warnings``."""
    return df.withColumn("warnings", failed_names([r for r in rules if not r.drop]))


def _counters(rules: list[Rule]) -> list[Column]:
    return [F.count(F.lit(1)).alias("_rows")] + [
        F.count_if(~holds(r)).alias(f"_failed_{i}") for i, r in enumerate(rules)
    ]


def rule_counts(df: DataFrame, rules: list[Rule], by: list[str] | None = None) -> DataFrame:
    """``rule, passed, failed`` for every rule, from a single aggregation of the rows."""
    by = by or []
    counted = df.groupBy(*by).agg(*_counters(rules))
    lines = F.explode(F.array(*[
        F.struct(
            F.lit(r.name).alias("rule"),
            (F.col("_rows") - F.col(f"_failed_{i}")).alias("passed"),
            F.col(f"_failed_{i}").alias("failed"),
        )
        for i, r in enumerate(rules)
    ]))
    return counted.select(*by, lines.alias("_line")).select(*by, "_line.*")


def observe(df: DataFrame, rules: list[Rule], observation: Observation) -> DataFrame:
    """Count the rules while ``df`` is being written, without another pass."""
    return df.observe(observation, *_counters(rules))


def observed_counts(rules: list[Rule], observation: Observation) -> list[tuple[str, int, int]]:
    seen = observation.get
    return [
        (r.name, seen["_rows"] - seen[f"_failed_{i}"], seen[f"_failed_{i}"])
        for i, r in enumerate(rules)
    ]
