"""Reading text lines by column name, and what to do with columns nobody announced.

Lines become a map from column name to text first. The columns of the contract are taken out of
the map by name, so the order of columns in a file does not matter, and whatever is left over is
kept in ``rescued_data``.
"""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.contracts import RESCUED
from ledgerline.sources.landing import readable

CORRUPT = "_corrupt_line"
ADD, RESCUE, FAIL, IGNORE = "add", "rescue", "fail", "ignore"
POLICIES = (ADD, RESCUE, FAIL, IGNORE)
MAX_NEW = 1000  # more names than this are data used as keys, not a change of layout


def json_fields(line: Column) -> Column:
    """Map of the top-level fields of a JSON line; nested objects stay JSON text."""
    return F.coalesce(F.from_json(line, "MAP<STRING, STRING>"), F.create_map(F.lit(CORRUPT), line))


def csv_headers(lines: DataFrame) -> list[tuple[str, str, list[str], bool]]:
    """File, header line, column names and whether cells may hold line breaks, for every file of a micro-batch.

    A line break inside quotation marks leaves a line with an odd number of them, escaped ones left out.

    ``lines`` has ``value``, ``source_file`` and ``block_start``. Within a task the rows of a file
    keep their order, so the first one of the block at offset 0 is the header. One short line per
    file comes to the driver, and the number of files is limited when the batch is formed.
    """
    marks = F.length(F.regexp_replace("value", r'\\.|[^"\\]', ""))
    first = (
        lines.select("source_file", "value", "block_start", F.monotonically_increasing_id().alias("_at"), (marks % 2 == 1).alias("odd"))
        .groupBy("source_file")
        .agg(F.min_by(F.when(F.col("block_start") == 0, F.col("value")), F.when(F.col("block_start") == 0, F.col("_at"))).alias("header"),
             F.max("odd").alias("broken"))
        .where("header IS NOT NULL")
        .collect()
    )
    names = {
        header: [n or f"_c{i}" for i, n in enumerate(next(csv.reader([header], escapechar="\\")))]
        for header in {r.header for r in first}
    }
    return [(r.source_file, r.header, names[r.header], r.broken) for r in first]


def csv_rows(spark: SparkSession, headers: list[tuple[str, str, list[str], bool]]) -> DataFrame:
    """``source_file`` and ``fields`` of the lines of some CSV files, files with equal headers read together.

    Spark's reader leaves out the first line of a file and no other. A line with more or fewer cells than its header
    is also kept whole. Files whose cells may hold line breaks are read each by one task, all others are split.
    """
    layouts: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for path, _, names, broken in headers:
        layouts.setdefault((tuple(names), broken), []).append(path)
    parts = []
    for (names, broken), paths in layouts.items():
        cells = [f"c{i}" for i in range(len(names))]
        rows = (
            spark.read.schema(", ".join(f"{c} STRING" for c in [*cells, CORRUPT]))
            .option("header", True).option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", broken)
            .csv([readable(p) for p in paths])
            .select(F.col("_metadata.file_path").alias("source_file"), *cells, CORRUPT)
        )
        bag = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*cells))
        whole = F.map_concat(bag, F.create_map(F.lit(CORRUPT), F.col(CORRUPT)))
        parts.append(rows.select("source_file", F.when(F.col(CORRUPT).isNull(), bag).otherwise(whole).alias("fields")))
    if not parts:
        return spark.createDataFrame([], "source_file STRING, fields MAP<STRING, STRING>")
    return reduce(DataFrame.unionByName, parts)


def outside(fields: Column, known: list[str]) -> Column:
    """The part of the map that is not in the contract."""
    return F.map_filter(fields, lambda name, _: ~name.isin(known))


def new_names(rows: DataFrame) -> list[str]:
    """Column names in ``outside``; of more than ``MAX_NEW`` of them, one more than that."""
    names = (
        rows.select(F.explode(F.map_keys("outside")).alias("name"))
        .where(F.col("name") != CORRUPT).distinct().limit(MAX_NEW + 1)
    )
    return sorted(r.name for r in names.collect())


def rescued(rest: Column, policy: str = ADD) -> Column:
    """JSON text of the fields outside the contract, NULL if there are none.

    Under ``ignore`` new columns are dropped, lines that could not be read are not.
    """
    kept = F.map_filter(
        rest, lambda name, value: value.isNotNull() & (F.lit(policy != IGNORE) | (name == CORRUPT)))
    return F.when(F.size(kept) > 0, F.to_json(kept))


def project(rows: DataFrame, columns: list[str], policy: str = ADD, carry: list[str] | None = None) -> DataFrame:
    """Contract columns by name, then ``rescued_data``, then ``carry``."""
    return rows.select(
        *[F.col("fields")[c].alias(c) for c in columns],
        rescued(F.col("outside"), policy).alias(RESCUED),
        *(carry or []),
    )
