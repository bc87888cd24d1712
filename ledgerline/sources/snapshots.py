"""Reference data delivered as one JSON object whose keys are data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.contracts import INGESTED_AT, SOURCE_FILE
from ledgerline.sources.versions import ReplacedTable


def read_pairs(spark: SparkSession, path: str, key: str, value: str, below: str = "", per_line: bool = False) -> DataFrame:
    """Entries of JSON objects as rows of ``key`` and ``value`` with lineage; keys make no columns.

    ``below`` names the field that holds the object, if it is not the file's own. Text is read as it is, a file or,
    with ``per_line``, a line at a time: lines of one file are then shared out over tasks.
    """
    kind = "MAP<STRING, STRING>"
    found = F.from_json("value", f"STRUCT<`{below}`: {kind}>" if below else kind)
    pairs = F.map_entries(found[below] if below else found)
    rows = spark.read.text(path, wholetext=not per_line).select(
        F.inline(pairs).alias(key, value), F.col("_metadata.file_path").alias(SOURCE_FILE))
    return _with_time(rows)


def _with_time(df: DataFrame) -> DataFrame:
    return df.withColumn(INGESTED_AT, F.current_timestamp())


def read_object(spark: SparkSession, path: str, key: str, value: str, below: str = "") -> DataFrame:
    """Entries of flat JSON objects, one object per file, each file read by many tasks; any text may be in it.

    The text is cut at its commas, which Spark does from any place in a file. A piece that can only be a whole pair of
    texts is taken as it is. Of the others, each comma counts as the end of an entry if the quotation marks before it,
    escaped ones left out, are even in number: they are counted in each block of the file, and the blocks' sums are added
    up along the file. Pieces between two such commas are put together again. What is no pair then stops the job.
    """
    text = F.col("value")
    pieces = spark.read.option("lineSep", ",").text(path).select(
        "value", F.col("_metadata.file_path").alias(SOURCE_FILE), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"))
    # read the other way round, from inside a text, the first pair of marks would hold blanks, colons and braces only
    whole = text.rlike(r'^\s*"[^"\\]*[^"\\\s:{}][^"\\]*"\s*:\s*"[^"\\]*"\s*$')
    plain = pieces.where(whole).select(
        F.split_part(text, F.lit('"'), F.lit(2)).alias(key), F.split_part(text, F.lit('"'), F.lit(4)).alias(value), SOURCE_FILE)

    open_marks = F.regexp_replace(text, r'(?s)\\.|[^"\\]', "")
    rest = pieces.where(~whole).withColumn("marks", F.length(open_marks))
    in_block = W.partitionBy(SOURCE_FILE, "block").orderBy("at")
    before = in_block.rowsBetween(W.unboundedPreceding, -1)
    earlier_blocks = W.partitionBy(SOURCE_FILE).orderBy("block").rowsBetween(W.unboundedPreceding, -1)

    def carried(rows: DataFrame, column: str) -> DataFrame:
        """Rows with ``earlier``, the sum of the column over the blocks of the file before theirs."""
        sums = rows.groupBy(SOURCE_FILE, "block").agg(F.sum(column).alias("_sum"))
        sums = sums.select(SOURCE_FILE, "block", F.coalesce(F.sum("_sum").over(earlier_blocks), F.lit(0)).alias("earlier"))
        return rows.join(sums, [SOURCE_FILE, "block"])

    marked = carried(rest, "marks").withColumn("marks", F.col("earlier") + F.coalesce(F.sum("marks").over(before), F.lit(0)))
    begins = marked.drop("earlier").withColumn("begins", F.when(F.col("marks") % 2 == 0, 1).otherwise(0))
    numbered = carried(begins, "begins").withColumn("entry", F.col("earlier") + F.sum("begins").over(in_block))
    entries = numbered.groupBy(SOURCE_FILE, "entry").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("block", "at", "value"))), lambda p: p["value"]), ",").alias("value"))
    opening = rf'^\s*\{{\s*"{below}"\s*:\s*\{{' if below else r"^\s*\{"
    closing = r"\}\s*\}\s*$" if below else r"\}\s*$"
    body = F.regexp_replace(F.regexp_replace(text, opening, ""), closing, "")
    # without escapes a pair is plain to see: a text, a colon, and a text or something without structure
    sound = F.regexp_replace(body, r"(?s)\\.", "x").rlike(r'^\s*"[^"]*"\s*:\s*(?:"[^"]*"|[^\s"{}\[\],:]+)\s*$')
    empty = text.rlike(opening + r"\s*" + closing)
    broken = F.raise_error(F.concat(F.lit("not a label pair or other entry: "), text))
    # the check sits in the filter, so that no projection can drop it
    kept = entries.where(F.when(sound, True).when(empty, False).otherwise(broken.cast("boolean")))
    pairs = F.from_json(F.concat(F.lit("{"), body, F.lit("}")), "MAP<STRING, STRING>")
    found = kept.select(F.inline(F.map_entries(pairs)).alias(key, value), SOURCE_FILE)
    return _with_time(plain.unionByName(found))


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """``{"5812": "Eating Places", ...}``, pretty-printed or not, one object per file."""
    return read_object(spark, path, "mcc", "description")


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """``{"target": {"<transaction id>": "Yes", ...}}``, one object per file, read in parallel.

    Ids and labels hold no comma, so a comma always ends a pair and the file can be split there.
    Text between two commas that is no plain pair of texts stops the job rather than being lost;
    such files are read by :func:`read_labels_map`, which costs more per character.
    """
    value = F.col("value")
    opening, closing = r'\{\s*"target"\s*:\s*\{', r"\}\s*\}"
    pair = r'"[^"\\,]*+"\s*:\s*"[^"\\,]*+"'
    broken = F.raise_error(F.concat(F.lit("not a label pair: "), value)).cast("boolean")
    # the check sits in the filter, so that no projection can drop it
    sound = (
        F.when(value.rlike(rf"^\s*(?:{opening}\s*)?{pair}\s*(?:{closing}\s*)?$"), True)
        .when(value.rlike(rf"^\s*{opening}\s*{closing}\s*$"), False)
        .otherwise(broken)
    )

    def text(at: int) -> Column:
        """The text that starts at the ``at``-th quotation mark from the end."""
        return F.substring_index(F.substring_index(value, '"', -at), '"', 1)

    return _with_time(
        spark.read.option("lineSep", ",").text(path).where(sound).select(
            text(4).alias("transaction_id"),
            text(2).alias("is_fraud"),
            F.col("_metadata.file_path").alias(SOURCE_FILE),
        )
    )


def read_labels_map(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The same object with any text in it, one in each file or (``multi_line=False``) in each line."""
    if multi_line:
        return read_object(spark, path, "transaction_id", "is_fraud", below="target")
    return read_pairs(spark, path, "transaction_id", "is_fraud", below="target", per_line=True)


def read_wide_object(spark: SparkSession, path: str) -> DataFrame:
    """One object read as one row with a column per key, turned into rows again."""
    wide = spark.read.option("multiLine", True).option("recursiveFileLookup", True).json(path)
    return unpivot(wide, [], wide.columns, "mcc", "description")


def unpivot(df: DataFrame, ids: list[str], values: list[str], name: str, value: str) -> DataFrame:
    return df.unpivot(ids, values, name, value)


def reload(spark: SparkSession, df: DataFrame, path: str) -> ReplacedTable:
    """Replace a snapshot table by a full delivery."""
    table = ReplacedTable(spark, path)
    table.publish(df)
    return table
