"""Records of several lines from log text.

A record starts with a line of a main level (LOG, ERROR, ...).  Lines of other levels (DETAIL, STATEMENT, ...) belong to
the record before them, and a line without a prefix goes on the line before it.  Text files are read in splits, and a
split may begin anywhere in a record, so heads are carried on in two levels: within a split by a window over its own
lines, from split to split by a window over one row a split.  No file is read by one task, and the
records do not depend on how files are split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.operators.reports import _parse_ts, read_log
from ledgerlake.sources.io import stage_table

# The levels of the server's log.
MAIN_LEVELS = ("LOG", "INFO", "NOTICE", "WARNING", "ERROR", "FATAL", "PANIC")
PARTS = ("DETAIL", "HINT", "CONTEXT", "QUERY", "STATEMENT")
PREFIX = r"^(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\.\d{3}) UTC \[(\d+)\][^:]* ([A-Z]+):  ((?s).*)$"


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of the files at ``path`` with their place (file, split, id) and prefix, stored."""
    value = F.col("value")
    lines = read_log(spark, path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"), F.rtrim(value, F.lit("\r")).alias("value"))
    part = lambda n: F.nullif(F.regexp_extract("value", PREFIX, n), F.lit(""))
    head = part(3).isin(*MAIN_LEVELS, *PARTS)
    return stage_table(lines.select(
        "file", "split", "id", F.when(head, _parse_ts(part(1))).alias("ts"), F.when(head, part(2).try_cast("long")).alias("pid"),
        F.when(head, part(3)).alias("level"), F.when(head, F.regexp_extract("value", PREFIX, 4)).otherwise(F.col("value")).alias("text")), "loglines")


def _carried(lines: DataFrame, starts: Column, name: str) -> DataFrame:
    """``lines`` with the id of the last line before or at each that starts something, across splits."""
    marked = lines.withColumn("_start", F.when(starts, F.col("id")))
    ends = marked.groupBy("file", "split").agg(F.max("_start").alias("_last"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)      # one row a split
    ends = ends.select("file", "split", F.last("_last", ignorenulls=True).over(before).alias("_carry"))
    own = Window.partitionBy("file", "split").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)    # one split's lines
    return marked.withColumn("_own", F.last("_start", ignorenulls=True).over(own)).join(ends, ["file", "split"]).withColumn(
        name, F.coalesce("_own", "_carry")).drop("_start", "_own", "_carry")


def log_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, ts, pid, level, message, and one column a part), one row a record.  Lines before a file's first record are
    one record without ts, pid and level; a part that comes twice is joined by a new line."""
    lines = _carried(log_lines(spark, path), F.col("level").isNotNull(), "section")
    lines = _carried(lines, F.col("level").isin(*MAIN_LEVELS), "record")
    # a section's lines in order: splits of a file, and ids within a split
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "id", "text"))), lambda x: x["text"]), "\n")
    sections = lines.groupBy("file", "record", "section").agg(
        text.alias("text"), F.first("level", ignorenulls=True).alias("level"), F.first("ts", ignorenulls=True).alias("ts"),
        F.first("pid", ignorenulls=True).alias("pid"), F.min(F.struct("split", "id")).alias("at"))
    main = F.col("level").isin(*MAIN_LEVELS)
    of = lambda cond: F.nullif(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("at", "text")))), lambda x: x["text"]), "\n"), F.lit(""))
    return sections.groupBy("file", "record").agg(
        F.max(F.when(main, F.col("ts"))).alias("ts"), F.max(F.when(main, F.col("pid"))).alias("pid"), F.max(F.when(main, F.col("level"))).alias("level"),
        of(main | F.col("level").isNull()).alias("message"), *[of(F.col("level") == p).alias(p.lower()) for p in PARTS]).drop("record")
