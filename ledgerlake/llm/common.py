"""Helpers shared by the corpus operators."""

from __future__ import annotations

import json
import string

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.session import scratch_path
from ledgerlake.sources.fs import delete

#: Internal row id; long enough not to meet a column of the caller's table.
RID = "__ledgerlake_rid"

#: Words of the license and decontamination contracts: runs of a-z, 0-9 and non-ASCII characters
#: (texts are lower-cased first).
WORD = r"[a-z0-9\x80-\x{10FFFF}]++"
#: The same in a text that isn't lower-cased yet; gives the same number of words.
ANY_CASE_WORD = r"[a-zA-Z0-9\x80-\x{10FFFF}]++"


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does that on pure ASCII texts and is much faster there than
    ``translate``, which the rest goes through."""
    return F.when(F.octet_length(col) == F.length(col), F.lower(col)).otherwise(
        F.translate(col, string.ascii_uppercase, string.ascii_lowercase))


def _reads_files_only(df: DataFrame) -> bool:
    """Whether each row of ``df`` is a row of one file: a scan below projections and filters, and nothing else."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    return node.nodeName() == "LogicalRelation"


def with_rid(df: DataFrame) -> DataFrame:
    """Tag each row: equal rows and null or repeated ids stay apart.

    The id is the number of the row's file and its place in the file, so every pass over the same
    files gives a row the same id, however the files are split.  Rows that are not plainly those of
    files are written once with their ids, and all passes read that."""
    at = f"{RID}_file", f"{RID}_row", f"{RID}_nth"
    try:
        if not _reads_files_only(df):
            raise ValueError("not a scan")
        meta = df.metadataColumn("_metadata")
        rows = df.select("*", meta["file_path"].alias(at[0]), meta["row_index"].alias(at[1]))
    except (AnalysisException, ValueError):
        return stored(df.withColumn(RID, F.monotonically_increasing_id()), "rows")
    files = sorted(r[0] for r in rows.select(at[0]).distinct().collect())
    if len(files) <= 1:
        return rows.drop(at[0]).withColumnRenamed(at[1], RID)
    numbers = df.sparkSession.range(1).select(F.posexplode(F.from_json(F.lit(json.dumps(files)), "array<string>")).alias(at[2], at[0]))
    # one row a file
    nth = F.coalesce(F.col(at[2]), F.raise_error(F.lit("the files of a table changed while it was read")).cast("int"))
    return rows.join(F.broadcast(numbers), at[0], "left").withColumn(
        RID, F.shiftleft(nth.cast("long"), 33) + F.col(at[1])).drop(*at)


def by_key(big: DataFrame, keys: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join a table of texts (or of all tokens) with keys whose number grows with it: always by
    shuffling both, so that the plan is the same at every size."""
    return big.join(keys.hint("merge"), on, how)


def first_by_hash(df: DataFrame, key: str, n: int) -> DataFrame:
    """About ``n`` rows, at most so many: those whose key's hash is least.  A share of the hashes is
    cut off first, by the number of rows, so that tasks hand on a few rows each however many there are."""
    near = F.xxhash64(key)
    part = min(1.0, 1.3 * n / max(1, df.count()))
    kept = df.where(F.pmod(near, F.lit(2**30)) < int(part * 2**30) + 1)
    return kept.orderBy(F.pmod(near, F.lit(2**30)), near, key).limit(n)


#: Shuffle files of a written table go with the query that wrote it.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Within ``with Scratch() as s``: tables that ``stored`` writes are deleted at the end, but for those
    given to ``keep``.  What is kept must not be read from the others any more."""

    open: list[Scratch] = []

    def __enter__(self) -> Scratch:
        self.tables: dict[str, DataFrame] = {}
        Scratch.open.append(self)
        return self

    def keep(self, table: DataFrame) -> DataFrame:
        if self.tables.pop(table.stored_at, None) is not None and len(Scratch.open) > 1:
            Scratch.open[-2].tables[table.stored_at] = table
        return table

    def __exit__(self, *_: object) -> None:
        Scratch.open.pop()
        forget(*self.tables.values())


def forget(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for table in tables:
        delete(table.sparkSession, table.stored_at)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there, and a lost
    executor costs no recomputation of what lies before."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    if Scratch.open:
        Scratch.open[-1].tables[path] = table
    return table
