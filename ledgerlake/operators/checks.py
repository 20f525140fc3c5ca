"""V1-V5, V7: table comparison and data-quality checks as Spark jobs.

All checks are aggregations or anti joins over the whole tables (partial
aggregation first, so a hot key is reduced on the map side).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """V1: bag difference both ways: rows whose multiplicity differs, with the
    side holding the surplus and the surplus count.  NULLs compare equal."""
    cols = a.columns
    u = (a.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
         .unionByName(b.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b"))))
    g = u.groupBy(*cols).agg(F.sum("_a").alias("_na"), F.sum("_b").alias("_nb"))
    g = g.where(F.col("_na") != F.col("_nb"))
    return g.select(*cols, F.when(F.col("_na") > F.col("_nb"), "a_only").otherwise("b_only").alias("side"),
                    F.abs(F.col("_na") - F.col("_nb")).cast("long").alias("n"))


def is_equal(a: DataFrame, b: DataFrame) -> bool:
    return table_diff(a, b).isEmpty()


def check_rows(df: DataFrame, rules: dict, keep: Sequence[str]) -> DataFrame:
    """V2: one pass; a row violates a rule when the rule is FALSE (a CHECK
    passes on NULL).  Output: ``keep`` columns + rule name, one row per
    violation."""
    flags = [F.when(~F.coalesce(cond, F.lit(True)), F.lit(name)) for name, cond in rules.items()]
    failed = F.filter(F.array(*flags), lambda x: x.isNotNull())
    return (df.select(*keep, failed.alias("_failed")).where(F.size("_failed") > 0)
            .select(*keep, F.explode("_failed").alias("rule")))


def not_null(*cols: str) -> dict:
    return {f"{c}_not_null": F.col(c).isNotNull() for c in cols}


def check_unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """V3: keys held by more than one row (rows with a NULL key part are exempt,
    as for UNIQUE)."""
    nn = None
    for c in cols:
        e = F.col(c).isNotNull()
        nn = e if nn is None else nn & e
    return (df.where(nn).groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def check_fk(child: DataFrame, parent: DataFrame, fk: dict) -> DataFrame:
    """V4: child rows whose non-NULL foreign key has no parent row."""
    nn = None
    cond = None
    for ck, pk in fk.items():
        e = F.col(ck).isNotNull()
        nn = e if nn is None else nn & e
        j = child[ck] == parent[pk]
        cond = j if cond is None else cond & j
    return child.where(nn).join(parent, cond, "left_anti")


def cascade_delete(child: DataFrame, surviving_parent: DataFrame, fk: dict) -> DataFrame:
    """V4: ``ON DELETE CASCADE``: keep child rows whose parent survives
    (NULL foreign keys are kept)."""
    nulls = None
    cond = None
    for ck, pk in fk.items():
        e = F.col(ck).isNull()
        nulls = e if nulls is None else nulls | e
        j = child[ck] == surviving_parent[pk]
        cond = j if cond is None else cond & j
    return child.where(nulls).unionByName(child.where(~nulls).join(surviving_parent, cond, "left_semi"))


def assert_counts(a: DataFrame, b: DataFrame) -> int:
    """V5: equal row counts or raise."""
    na, nb = a.count(), b.count()
    if na != nb:
        raise ValueError(f"row counts differ: {na} != {nb}")
    return na


def row_digest(df: DataFrame):
    """A number from a row's text: the first 15 hex digits of the md5 of its columns' texts,
    each with its length, NULL as ``-``."""
    parts = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
             for c in df.columns]
    return F.conv(F.substring(F.md5(F.concat_ws(",", *parts)), 1, 15), 16, 10).cast("decimal(20,0)")


def fingerprint(df: DataFrame, by: Sequence[str] | str) -> DataFrame:
    """V7: per-partition row count and order-independent content digest (a sum of row
    digests that other engines can compute as well)."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"),
                               F.sum(row_digest(df)).cast("decimal(38,0)").alias("fingerprint"))


def verify_fingerprints(current: DataFrame, manifest: DataFrame, by: Sequence[str] | str) -> DataFrame:
    """V7: partitions whose count or hash differs from a recorded manifest."""
    by = [by] if isinstance(by, str) else list(by)
    now = fingerprint(current, by).withColumnRenamed("rows", "rows_now") \
        .withColumnRenamed("fingerprint", "fp_now")
    j = manifest.join(now, on=by, how="full")
    return j.where(~F.col("rows").eqNullSafe(F.col("rows_now"))
                   | ~F.col("fingerprint").eqNullSafe(F.col("fp_now")))

