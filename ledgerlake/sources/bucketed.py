"""Catalog tables, bucketed by a key for joins without a shuffle.

A bucketed table is hashed by its key once, when it is written.  Every later join or aggregate on that key reads
bucket beside bucket: no side is shuffled or sorted again, however often it is joined.  A bucket is read by one
task, so AQE can't split a hot key there: ``save_bucketed`` refuses a key that holds too large a share
of the rows, and such a table is joined with ``relational.hinted_join``, where it can.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.session import scratch_path, shared_dir
from ledgerlake.sources import fs
from ledgerlake.sources.io import fingerprint_of

#: Times a bucket's even share that one key may hold.
HOT_BUCKETS = 4
#: Rows of a bucket, which one task sorts and joins.
BUCKET_ROWS = 1_000_000


class HotKey(ValueError):
    """A key holds too many rows for one bucket."""


def bucket_count(*tables: DataFrame, least: int = 1, bucket_rows: int = BUCKET_ROWS) -> int:
    """A number of buckets for tables that are to be joined: ``least``, or as many as leave about ``bucket_rows``
    rows of the largest table in each, so that a task's memory does not grow with the tables."""
    return max(least, *(-(-t.count() // bucket_rows) for t in tables))


def save_bucketed(df: DataFrame, keys: Sequence[str], buckets: int, name: str | None = None, hot_buckets: float = HOT_BUCKETS) -> DataFrame:
    """Write ``df`` as a catalog table in ``buckets`` sorted files by the hash of ``keys``, in the shared folder, and
    return it.  Tables join without a shuffle when keys have equal types and the numbers of buckets are equal.

    A key with more than ``hot_buckets`` times the even share of a bucket raises ``HotKey``; with as few rows as
    buckets no key is hot."""
    spark, keys = df.sparkSession, list(keys)
    top, total = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.sum("n")).first()
    if top is not None and top > max(1000, hot_buckets * total / buckets):
        raise HotKey(f"{top} of {total} rows share one {'/'.join(keys)}: join with hinted_join, which splits it")
    name = name or f"ledgerlake_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet")
     .option("compression", "zstd").option("path", scratch_path(spark, name)).saveAsTable(name))
    return spark.table(name)


def restore_tables(spark: SparkSession, path: str, tables: Sequence[str], database: str) -> None:
    """Restore the named tables of an export into a database of the catalog, which is made in the shared folder if
    it is missing.  Other tables stay absent.  A table whose count or fingerprint differs from the manifest, or
    that is there already, raises and leaves what was there."""
    manifest = json.loads(fs.read_text(spark, f"{path}/_manifest.json"))
    if missing := [t for t in tables if t not in manifest]:
        raise KeyError(f"tables {missing} are not in the export at {path}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{shared_dir(spark)}/{database}-{uuid.uuid4().hex[:8]}'")
    for t in tables:
        if spark.catalog.tableExists(f"`{database}`.`{t}`"):
            raise ValueError(f"table {database}.{t} exists")
    for t in tables:
        meta = manifest[t]
        spark.read.schema(T.StructType.fromJson(meta["schema"])).parquet(f"{path}/{t}").write.saveAsTable(f"`{database}`.`{t}`")
        row = fingerprint_of(spark.table(f"`{database}`.`{t}`")).first()
        if int(row["rows"]) != meta["rows"] or str(row["fp"]) != meta["fingerprint"]:
            spark.sql(f"DROP TABLE `{database}`.`{t}`")
            raise ValueError(f"restore of {t}: count or fingerprint differs from the manifest")
