"""M2, M4 (stream), M8: Structured Streaming jobs.

Sinks are idempotent by ``batch_id``: a micro-batch adds a delta of its own rows to a merge-on-read
table (``KeyedTable``), whose buckets are compacted when their deltas outgrow them; replicas without
a key rewrite the hash partitions that a batch touches.  A batch's number is published with it.  A batch
retried after a failure is skipped if it is in, and a restart from the checkpoint resumes at the
first uncommitted batch.  Old attempts stay until ``vacuum``.  ``run_available`` drives a query with the
``availableNow`` trigger (all input present at start, then stop), which is
also how the batch == stream tests run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.changes import apply_changes
from ledgerlake.operators.partitions import PartitionedTable, PartitionSpec
from ledgerlake.sources.io import stage_table
from ledgerlake.sources.keyed import KeyedTable, upserts
from ledgerlake.sources.versioned import VersionedTable


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str | None = None,
                files_a_batch: int | None = None) -> DataFrame:
    """New parquet files in ``folder`` (optionally only names matching
    ``glob``) as a stream with a declared schema."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if files_a_batch:
        r = r.option("maxFilesPerTrigger", files_a_batch)
    return r.parquet(folder)


def read_changes(spark: SparkSession, folder: str, schema: T.StructType, start_seq: int | None = None,
                 glob: str | None = None) -> DataFrame:
    """A change-log stream.  With ``start_seq`` only later changes flow
    (a subscription without the initial copy); the initial copy itself is the
    ``base`` handed to ``replicate_stream``."""
    s = file_stream(spark, folder, schema, glob)
    if start_seq is not None:
        s = s.where(F.col("seq") > F.lit(start_seq))
    return s


def run_available(writer, checkpoint: str) -> None:
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _newest_batch(table: PartitionedTable) -> int:
    return table.manifest().get("batch", -1)


def _start(table: PartitionedTable, rows: DataFrame) -> PartitionedTable:
    """Write a table's first rows, if it has no manifest yet."""
    return table if table.current() is not None else table.write(rows, {"batch": -1})


def _touched(table: PartitionedTable, values: list[Column], rows: DataFrame) -> list[str]:
    """Names of the partitions that hold the given key values (at most as many as partitions)."""
    kind = table.read().schema[table.spec.column].dataType
    names = F.array(*[F.when(v.isNotNull(), table.spec.assign(v.cast(kind))) for v in values])
    got = rows.select(F.explode(names).alias("p")).where("p is not null").distinct().collect()
    return sorted(r.p for r in got)


def upsert_sink(table: KeyedTable):
    """foreachBatch function: each row replaces the row with its keys; what a batch writes does not depend on
    the table's size."""
    def write(batch: DataFrame, batch_id: int) -> None:
        table.append(batch, batch_id)
        table.compact()
    return write


# ------------------------------------------------------------------ M2
#: Hash partitions of replicas without a key.
BUCKETS = 16


def replicate_stream(spark: SparkSession, changes: DataFrame, base: DataFrame, target_root: str,
                     checkpoint: str, identity: str = "key", buckets: int = BUCKETS) -> KeyedTable | PartitionedTable:
    """Continuous replica.  With identity ``key`` each micro-batch becomes one delta of a merge-on-read table, and a
    truncate starts the table anew.  Otherwise the batch is applied to the hash partitions of the first key
    column that its images fall in (to all of them after a truncate).  A batch that is in already (a
    retry) is skipped; an apply error stops the query, and a restart resumes at that batch."""
    keys = changes.schema["key"].dataType.fieldNames()
    if identity == "key":
        table = KeyedTable(spark, target_root).start(base, keys)

        def merge(batch: DataFrame, batch_id: int) -> None:
            if batch_id > table.state().batch:
                rows, truncate = upserts(batch, table)
                table.append(rows, batch_id, truncate)
                table.compact()

        run_available(changes.writeStream.foreachBatch(merge), checkpoint)
        return table
    column = keys[0]
    target = _start(PartitionedTable(spark, target_root, PartitionSpec.hash(column, buckets)), base)

    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= _newest_batch(target):
            return
        if batch.where(F.col("op") == "T").isEmpty():
            images = [F.col(f"{c}.{column}") for c in ("key", "before", "after") if column in batch.schema[c].dataType.fieldNames()]
            touched = _touched(target, images, batch)
        else:
            touched = [f"p{k}" for k in range(buckets)]
        if touched:
            target.rewrite(touched, lambda rows: apply_changes(rows, batch, identity), {"batch": batch_id})

    run_available(changes.writeStream.foreachBatch(apply), checkpoint)
    return target


# ------------------------------------------------------------------ M4 as a stream
def mart_stream(spark: SparkSession, changes: DataFrame, prices: DataFrame, root: str, checkpoint: str) -> DataFrame:
    """The delta mart as a stream over the sales change log (inserts, updates, deletes,
    truncates): each micro-batch is summed per name and added to the kept sums and counts
    of live sales.  A name without live sales has no row."""
    from ledgerlake.operators.mart import AMOUNT, steps
    schema = f"good_name string, sum_sale {AMOUNT}, n long"
    table = KeyedTable(spark, root).start(spark.createDataFrame([], schema), ["good_name"], "sum")

    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= table.state().batch:
            return
        batch = stage_table(batch, "mart_batch")
        signed = F.when(F.col("kind") == "ADD", F.col("amt")).otherwise(-F.col("amt"))
        delta = steps(batch, prices).groupBy("good_name").agg(F.sum(signed).cast(AMOUNT).alias("sum_sale"), F.sum("cnt").alias("n"))
        table.append(delta, batch_id, truncate=not batch.where(F.col("op") == "T").isEmpty())
        table.compact()

    run_available(changes.writeStream.foreachBatch(apply), checkpoint)
    return table.read().where("n > 0").select("good_name", "sum_sale")


# ------------------------------------------------------------------ M8
def minute_stream(spark: SparkSession, events: DataFrame, root: str, checkpoint: str,
                  watermark: str = "10 minutes") -> DataFrame:
    """Per-minute event count and bytes with a watermark for late data."""
    # watermarks need zoned timestamps; the session zone is UTC, so wall time is kept
    agg = (events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
           .groupBy(F.window("ts", "1 minute").alias("w"))
           .agg(F.count(F.lit(1)).alias("events"), F.sum(F.length("props")).cast("long").alias("bytes"))
           .select(F.col("w.start").cast("timestamp_ntz").alias("minute"), "events", "bytes"))
    table = KeyedTable(spark, root).start(spark.createDataFrame([], "minute timestamp_ntz, events long, bytes long"), ["minute"])
    run_available(agg.writeStream.outputMode("update").foreachBatch(upsert_sink(table)), checkpoint)
    return table.read()


# ------------------------------------------------------------------ M3 as a stream
def mart_exact_batch(spark: SparkSession, target: VersionedTable, prices: DataFrame):
    """foreachBatch function of the exact mart: the current mart rows enter
    as leading ADD steps (a present row = an insert of its sum), the batch's
    changes follow, and the ordered fold runs in parallel (``apply_exact``).
    A truncate in the batch drops the carried state.  The result is committed
    as version ``batch_id + 1``; a retried batch whose version exists is skipped."""
    from ledgerlake.operators.mart import AMOUNT, NEG_INF_SEQ, apply_exact, steps

    def apply(batch: DataFrame, batch_id: int) -> None:
        v = batch_id + 1
        if v in target.versions():
            return
        last_t = batch.where(F.col("op") == "T").agg(F.max("seq").alias("_tseq"))
        carried = (target.read().crossJoin(F.broadcast(last_t))    # one row by construction
                   .where(F.col("_tseq").isNull())
                   .select("good_name", F.lit(NEG_INF_SEQ).cast("long").alias("o"), F.lit("ADD").alias("kind"),
                           F.col("sum_sale").cast(AMOUNT).alias("amt"), F.lit(1).alias("cnt")))
        new = apply_exact(spark, carried.unionByName(steps(batch, prices)))
        target.publish(target.stage(new, version=v), new.schema)
    return apply


def mart_stream_exact(spark: SparkSession, changes: DataFrame, prices: DataFrame, target_root: str,
                      checkpoint: str) -> VersionedTable:
    """M3 stream: the exact mart kept by a stream of sales changes."""
    target = VersionedTable(spark, target_root)
    if target.current() is None:
        empty = spark.createDataFrame([], "good_name string, sum_sale decimal(38,2)")
        target.publish(target.stage(empty, version=0), empty.schema)
    run_available(changes.writeStream.foreachBatch(mart_exact_batch(spark, target, prices)), checkpoint)
    return target
