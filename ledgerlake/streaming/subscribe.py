"""Subscriptions with an initial copy, and several publishers in one reader.

Initial copy: the publisher's table at a position n of its log is copied, and the log is followed from n on.  The
position is fixed before the copy starts and kept with it, so it does not matter how the log grows meanwhile, in which
files its changes lie, or how often the reader starts again: a change up to n is in the copy, any later one
comes through the log, none is lost or applied twice.

Several publishers: the reader's rows carry their source, and its commits a position a source.  Each source is
followed by a stream of its own; one that fails stops where it is while the others go on, and a later start
resumes it after its last committed change.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.changes import as_of
from ledgerlake.sources import fs
from ledgerlake.sources.io import stage_table
from ledgerlake.sources.keyed import GONE, KeyedTable, upserts
from ledgerlake.streaming.jobs import file_stream

SOURCE = "source"


def take_snapshot(base: DataFrame, log: DataFrame, path: str) -> int:
    """Copy a publisher's table, ``base`` with its log applied, to ``path``; returns the position that it is a copy
    of.  A copy that was not finished has no position and can't be subscribed to."""
    spark = base.sparkSession
    newest = log.agg(F.max("seq")).first()[0]
    position = -1 if newest is None else int(newest)
    as_of(base, log, position).write.option("compression", "zstd").parquet(f"{path}/rows")
    fs.write_text(spark, f"{path}/_position", json.dumps({"position": position, "schema": json.loads(base.schema.json())}))
    return position


def read_snapshot(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    c = json.loads(fs.read_text(spark, f"{path}/_position"))
    return spark.read.schema(T.StructType.fromJson(c["schema"])).parquet(f"{path}/rows"), c["position"]


class Reader:
    """A table of (source, key) fed by several publishers."""

    def __init__(self, spark: SparkSession, root: str, rows: T.StructType, keys: list[str]):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), keys
        schema = T.StructType([T.StructField(SOURCE, T.StringType()), *rows.fields])
        self.table = KeyedTable(spark, f"{self.root}/table").start(spark.createDataFrame([], schema), [SOURCE, *keys])
        self._lock = threading.Lock()       # streams of one driver commit one after the other

    def positions(self) -> dict[str, int]:
        """Last committed position of each source."""
        return dict(self.table.state().marks)

    def _commit(self, name: str, rows: DataFrame, position: int, start_anew: bool) -> None:
        rows = rows.withColumn(SOURCE, F.lit(name))
        with self._lock:
            if start_anew:      # a truncate of one source: tombstones for its rows that the batch does not bring
                names = self.table.read().columns
                old = self.table.read().where(F.col(SOURCE) == name).join(rows, [SOURCE, *self.keys], "left_anti")
                rows = rows.select(*names, GONE).unionByName(old.select(*names, F.lit(True).alias(GONE)))
            self.table.append(rows, position, source=name)
            self.table.compact()

    def add(self, name: str, snapshot: str) -> None:
        """Start a source from a snapshot, if it has no position yet."""
        if name not in self.positions():
            rows, position = read_snapshot(self.spark, snapshot)
            self._commit(name, rows.withColumn(GONE, F.lit(False)), position, False)

    def follow(self, logs: Mapping[str, DataFrame]) -> dict[str, str | None]:
        """Apply what is there of each source's change stream; returns source -> error, None if it is up to date."""
        running = {}
        for name, changes in logs.items():
            writer = changes.writeStream.foreachBatch(self._apply(name)).option("checkpointLocation", f"{self.root}/_checkpoint-{name}")
            running[name] = writer.trigger(availableNow=True).start()
        errors: dict[str, str | None] = {}
        for name, q in running.items():
            try:
                q.awaitTermination()
                errors[name] = None
            except Exception as e:  # noqa: BLE001  (reported to the caller by source; the others go on)
                errors[name] = str(e)
        return errors

    def _apply(self, name: str):
        def apply(batch: DataFrame, batch_id: int) -> None:
            position = self.positions().get(name)
            batch = batch if position is None else batch.where(F.col("seq") > position)
            batch = stage_table(batch, "source_batch")
            newest = batch.agg(F.max("seq")).first()[0]
            if newest is not None:
                rows, truncate = upserts(batch, _Part(self.table, name, self.keys))
                self._commit(name, rows, int(newest), truncate)
        return apply


class _Part:
    """One source's rows of a reader's table, as ``upserts`` reads them."""

    def __init__(self, table: KeyedTable, name: str, keys: list[str]):
        self.table, self.name, self.keys = table, name, keys

    def info(self) -> dict:
        info = self.table.info()
        return {"keys": self.keys, "schema": {"fields": [f for f in info["schema"]["fields"] if f["name"] != SOURCE]}}

    def read_keys(self, wanted: DataFrame) -> DataFrame:
        return self.table.read_keys(wanted.select(F.lit(self.name).alias(SOURCE), *self.keys)).drop(SOURCE)


def follow_folders(reader: Reader, folders: Mapping[str, str], schema: T.StructType, files_a_batch: int | None = None) -> dict[str, str | None]:
    """``follow`` of change logs in folders of Parquet files."""
    return reader.follow({n: file_stream(reader.spark, f, schema, files_a_batch=files_a_batch) for n, f in folders.items()})
