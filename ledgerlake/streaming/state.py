"""M3, U1 as keyed state: the exact mart kept by a stateful processor.

Each good name's running sum lives in the state store (RocksDB), so a micro-batch costs its own rows: no
table is read or rewritten to apply it.  The processor puts a name's steps of the batch in order and
applies the mart's rules; a run of steps in which no delete is ignored is one sum.

A truncate concerns every name and has no name of its own, so it is an epoch: each step carries the
number of truncates before it, a name whose state is of an older epoch starts from nothing, and the mart
leaves out names of older epochs.  The truncates known at the start go into the plan; one that is met in the
stream and was not known stops the query before the batch is committed, and the next start knows it.

The changed names of a batch (update mode) are one delta of a merge-on-read table.  State and offsets
come from the checkpoint, the table skips batches that it has, so a stop at any point loses and repeats
nothing.  A name's steps of one micro-batch meet in one task: ``files_a_batch`` of the source bounds them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ledgerlake.operators.mart import AMOUNT, priced_steps
from ledgerlake.sources.keyed import GONE, KeyedTable
from ledgerlake.streaming.jobs import run_available

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Truncates that a log may hold; they are part of the plan.
MAX_TRUNCATES = 10_000


def fold(total: int, there: bool, adds: np.ndarray, amounts: np.ndarray) -> tuple[int, bool]:
    """The mart's rules for a name that is entered with a sum: steps in order, ``adds`` tells the kind."""
    at, n = 0, len(amounts)
    while at < n:
        run = total + np.cumsum(np.where(adds[at:], amounts[at:], -amounts[at:]))
        # a delete that would leave less than nothing is ignored; so is one of a row that is not there
        wrong = np.flatnonzero(~adds[at:] & ((run < 0) | (amounts[at:] < 0)))
        end = int(wrong[0]) if len(wrong) else n - at
        if end:
            total = int(run[end - 1])
            there = bool(adds[at + end - 1]) or total != 0
        if end < n - at:
            amount = int(amounts[at + end])
            if there and total >= amount:
                total -= amount
                there = total != 0
            end += 1
        at += end
    return total, there


class MartState(StatefulProcessor):
    """Per name: the sum in cents, whether the mart has a row, the epoch and the order of the last step."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("mart", "cents long, there boolean, epoch long, o long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [(f["epoch"].to_numpy(np.int64), f["o"].to_numpy(np.int64), (f["kind"] == "ADD").to_numpy(bool), f["cents"].to_numpy(np.int64)) for f in rows]
        epoch, o, adds, cents = (np.concatenate(x) for x in zip(*parts))
        total, there, before, last = self.state.get() if self.state.exists() else (0, False, 0, None)
        order = np.argsort(o, kind="stable")
        o, epoch, adds, cents = o[order], epoch[order], adds[order], cents[order]
        if (last is not None and o[0] <= last) or (o[1:] == o[:-1]).any():
            raise ValueError(f"mart: steps of {key[0]!r} came twice or out of order")
        if epoch[-1] > before:
            total, there = 0, False
        now = epoch == epoch[-1]
        total, there = fold(total, there, adds[now], cents[now])
        self.state.update((total, there, int(epoch[-1]), int(o[-1])))
        yield pd.DataFrame({"good_name": [key[0]], "cents": [total], "there": [there], "epoch": [int(epoch[-1])]})

    def close(self) -> None:
        pass


def mart_stream_state(spark: SparkSession, changes: DataFrame, log: DataFrame, prices: DataFrame, root: str,
                      checkpoint: str) -> DataFrame:
    """The exact mart over a stream of sales changes that arrive in the order of their ``seq``; ``log`` is what is
    there of the same log at the start, read for its truncates only.  Returns (good_name, sum_sale)."""
    cuts = sorted(r.seq for r in log.where(F.col("op") == "T").select("seq").distinct().limit(MAX_TRUNCATES + 1).collect())
    if len(cuts) > MAX_TRUNCATES:
        raise ValueError(f"more than {MAX_TRUNCATES} truncates in the log")
    known = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    late = F.raise_error(F.lit("a truncate came while the stream ran: start it again")).cast("boolean")
    rows = F.when(F.col("op") != "T", F.lit(True)).otherwise(F.when(F.array_contains(known, F.col("seq")), F.lit(False)).otherwise(late))
    epoch = F.size(F.filter(known, lambda c: c < F.col("seq"))).cast("long")
    steps = priced_steps(changes.where(rows).withColumn("epoch", epoch), prices, "epoch")
    steps = steps.select("good_name", "epoch", "o", "kind", (F.col("amt") * 100).cast("long").alias("cents"))
    out = steps.groupBy("good_name").transformWithStateInPandas(
        MartState(), "good_name string, cents long, there boolean, epoch long", "Update", "None")
    table = KeyedTable(spark, root).start(spark.createDataFrame([], f"good_name string, sum_sale {AMOUNT}, epoch long"), ["good_name"])

    def apply(batch: DataFrame, batch_id: int) -> None:
        table.append(batch.select("good_name", (F.col("cents").cast("decimal(20,0)") / 100).cast(AMOUNT).alias("sum_sale"), "epoch",
                                  (~F.col("there")).alias(GONE)), batch_id)
        table.compact()

    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        run_available(out.writeStream.outputMode("update").foreachBatch(apply), checkpoint)
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)
    return table.read().where(F.col("epoch") == len(cuts)).select("good_name", "sum_sale")
