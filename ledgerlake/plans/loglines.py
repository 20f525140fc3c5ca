"""Server log lines, sampler tables and wait edges from the driver's ``events`` table, so that the reports run on input
that grows with the tables.  The queries store the text once and read it from there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.scalar import long_to_lsn
from ledgerlake.operators.ordered import chunked_lag, running_sum, ts_bucket
from ledgerlake.operators.reports import DAY, _from_millis, _millis, _ts_text


def wal_samples(events: DataFrame, bytes_per_char: int = 8192) -> DataFrame:
    """A per-minute sampler's table: ``(source, sample_ts, lsn_position)``.

    Log bytes per minute are derived from the events; the position is the
    running total, rendered as ``hi/lo`` hex text."""
    per_min = events.groupBy(F.date_trunc("minute", "ts").alias("sample_ts")).agg(
        (F.sum(F.length("props")) * bytes_per_char).cast("long").alias("_b"))
    per_min = per_min.withColumn("source", F.lit("events"))
    cum = running_sum(per_min, "source", "sample_ts", "_b", "_lsn", ts_bucket("sample_ts", DAY))
    return cum.select("source", "sample_ts", long_to_lsn("_lsn").alias("lsn_position"))


def checkpoint_lines(events: DataFrame) -> DataFrame:
    """Server log lines: a checkpoint line per 'purchase' event, a connection
    line per 'view' event (noise the report must skip)."""
    pre = F.concat(_ts_text("ts"), F.lit(" UTC ["), F.col("user_id").cast("string"), F.lit("] LOG:  "))
    ck = events.where(F.col("event_type") == "purchase").select(F.concat(
        pre, F.lit("checkpoint complete: wrote "), F.floor("value").cast("string"),
        F.lit(" buffers (0.0%); 0 WAL file(s) added, 0 removed, 0 recycled; write=0.001 s, sync=0.001 s, "
              "total=0.002 s; sync files=0, longest=0.000 s, average=0.000 s; distance="),
        F.floor(F.col("value") * 100).cast("string"), F.lit(" kB, estimate="),
        F.floor(F.col("value") * 100).cast("string"), F.lit(" kB; lsn=0/0, redo lsn=0/0")).alias("value"))
    noise = events.where(F.col("event_type") == "view").select(
        F.concat(pre, F.lit("connection received: host=[local]")).alias("value"))
    return ck.unionByName(noise)


def lock_lines(events: DataFrame) -> DataFrame:
    """The lines per lock wait ('error' events): still waiting, DETAIL and a STATEMENT of two lines at
    the event time, acquired after the wait.  Even events wait for a transaction,
    odd ones for a tuple; every third one for two holders."""
    pid = (F.col("event_id") + 1000).cast("string")
    odd, third = F.col("event_id") % 2 == 1, F.col("event_id") % 3 == 0
    lock = F.when(odd, F.concat(F.lit("ExclusiveLock on tuple (0,"), (F.col("event_id") % 100).cast("string"),
                                F.lit(") of relation 16388 of database 16385"))).otherwise(
        F.concat(F.lit("ShareLock on transaction "), (F.col("event_id") + 4545000).cast("string")))
    holder = (F.col("user_id") + 1000).cast("string")
    holders = F.when(third, F.concat(F.lit("Processes holding the lock: "), holder, F.lit(", 999. Wait queue: "))).otherwise(
        F.concat(F.lit("Process holding the lock: "), holder, F.lit(". Wait queue: ")))
    wait_ms = F.floor(F.col("value") * 1000) + 100
    e = events.where(F.col("event_type") == "error")
    acq_ts = _from_millis(_millis(F.col("ts")) + wait_ms - 100)

    def line(ts, level, *rest):
        return F.concat(_ts_text(ts), F.lit(" UTC ["), pid, F.lit(f"] app@appdb {level}:  "), *rest)

    log = F.array(
        line(F.col("ts"), "LOG", F.lit("process "), pid, F.lit(" still waiting for "), lock, F.lit(" after 100.000 ms")),
        line(F.col("ts"), "DETAIL", holders, pid, F.lit(".")),
        line(F.col("ts"), "STATEMENT", F.lit("update accounts set n = n + 1\n\twhere id = "), F.col("user_id").cast("string"), F.lit(";")),
        line(acq_ts, "LOG", F.lit("process "), pid, F.lit(" acquired "), lock, F.lit(" after "), wait_ms.cast("string"), F.lit(".250 ms")))
    return e.select(F.explode(log).alias("value"))


def wait_edges(events: DataFrame) -> DataFrame:
    """Waits-for edges: each 'error' event's process waits for the previous
    'error' process of the same user on the same day, else for a root
    process (user_id + 100000) that waits for nobody."""
    e = events.where(F.col("event_type") == "error").select(
        (F.col("event_id") + 1000).alias("pid"), "user_id", "ts", F.to_date("ts").alias("day"))
    e = chunked_lag(e, ["user_id", "day"], ["ts", "pid"], ["pid"], ts_bucket("ts", 3600))
    return e.select("pid", F.coalesce(F.col("prev_pid"), F.col("user_id") + 100000).alias("blocker"))


def progress_lines(events: DataFrame) -> DataFrame:
    """Load-tool progress lines: one per (run = event_type, hour)."""
    hour = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600).cast("long")
    per = events.groupBy(F.col("event_type").alias("run"), hour.alias("h")).agg(
        F.sum(F.col("value").cast("decimal(12,2)")).alias("tps"), F.count(F.lit(1)).alias("lat"))
    first = per.groupBy("run").agg(F.min("h").alias("h0"))
    p = per.join(first, "run")
    return p.select(F.concat(F.lit("[run="), F.col("run"), F.lit("] progress: "),
                             ((F.col("h") - F.col("h0") + 1) * 3600).cast("string"), F.lit(".0 s, "),
                             F.col("tps").cast("string"), F.lit(" tps, lat "), F.col("lat").cast("string"),
                             F.lit(".000 ms stddev 0.000, 0 failed")).alias("value"))
