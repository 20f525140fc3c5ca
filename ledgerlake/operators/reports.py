"""Operational reports over log text and sample tables.

The parse is ``regexp_extract`` on ``spark.read.text`` lines; the work is
the distributed aggregation, lag and join after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.scalar import idiv, lsn_to_long, rate_pretty, size_pretty
from ledgerlake.operators.ordered import bucket, chunked_lag, ts_bucket

DAY, HOUR = 86400, 3600
TS_FMT = "yyyy-MM-dd HH:mm:ss.SSS"

# Trailing windows of the log-volume summary (label, seconds).
SUMMARY_WINDOWS = [("Last 5 minutes", 300), ("Last 10 minutes", 600), ("Last hour", 3600),
                   ("Last day", 86400)]


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Text log source, one row per line in column ``value``."""
    return spark.read.text(path)


def _ts_text(c):
    return F.date_format(c, TS_FMT)


def _parse_ts(c):
    # log text is untrusted input: a malformed stamp becomes NULL instead of failing the job
    return F.try_to_timestamp(c, F.lit(TS_FMT)).cast("timestamp_ntz")


def _millis(c):
    return F.unix_millis(c.cast("timestamp"))


def _from_millis(c):
    return F.timestamp_millis(c).cast("timestamp_ntz")


# ------------------------------------------------------------------ L1 / L2 / M8
def log_volume(samples: DataFrame) -> DataFrame:
    """L1: bytes and seconds since the previous sample per source, rate, pretty forms."""
    s = samples.withColumn("_lsn", lsn_to_long("lsn_position"))
    s = chunked_lag(s, "source", "sample_ts", ["_lsn", "sample_ts"], ts_bucket("sample_ts", DAY))
    b = F.col("_lsn") - F.col("prev__lsn")
    secs = F.unix_seconds(F.col("sample_ts").cast("timestamp")) - F.unix_seconds(F.col("prev_sample_ts").cast("timestamp"))
    return s.select("source", "sample_ts", "lsn_position",
                    b.alias("wal_bytes_since_previous"), size_pretty(b).alias("wal_size_since_previous"),
                    idiv(b, secs).alias("bytes_per_second"), rate_pretty(idiv(b, secs)).alias("rate_pretty"),
                    secs.alias("seconds_since_previous"))


def log_volume_summary(volume: DataFrame, now=None, windows=SUMMARY_WINDOWS) -> DataFrame:
    """L2: per trailing window: samples, total, average per sample-minute and
    average rate over the nominal window length.  ``now`` defaults to the
    newest sample (one tiny aggregate); one conditional-aggregate pass."""
    if now is None:
        now = volume.agg(F.max("sample_ts")).first()[0]
    age = F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds(F.col("sample_ts").cast("timestamp"))
    aggs = []
    for i, (_, secs) in enumerate(windows):
        inside = age < secs
        aggs += [F.count(F.when(inside, 1)).alias(f"n{i}"),
                 F.sum(F.when(inside, F.col("wal_bytes_since_previous"))).cast("long").alias(f"t{i}")]
    one = volume.agg(*aggs)
    rows = [F.struct(F.lit(label).alias("window"), F.col(f"n{i}").alias("samples"), F.col(f"t{i}").alias("total"),
                     F.lit(secs).alias("secs")) for i, (label, secs) in enumerate(windows)]
    r = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return r.select("window", "samples", size_pretty("total").alias("total_wal_size"),
                    size_pretty(idiv("total", "samples")).alias("avg_wal_per_minute"),
                    rate_pretty(idiv("total", "secs")).alias("avg_rate"))


def minute_volume(events: DataFrame) -> DataFrame:
    """M8 batch form: events and bytes per one-minute window."""
    return events.groupBy(F.window("ts", "1 minute").alias("w")).agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.length("props")).cast("long").alias("bytes")
    ).select(F.col("w.start").alias("minute"), "events", "bytes")


# ------------------------------------------------------------------ L3
def checkpoint_report(lines: DataFrame, target_seconds: int) -> DataFrame:
    """L3: parsed checkpoints, time since the previous one, on-schedule flag."""
    c = lines.where(F.col("value").contains("checkpoint complete")).select(
        _parse_ts(F.regexp_extract("value", r"^(\S+ \S+) UTC", 1)).alias("ts"),
        F.regexp_extract("value", r"wrote (\d+) buffers", 1).try_cast("long").alias("buffers"),
        F.regexp_extract("value", r"distance=(\d+) kB", 1).try_cast("long").alias("distance_kb"),
        F.lit("server").alias("_src"))
    c = chunked_lag(c, "_src", ["ts", "buffers", "distance_kb"], ["ts"], ts_bucket("ts", DAY))
    gap = _millis(F.col("ts")) - _millis(F.col("prev_ts"))
    return c.select("ts", "buffers", "distance_kb", gap.alias("ms_since_previous"),
                    (gap <= target_seconds * 1000).alias("on_schedule"))


def checkpoint_summary(report: DataFrame) -> DataFrame:
    """L3: number of checkpoints, how many were on schedule, and their mean distance."""
    return report.agg(F.count(F.lit(1)).alias("checkpoints"), F.count_if(F.col("on_schedule")).alias("on_schedule"),
                      idiv(F.sum("distance_kb"), F.count("distance_kb")).alias("mean_distance_kb"))


# ------------------------------------------------------------------ L4
def lock_waits(lines: DataFrame) -> DataFrame:
    """L4: one row per wait: pid, lock mode and target (a transaction, a tuple, ...), the
    transaction's number if it is one, holders and wait queue as listed, logged at,
    acquired at, wait in ms (null while the wait lasts).

    Each line is parsed once.  A DETAIL line belongs to the line of the same process
    and time; an acquisition ends the wait of the same process on the same lock before it."""
    value = F.col("value")
    lock = r"(still waiting for|acquired) (\S+) on (.+) after ([\d.]+) ms"
    p = lines.where(value.rlike(r"still waiting for| acquired |holding the lock:")).select(
        _parse_ts(F.regexp_extract(value, r"^(\S+ \S+) UTC", 1)).alias("ts"),
        F.regexp_extract(value, r"UTC \[(\d+)\]", 1).try_cast("long").alias("pid"),
        F.nullif(F.regexp_extract(value, lock, 1), F.lit("")).alias("what"),
        F.nullif(F.regexp_extract(value, lock, 2), F.lit("")).alias("mode"),
        F.nullif(F.regexp_extract(value, lock, 3), F.lit("")).alias("target"),
        F.regexp_extract(value, lock, 4).try_cast("decimal(18,3)").alias("ms"),
        F.nullif(F.regexp_extract(value, r"holding the lock: ([\d, ]+)", 1), F.lit("")).alias("holders"),
        F.nullif(F.regexp_extract(value, r"Wait queue: ([\d, ]+)", 1), F.lit("")).alias("queue"))
    got = F.coalesce(F.col("what") == "acquired", F.lit(False))
    one = p.groupBy("pid", "ts", got.alias("got")).agg(*[F.max(c).alias(c) for c in ("mode", "target", "ms", "holders", "queue")])
    # the next line on the lock is the one before it in reversed time, which goes by chunks: a pooled process on one hot
    # lock is not one task
    back = one.where(F.col("target").isNotNull()).withColumn(
        "_back", F.coalesce(-F.unix_micros(F.col("ts").cast("timestamp")), F.lit(2 ** 63 - 1))).withColumn("_wait", ~F.col("got"))
    back = chunked_lag(back, ["pid", "mode", "target"], ["_back", "_wait"], ["got", "ts", "ms"], bucket("_back", HOUR * 1_000_000), "next_")
    ended = F.col("next_got")
    w = back.select("*", F.when(ended, F.col("next_ts")).alias("acquired_at"), F.when(ended, F.col("next_ms")).alias("wait_ms"))
    return w.where(~F.col("got")).select(
        "pid", "mode", "target", F.regexp_extract("target", r"^transaction (\d+)$", 1).try_cast("long").alias("trx"),
        "holders", "queue", F.col("ts").alias("waiting_at"), "acquired_at", "wait_ms")


# ------------------------------------------------------------------ L5
def blocking_chains(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """For every waiting process and every root blocker (a process that waits for
    nobody) at the end of its chains: least and greatest depth (hops to the root) and
    the shortest chain as ``pid -> ... -> root`` (the first one by process ids).

    A process may wait for several others.  Pointer jumping: each pass replaces
    every pointer by its target's pointers and adds the hop counts, then keeps one row
    per (process, target), so after k passes a pointer has followed up to 2**k hops and
    chains that meet again do not multiply.  The number of passes is about log2 of the
    longest chain, and the state is written to the shared folder between passes.  A
    process whose chain runs into a cycle has a row with NULL root, depth and path.
    """
    from ledgerlake.sources.io import stage_table
    e = edges.select(F.col("pid").cast("long").alias("pid"), F.col("blocker").cast("long").alias("blocker")).distinct()
    e = stage_table(e, "chains")
    waiting = e.select(F.col("pid").alias("w")).distinct()
    cur = e.join(waiting, e.blocker == waiting.w, "left").select(
        "pid", F.col("blocker").alias("nxt"), F.lit(1).cast("long").alias("lo"), F.lit(1).cast("long").alias("hi"),
        F.array("pid", "blocker").alias("path"), F.col("w").isNull().alias("done"))
    cur = stage_table(cur, "chains")
    # a chain without a cycle has at most as many hops as processes wait, so it is
    # resolved after about log2 of them passes; what is open then runs into a cycle
    for _ in range(waiting.count().bit_length() + 1):
        if cur.where(~F.col("done")).isEmpty():
            break
        hop = cur.select(F.col("pid").alias("h_pid"), F.col("nxt").alias("h_nxt"), F.col("lo").alias("h_lo"),
                         F.col("hi").alias("h_hi"), F.col("path").alias("h_path"), F.col("done").alias("h_done"))
        far = cur.where(~F.col("done")).join(hop, F.col("nxt") == F.col("h_pid")).select(
            "pid", F.col("h_nxt").alias("nxt"), (F.col("lo") + F.col("h_lo")).alias("lo"), (F.col("hi") + F.col("h_hi")).alias("hi"),
            F.concat("path", F.slice("h_path", 2, F.size("h_path"))).alias("path"), F.col("h_done").alias("done"))
        cur = stage_table(cur.where("done").unionByName(far).groupBy("pid", "nxt", "done").agg(
            F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min(F.struct("lo", "path")).alias("p")).select(
            "pid", "nxt", "lo", "hi", F.col("p.path").alias("path"), "done"), "chains")
    done = F.col("done")
    return cur.select("pid", F.when(done, F.col("nxt")).alias("root"), F.when(done, F.col("lo")).cast("int").alias("min_depth"),
                      F.when(done, F.col("hi")).cast("int").alias("max_depth"),
                      F.when(done, F.array_join(F.transform("path", lambda x: x.cast("string")), " -> ")).alias("path")).distinct()


def chain_path(spark: SparkSession, edges: DataFrame, pid: int) -> str:
    """The wait chain of one process as ``pid -> ... -> root``: a recursive CTE
    seeded with that process follows one pointer per step (the frontier is a
    single row); a process already on the path ends the walk."""
    walk = spark.sql(
        """
        WITH RECURSIVE r(cur, depth, path) AS (
          SELECT CAST(:pid AS BIGINT), 0, array(CAST(:pid AS BIGINT))
          UNION ALL
          SELECT e.blocker, r.depth + 1, concat(r.path, array(e.blocker))
          FROM r JOIN {edges} e ON e.pid = r.cur
          WHERE NOT array_contains(r.path, e.blocker)
        )
        SELECT path FROM r ORDER BY depth DESC, path LIMIT 1
        """, args={"pid": int(pid)},
        edges=edges.select(F.col("pid").cast("long").alias("pid"), F.col("blocker").cast("long").alias("blocker")))
    return " -> ".join(str(x) for x in walk.first()[0])


# ------------------------------------------------------------------ L6
def load_report(lines: DataFrame, baseline: str) -> DataFrame:
    """Per run: intervals, min / max tps, average tps (in cents,
    integer division) and the average relative to the baseline run (per mille)."""
    p = lines.where(F.col("value").contains("progress:")).select(
        F.regexp_extract("value", r"^\[run=([^\]]+)\]", 1).alias("run"),
        F.regexp_extract("value", r"progress: ([\d.]+) s", 1).try_cast("decimal(18,1)").alias("t"),
        F.regexp_extract("value", r", ([\d.]+) tps", 1).try_cast("decimal(18,2)").alias("tps"))
    g = p.groupBy("run").agg(F.count(F.lit(1)).alias("intervals"), F.min("tps").alias("min_tps"),
                             F.max("tps").alias("max_tps"),
                             F.sum((F.col("tps") * 100).cast("long")).alias("_cents"))
    g = g.withColumn("avg_tps_cents", idiv("_cents", "intervals"))
    base = g.where(F.col("run") == baseline).select(F.col("avg_tps_cents").alias("_base"))
    return (g.crossJoin(F.broadcast(base))     # one row by construction
            .select("run", "intervals", "min_tps", "max_tps", "avg_tps_cents",
                    idiv(F.col("avg_tps_cents") * 1000, "_base").alias("vs_baseline_permille")))
