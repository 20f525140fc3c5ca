import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake.operators import reports
from ledgerlake.operators.ordered import chunked_lag, latest_by_key, running_sum, ts_bucket

# log-position samples (newest first in the reference output)
SAMPLES = [("2025-11-17 18:56:00", "0/85827258"), ("2025-11-17 18:55:00", "0/807AEED0"),
           ("2025-11-17 18:54:00", "0/7B656CB8"), ("2025-11-17 18:53:00", "0/765A2118"),
           ("2025-11-17 18:52:00", "0/714A8F00"), ("2025-11-17 18:51:00", "0/6C3D05C0"),
           ("2025-11-17 18:50:00", "0/67329B70"), ("2025-11-17 18:49:00", "0/622806F8"),
           ("2025-11-17 18:48:00", "0/5D174F68"), ("2025-11-17 18:47:00", "0/58117678"),
           ("2025-11-17 18:46:00", "0/550C6F40"), ("2025-11-17 18:45:00", "0/550C4AC8")]


def samples(spark):
    return spark.createDataFrame([("wal", dt.datetime.fromisoformat(t), l) for t, l in SAMPLES],
                                 "source string, sample_ts timestamp_ntz, lsn_position string")


def test_log_volume_and_summary_goldens(spark):
    v = reports.log_volume(samples(spark))
    top = v.where(F.col("sample_ts") == F.lit("2025-11-17 18:56:00").cast("timestamp_ntz")).first()
    assert top.wal_bytes_since_previous == 84378504 and top.wal_size_since_previous == "80 MB"
    assert top.seconds_since_previous == 60
    s = {r.window: r for r in reports.log_volume_summary(v).collect()}
    assert s["Last 5 minutes"].samples == 5 and s["Last 5 minutes"].total_wal_size == "404 MB"
    assert s["Last 10 minutes"].samples == 10 and s["Last 10 minutes"].total_wal_size == "775 MB"
    assert s["Last 5 minutes"].avg_wal_per_minute == "81 MB"


def chains(spark, edges):
    found = reports.blocking_chains(spark, spark.createDataFrame(edges, "pid bigint, blocker bigint"))
    return sorted(((r.pid, r.root, r.min_depth, r.max_depth, r.path) for r in found.collect()), key=repr)


def test_blocking_chain_golden(spark):
    # lock table: 1795 waits for 1737, 12982 waits for 1795
    edges = [(1795, 1737), (12982, 1795)]
    assert chains(spark, edges) == [(12982, 1737, 2, 2, "12982 -> 1795 -> 1737"), (1795, 1737, 1, 1, "1795 -> 1737")]
    assert reports.chain_path(spark, spark.createDataFrame(edges, "pid bigint, blocker bigint"), 12982) == "12982 -> 1795 -> 1737"


def test_several_blockers_give_one_row_per_root(spark):
    assert chains(spark, [(1, 2), (1, 3), (5, 1)]) == [
        (1, 2, 1, 1, "1 -> 2"), (1, 3, 1, 1, "1 -> 3"), (5, 2, 2, 2, "5 -> 1 -> 2"), (5, 3, 2, 2, "5 -> 1 -> 3")]
    # two ways of different length to one root, given twice
    assert chains(spark, [(1, 9), (1, 2), (2, 9), (1, 9)]) == [(1, 9, 1, 2, "1 -> 9"), (2, 9, 1, 1, "2 -> 9")]


def test_long_chain_is_exact_and_cycles_have_no_root(spark):
    n = 100                                   # one chain 1 -> 2 -> ... -> 100 -> 0
    got = {x[0]: x[1:4] for x in chains(spark, [(i, i + 1) for i in range(1, n)] + [(n, 0)] + [(1001, 1002), (1002, 1001), (1003, 1001)])}
    assert got[1] == (0, n, n) and got[n] == (0, 1, 1) and got[50] == (0, 51, 51)
    assert got[1001] == got[1003] == (None, None, None)


def test_lock_wait_stitching(spark):
    def line(at, pid, text):
        return (f"2025-11-20 {at} UTC [{pid}] app@appdb {text}",)

    lines = spark.createDataFrame([
        line("17:54:44.936", 1795, "LOG:  process 1795 still waiting for ShareLock on transaction 4545163 after 100.563 ms"),
        line("17:54:44.936", 1795, "DETAIL:  Process holding the lock: 1737. Wait queue: 1795."),
        line("17:55:37.888", 1795, "LOG:  process 1795 acquired ShareLock on transaction 4545163 after 53052.348 ms"),
        line("17:56:01.000", 7, "LOG:  process 7 still waiting for ExclusiveLock on tuple (0,4) of relation 16388 of database 16385 after 100.1 ms"),
        line("17:56:01.000", 7, "DETAIL:  Processes holding the lock: 8, 9. Wait queue: 7, 11."),
        line("17:56:02.000", 7, "LOG:  process 7 acquired ExclusiveLock on tuple (0,4) of relation 16388 of database 16385 after 1100.5 ms"),
        line("17:57:01.000", 7, "LOG:  process 7 still waiting for ExclusiveLock on tuple (0,4) of relation 16388 of database 16385 after 100.1 ms"),
    ], "value string")
    got = sorted(reports.lock_waits(lines).collect(), key=lambda r: r.waiting_at)
    assert [(r.pid, r.mode, r.trx, r.holders, r.queue, None if r.wait_ms is None else float(r.wait_ms)) for r in got] == [
        (1795, "ShareLock", 4545163, "1737", "1795", 53052.348), (7, "ExclusiveLock", None, "8, 9", "7, 11", 1100.5),
        (7, "ExclusiveLock", None, None, None, None)]
    assert got[1].target == "tuple (0,4) of relation 16388 of database 16385" and got[2].acquired_at is None


def test_lock_waits_of_a_pooled_process(spark):
    """One process on one hot lock over many hours: each wait ends with the next line if that is an acquisition."""
    import datetime as dt
    import random
    rnd, at, kinds = random.Random(4), dt.datetime(2025, 11, 20, 23), []
    for k in range(300):
        at += dt.timedelta(milliseconds=rnd.choice([1, 500, 60_000, 5_000_000]))
        kinds.append((at, rnd.random() < 0.5, k))
    text = {True: "acquired", False: "still waiting for"}
    lines = spark.createDataFrame(
        [(f"{t:%Y-%m-%d %H:%M:%S}.{t.microsecond // 1000:03d} UTC [5] app@appdb LOG:  process 5 {text[done]} ShareLock on transaction 9 after {k}.000 ms",)
         for t, done, k in kinds], "value string").repartition(5)
    got = sorted((r.waiting_at, r.acquired_at, None if r.wait_ms is None else int(r.wait_ms)) for r in reports.lock_waits(lines).collect())
    want = [(t, kinds[i + 1][0], kinds[i + 1][2]) if i + 1 < len(kinds) and kinds[i + 1][1] else (t, None, None)
            for i, (t, done, _) in enumerate(kinds) if not done]
    assert [(a.replace(tzinfo=None), b and b.replace(tzinfo=None), c) for a, b, c in got] == want


def test_load_report_from_progress_lines(spark):
    tps = [1065.6, 1324.0, 1335.6, 1276.2, 1251.8, 1256.4, 1181.0, 1179.6, 1235.6, 1345.4, 1339.9, 1269.3]
    lines = [(f"[run=base] progress: {5.0 * (i + 1)} s, {t} tps, lat 40.000 ms stddev 50.000, 0 failed",)
             for i, t in enumerate(tps)]
    r = reports.load_report(spark.createDataFrame(lines, "value string"), "base").first()
    assert float(r.min_tps) == 1065.6 and float(r.max_tps) == 1345.4 and r.intervals == 12
    assert r.vs_baseline_permille == 1000


def test_two_level_running_sum_and_lag_equal_plain_window_under_skew(spark):
    rnd = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    data = [(0 if rnd.random() < 0.6 else rnd.randint(1, 5), i, start + dt.timedelta(minutes=rnd.randint(0, 20000)),
             rnd.randint(-50, 50)) for i in range(3000)]
    df = spark.createDataFrame(data, "k int, id int, ts timestamp_ntz, v int")
    w = Window.partitionBy("k").orderBy("ts", "id")
    plain = df.select("id", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
                      F.lag("v").over(w).alias("p"))
    two = running_sum(df, "k", ["ts", "id"], "v", "s", ts_bucket("ts", 3600))
    two = chunked_lag(two, "k", ["ts", "id"], ["v"], ts_bucket("ts", 7200)).select("id", "s", F.col("prev_v").alias("p"))
    assert sorted(plain.collect()) == sorted(two.collect())
    latest = {r.k: r.id for r in latest_by_key(df, "k", ["ts", "id"]).collect()}
    best = {}
    for k, i, ts, _ in data:
        if k not in best or (ts, i) > best[k][0]:
            best[k] = ((ts, i), i)
    assert latest == {k: v[1] for k, v in best.items()}


def test_log_parsers_tolerate_malformed_lines(spark):
    lines = spark.createDataFrame([
        ("2025-11-17 18:40:23.882 UTC [2158] LOG:  checkpoint complete: wrote 4 buffers (0.0%); distance=5 kB",),
        ("garbage checkpoint complete: wrote many buffers; distance=?? kB",),
        ("[run=x] progress: 5.0 s, 10.50 tps, lat 1.000 ms stddev 0.000, 0 failed",),
        ("[run=x] progress: oops s, n/a tps",),
    ], "value string")
    ck = reports.checkpoint_report(lines, 60).collect()
    assert sorted(r.buffers for r in ck if r.buffers is not None) == [4] and len(ck) == 2
    lr = reports.load_report(lines, "x").first()
    assert lr.intervals == 2 and float(lr.max_tps) == 10.5


def test_two_level_forms_keep_null_keys_and_orders(spark):
    df = spark.createDataFrame([(None, 1, None, 5), (None, 2, None, 7), (1, 3, None, 1), (1, 4, dt.datetime(2024, 1, 1), 2)],
                               "k int, id int, ts timestamp_ntz, v int")
    w = Window.partitionBy("k").orderBy("ts", "id")
    plain = df.select("id", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
                      F.lag("v").over(w).alias("p"))
    two = running_sum(df, "k", ["ts", "id"], "v", "s", ts_bucket("ts", 3600))
    two = chunked_lag(two, "k", ["ts", "id"], ["v"], ts_bucket("ts", 3600)).select("id", "s", F.col("prev_v").alias("p"))
    assert sorted(plain.collect()) == sorted(two.collect())
