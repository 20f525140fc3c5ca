"""Subscriptions with an initial copy, several publishers, and reads of a log at any position."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.changes import as_of
from ledgerlake.sources.archive import LogArchive
from ledgerlake.streaming.subscribe import Reader, follow_folders, read_snapshot, take_snapshot

ROW = "id long, v long"
LOG = "seq long, commit_ts timestamp_ntz, op string, key struct<id:long>, before struct<v:long>, after struct<v:long>"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def changes(rng, lo, hi, truncates=()):
    out = []
    for seq in range(lo, hi):
        op = "T" if seq in truncates else rng.choice("IUUD")
        out.append((seq, None, op, None if op == "T" else (rng.randrange(12),), None, (seq * 10,) if op in "IU" else None))
    return out


def table_after(log, base=()):
    out = dict(base)
    for _, _, op, key, _, after in sorted(log):
        if op == "T":
            out = {}
        elif op == "D":
            out.pop(key[0], None)
        else:
            out[key[0]] = after[0]
    return sorted(out.items())


def put(spark, rows_, folder):
    spark.createDataFrame(rows_, LOG).coalesce(1).write.mode("append").parquet(folder)


def test_no_change_is_lost_or_applied_twice_while_the_log_grows(spark, scratch):
    rng, root = random.Random(1), scratch("handover")
    schema, base = spark.createDataFrame([], LOG).schema, spark.createDataFrame([(100, 1)], ROW)
    log = changes(rng, 0, 30)
    put(spark, log, f"{root}/log")
    seen = spark.read.schema(schema).parquet(f"{root}/log")
    # the log grows after the copy's view of it was taken, in a file that also holds later changes
    log += changes(rng, 30, 45)
    put(spark, log[30:], f"{root}/log")
    assert take_snapshot(base, seen, f"{root}/copy") == 29
    assert rows(read_snapshot(spark, f"{root}/copy")[0]) == table_after(log[:30], [(100, 1)])
    reader = Reader(spark, f"{root}/reader", base.schema, ["id"])
    reader.add("a", f"{root}/copy")
    for n in range(2):      # a later start, and one that finds nothing new
        assert follow_folders(reader, {"a": f"{root}/log"}, schema) == {"a": None}
        assert rows(reader.table.read().drop("source")) == table_after(log, [(100, 1)])
        reader.add("a", f"{root}/copy")         # a source that has a position is not copied again
        log += changes(rng, len(log), len(log) + 9)
        put(spark, log[-9:], f"{root}/log")
    reader = Reader(spark, f"{root}/reader", base.schema, ["id"])
    follow_folders(reader, {"a": f"{root}/log"}, schema)
    assert rows(reader.table.read().drop("source")) == table_after(log, [(100, 1)])
    assert reader.positions() == {"a": len(log) - 1}
    # a reader whose stream checkpoint is lost reads the log again and applies nothing twice
    reader.root = f"{root}/elsewhere"
    follow_folders(reader, {"a": f"{root}/log"}, schema)
    assert rows(reader.table.read().drop("source")) == table_after(log, [(100, 1)])


def test_unfinished_copy_cannot_be_subscribed_to(spark, scratch):
    root = scratch("unfinished")
    spark.createDataFrame([(1, 1)], ROW).write.parquet(f"{root}/copy/rows")
    with pytest.raises(Exception):
        Reader(spark, f"{root}/reader", spark.createDataFrame([], ROW).schema, ["id"]).add("a", f"{root}/copy")


def test_one_source_stops_and_resumes_while_others_go_on(spark, scratch):
    rng, root = random.Random(2), scratch("sources")
    schema = spark.createDataFrame([], LOG).schema
    logs = {n: changes(rng, 0, 20) for n in "ab"}
    folders = {n: f"{root}/{n}" for n in "ab"}
    for n in "ab":
        put(spark, logs[n], folders[n])
    reader = Reader(spark, f"{root}/reader", spark.createDataFrame([], ROW).schema, ["id"])
    assert follow_folders(reader, folders, schema) == {"a": None, "b": None}
    for n in "ab":
        logs[n] += changes(rng, 20, 40, truncates=(31,) if n == "b" else ())
        put(spark, logs[n][20:], folders[n])
    apply = reader._apply

    def broken(name):
        def fail(batch, batch_id):
            raise RuntimeError("apply error")
        return fail if name == "a" else apply(name)

    reader._apply = broken
    errors = follow_folders(reader, folders, schema)
    assert "apply error" in errors["a"] and errors["b"] is None and reader.positions() == {"a": 19, "b": 39}

    def of(name):
        return rows(reader.table.read().where(F.col("source") == name).drop("source"))

    assert of("a") == table_after(logs["a"][:20]) and of("b") == table_after(logs["b"])
    reader._apply = apply
    assert follow_folders(reader, folders, schema) == {"a": None, "b": None}
    assert reader.positions() == {"a": 39, "b": 39}
    assert of("a") == table_after(logs["a"]) and of("b") == table_after(logs["b"])     # b's truncate left a's rows alone


def test_archive_reads_one_state_and_the_files_after_it(spark, scratch):
    rng = random.Random(3)
    log = changes(rng, 0, 400, truncates=(170,))
    base = spark.createDataFrame([(1000, 1)], ROW)
    whole = spark.createDataFrame(log, LOG)
    archive = LogArchive(spark, scratch("archive"), every=80).create(base, whole.schema)
    for lo, hi in ((0, 50), (50, 260), (260, 400)):
        archive.append(spark.createDataFrame(log[lo:hi], LOG))
    states = archive.states()
    assert len(states) >= 3 and all(b - a <= 160 for a, b in zip([-1, *states], states))
    files = archive.log.files().count()
    for n in (-1, 0, 49, 50, states[0], states[0] + 1, 169, 170, 171, 333, 399, 10_000):
        at, within = archive.since(n)
        assert (at is None or at <= n) and rows(archive.as_of(n)) == rows(as_of(base, whole, n))
        opened = archive.log.candidates(within)
        assert len(opened) <= 0.5 * files, (n, len(opened), files)
    with pytest.raises(ValueError):
        archive.append(spark.createDataFrame(log[390:], LOG))
    archive.append(spark.createDataFrame([], LOG))
    # a writer that died before it stored the states that were due: the next call stores them
    late = LogArchive(spark, scratch("archive"), every=80).create(base, whole.schema)
    late._store_due, due = (lambda: None), late._store_due
    late.append(whole)
    late._store_due = due
    assert late.states() == [] and rows(late.as_of(399)) == rows(archive.as_of(399))
    late.append(spark.createDataFrame([], LOG))
    assert len(late.states()) >= 3 and rows(late.as_of(399)) == rows(archive.as_of(399))
