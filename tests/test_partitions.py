import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.partitions import PartitionSpec, write_partitioned

SCHEMA = "id int, ts timestamp_ntz, fare string"


def data(spark):
    rows = [(i, dt.datetime(2025, 11, 21) + dt.timedelta(hours=7 * i), "Economy") for i in range(20)]
    rows.append((99, dt.datetime(2026, 3, 1), "Business"))      # outside every bound
    return spark.createDataFrame(rows, SCHEMA)


def daily_spec():
    return PartitionSpec.range("ts", PartitionSpec.daily(dt.datetime(2025, 11, 21), dt.datetime(2025, 11, 28)))


def test_default_partition_and_row_movement(spark, scratch):
    t = write_partitioned(spark, data(spark), daily_spec(), scratch("range"))
    assert [r.id for r in t.read_partition("p_default").collect()] == [99]
    t.update(F.col("id") == 99, {"ts": F.lit(dt.datetime(2025, 11, 22, 5)).cast("timestamp_ntz")})
    assert t.read_partition("p_default").count() == 0
    moved = t.read_partition("p2025_11_22", with_part=True).where(F.col("id") == 99).collect()
    assert len(moved) == 1 and moved[0].part == "p2025_11_22"
    assert t.read().count() == 21


def test_pruned_read_lists_only_overlapping_partitions(spark, scratch):
    t = write_partitioned(spark, data(spark), daily_spec(), scratch("range"))
    lo, hi = dt.datetime(2025, 11, 22, 0), dt.datetime(2025, 11, 23, 0)   # BETWEEN includes the 23rd, 00:00
    df = t.read_pruned(lo, hi)
    files = df.inputFiles()
    assert files and all("part=p2025_11_22" in f or "part=p2025_11_23" in f for f in files)
    want = data(spark).where(F.col("ts").between(F.lit(lo), F.lit(hi)))
    assert sorted(r.id for r in df.collect()) == sorted(r.id for r in want.collect())


def test_zone_dependent_day_bounds(spark):
    spec = PartitionSpec.range("ts", PartitionSpec.daily(dt.datetime(2025, 8, 31), dt.datetime(2025, 9, 2)),
                               zone="Europe/Moscow")
    df = spark.sql("SELECT TIMESTAMP'2025-08-31 21:00:00' AS ts")          # session zone UTC
    # 21:00 UTC on Aug 31 is already Sep 1 at +03
    assert df.select(spec.assign()).first()[0] == "p2025_09_01"


@pytest.mark.parametrize("zone,day", [("Europe/Moscow", dt.datetime(2025, 8, 31)), ("Europe/Berlin", dt.datetime(2025, 10, 26)),
                                      ("America/New_York", dt.datetime(2025, 3, 9))])
def test_zoned_pruned_read_equals_the_plain_filter(spark, scratch, zone, day):
    spec = PartitionSpec.range("ts", PartitionSpec.daily(day - dt.timedelta(days=2), day + dt.timedelta(days=3)), zone=zone)
    df = spark.createDataFrame([(k, day - dt.timedelta(days=1) + dt.timedelta(minutes=30 * k)) for k in range(160)], "id int, ts timestamp")
    t = write_partitioned(spark, df, spec, scratch("zoned"))
    for start in range(0, 70, 3):
        lo = day - dt.timedelta(hours=12) + dt.timedelta(minutes=30 * start)
        hi = lo + dt.timedelta(hours=1)
        want = df.where(F.col("ts").between(F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz")))
        assert sorted(r.id for r in t.read_pruned(lo, hi).collect()) == sorted(r.id for r in want.collect()), (lo, hi)


def test_a_crash_before_publishing_leaves_no_rows(spark, scratch, monkeypatch):
    from ledgerlake.operators.partitions import PartitionedTable
    t = PartitionedTable(spark, scratch("crash"), daily_spec())
    real = PartitionedTable._publish

    def crash(*a, **k):
        raise OSError("driver lost")

    for step in (lambda: t.write(data(spark)), lambda: t.update(F.col("id") < 10, {"ts": F.col("ts") + F.expr("INTERVAL 1 DAY")})):
        monkeypatch.setattr(PartitionedTable, "_publish", crash)
        with pytest.raises(OSError):
            step()
        monkeypatch.setattr(PartitionedTable, "_publish", real)
        step()
        assert t.read().count() == 21
    t.vacuum()
    assert t.read().count() == 21


def test_of_two_writers_the_second_fails(spark, scratch):
    from ledgerlake.sources.fs import CommitConflict
    from ledgerlake.sources.versioned import VersionedTable
    a = VersionedTable(spark, scratch("two"))
    b = VersionedTable(spark, a.root)
    df = spark.createDataFrame([(1,)], "id int")
    va, vb = a.stage(df), b.stage(df.union(df))
    assert va == vb == 0
    a.publish(va, df.schema)
    with pytest.raises(CommitConflict):
        b.publish(vb, df.schema)
    assert a.read().count() == 1


def test_versions_stay_until_vacuum_and_staging_again_replaces(spark, scratch):
    from ledgerlake.sources.versioned import VersionedTable
    t = VersionedTable(spark, scratch("keep"))
    df = spark.createDataFrame([(k, k % 3) for k in range(6)], "id int, p int")
    t.stage(df, version=0, partition_by=["p"])                       # an attempt that was lost
    t.publish(t.stage(df.where("p = 1"), version=0, partition_by=["p"]), df.schema)
    assert t.read().count() == 2
    t.commit(df)
    t.commit(df.limit(1))
    assert [t.read(v).count() for v in (0, 1, 2)] == [2, 6, 1]
    t.vacuum()
    assert t.versions() == [2] and t.read().count() == 1


def test_list_partition_without_default_rejects_unknown_value(spark, scratch):
    spec = PartitionSpec.list("fare", {"economy": ["Economy"], "business": ["Business"]})
    with pytest.raises(Exception, match="no partition"):
        write_partitioned(spark, data(spark).unionByName(
            spark.createDataFrame([(7, None, "First")], SCHEMA)), spec, scratch("list"))


def test_hash_equality_reads_one_partition(spark, scratch):
    t = write_partitioned(spark, data(spark), PartitionSpec.hash("id", 10), scratch("hash"))
    df = t.read_key(7)
    assert [r.id for r in df.collect()] == [7]
    assert len({f.split("part=")[1].split("/")[0] for f in df.inputFiles()}) == 1
