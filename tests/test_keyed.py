"""Merge-on-read tables against a plain dictionary."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.sources import fs
from ledgerlake.sources import keyed as K

SCHEMA = "id long, zone string, value long"


def table(spark, scratch, rows, rule="last", **more):
    df = spark.createDataFrame(rows, SCHEMA)
    return K.KeyedTable(spark, scratch("keyed"), **more).start(df, ["id", "zone"], rule, buckets=1)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def delta(spark, rows):
    return spark.createDataFrame(rows, SCHEMA + f", {K.GONE} boolean")


def written(spark, t, names_before, commits_before):
    new = [n for n in fs.list_names(spark, t.root) if n not in names_before]
    commits = [n for n in fs.list_names(spark, f"{t.root}/_commits") if n not in commits_before]
    return sum(fs.size(spark, f"{t.root}/{n}") for n in new) + sum(fs.size(spark, f"{t.root}/_commits/{n}") for n in commits)


def test_ten_keys_write_the_same_however_large_the_table(spark, scratch):
    cost = {}
    for size in (1_000, 300_000):
        base = spark.range(size).select("id", F.lit("z").alias("zone"), (F.col("id") * 7).alias("value"))
        t = K.KeyedTable(spark, scratch("keyed")).start(base, ["id", "zone"], buckets=8)
        names, commits = fs.list_names(spark, t.root), fs.list_names(spark, f"{t.root}/_commits")
        t.append(delta(spark, [(k * 90, "z", k, False) for k in range(10)]), batch=0)
        cost[size] = written(spark, t, names, commits)
        assert fs.size(spark, t.root) > 10 * cost[size] or size == 1_000
        assert t.read().count() == size
    assert cost[300_000] < 1.2 * cost[1_000]


@pytest.mark.parametrize("seed", range(3))
def test_batches_tombstones_truncates_and_compactions_equal_a_dictionary(spark, scratch, seed):
    rng = random.Random(seed)
    zones = ["a", "b", None]
    model = {(k, rng.choice(zones)): k for k in range(40)}
    t = table(spark, scratch, [(*k, v) for k, v in model.items()], bucket_bytes=2_000)
    for batch in range(8):
        keys = {(rng.randrange(60), rng.choice(zones)) for _ in range(rng.randrange(12))} | {(None, None)}
        change = [(*k, rng.randrange(100), rng.random() < 0.3) for k in keys]
        truncate = rng.random() < 0.15
        model = {} if truncate else model
        for i, z, v, gone in change:
            model.pop((i, z), None) if gone else model.update({(i, z): v})
        t.append(delta(spark, change), batch, truncate)
        t.append(delta(spark, [(1, "a", -1, False)]), batch)        # a retry of the batch does nothing
        want = sorted(((*k, v) for k, v in model.items()), key=repr)
        assert rows_of(t.read()) == want
        if batch % 3 == 2:
            t.compact(everything=batch == 5)
            assert rows_of(t.read()) == want
    asked = spark.createDataFrame([(3, "a"), (None, None), (59, "b"), (77, "a")], "id long, zone string")
    assert rows_of(t.read_keys(asked)) == sorted(((*k, v) for k, v in model.items() if k in {(3, "a"), (None, None), (59, "b"), (77, "a")}), key=repr)


def test_versions_stay_readable_until_vacuum(spark, scratch):
    t = table(spark, scratch, [(1, "a", 1)])
    seen = {t.current(): rows_of(t.read())}
    for n in range(25):     # over a commit that lists all folders
        t.append(delta(spark, [(n % 4, "a", n, n % 5 == 0)]))
        seen[t.current()] = rows_of(t.read())
    t.compact(everything=True)
    assert all(rows_of(t.read(v)) == rows for v, rows in seen.items() if v % 6 == 0 or v > 22)
    newest = rows_of(t.read())
    t.append(delta(spark, [(9, "a", 9, False)]))
    t.vacuum()
    assert rows_of(t.read()) == sorted([*newest, (9, "a", 9)], key=repr)
    assert len(t._commits()) == 1
    with pytest.raises(FileNotFoundError):
        t.read(0)


def test_sums_add_up(spark, scratch):
    t = table(spark, scratch, [(1, "a", 5), (2, "a", 1)], rule="sum")
    plain = lambda rows: spark.createDataFrame(rows, SCHEMA)
    t.append(plain([(1, "a", 2), (1, "a", 3), (None, None, 4)]), 0)
    t.append(plain([(1, "a", -10), (3, "b", 1)]), 1)
    want = [(1, "a", 0), (2, "a", 1), (3, "b", 1), (None, None, 4)]
    assert rows_of(t.read()) == sorted(want, key=repr)
    t.compact(everything=True)
    t.append(plain([(2, "a", 1)]), 2)
    assert dict((r[:2], r[2]) for r in rows_of(t.read()))[2, "a"] == 2
    t.append(plain([(8, "c", 1)]), 3, truncate=True)
    assert rows_of(t.read()) == [(8, "c", 1)]


def test_only_due_buckets_are_rewritten_and_split(spark, scratch):
    base = spark.range(4_000).select("id", F.lit("z").alias("zone"), (F.col("id") * 7).alias("value"))
    t = K.KeyedTable(spark, scratch("keyed"), bucket_bytes=1 << 30).start(base, ["id", "zone"], buckets=8)
    before = t.state()
    hit = spark.range(4_000).withColumn("zone", F.lit("z")).where(K.bucket_of(["id", "zone"], 8) == 3)
    t.append(hit.select("id", "zone", F.lit(1).alias("value")), 0)
    t.append(hit.select("id", "zone", F.lit(2).alias("value")), 1)
    t.append(delta(spark, [(k, "z", 0, True) for k in range(30)]), 2)
    t.compact()
    after = t.state()
    assert after.buckets == 8 and {b for b in before.base if after.base[b] != before.base[b]} == {"3"}
    assert all("3" not in sizes for _, sizes in after.deltas) and after.deltas
    assert t.read().where("id >= 30").agg(F.sum(F.when(F.col("value") == 2, 1))).first()[0] == hit.where("id >= 30").count()
    # with smaller buckets the next compaction splits some, and each key is found in its new bucket
    t.bucket_bytes = sum(n for _, n in after.base.values()) // 11
    want = rows_of(t.read())
    t.append(hit.select("id", "zone", F.lit(3).alias("value")), 3)
    t.append(hit.select("id", "zone", F.lit(2).alias("value")), 4)
    t.append(hit.select("id", "zone", F.lit(2).alias("value")), 5)
    t.compact()
    grown = t.state()
    assert 8 < grown.buckets <= 16
    untouched = set(after.base) - {"3", *(str(K.parent_of(b)) for b in range(8, grown.buckets))}
    assert untouched and all(grown.base[b] == after.base[b] for b in untouched)
    fixed = [r if r[0] not in {x.id for x in hit.where("id < 30").collect()} else r for r in want]
    got = rows_of(t.read().where("id >= 30"))
    assert got == [r for r in fixed if r[0] >= 30]
    for b in ("3", "8"):
        own = t.read(buckets=[b])
        assert own.count() and own.where(K.bucket_of(["id", "zone"], grown.buckets) != int(b)).isEmpty()


def test_upserts_take_the_latest_change_and_keep_lacking_columns(spark, scratch):
    log = "seq long, op string, key struct<id:long,zone:string>, after struct<value:long>"
    t = K.KeyedTable(spark, scratch("keyed")).start(
        spark.createDataFrame([(1, "a", 5, "note")], SCHEMA + ", note string"), ["id", "zone"])
    rows, cut = K.upserts(spark.createDataFrame([
        (3, "U", (1, "a"), (7,)), (1, "U", (1, "a"), (6,)), (2, "I", (2, "a"), (1,)), (4, "D", (2, "a"), None), (5, "I", (3, None), (9,))], log), t)
    t.append(rows, 0, cut)
    assert not cut and rows_of(t.read()) == [(1, "a", 7, "note"), (3, None, 9, None)]
    rows, cut = K.upserts(spark.createDataFrame([(6, "I", (4, "a"), (1,)), (7, "T", None, None), (8, "I", (5, "a"), (2,))], log), t)
    t.append(rows, 1, cut)
    assert cut and rows_of(t.read()) == [(5, "a", 2, None)]
