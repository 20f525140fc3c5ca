import random
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import digests as D
from ledgerlake.operators.checks import table_diff
from ledgerlake.sources import bucketed as B
from ledgerlake.sources.io import export_schema


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_tables_join_and_aggregate_without_an_exchange(spark, no_broadcast):
    left = spark.range(5000).select("id", (F.col("id") % 7).alias("a"))
    right = spark.range(9000).select((F.col("id") % 4000).alias("id"), (F.col("id") * 2).alias("b"))
    plain = left.join(right, "id").groupBy("id").agg(F.sum("b").alias("s"))
    x, y = B.save_bucketed(left, ["id"], 6), B.save_bucketed(right, ["id"], 6)
    joined = x.join(y, "id")
    assert "Exchange" in plan(plain)
    p = plan(joined)
    assert "SortMergeJoin" in p and "Exchange" not in p, p
    summed = joined.groupBy("id").agg(F.sum("b").alias("s"))
    assert "Exchange" not in plan(summed) and rows(summed) == rows(plain)
    # numbers of buckets that differ cost one side's shuffle, not the result
    z = B.save_bucketed(right, ["id"], 4)
    assert rows(x.join(z, "id").groupBy("id").agg(F.sum("b").alias("s"))) == rows(plain)


def test_bucketed_query_shuffles_nothing(spark, no_broadcast):
    from ledgerlake.plans.catalog import QUERIES
    assert "Exchange" not in plan(QUERIES["bucketed_join"](spark, "/root/testdata/sf0.001"))


def test_buckets_grow_with_the_tables(spark, monkeypatch):
    from ledgerlake.plans.catalog import QUERIES
    small, large = spark.range(100), spark.range(1001)
    assert B.bucket_count(small, large, bucket_rows=100) == 11 and B.bucket_count(small, large, least=8) == 8
    assert B.bucket_count(small.where("false")) == 1
    made = []
    save = B.save_bucketed
    monkeypatch.setattr(B, "save_bucketed", lambda df, keys, buckets: made.append((df.count(), buckets)) or save(df, keys, buckets))
    monkeypatch.setattr(B.bucket_count, "__kwdefaults__", {"least": 1, "bucket_rows": 200})
    QUERIES["bucketed_join"](spark, "/root/testdata/sf0.001")
    (_, x), (lines, y) = made
    assert x == y and lines <= 200 * y


def test_hot_key_is_refused(spark):
    hot = spark.range(6000).select(F.when(F.col("id") < 2500, 1).otherwise(F.col("id")).alias("k"))
    with pytest.raises(B.HotKey):
        B.save_bucketed(hot, ["k"], 16)
    assert B.save_bucketed(hot, ["k"], 16, hot_buckets=16).count() == 6000
    assert B.save_bucketed(hot.where("k < 0"), ["k"], 4).count() == 0


def test_restore_into_a_catalog_leaves_other_tables_absent(spark, scratch):
    path, db = scratch("export"), f"r{uuid.uuid4().hex[:8]}"
    a, b = spark.range(10).toDF("x"), spark.range(3).toDF("y")
    export_schema(spark, {"a": a, "b": b}, path)
    B.restore_tables(spark, path, ["a"], db)
    assert [t.name for t in spark.catalog.listTables(db)] == ["a"] and rows(spark.table(f"{db}.a")) == rows(a)
    with pytest.raises(KeyError):
        B.restore_tables(spark, path, ["nothing"], db)
    with pytest.raises(ValueError, match="exists"):
        B.restore_tables(spark, path, ["b", "a"], db)
    assert not spark.catalog.tableExists(f"{db}.b")
    spark.range(5).toDF("y").write.mode("overwrite").parquet(f"{path}/b")       # the export was tampered with
    with pytest.raises(ValueError, match="differs"):
        B.restore_tables(spark, path, ["b"], db)
    assert not spark.catalog.tableExists(f"{db}.b")


def tables(spark, seed, changes):
    rng = random.Random(seed)
    one = [(k, rng.choice(["x", "y", None]), rng.random()) for k in range(3000)] + [(7, "x", 0.5)] * 3 + [(None, None, None)]
    two = list(one)
    for _ in range(changes):
        k = rng.randrange(len(two))
        two[k] = rng.choice([(two[k][0], "new", 1.0), (rng.randrange(9000), "moved", None), two[(k + 1) % len(two)]])
    make = lambda r: spark.createDataFrame(r, "k long, s string, v double")
    return make(one), make(two)


@pytest.mark.parametrize("changes,bits", [(0, 12), (1, 5), (40, 12), (40, 0), (3000, 6)])
def test_tree_diff_equals_table_diff(spark, changes, bits):
    a, b = tables(spark, changes, changes)
    assert rows(D.tree_diff(a, b, ["k"], bits)) == rows(table_diff(a, b))


def test_only_rows_of_differing_ranges_are_compared(spark, monkeypatch):
    a, b = tables(spark, 5, 3)
    seen = []
    monkeypatch.setattr(D, "table_diff", lambda x, y: seen.append((x.count(), y.count())) or table_diff(x, y))
    got = D.tree_diff(a, b, ["k"])
    assert rows(got) == rows(table_diff(a, b))
    assert all(n < 0.02 * a.count() for n in seen[0])
    # the rows of equal ranges are cut off below the only shuffle of rows
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Aggregate") < text.index("LeftSemi")


def test_descent_compares_few_nodes_and_stored_digests_suffice(spark):
    a, b = tables(spark, 6, 1)
    x, y = D.digests(a, ["k"]), D.digests(b, ["k"])
    nodes, compared = D.differing(x, y)
    assert 1 <= nodes.count() <= 2 and compared <= 1 + 16 + 2 * 16 + 2 * 16
    assert D.differing(x, x)[1] == 1
    assert rows(D.tree_diff(a, b, ["k"], digests_a=x, digests_b=y)) == rows(table_diff(a, b))
    with pytest.raises(ValueError):
        D.digests(a, ["k"], 17)


def test_empty_and_one_sided_tables(spark):
    a, _ = tables(spark, 7, 0)
    none = a.where("false")
    assert rows(D.tree_diff(none, none, ["k"])) == []
    assert rows(D.tree_diff(a, none, ["k"])) == rows(table_diff(a, none))
