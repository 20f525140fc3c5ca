from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.changes import Snapshot, apply_changes, as_of, churn_report, publish

LOG = ("seq bigint, commit_ts timestamp_ntz, op string, key struct<id:int>, "
       "before struct<id:int,v:string>, after struct<id:int,v:string>")


def log(spark, rows):
    return spark.createDataFrame(
        [(i + 1, None, op, None if k is None else (k,), b, a) for i, (op, k, b, a) in enumerate(rows)], LOG)


@pytest.fixture
def base(spark):
    return spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")


def test_identity_key_matrix(spark, base):
    ch = log(spark, [("I", 3, None, (3, "c")), ("U", 1, (1, "a"), (1, "a2")), ("D", 2, (2, "b"), None),
                     ("U", 3, (3, "c"), (3, "c2"))])
    assert rows(apply_changes(base, ch)) == [(1, "a2"), (3, "c2")]


def test_truncate_clears_base_and_earlier_changes(spark, base):
    ch = log(spark, [("I", 3, None, (3, "c")), ("T", None, None, None), ("I", 4, None, (4, "d"))])
    assert rows(apply_changes(base, ch)) == [(4, "d")]


def test_identity_none_rejects_update_and_delete(spark, base):
    ok = log(spark, [("I", 3, None, (3, "c"))])
    assert rows(apply_changes(base, ok, "none")) == [(1, "a"), (2, "b"), (3, "c")]
    bad = log(spark, [("I", 3, None, (3, "c")), ("D", 1, (1, "a"), None)])
    with pytest.raises(Exception, match="replica identity none"):
        apply_changes(base, bad, "none").collect()


def test_identity_full_removes_one_equal_row(spark):
    dup = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id int, v string")
    ch = log(spark, [("D", 1, (1, "a"), None), ("U", 2, (2, "b"), (2, "z")), ("I", 5, None, (5, "e"))])
    assert rows(apply_changes(dup, ch, "full")) == [(1, "a"), (2, "z"), (5, "e")]


def test_as_of_pinned_snapshot(spark):
    # persons: two rows, then commit 3 and commit 4; a reader pinned before 4 sees 3 rows
    empty = spark.createDataFrame([], "id int, v string")
    state = {"n": 3}
    all_changes = [("I", 1, None, (1, "ivan")), ("I", 2, None, (2, "petr")), ("I", 3, None, (3, "sergey")),
                   ("I", 4, None, (4, "sveta"))]
    reader = lambda: log(spark, all_changes[:state["n"]])
    pinned = Snapshot(empty, reader, "repeatable")
    committed = Snapshot(empty, reader, "committed")
    state["n"] = 4
    assert pinned.read().count() == 3
    assert committed.read().count() == 4
    assert as_of(empty, reader(), 2).count() == 2


def test_publish_diff(spark):
    b = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, v string")
    a = spark.createDataFrame([(1, "a"), (2, "B"), (3, None), (4, "d")], "id int, v string")
    got = sorted((r.op, r.key.id) for r in publish(b.where(F.col("id") != 3).unionByName(b.where(F.col("id") == 3)), a,
                                               ["id"]).collect())
    assert got == [("I", 4), ("U", 2)]
    gone = publish(a, b, ["id"])
    assert sorted((r.op, r.key.id) for r in gone.collect()) == [("D", 4), ("U", 2)]


def test_published_changes_apply(spark):
    b = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, v string")
    a = spark.createDataFrame([(1, "a"), (2, None), (4, "d")], "id int, v string")
    for x, y in ((b, a), (a, b), (b, b), (b.where("id > 9"), a)):
        assert rows(apply_changes(x, publish(x, y, ["id"]))) == rows(y)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_identity_full_follows_the_order(spark):
    none = spark.createDataFrame([], "id int, v string")
    one = spark.createDataFrame([(1, "a")], "id int, v string")
    gone_then_new = log(spark, [("D", 1, (1, "a"), None), ("I", 1, None, (1, "a"))])
    assert rows(apply_changes(none, gone_then_new, "full")) == [(1, "a")]
    assert rows(apply_changes(one, gone_then_new, "full")) == [(1, "a")]
    new_then_gone = log(spark, [("I", 1, None, (1, "a")), ("D", 1, (1, "a"), None), ("D", 1, (1, "a"), None), ("I", 2, None, (2, None))])
    assert rows(apply_changes(one, new_then_gone, "full")) == [(2, None)]


def test_churn(spark):
    ch = log(spark, [("I", 1, None, (1, "a")), ("U", 1, (1, "a"), (1, "b")), ("I", 2, None, (2, "c")),
                     ("D", 2, (2, "c"), None)])
    r = churn_report(ch).first()
    assert (r.changes, r.dead, r.live, r.dead_pct) == (4, 2, 1, 100.0)


def test_replica_matches_batch_apply_on_driver_tables(spark):
    from ledgerlake.plans.catalog import QUERIES
    d = "/root/testdata/sf0.001"
    assert rows(QUERIES["replica_stream"](spark, d)) == rows(QUERIES["replica_apply"](spark, d))
    assert Decimal is not None
