import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.dml import Clause, add_column, delete, merge, update, update_from


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_update_sees_old_values_and_keeps_null_predicate_rows(spark):
    df = spark.createDataFrame([(1, 10, "x"), (2, None, "y")], "id int, q int, s string")
    out = update(df, F.col("q") > 5, {"q": F.col("q") + 1, "s": F.concat(F.col("s"), F.col("q").cast("string"))})
    assert rows(out) == [(1, 11, "x10"), (2, None, "y")]


def test_bands_update(spark):
    bands = spark.createDataFrame([("korpiklaani", 9), ("avatar", 8), ("rammstein", 10)], "name string, rating int")
    out = update(bands, F.col("name") == "rammstein", {"rating": F.lit(100)})
    assert rows(out) == [("avatar", 8), ("korpiklaani", 9), ("rammstein", 100)]


def test_delete_keeps_rows_with_null_predicate(spark):
    df = spark.createDataFrame([(1, 10), (2, None), (3, 1)], "id int, q int")
    assert rows(delete(df, F.col("q") > 5)) == [(2, None), (3, 1)]


def test_update_from_backfills_and_rejects_ambiguous_source(spark):
    t = add_column(spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "a int, b int"), "fare", "string")
    src = spark.createDataFrame([(1, 1, "Economy"), (1, 2, "Business")], "a int, b int, fc string")
    out = update_from(t, src, {"a": "a", "b": "b"}, {"fare": "fc"})
    assert rows(out) == [(1, 1, "Economy"), (1, 2, "Business"), (2, 1, None)]
    dup = src.unionByName(spark.createDataFrame([(1, 1, "Comfort")], "a int, b int, fc string"))
    with pytest.raises(Exception, match="more than one source row"):
        update_from(t, dup, {"a": "a", "b": "b"}, {"fare": "fc"}).collect()


def test_merge_first_true_clause_wins(spark):
    t = spark.createDataFrame([("a", 10), ("b", 5), ("c", 7)], "k string, s int")
    src = spark.createDataFrame([("a", 10), ("b", 2), ("d", 4)], "k string, amt int")
    clauses = [Clause("matched", "delete", F.col("s") == F.col("src_amt")),
               Clause("matched", "update", F.col("s") > F.col("src_amt"), {"s": F.col("s") - F.col("src_amt")}),
               Clause("not_matched", "insert", None, {"k": F.col("src_k"), "s": F.col("src_amt")})]
    assert rows(merge(t, src, {"k": "k"}, clauses)) == [("b", 3), ("c", 7), ("d", 4)]


def test_merge_rejects_duplicate_source_keys(spark):
    t = spark.createDataFrame([("a", 10)], "k string, s int")
    src = spark.createDataFrame([("a", 1), ("a", 2)], "k string, amt int")
    with pytest.raises(Exception, match="more than one source row"):
        merge(t, src, {"k": "k"}, [Clause("matched", "update", None, {"s": F.col("src_amt")})]).collect()


def test_source_keys_are_counted_without_a_window(spark):
    from ledgerlake.operators.dml import _unique_source
    src = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "d")], "k long, v string")
    out = _unique_source(src, ["k"])
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.columns == ["k", "v", "_src_n"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        [(1, "a", 3), (1, "a", 3), (1, "b", 3), (2, "c", 1), (None, "d", 1), (None, "d", 1)], key=repr)
