import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.checks import check_fk, check_rows, check_unique, fingerprint, table_diff, verify_fingerprints
from ledgerlake.sources.io import copy_in, copy_out, export_schema, restore
from ledgerlake.sources.versioned import VersionedTable

SCHEMA = "id int, value string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_copy_roundtrip_keeps_tabs_newlines_backslashes_nulls_and_empty(spark, scratch):
    vals = [(1, "plain"), (2, "tab\there"), (3, "line\nbreak"), (4, "back\\slash"), (5, None), (6, ""),
            (7, "\\N"), (8, "cr\rx"), (None, "null id")]
    df = spark.createDataFrame(vals, SCHEMA)
    back = copy_in(spark, copy_out(df, scratch("copy")), df.schema)
    assert rows(back) == rows(df)
    assert table_diff(df, back).count() == 0


def test_copy_in_rejects_bad_lines(spark, scratch):
    p = scratch("bad")
    spark.createDataFrame([("1\tok",), ("2",)], "value string").write.text(p)
    with pytest.raises(Exception, match="wrong field count"):
        copy_in(spark, p, spark.createDataFrame([], SCHEMA).schema).collect()


def test_export_and_selective_restore(spark, scratch):
    t1 = spark.range(1, 101).select(F.col("id").cast("int"), F.md5(F.col("id").cast("string")).alias("value"))
    t2 = t1.where(F.col("id") <= 10)
    p = scratch("export")
    export_schema(spark, {"table1": t1, "table2": t2}, p)
    got = restore(spark, p, ["table2"])
    assert list(got) == ["table2"] and got["table2"].count() == 10
    with pytest.raises(KeyError):
        restore(spark, p, ["table3"])


def test_table_diff_bag_semantics(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], SCHEMA)
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], SCHEMA)
    assert rows(table_diff(a, b)) == [(1, "x", "a_only", 1), (3, "z", "b_only", 1)]


def test_check_rows_passes_null(spark):
    df = spark.createDataFrame([(1, "Economy", 10), (2, "Gold", -1), (3, None, None)], "id int, fare string, price int")
    v = check_rows(df, {"fare_domain": F.col("fare").isin("Economy", "Business", "Comfort"),
                        "price_nonneg": F.col("price") >= 0}, ["id"])
    assert rows(v) == [(2, "fare_domain"), (2, "price_nonneg")]


def test_unique_and_fk(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 10)], "id int, fk int")
    parent = spark.createDataFrame([(10,)], "pk int")
    assert rows(check_fk(child, parent, {"fk": "pk"})) == [(2, 11)]
    assert rows(check_unique(child, ["fk"])) == [(10, 2)]


def test_fingerprint_detects_corruption(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], SCHEMA).withColumn("p", F.col("id") % 2)
    manifest = fingerprint(df, "p")
    bad = df.withColumn("value", F.when(F.col("id") == 3, "X").otherwise(F.col("value")))
    assert [r.p for r in verify_fingerprints(bad, manifest, "p").collect()] == [1]
    assert verify_fingerprints(df, manifest, "p").count() == 0


def test_versioned_checked_load_keeps_old_version_on_failure(spark, scratch):
    t = VersionedTable(spark, scratch("ver"))
    v0 = t.commit(spark.createDataFrame([(1, "a")], SCHEMA))

    def fail(_):
        raise ValueError("count check failed")
    with pytest.raises(ValueError):
        t.commit_if(spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA), [fail])
    assert t.current() == v0 and t.read().count() == 1
    t.commit_if(spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA), [lambda w: None])
    assert t.read().count() == 2
