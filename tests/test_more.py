import random

from pyspark.sql import functions as F

from ledgerlake.schemas import DRIVER

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_trigram_search_equals_like_on_random_patterns(spark, scratch):
    from ledgerlake.operators.layout import read_trigram_index, trigram_search, write_trigram_index
    from ledgerlake.sources.tables import load
    docs = load(spark, SF, "documents")
    index = read_trigram_index(spark, write_trigram_index(docs, "doc_id", "text", scratch("tri")), "doc_id")
    texts = [r.text for r in docs.select("text").limit(20).collect()]
    rnd = random.Random(11)
    patterns = ["mentoi", "ab", "Ea", "xyzzyq", "\n"]
    for t in texts:
        i = rnd.randrange(0, max(1, len(t) - 10))
        patterns.append(t[i:i + rnd.randint(3, 9)])
    patterns.append(patterns[-1].upper())
    for p in patterns:
        got = {r.doc_id for r in trigram_search(spark, index, docs, "doc_id", "text", p).collect()}
        want = {r.doc_id for r in docs.where(F.col("text").contains(p)).collect()}
        assert got == want, p


def test_semi_plus_anti_is_total(spark):
    from ledgerlake.operators.relational import anti, semi
    from ledgerlake.sources.tables import load
    o, li = load(spark, SF, "orders"), load(spark, SF, "lineitem")
    k = {"o_orderkey": "l_orderkey"}
    assert semi(o, li, k).count() + anti(o, li, k).count() == o.count()


def test_migrate_enrich_and_cascade(spark):
    from ledgerlake.operators.checks import cascade_delete
    from ledgerlake.operators.relational import enrich
    from ledgerlake.sources.io import append_rows, migrate
    from ledgerlake.sources.tables import load
    li = load(spark, SF, "lineitem").select("l_orderkey", "l_linenumber")
    o = load(spark, SF, "orders")
    dst = "l_orderkey bigint, l_linenumber int, o_orderdate timestamp_ntz"
    out = migrate(li, spark.createDataFrame([], dst).schema,
                  lambda df: enrich(df, o, {"l_orderkey": "o_orderkey"}, ["o_orderdate"], check_count=True))
    assert out.columns == ["l_orderkey", "l_linenumber", "o_orderdate"] and out.count() == li.count()
    kept = cascade_delete(li, o.where(F.col("o_orderstatus") == "F"), {"l_orderkey": "o_orderkey"})
    want = li.join(o.where(F.col("o_orderstatus") == "F"), li.l_orderkey == o.o_orderkey, "left_semi")
    assert rows(kept) == rows(want)
    more = append_rows(spark, li, [(1, 99)])
    assert more.count() == li.count() + 1


def test_natural_join_guard(spark):
    import pytest
    from ledgerlake.operators.relational import natural_join
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(1, "y")], "k int, v string")
    with pytest.raises(ValueError):
        natural_join(a, b, expect=["k"])
    assert natural_join(a, b.withColumnRenamed("v", "w"), expect=["k"]).columns == ["k", "v", "w"]


def test_enrich_keeps_the_row_count_or_raises(spark):
    import pytest
    from ledgerlake.operators.relational import cross_count, enrich
    child = spark.createDataFrame([(1, 10), (2, 11)], "id int, fk int")
    one = spark.createDataFrame([(10, "a"), (11, None)], "pk int, v string")
    assert rows(enrich(child, one, {"fk": "pk"}, ["v"], check_count=True)) == [(1, 10, "a"), (2, 11, None)]
    for bad in ([(10, "a")], [(10, "a"), (10, "b"), (11, "c")]):
        with pytest.raises(Exception, match="changed the row count"):
            enrich(child, spark.createDataFrame(bad, "pk int, v string"), {"fk": "pk"}, ["v"], check_count=True).collect()
    assert cross_count(child, one).first()[0] == 4


def test_every_query_reads_driver_tables():
    from ledgerlake.plans.catalog import QUERIES
    assert len(QUERIES) >= 77
    assert set(DRIVER) >= {"orders", "lineitem", "events", "documents"}
