"""Tables by file: copy on write, zones, a layout by several columns, damage."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import dml
from ledgerlake.operators.dml import Clause
from ledgerlake.operators.layout import z_value
from ledgerlake.sources.filetable import FileTable
from ledgerlake.sources.fs import CommitConflict

SCHEMA = "id long, zone string, day date, price double"


def data(n=2000, seed=1):
    rng = random.Random(seed)
    return [(k if k % 97 else None, rng.choice(["a", "b", "c", None]), dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(300)),
             rng.choice([None, rng.random() * 100])) for k in range(n)]


@pytest.fixture
def table(spark, scratch):
    def make(rows=None, **more):
        df = spark.createDataFrame(data() if rows is None else rows, SCHEMA)
        return FileTable(spark, scratch("files")).create(df, **{"zones": ["id", "zone", "day", "price"], "order": ["id"], "files": 16, **more}), df
    return make


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def names(t, version=None):
    return {r.file for r in t.files(version).collect()}


def test_manifest_counts_and_zones_are_the_files_own(spark, table):
    t, df = table()
    assert rows_of(t.read()) == rows_of(df)
    for e in t.files().collect():
        own = spark.read.parquet(f"{t.root}/{e.file}")
        assert tuple(own.agg(F.count(F.lit(1)), F.min("id"), F.max("day"), F.min("price")).first()) == (e.rows, e.lo_id, e.hi_day, e.lo_price)


def test_untouched_files_keep_their_names_after_merge(spark, table):
    t, df = table()
    source = spark.createDataFrame([(5, 1.5), (6, 2.5), (1999, 0.5), (70_000, 9.0)], "k long, p double")
    clauses = [Clause("matched", "delete", F.col("src_p") < 1), Clause("matched", "update", None, {"price": F.col("src_p")}),
               Clause("not_matched", "insert", None, {"id": F.col("src_k"), "price": F.col("src_p")})]
    before = names(t)
    touched = t.merge(source, {"id": "k"}, clauses)
    assert 0 < len(touched) <= 3 and names(t) & before == before - set(touched)
    assert rows_of(t.read()) == rows_of(dml.merge(df, source, {"id": "k"}, clauses))
    assert rows_of(t.read(version=0)) == rows_of(df)


def test_merge_without_any_match_only_adds_files(spark, table):
    t, df = table()
    before = names(t)
    assert t.merge(spark.createDataFrame([(90_000,)], "k long"), {"id": "k"}, [Clause("not_matched", "insert", None, {"id": F.col("src_k")})]) == []
    assert names(t) > before and t.read().count() == df.count() + 1
    v = t.current()
    assert t.merge(spark.createDataFrame([(90_001,)], "k long"), {"id": "k"}, [Clause("matched", "delete")]) == [] and t.current() == v


def test_merge_of_rows_without_a_source(spark, table):
    t, df = table()
    source = df.where("id is not null").select(F.col("id").alias("k"))
    clauses = [Clause("not_matched_by_source", "update", F.col("zone") == "b", {"zone": F.lit("lost")}), Clause("matched", "update", F.col("zone") == "a", {"zone": F.lit("A")})]
    t.merge(source, {"id": "k"}, clauses)
    assert rows_of(t.read()) == rows_of(dml.merge(df, source, {"id": "k"}, clauses))


def test_merge_rejects_two_sources_of_a_row(spark, table):
    t, _ = table()
    with pytest.raises(Exception, match="more than one source row"):
        t.merge(spark.createDataFrame([(5,), (5,)], "k long"), {"id": "k"}, [Clause("matched", "delete")])
    assert t.current() == 0


def test_update_and_delete_rewrite_only_files_that_hold_rows(spark, table):
    t, df = table()
    before = names(t)
    touched = t.update(F.col("zone") == "a", {"zone": F.lit("z")}, within={"id": (10, 40)})
    assert 0 < len(touched) <= 2 and before - set(touched) < names(t)
    inside = (F.col("zone") == "a") & F.col("id").between(10, 40)
    want = dml.update(df, inside, {"zone": F.lit("z")})
    assert rows_of(t.read()) == rows_of(want)
    assert t.delete(F.col("price") > 1000) == []
    t.delete(F.col("price").isNull())
    assert rows_of(t.read()) == rows_of(want.where("price is not null"))
    t.vacuum()
    assert rows_of(t.read()) == rows_of(want.where("price is not null")) and t.versions() == [3 - 1]


def test_second_writer_fails(spark, table):
    t, _ = table()
    other = FileTable(spark, t.root)
    old = other.current
    t.delete(F.col("id") == 5)
    other.current = lambda: 0       # it still sees the first version
    with pytest.raises(CommitConflict):
        other.delete(F.col("id") == 6)
    other.current = old
    assert other.read().where("id = 6").count() == 1


def test_curve_cuts_files_off_by_each_column(spark, table):
    rng = random.Random(3)
    rows = [(rng.randrange(10_000), rng.choice("abcdefgh"), dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(365)), rng.random()) for _ in range(8000)]
    t, df = table(rows, order=["id", "day", "price"], files=64)
    n = len(names(t))
    ranges = {"id": (1000, 1500), "day": (dt.date(2024, 3, 1), dt.date(2024, 3, 20)), "price": (0.5, 0.55)}
    for c, (lo, hi) in ranges.items():
        assert len(t.candidates({c: (lo, hi)})) <= 0.5 * n, c
        assert rows_of(t.read({c: (lo, hi)})) == rows_of(df.where(F.col(c).between(F.lit(lo), F.lit(hi))))
    three = {"id": (1000, 3000), "day": (dt.date(2024, 3, 1), dt.date(2024, 5, 1)), "price": (0.5, 0.7)}
    assert len(t.candidates(three)) <= 0.15 * n
    assert t.read(three).count() == df.where("id between 1000 and 3000 and day between '2024-03-01' and '2024-05-01' and price between 0.5 and 0.7").count()
    # a layout by one column alone leaves all files to the others
    one, _ = table(rows, order=["id"], files=64)
    assert len(one.candidates({"day": ranges["day"]})) == len(names(one))


def test_compound_opens_a_small_share(spark):
    from ledgerlake.plans import catalog
    sf = "/root/testdata/sf0.01"
    got = catalog.QUERIES["compound_zones"](spark, sf)
    assert rows_of(got) == rows_of(catalog.QUERIES["compound"](spark, sf))
    path = next(p for k, p in catalog._BUILT.items() if k[1:3] == (sf, "orders_zones"))
    t = FileTable(spark, path)
    opened = t.candidates({"o_orderstatus": ("F", "F"), "o_orderdate": (dt.datetime(1996, 1, 1), dt.datetime(1996, 3, 1))})
    assert len(opened) <= 0.3 * t.files().count()


def test_z_value_interleaves_ranks(spark):
    df = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a int, b int")
    got = {(r.a, r.b): r.z for r in df.withColumn("z", z_value(df, ["a", "b"], bits=2)).collect()}
    ranks = sorted(got, key=got.get)
    assert len(set(got.values())) >= 9 and ranks[0] == (0, 0) and ranks[-1] == (3, 3)
    assert all(got[a, b] <= got[c, d] for a, b in got for c, d in got if a <= c and b <= d)


def test_nulls_open_ends_and_all_null_columns(spark, table):
    rows = [(k, None, dt.date(2024, 1, 1 + k % 28), None) for k in range(200)]
    t, df = table(rows, order=["id", "price"], files=4)
    assert t.candidates({"price": (0, 1)}) == [] and t.read({"price": (None, None)}).count() == 0
    assert t.read({"id": (None, 20)}).count() == 21 and t.read({"id": (150, None), "day": (None, None)}).count() == 50


def test_damaged_files_are_reported_and_passed_over(spark, table):
    t, df = table(data(20_000), files=8)
    files = sorted(t.files().collect(), key=lambda e: e.file)
    assert t.damage().collect() == []
    local = lambda e: f"{t.root}/{e.file}".removeprefix("file:")
    cut, gone, hurt = files[0], files[3], files[5]
    with open(local(cut), "r+b") as f:
        f.truncate(os.path.getsize(local(cut)) // 2)
    os.remove(local(gone))
    with open(local(hurt), "r+b") as f:     # a page's bytes
        f.seek(os.path.getsize(local(hurt)) // 3)
        f.write(b"\xff" * 400)
    for e in (cut, hurt):
        crc = os.path.join(os.path.dirname(local(e)), f".{os.path.basename(e.file)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    sound, report = t.read_sound()
    found = {r.file: (r.rows, r.rows_read) for r in report.collect()}
    assert set(found) == {cut.file, gone.file, hurt.file}
    assert all(found[e.file][0] == e.rows for e in (cut, gone, hurt)) and all(found[e.file][1] < e.rows for e in (cut, gone))
    kept = [e for e in files if e.file not in found]
    assert sound.count() == sum(e.rows for e in kept) == df.count() - cut.rows - gone.rows - hurt.rows


def test_empty_table(spark, table):
    t, df = table([])
    assert t.read().collect() == [] and t.read({"id": (1, 2)}).collect() == [] and t.update(F.lit(True), {"zone": F.lit("x")}) == []
    t.merge(spark.createDataFrame([(1,)], "k long"), {"id": "k"}, [Clause("not_matched", "insert", None, {"id": F.col("src_k")})])
    assert rows_of(t.read()) == [(1, None, None, None)]
