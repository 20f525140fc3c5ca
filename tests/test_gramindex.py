"""A trigram index under appends, changes and merges finds what LIKE finds."""
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.sources import fs
from ledgerlake.sources.gramindex import BITS, GramIndex
from ledgerlake.sources.tables import load

SF = "/root/testdata/sf0.001"


def table(spark, rows):
    return spark.createDataFrame(rows, "id long, text string")


def hits(df, *keys):
    return sorted(r[0] for r in df.select("id").collect())


def like(df, pattern):
    return hits(df.where(F.col("text").contains(pattern)))


def test_appended_index_equals_like(spark, scratch):
    docs = load(spark, SF, "documents").select(F.col("doc_id").alias("id"), "text")
    index = GramIndex(spark, scratch("grams"), "id", "text")
    for k in range(4):
        index.append(docs.where(F.pmod("id", F.lit(4)) == k))
    texts = [r.text for r in docs.limit(20).collect() if r.text]
    rnd = random.Random(3)
    patterns = ["mentoi", "ab", "Ea", "xyzzyq", "\n", "aaa"]
    for t in texts[:5]:
        at = rnd.randrange(max(1, len(t) - 10))
        patterns.append(t[at:at + rnd.randint(3, 9)])
    for p in patterns + [patterns[-1].upper()]:
        assert hits(index.search(docs, p)) == like(docs, p), p
    before = index.blocks().count()
    index.merge()
    index.vacuum()
    assert len(index.parts()) == 1 and index.blocks().count() <= before
    assert hits(index.search(docs, "mentoi")) == like(docs, "mentoi")


def test_an_append_writes_its_texts_only(spark, scratch):
    """Bytes of a batch of ten texts do not grow with the index."""
    def texts(n, start=0):
        return spark.range(start, start + n).select("id", F.concat_ws(" ", *[F.md5(F.concat(F.col("id").cast("string"), F.lit(str(k)))) for k in range(4)]).alias("text"))
    wrote = []
    for n in (500, 5000):
        index = GramIndex(spark, scratch("grams"), "id", "text")
        index.append(texts(n))
        index.append(texts(10, n))
        assert len(index.parts()) == 2
        wrote.append(index.parts()[1]["bytes"])
    assert wrote[1] < 1.5 * wrote[0]


def test_parts_stay_few(spark, scratch):
    index, n = GramIndex(spark, scratch("grams"), "id", "text"), 12
    whole = table(spark, [(k, f"text number {k} of {k * k}") for k in range(n)])
    for k in range(n):
        index.append(whole.where(F.col("id") == k))
    sizes = [p["bytes"] for p in index.parts()]
    assert len(sizes) <= 5 and all(a > b for a, b in zip(sizes, sizes[1:]))
    assert hits(index.search(whole, "number 1")) == [1, 10, 11]


def test_changed_gone_and_odd_rows(spark, scratch):
    span = 1 << BITS
    rows = [(1, "alpha beta"), (-7, "beta gamma"), (span + 1, "alpha gamma"), (5, None), (None, "alpha"), (6, ""), (8, "al"),
            (9, "alpha"), (9, "gamma gamma"), (10, "één \U0001f600 alpha")]
    index = GramIndex(spark, scratch("grams"), "id", "text")
    index.append(table(spark, []))
    assert hits(index.search(table(spark, rows), "zzz")) == []
    index.append(table(spark, rows))
    now = table(spark, rows)
    assert hits(index.search(now, "alpha")) == [1, 9, 10, span + 1]      # null keys have no place in an index
    assert hits(index.search(now, "gamma")) == [-7, 9, span + 1]
    assert hits(index.search(now, "n \U0001f600 a")) == [10]
    # 1 changes, -7 goes
    index.append(table(spark, [(1, "delta")]))
    now = table(spark, [(1, "delta"), (span + 1, "alpha gamma")])
    assert hits(index.search(now, "delta")) == [1] and hits(index.search(now, "beta")) == []
    assert -7 in hits(index.candidates("gamma"))
    index.merge(live=now)
    assert hits(index.candidates("gamma")) == [span + 1] and hits(index.search(now, "delta")) == [1]
    with pytest.raises(ValueError):
        index.candidates("ab")


def test_second_writer_fails(spark, scratch):
    index = GramIndex(spark, scratch("grams"), "id", "text")
    index.append(table(spark, [(1, "alpha")]))
    seen, parts = index._version(), index.parts()
    index.append(table(spark, [(2, "beta beta beta")]))
    with pytest.raises(fs.CommitConflict):
        index._commit(seen, parts)


def test_search_plan(spark, scratch):
    index = GramIndex(spark, scratch("grams"), "id", "text")
    index.append(table(spark, [(k, f"alpha {k}") for k in range(50)]))
    plan = index.candidates("alpha")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "In(tri" in plan and "PartitionFilters: [bucket" in plan


@pytest.mark.parametrize("gram_bytes", [1, 50, 1 << 22])
def test_trigrams_travel_in_lists(spark, monkeypatch, gram_bytes):
    """Values meet by trigram before any shuffle; trigrams are those of the characters."""
    import pyarrow as pa

    from ledgerlake.operators import layout
    texts = ["alpha beta", "", "al", "één \U0001f600 alpha", "alpha\0\nalpha", "\U0001f600\U0001f601\U0001f602"] + ["the same words"] * 50
    monkeypatch.setattr(layout, "GRAM_BYTES", gram_bytes)
    batch = pa.RecordBatch.from_arrays([pa.array([k % 2 for k in range(len(texts))]), pa.array(range(len(texts))), pa.array(texts)], ["span", "v", "t"])
    found = [(r["span"], r["gram"], v) for b in layout._gram_lists([batch, batch.slice(3, 0), batch.slice(1, 2)]) for r in b.to_pylist() for v in r["held"]]
    want = {(k % 2, t[i:i + 3], k) for k, t in enumerate(texts) for i in range(len(t) - 2)}
    assert sorted(found) == sorted(want)
    # more kinds of characters than fit a number thrice
    many = "".join(chr(c) for c in range(0x100, 0xd000)) * 2
    wide = pa.RecordBatch.from_arrays([pa.array([0] * 70000), pa.array(range(70000)), pa.array([many[:4000], many] + [""] * 69998)], ["span", "v", "t"])
    monkeypatch.setattr(layout, "GRAM_BYTES", 1 << 30)
    n = sum(len(r["held"]) for b in layout._gram_lists([wide]) for r in b.to_pylist())
    assert n == len({many[i:i + 3] for i in range(len(many) - 2)}) + 3998
    rows = spark.createDataFrame([(0, k, "The Same words") for k in range(500)], "span long, k long, t string").coalesce(1)
    lists = layout.gram_lists(rows)
    assert lists.count() <= 13 and lists.selectExpr("sum(size(held))").first()[0] == 12 * 500
    assert {r.tri for r in lists.collect()} == set(layout.pattern_trigrams(spark, "the SAME words"))
