"""Quality, language, packing and the pipeline."""

import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import langid, quality
from ledgerlake.llm.packing import CAPACITIES, pack, plan
from tests.llm.helpers import documents, edited, prose, texts


def good_and_bad(count):
    rows, labels = [], []
    for k in range(count):
        bad, n = k % 4 == 0, 20 + k * 7 % 90
        rows.append((k, " ".join(w.upper() + "!!" for w in prose(k, n).split()) if bad else prose(k, n) + "."))
        labels.append((k, int(not bad), 0))
    return rows, labels


def test_quality_on_held_out_documents(spark):
    rows, labels = good_and_bad(240)
    known = spark.createDataFrame([x if x[0] < 120 else (x[0], None, None) for x in labels] + [(None, 1, 0), (5000, 0, 0)], "doc_id long, quality int, toxic int")
    out = quality.classify(documents(spark, rows + [(None, None), (900, "")], extra=True), known)
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == 242 and all(0 <= r.score <= 1 for r in got.values())
    right = [got[i].kept == bool(q) for i, q, _ in labels if i >= 120]
    assert np.mean(right) > 0.97
    kept = quality.keep_good(documents(spark, rows, extra=True), known)
    assert kept.columns == documents(spark, rows, extra=True).columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows if got[i].kept}


def test_quality_without_labels_keeps_all(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.classify(documents(spark), none).where("kept").count() == len(texts())
    assert quality.classify(documents(spark, []), none).count() == 0
    short = documents(spark).select("doc_id", "text")        # no metadata columns at all
    assert quality.classify(short, none).count() == len(texts())


def test_views_teach_each_other():
    """The metadata view knows more than its labels once the text view has labelled the pool."""
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 600).astype(float)
    text = rng.normal(size=(600, 3)) + 4 * y[:, None]
    meta = rng.normal(size=(600, 8)) + 0.8 * y[:, None]
    label = y.copy()
    label[60:] = np.nan
    model = quality.co_train(text, meta, label)
    t, m, s = model.views(text[60:], meta[60:])
    assert ((s > 0.5) == y[60:]).mean() > 0.97
    alone = quality.fit_linear(meta[:60], y[:60])
    assert ((m > 0.5) == y[60:]).mean() >= ((alone.logit(meta[60:]) > 0) == y[60:]).mean() - 0.01
    assert quality.co_train(text, meta, np.full(600, np.nan)) is None


def test_each_view_receives_labels_of_both_classes():
    """Also from a view that is never sure, and such a view does not spoil the other."""
    rng = np.random.default_rng(5)
    y = (rng.random(3000) < 0.85).astype(float)
    text = rng.normal(size=(3000, 6)) + 2.5 * y[:, None] * (np.arange(6) < 2)
    meta = rng.normal(size=(3000, 5)) + 0.1 * y[:, None]
    label = y.copy()
    label[600:] = np.nan
    model = quality.co_train(text, meta, label)
    for zeros, ones in model.handed:
        assert zeros > 50 and ones > 50 and zeros + ones == 2400 * quality.ROUNDS // quality.HANDED
    assert all(zeros and ones for zeros, ones in quality.co_train(text[:640], meta[:640], label[:640]).handed)
    t, m, s = model.views(text[600:], meta[600:])
    alone = quality.fit_linear(text[:600], y[:600])
    right = ((alone.logit(text[600:]) > 0) == y[600:]).mean()
    assert ((s > 0.5) == y[600:]).mean() > right - 0.01
    # texts' labels tell the metadata view more than its own
    own = quality.fit_linear(meta[:600], y[:600])
    assert quality.ranking(m, y[600:]) > quality.ranking(own.logit(meta[600:]), y[600:]) - 0.01


def test_surest_and_ranking():
    low, high = quality.surest(np.array([0.5, 0.1, 0.9, 0.1, 0.7]), 3, 0.4)
    assert list(low) == [1, 3] and list(high) == [2]
    for count in range(4):
        low, high = quality.surest(np.array([2.0, 1.0]), count, 0.99)
        assert len(low) + len(high) == min(count, 2) and not set(low) & set(high)
    assert quality.surest(np.zeros(0), 5, 0.5)[0].size == 0
    y = np.array([0, 0, 1, 1.0])
    assert quality.ranking(np.array([1, 2, 3, 4.0]), y) == 1 and quality.ranking(np.array([4, 3, 2, 1.0]), y) == 0
    assert quality.ranking(np.ones(4), y) == 0


def test_weighted_rows_count_as_repeated_ones():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(60, 2)), (rng.random(60) < 0.5).astype(float)
    twice = quality.fit_linear(np.concatenate([x, x]), np.concatenate([y, y]))
    assert np.allclose(twice.weights, quality.fit_linear(x, y, weight=np.full(60, 2.0)).weights)


def test_quality_of_long_repeated_and_tied_rows(spark):
    rows, labels = good_and_bad(80)
    rows += [(300, "word " * 60_000), (301, rows[0][1]), (301, rows[0][1])]
    out = quality.classify(documents(spark, rows, extra=True), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(out) == 83 and len({r.score for r in out if r.doc_id in (301,)}) == 1


def test_gradients_by_difference():
    net = langid.Net(["a", "b"], hidden=3)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    x, n = langid._arrays([b"abca", b"cab", b"b"])
    y = np.array([0, 1, 1])
    _, g = net.step(x, n, y)
    rng = np.random.default_rng(1)
    for k, w in net.p.items():
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in w.shape) if not k.startswith("W") else (rng.choice([97, 98, 99]), rng.integers(0, 9))
            old, h = w[at], 1e-3
            w[at] = old + h
            up = net.step(x, n, y)[0]
            w[at] = old - h
            down = net.step(x, n, y)[0]
            w[at] = old
            assert abs((up - down) / (2 * h) - g[k][at]) < 2e-3, (k, at)


def languages(n):
    one, two = ["kata", "mino", "der", "auf"], ["lyth", "wons", "the", "ing"]
    rng = np.random.default_rng(3)
    return [(k, " ".join(rng.choice(one if k % 2 else two, 12)), "xx" if k % 2 else "yy") for k in range(n)]


def test_language_of_held_out_documents(spark, monkeypatch):
    rows = languages(120) + [(500, None, "xx"), (501, "12 34 !!", "yy"), (502, "", None), (None, "der auf", None), (503, "kata " * 4000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'clash' as score", "'clash' as p").repartition(3)
    out = {r.doc_id: r for r in langid.identify(df).collect()}
    assert len(out) == len(rows)
    for i, t, lang in rows:
        r = out[i]
        assert r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2)
        if i in (500, 501, 502):
            assert (r.lang_pred, r.score) == ("und", 0)
        elif lang:
            assert r.lang_pred == lang and 0.5 < r.score <= 1
    assert out[503].lang_pred == "xx"
    nothing = df.where("lang is null")
    assert {r.lang_pred for r in langid.identify(nothing).collect()} == {"und"}
    assert langid.identify(df.limit(0)).count() == 0


def test_positions_and_memory_do_not_change_results():
    rows = languages(60)
    runs = [r[0] for _, t, _ in rows for r in langid.stretches(t)]
    labels = np.array([int(lang == "yy") for _, t, lang in rows for _ in langid.stretches(t)])
    net = langid.train(runs, labels, ["xx", "yy"], steps=60)
    texts = pd.Series([t for _, t, _ in rows] + ["kata wons", "a" * 70, "kata der " * 100, "wons the é " * 90, "kata der " * 100])
    empty = lambda: ({}, [np.zeros((0, 2), np.int64)])
    whole = langid._judge(net, texts, *empty())
    each = [langid._judge(net, texts[k:k + 1], *empty()) for k in range(len(texts))]
    assert whole[0] == [e[0][0] for e in each] and np.allclose(whole[1], [e[1][0] for e in each])
    both = "kata der\n mino auf " * 20 + "wons the é lyth ing " * 20
    named = langid.label_positions(net, both)
    assert len(named) == len(both.encode()) and set(named[100:300]) == {"xx"} and set(named[-300:-100]) == {"yy"}
    # the state runs through white space: the same word is read otherwise among other words
    alone, among = (net.positions(*langid._arrays([t]))[0, -4:] for t in (b"    kata", b"the lyth kata"))
    assert np.abs(alone - among).max() > 1e-3


def test_repeated_documents_and_ties_have_one_language(spark):
    rows = languages(60) + [(700, "kata mino der", None)] * 3 + [(None, "kata mino der", None)]
    out = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)).collect()
    assert len(out) == 64 and len({(r.lang_pred, r.score) for r in out if r.doc_id in (700, None)}) == 1
    even = langid.Net(["aa", "bb"], hidden=2)
    for k in even.p:
        even.p[k] = np.zeros_like(even.p[k])
    names, scores = langid._judge(even, pd.Series(["tie", "more " * 400]), {}, [np.zeros((0, 2), np.int64)])
    assert names == ["aa", "aa"] and np.allclose(scores, 0.5)


def test_documents_pool_all_their_positions():
    """Against the network run over each stretch by itself; a stretch is read with what is around it."""
    net = langid.Net(["a", "b", "c"], seed=5)
    for text in ("x", "short text", "word " * 52, "some é more words " * 60, "a" * 256, "b" * 513):
        raw = text.encode()
        runs = langid.stretches(text)
        assert b"".join(r[lo:hi] for r, lo, hi in runs) == raw
        want = np.zeros(3)
        for k in range(0, len(raw), langid.STRETCH):
            lo = max(0, k - langid.AROUND)
            logs = net.positions(*langid._arrays([raw[lo:k + langid.STRETCH + langid.AROUND]]))[0]
            want += logs[k - lo:k - lo + min(langid.STRETCH, len(raw) - k)].sum(0)
        assert np.allclose(net.pooled(runs).sum(0) * langid.GRAIN, want, atol=0.01 * len(runs))
        assert (net.pooled(runs) == np.concatenate([net.pooled([r]) for r in runs])).all() or len(runs) > 1


def test_sample_is_the_first_by_hash(spark):
    rows = [(k, f"text {k}", "aa" if k % 3 else "bb") for k in range(4000)] + [(7, "again", "aa"), (None, "none", "cc"), (8, None, "cc"), (9, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    near = {r[0]: r[1] for r in df.selectExpr("doc_id", "pmod(xxhash64(cast(doc_id as string)), 1073741824)").distinct().collect()}
    out = langid.sample(df, "doc_id", "text", "lang")
    for lang in ("aa", "bb", "cc"):
        can = [(near[i], i, t) for i, t, own in rows if own == lang and t is not None and (i is None or zlib.crc32(str(i).encode()) % 4 != 2)]
        can.sort(key=lambda x: (x[0], str(x[1]), x[2]))
        assert sorted(r[0].decode() for own, r in out if own == lang) == sorted(t for _, _, t in can[:langid.DOCS_PER_LANGUAGE])


def check_plan(histogram, capacities):
    lines, runs = plan(histogram, capacities)
    used, sizes, seen = {}, {}, {}
    for x in lines:
        assert x.rank == seen.get(x.length, 0)              # ranks of a length go on without gaps
        seen[x.length] = x.rank + x.pieces
        for k in range(x.pieces):
            b = x.bin + k // x.each
            assert used.get(b, 0) == x.offset + k % x.each * x.length
            used[b] = used.get(b, 0) + x.length
            sizes.setdefault(b, set()).add(x.size)
    assert seen == {k: n for k, n in histogram.items() if n}
    assert all(len(s) == 1 and used[b] <= max(s) for b, s in sizes.items())
    assert sorted(used) == list(range(len(used))) and sum(r.bins for r in runs) == len(used)
    for b, (s,) in sizes.items():                           # downsized: no smaller size holds the contents
        assert min(c for c in capacities if c >= used[b]) == s
    return used, sizes


@pytest.mark.parametrize("seed", range(8))
def test_plans(seed):
    rng = np.random.default_rng(seed)
    capacities = (8, 16, 32) if seed % 2 else (16, 24, 64)
    histogram = {int(k): int(n) for k, n in zip(rng.integers(1, capacities[-1], 12), rng.integers(1, 60, 12))}
    used, sizes = check_plan(histogram, capacities)
    total = sum(max(s) for s in sizes.values())
    assert sum(used.values()) / total > 0.75


def naive_bins(lengths, capacities, costs):
    """Best fit over explicit bins, one piece at a time: (contents in order, final size) of each bin."""
    bins = []
    for length in sorted(lengths, reverse=True):
        fits = [(size - sum(held), k) for k, (held, size) in enumerate(bins) if size - sum(held) >= length]
        if fits:
            bins[min(fits)[1]][0].append(length)
            continue
        prices = []
        for size in capacities:
            if size >= length:
                filled = size // length * length
                filled += max((x for x in lengths if x < length and x <= size - filled), default=0)
                prices.append((costs[size] / filled, size))
        bins.append(([length], min(prices)[1]))
    return [(held, min((costs[c], c) for c in capacities if c >= sum(held))[1]) for held, _ in bins]


@pytest.mark.parametrize("seed", range(40))
def test_plans_equal_naive_best_fit(seed):
    rng = np.random.default_rng(seed)
    capacities = [(8, 16, 32), (16, 24, 64), (10,), (7, 11, 13, 50)][seed % 4]
    costs = {c: c + float(rng.integers(0, 9)) for c in capacities}
    histogram = {int(k): int(n) for k, n in zip(rng.integers(1, capacities[-1] + 1, 9), rng.integers(1, 25, 9))}
    lines, runs = plan(histogram, capacities, costs)
    held, sizes = {}, {}
    for x in lines:
        for k in range(x.pieces):
            held.setdefault(x.bin + k // x.each, []).append(x.length)
            sizes[x.bin + k // x.each] = x.size
    want = naive_bins([k for k, n in histogram.items() for _ in range(n)], capacities, costs)
    assert [(held[b], sizes[b]) for b in range(len(held))] == want


def test_plan_is_small_for_any_number_of_documents():
    lines, runs = plan({k: 10**9 + k for k in range(1, 512)}, (128, 512))
    assert len(lines) < 10_000 and sum(r.bins for r in runs) > 10**9
    assert plan({}, (8,)) == ([], [])


def test_pack(spark):
    rows = texts() + [(300 + k, "w " * 7) for k in range(400)]
    out = pack(documents(spark, rows, extra=True), capacities=(16, 64, 128)).collect()
    n = sum(len((t or "").split()) for _, t in rows)
    assert sum(r.length for r in out) <= n and sum(r.length for r in out) == sum(
        len(__import__("re").findall(r"[^ \t\n\x0b\f\r]+", t or "")) for _, t in rows)
    bins = {}
    for r in out:
        bins.setdefault(r.bin_id, []).append((r.bin_offset, r.length, r.bin_size))
    for pieces in bins.values():
        at = 0
        for offset, length, size in sorted(pieces):
            assert offset == at and at + length <= size
            at += length
    long = sorted((r.start, r.length) for r in out if r.doc_id == 16)
    assert long[0] == (0, 128) and sum(x[1] for x in long) == 3000
    assert pack(documents(spark, [])).count() == 0 and pack(documents(spark, [(1, None), (2, "")])).count() == 0
    assert CAPACITIES == tuple(sorted(CAPACITIES))


def test_pipeline_on_odd_tables(spark, scratch):
    """Nulls in any column, an empty table, clashing column names, repeated rows and a very long text."""
    rows, labels = good_and_bad(60)
    long = prose(31, 40_000) + "."
    odd = [(None, None), (None, rows[1][1]), (900, long), (901, long), (902, ""), (903, rows[3][1]), (903, rows[3][1])]
    for name, mine in (("odd", rows + odd), ("empty", [])):
        folder = scratch(name)
        docs = documents(spark, mine, extra=True).withColumn("lang", F.lit(None).cast("string"))
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, prose(991, 25)), (None, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        if name == "empty":
            assert corpus_pipeline.run(spark, folder).collect() == []
        else:
            table = spark.read.parquet(f"{folder}/documents.parquet")
            good = corpus_pipeline.quality(spark, table, folder)
            assert good.columns == table.columns and {3, 903} <= {r.doc_id for r in good.collect()}
            # the classifier may reject so long a text; the other stages have no say in its quality
            for step, stage in corpus_pipeline.STAGES[1:]:
                stage(spark, table, folder).write.parquet(f"{folder}/{step}")
                table = spark.read.parquet(f"{folder}/{step}")
            assert sum(r.length for r in table.collect() if r.doc_id in (900, 901)) == 40_000
            assert len({r.doc_id for r in table.collect()} & {900, 901}) == 1
            assert sum(r.length for r in table.collect() if r.doc_id in (3, 903)) == len(rows[3][1].split())


def test_pipeline_stages(spark, scratch):
    rows, labels = good_and_bad(160)
    item = prose(991, 25)
    copies = [(1000 + k, rows[1][1].upper().lower()) for k in range(4)] + [(1100 + k, edited(prose(777, 80) + ".", k, min(k, 1))) for k in range(5)] + [
        (1200, prose(5, 20) + " " + item + "."), (1300, None), (1301, "")]
    folder = scratch("sf")
    documents(spark, rows + copies).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        path = scratch(name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = {r.doc_id for r in docs.collect()}
    bad = {i for i, q, _ in labels if not q}
    assert not seen["quality"] & bad and {i for i, q, _ in labels if q} <= seen["quality"]
    assert len(seen["exact"] & {1, 1000, 1001, 1002, 1003}) == 1
    assert seen["near"] & set(range(1100, 1105)) == {1100}
    assert 1200 in seen["near"] and seen["benchmark"] == seen["near"] - {1200}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in packed.collect()} == seen["benchmark"] - {1300, 1301}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "benchmark", "packing"] and corpus_pipeline.ORACLE_SQL is None
