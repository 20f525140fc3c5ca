"""Exact copies, near copies and repeated substrings against plain Python."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.llm.common import RID, stored, with_rid
from ledgerlake.llm.exact import drop_exact, exact_groups
from ledgerlake.llm.graph import components
from ledgerlake.llm.ngrams import EXTRA, _sides, _agree, _verified, drop_near, near_groups, needed
from ledgerlake.llm.repeats import find_repeats, remove_repeats
from ledgerlake.llm.suffix import suffix_array, types
from tests.llm.helpers import documents, got, lower, prose, texts


def exact_rows(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    return sorted(((i, max((x for x in groups[lower(t)] if x is not None), default=None), len(groups[lower(t)]),
                    hashlib.sha256(lower(t).encode()).hexdigest()) for i, t in rows), key=repr)


@pytest.mark.parametrize("block,fingerprint", [(4096, F.xxhash64), (7, lambda c: F.length(c).cast("long") % 2)])
def test_exact_groups(spark, block, fingerprint):
    """Also with small blocks (many levels of names) and a fingerprint that nearly all blocks share."""
    rows = [(i, t and t[:400]) for i, t in texts()]
    out = exact_groups(documents(spark, rows, extra=True), block_chars=block, fingerprint=fingerprint)
    assert got(out, "doc_id", "keep_id", "group_size", "text_sha256") == exact_rows(rows)
    kept = Counter(lower(t) for (i, t), k in zip(rows, range(len(rows))))
    assert out.where("kept").count() == len(kept)
    assert all(r.doc_id == r.keep_id for r in out.where("kept").collect())


def test_drop_exact_keeps_columns_and_one_row_a_text(spark):
    docs = documents(spark, extra=True)
    out = drop_exact(docs)
    assert out.columns == docs.columns
    assert out.count() == len({lower(t) for _, t in texts()})
    assert drop_exact(documents(spark, [])).count() == 0


def shingles(text):
    w = lower(text).encode().split()
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def near_rows(rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            if sets[x] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                group[max(find(x), find(y))] = min(find(x), find(y))
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        least[find(k)] += [] if i is None else [i]
    return sorted(((i, len(s), min(least[find(k)], default=None)) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=repr)


@pytest.mark.parametrize("crowd", [32, 1])
def test_near_groups(spark, crowd):
    out = near_groups(documents(spark, extra=True), crowd=crowd)
    assert got(out, "doc_id", "n_shingles", "component_id") == near_rows(texts())


def test_candidates_are_asked_for_both_orders(spark):
    """A pair must agree on its hash-order prefixes before its sets are compared; no link is lost by that."""
    rng = np.random.default_rng(8)
    rows, sets = [], {}
    base = rng.integers(0, 2 ** 64, 150, dtype=np.uint64)
    for cls in range(60):
        n = int(rng.integers(20, 140))
        take = int(n * rng.choice([0.0, 0.1, 0.3, 0.95, 1.0]))
        s = np.unique(np.concatenate([base[:take], rng.integers(0, 2 ** 64, n - take, dtype=np.uint64)]))
        end = s[len(s) - needed(len(s)) + len(s) // EXTRA]
        sets[cls] = set(s.tolist())
        rows.append((cls, len(s), int(end ^ np.uint64(2 ** 63)) - (2 ** 64 if int(end ^ np.uint64(2 ** 63)) >= 2 ** 63 else 0),
                     s.view(np.int64).tolist(), 0))
    live = spark.createDataFrame(rows, "cls long, n long, h long, tokens array<long>, few int")
    pairs = spark.createDataFrame([(a, b) for a in sets for b in sets if a < b], "a long, b long")
    prefix = {cls: set(sorted(s)[:len(s) - needed(len(s)) + 1 + len(s) // EXTRA]) for cls, s in sets.items()}
    agreed = {(r.a, r.b) for r in _sides(pairs, live).where(_agree()).collect()}
    assert agreed == {(a, b) for a in sets for b in sets if a < b
                      and len(prefix[a] & prefix[b]) >= 1 + min(len(sets[a]), len(sets[b])) // EXTRA}
    linked = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert {(r.a, r.b) for r in _verified(pairs, live, 80).collect()} == linked
    assert linked and linked < agreed and len(agreed) < 60 * 59 // 2


def test_drop_near(spark):
    docs = documents(spark)
    out = drop_near(docs)
    assert out.columns == docs.columns
    rows = near_rows(texts())
    # one row a component; rows without words, and without an id in the component, are counted apart
    assert {r.doc_id for r in out.collect() if r.doc_id is not None} == {c for i, _, c in rows if i is not None}
    assert near_groups(documents(spark, [])).count() == 0
    assert near_groups(documents(spark, [(1, None), (2, "")])).where("component_id = doc_id").count() == 2


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=14))
def test_components(spark, edges):
    group = {x: x for e in edges for x in e}
    for _ in group:
        for a, b in edges:
            group[a] = group[b] = min(group[a], group[b])
    out = components(spark.createDataFrame(edges, "a long, b long"))
    want = {x: r for x, r in group.items() if any(x in e and e[0] != e[1] for e in edges)}
    assert {r.node: r.root for r in out.collect()} == want


def repeat_rows(rows, length):
    """(id, bytes, removed, spans, sha) of rows in order."""
    seen, out = set(), []
    for i, t in rows:
        b = (t or "").encode()
        hit = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if b[p:p + length] in seen:
                hit[p:p + length] = b"\1" * length
            seen.add(b[p:p + length])
        kept = bytes(x for x, h in zip(b, hit) if not h)
        spans = sum(h and (k == 0 or not hit[k - 1]) for k, h in enumerate(hit))
        out.append((i, len(b), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length,gram,crowd", [(100, 28, 4096), (100, 28, 1), (24, 9, 2)])
def test_remove_repeats(spark, length, gram, crowd):
    rows = [(k, t) for k, (_, t) in enumerate(texts())]
    out = remove_repeats(documents(spark, rows, extra=True), length=length, gram=gram, crowd=crowd)
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == repeat_rows(rows, length)


def test_repeats_order_null_ids_first_and_no_rows(spark):
    t = prose(8, 60)
    out = remove_repeats(documents(spark, [(5, t), (None, t), (2, t)]))
    assert got(out.where("n_removed = 0"), "doc_id") == [(None,)]
    assert remove_repeats(documents(spark, [])).count() == 0


def test_repeats_in_a_text_longer_than_a_chunk(spark, monkeypatch):
    from ledgerlake.llm import hashing, repeats
    monkeypatch.setattr(hashing, "CHUNK", 700)
    monkeypatch.setattr(repeats, "CHUNK", 700)
    import pyarrow as pa
    t = (prose(3, 400) + prose(4, 50) + prose(3, 100)).encode()
    whole = {}
    for r, g, c, lo, hi in repeats._contexts(pa.array([t.decode()]), 100, 28):
        for h, a, b in zip(g.tolist(), lo.tolist(), hi.tolist()):
            whole.update({p: h for p in range(a, b + 1)})
    data = np.frombuffer(t, np.uint8)
    _, g, _, lo, hi = repeats.anchors(data, np.array([0, len(data)]), 100, 28)
    once = {p: h for h, a, b in zip(g.tolist(), lo.tolist(), hi.tolist()) for p in range(a, b + 1)}
    assert whole == once and sorted(once) == list(range(len(t) - 99))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=40))
def test_suffix_array(s):
    t = np.array([*s, 0], np.int16)
    want = sorted(range(len(t)), key=lambda k: t[k:].tolist())
    assert suffix_array(t, 10**6).tolist() == want
    assert types(t).tolist() == [k == len(t) - 1 or t[k:].tolist() < t[k + 1:].tolist() for k in range(len(t))]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=9, max_size=40).map(lambda b: bytes(97 + x % 2 for x in b)), min_size=1, max_size=5))
def test_find_repeats(contexts):
    seen = set()
    for c, again in zip(contexts, find_repeats(contexts, [len(c) - 8 for c in contexts], 9)):
        want = []
        for p in range(len(c) - 8):
            want += [p] if c[p:p + 9] in seen else []
            seen.add(c[p:p + 9])
        assert again.tolist() == want


def test_row_ids_hold_when_files_are_split_anew(spark):
    rows = [(k % 7 or None, prose(k % 30, 40)) for k in range(400)]
    docs = documents(spark, rows, parts=5)
    tables = {"files": docs, "cut": docs.where("n_chars > 0").select("doc_id", "text"), "one": documents(spark, rows, parts=1),
              "union": docs.union(docs), "memory": spark.createDataFrame(rows, "doc_id long, text string").repartition(5)}
    for name, table in tables.items():
        tagged = with_rid(table)
        seen = []
        for size in ("128m", "6k", "1k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            try:
                seen.append({r[RID]: (r.doc_id, r.text) for r in tagged.select(RID, "doc_id", "text").collect()})
            finally:
                spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert len(seen[0]) == len(rows) * (1 + (name == "union")), name
        assert seen[0] == seen[1] == seen[2], name
        assert tagged.columns == [*table.columns, RID]
    joined = docs.alias("a").join(stored(docs.select("doc_id").distinct(), "ids"), "doc_id")
    assert with_rid(joined).select(RID).distinct().count() == joined.count()
