"""Lexical search and sharding against plain-Python forms."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from ledgerlake.llm import lexical as L
from ledgerlake.llm import shards as S
from tests.llm.helpers import documents, prose, texts

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return [t.translate(UPPER) for t in TERM.findall(text or "")]


def ranked(docs, items, k=20):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for own, bag in bags:
            m = 100 - 25 + (25 * sum(bag.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * bag[t]) // (1000 * bag[t] + 12 * m))
                        for t in terms(text) if t in bag)
            if score > 0:
                scored.append((-score, own is None, own or 0))
        out += [(item, rank, None if none else own, -s) for rank, (s, none, own) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def items(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "item_id long, text string")
    return df.selectExpr("*", *(f"'clash' as {c}" for c in ("own", "query", "term", "score", "m", "rank"))) if extra else df


def rows_of(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


QUERIES = [(1, "ka1 lo2 mi3 te4 su5 ka1"), (2, prose(1, 60)), (3, None), (4, ""), (5, "unknown words only"), (5, "ÉTÉ naïve"), (None, "one two three"),
           (6, "x"), (7, "日本語のテキスト"), (8, prose(5, 900))]


@pytest.mark.parametrize("block,first", [(1024, 1000), (3, 4), (1, 1)])
def test_search_equals_scoring_everything(spark, monkeypatch, block, first):
    monkeypatch.setattr(L, "FIRST", first)
    index = L.build_index(documents(spark, extra=True), block=block)
    assert rows_of(L.search(index, items(spark, QUERIES, extra=True))) == ranked(texts(), QUERIES)
    assert rows_of(L.search(index, items(spark, QUERIES), k=3, pass_terms=400)) == ranked(texts(), QUERIES, 3)


def test_search_reads_only_strata_that_can_matter(spark, monkeypatch):
    """Long documents that hold a query's term once can't beat short ones: their blocks are not scored."""
    monkeypatch.setattr(L, "FIRST", 30)
    rows = [(i, "needle " + prose(i, 8)) for i in range(30)] + [(100 + i, "needle " + prose(i, 900 + 40 * i)) for i in range(30)]
    index = L.build_index(documents(spark, rows))
    bounds = {r.m: L.impact(1, r.m) for r in index.blocks.select("m").distinct().collect()}
    scored = []
    monkeypatch.setattr(L, "stored", lambda df, name, put=L.stored: (lambda t: scored.append((name, t)) or t)(put(df, name)))
    got = rows_of(L.search(index, items(spark, [(1, "needle")])))
    assert got == ranked(rows, [(1, "needle")])
    visited = {r.m for name, t in scored if name == "openstrata" for r in t.collect()}
    least = min(s for *_, s in got)
    assert visited < set(bounds) and all(bounds[m] * (least // bounds[max(visited)]) < least for m in set(bounds) - visited)


def test_ties_and_equal_lengths(spark):
    rows = [(i, "same words here again") for i in range(90, 0, -1)] + [(None, "same words here again")] * 2 + [(5, "same words here again")]
    index = L.build_index(documents(spark, rows, parts=7), block=4)
    assert max(r.n for r in index.blocks.selectExpr("size(ids) as n").collect()) <= 4
    assert rows_of(L.search(index, items(spark, [(1, "words again"), (2, "words again")]))) == ranked(rows, [(1, "words again"), (2, "words again")])


def test_search_of_nothing(spark):
    index = L.build_index(documents(spark, [(1, None), (2, "")]))
    assert index.documents == 0 and rows_of(L.search(index, items(spark, QUERIES))) == []
    assert rows_of(L.search(L.build_index(documents(spark, [])), items(spark, QUERIES))) == []
    assert rows_of(L.search(L.build_index(documents(spark)), items(spark, []))) == []


# ---- sharding

def one_by_one(segs, owners, room):
    """Rows in ring order walk clockwise one by one: own rows first, then the others."""
    owners = [*owners, owners[0]]
    room, where, over = list(room), {}, []
    order = sorted(range(len(segs)), key=lambda r: ((segs[r] + 1) % len(owners), r))
    for r in order:
        s = owners[segs[r]]
        if room[s]:
            room[s] -= 1
            where[r] = s
        else:
            over.append(r)
    ringwise = [len(owners) - 1, *range(len(owners) - 1)]
    waiting, todo = [], {g: [r for r in over if segs[r] == g] for g in ringwise}
    for seg in ringwise * 2:
        waiting += todo.pop(seg, [])
        while waiting and room[owners[seg]]:
            room[owners[seg]] -= 1
            where[waiting.pop(0)] = owners[seg]
    return [where[r] for r in range(len(segs))]


@pytest.mark.parametrize("seed", range(12))
def test_plan_equals_rows_walking_one_by_one(seed):
    rng = random.Random(seed)
    shards = rng.randrange(1, 7)
    points, owners = S.ring(shards, rng.randrange(1, 6))
    segs = sorted(rng.choice([rng.randrange(len(points) + 1), 2 % (len(points) + 1)]) for _ in range(rng.randrange(200)))
    counts = [segs.count(k) for k in range(len(points) + 1)]
    room = S.bounds(len(segs), shards, rng.choice([0, 0, 0.3]))
    got = {}
    for run in S.plan(counts, owners.tolist(), room):
        for k in range(run.rows):
            got[run.rank + k] = (run.shard, run.slot + k)
    want = one_by_one(segs, owners.tolist(), room)
    assert [got[r][0] for r in range(len(segs))] == want
    taken = defaultdict(list)
    for r in range(len(segs)):
        taken[got[r][0]].append(got[r][1])
    assert all(slots == list(range(len(slots))) for slots in taken.values())


def sharded(spark, rows, **more):
    return S.shard_rows(documents(spark, rows, extra=True), **more).collect()


@pytest.mark.parametrize("rows", [texts(), [(7, "same")] * 100 + [(None, None)] * 50 + texts(), [(1, "x" * 300_000)], []])
def test_rows_law_sizes_and_slots(spark, rows):
    got = sharded(spark, rows)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr) == sorted(
        ((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows), key=repr)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(24)]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_each_key_stands_where_the_plan_puts_it(spark):
    rows = [(i, f"text {i}") for i in range(2000)]
    got = sharded(spark, rows, shards=5, points=16)
    points, owners = S.ring(5, 16)
    hashes = {r.doc_id: r.h for r in spark.range(2000).selectExpr("id as doc_id", "xxhash64(id) as h").collect()}
    order = sorted(range(2000), key=lambda i: hashes[i])
    segs = S.segments([hashes[i] for i in order], points).tolist()
    want = dict(zip(order, one_by_one(segs, owners.tolist(), S.bounds(2000, 5))))
    assert {r.doc_id: r.shard for r in got} == want


def test_one_more_shard_moves_few_rows(spark):
    rows = [(i, f"text {i}") for i in range(3000)]
    a = {r.doc_id: r.shard for r in sharded(spark, rows)}
    b = {r.doc_id: r.shard for r in sharded(spark, rows, shards=25)}
    assert sum(a[i] != b[i] for i in a) / len(a) < 0.25       # 0.04 have to move, 0.96 would by remainders
    loose = {r.doc_id: (r.shard, r.home) for r in sharded(spark, rows, slack=1.0)}
    assert all(s == h for s, h in loose.values())


def test_written_shards_hold_whole_rows_in_order(spark, scratch):
    path = scratch("shards")
    docs = documents(spark)
    S.write_shards(docs, path, shards=4, rows_a_task=5)
    back = spark.read.parquet(path)
    assert sorted(map(repr, (tuple(r) for r in back.drop("shard", "slot").collect()))) == sorted(map(repr, (tuple(r) for r in docs.collect())))
    counts = Counter(r.shard for r in back.collect())
    assert max(counts.values()) - min(counts.values()) <= 1
