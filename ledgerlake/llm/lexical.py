"""Ranked lexical search over a length-stratified index.

A document's score for a query depends on its length only through the normaliser m, a small whole number.
Documents with equal m are a stratum; the index stores each stratum in blocks of at most ``BLOCK`` documents,
and in a block a term's postings by descending tf.  So what a posting adds is computed once per (term, tf)
of a block, and a stratum's terms and their greatest tf bound every score in it.

Search visits strata by those bounds.  For each query the strata with the greatest bounds that hold
``FIRST`` documents are scored first; the k-th best score found there is a threshold.  Then every stratum
whose bound reaches the threshold of some query is read; a query passes over a block that can't reach its
threshold, which rises with what the task has found.  A score equal to the threshold still counts, since ties
go to the smaller id, so results are exact.

Scale: a stratum is dealt out by hash in as many pieces as its bytes and documents ask for, so a length that a
third of all documents share is cut into many blocks, and no task holds more than a block.  All terms of all documents are indexed.  A block is
one row, so search shuffles nothing but each task's k best rows a query.  Queries are searched in passes
of about ``PASS_TERMS`` distinct (query, term) pairs, the only rows that reach the driver and the tasks whole.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import stored

K = 20
#: Documents, and bytes of their distinct terms, of a block of the index.
BLOCK, BLOCK_BYTES = 1024, 1 << 22
#: Documents in the strata that a query visits first.
FIRST = 1000
#: Distinct terms of the queries of one pass, all queries together.
PASS_TERMS = 500_000

#: Bytes that are in no term become spaces, A-Z become a-z; every byte of a non-ASCII character stays.
_WORD_BYTES = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD_BYTES else 0x20 for b in range(256))

#: What a block's row has besides m: ids, for each term its greatest tf and its number of documents, and all that
#: search reads, compressed.
COLUMNS = {"ids": "array<long>", "terms": "array<string>", "most": "array<int>", "df": "array<int>", "packed": "binary"}


class Index(NamedTuple):
    """Stored blocks (m and ``COLUMNS``), the number of documents with a term and of all terms."""

    blocks: DataFrame
    documents: int
    terms: int


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(FOLD).split()


def impact(tf, m):
    """What one unit of a term's weight adds for its frequency, in whole numbers."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n, bag, tfs) of rows (id, text): number of terms, the distinct ones, their frequencies."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def done(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], ["id", "n", "bag", "tfs"])

    rows, size = [], 0
    for batch in batches:
        ids, texts = batch.columns
        for k in range(batch.num_rows):
            counts = Counter(terms_of(texts[k].as_py()))
            if counts:
                bag = b" ".join(counts)
                rows.append((ids[k].as_py(), counts.total(), bag, np.fromiter(counts.values(), np.int32, len(counts)).tobytes()))
                size += len(bag)
            if size >= BLOCK_BYTES:
                yield done(rows)
                rows, size = [], 0
    if rows:
        yield done(rows)


class _Block:
    """The documents of one block, added one by one, and their row of the index: postings of term t are the runs
    runs[t-1]..runs[t]; run r has frequency tfs[r] and the documents posts[ends[r-1]..ends[r]]."""

    def __init__(self, m: int):
        self.m, self.ids, self.numbers, self.size = m, [], {}, 0
        self.terms, self.tfs = [], []

    def add(self, own: int | None, bag: bytes, tfs: bytes) -> None:
        number = self.numbers
        self.terms.append(np.array([number.setdefault(t, len(number)) for t in bag.split(b" ")], np.int32))
        self.tfs.append(np.frombuffer(tfs, np.int32))
        self.ids.append(own)
        self.size += len(bag)

    def row(self) -> pa.RecordBatch:
        terms, tfs = np.concatenate(self.terms), np.concatenate(self.tfs)
        docs = np.repeat(np.arange(len(self.ids), dtype=np.int32), [len(t) for t in self.terms])
        order = np.lexsort((docs, -tfs, terms))
        terms, tfs, docs = terms[order], tfs[order], docs[order]
        starts = np.flatnonzero(np.append(True, (terms[1:] != terms[:-1]) | (tfs[1:] != tfs[:-1])))     # of runs
        firsts = np.flatnonzero(np.append(True, terms[1:] != terms[:-1]))                               # of terms
        runs = np.searchsorted(starts, np.append(firsts[1:], len(terms)))
        most, df, ends = tfs[firsts], np.diff(firsts, append=len(terms)), np.append(starts[1:], len(terms))
        ints = [c.astype(np.int32) for c in (most, runs, tfs[starts], ends)]
        packed = zlib.compress(b"".join([np.array([len(most), len(starts)], np.int32).tobytes(), *(c.tobytes() for c in ints),
                                         docs.astype(np.uint16).tobytes(), b" ".join(self.numbers)]), 1)
        lists = [pa.array([c.astype(np.int32)], pa.list_(pa.int32())) for c in (most, df)]
        return pa.RecordBatch.from_arrays([pa.array([self.m], pa.int64()), pa.array([self.ids], pa.list_(pa.int64())),
                                           pa.array([list(self.numbers)], pa.list_(pa.string())), *lists, pa.array([packed], pa.binary())], ["m", *COLUMNS])


class Postings(NamedTuple):
    """A block as search reads it, see ``_Block``; ``most`` is each term's greatest tf."""

    terms: list[bytes]
    most: np.ndarray
    runs: np.ndarray
    tfs: np.ndarray
    ends: np.ndarray
    posts: np.ndarray


def unpacked(packed: bytes) -> Postings:
    raw = zlib.decompress(packed)
    n, r = np.frombuffer(raw, np.int32, 2).tolist()
    arrays, at = [], 8
    for size in (n, n, r, r):
        arrays.append(np.frombuffer(raw, np.int32, size, at))
        at += 4 * size
    posts = np.frombuffer(raw, np.uint16, int(arrays[3][-1]), at)
    return Postings(raw[at + 2 * len(posts):].split(b" "), *arrays, posts)


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows (m, piece, id, bag, tfs) sorted by m and piece, cut into blocks of at most ``most`` documents."""
    held, last = None, None
    for batch in batches:
        for k in range(batch.num_rows):
            m, piece, own, bag, tfs = (c[k] for c in batch.columns)
            at = m.as_py(), piece.as_py()
            if held and (at != last or len(held.ids) == most or held.size >= 2 * BLOCK_BYTES):
                yield held.row()
                held = None
            held, last = held or _Block(at[0]), at
            held.add(own.as_py(), bag.as_buffer().to_pybytes(), tfs.as_py())
    if held:
        yield held.row()


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> Index:
    """Index every document that has a term.  Ids are whole numbers; null and repeated ids are kept as they are,
    null and empty texts have no terms, very long ones are indexed whole, and other columns are not read.
    An empty table gives an index without blocks.  A block holds 65,536 documents at the most."""
    if not 0 < block <= 1 << 16:
        raise ValueError("a block holds 1 to 65,536 documents")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    bags = stored(rows.mapInArrow(_bags, "id long, n long, bag string, tfs binary"), "bags")
    documents, terms = bags.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    m = F.lit(75) + F.expr(f"(25 * n * {documents}L) div {max(1, terms)}L")
    rows = bags.select(m.alias("m"), "id", "bag", "tfs")
    pieces = stored(rows.groupBy("m").agg(F.greatest(F.ceil(F.sum(F.octet_length("bag").cast("long")) / BLOCK_BYTES), F.ceil(
        F.count(F.lit(1)) / block)).alias("pieces")), "pieces")
    strata = rows.withColumn("at", F.monotonically_increasing_id()).join(pieces, "m").withColumn("piece", F.pmod(F.xxhash64("at"), "pieces"))
    strata = strata.repartition("m", "piece").sortWithinPartitions("m", "piece").select("m", "piece", "id", "bag", "tfs")
    schema = ", ".join(["m long", *(f"{c} {k}" for c, k in COLUMNS.items())])
    return Index(stored(strata.mapInArrow(lambda batches: _blocks(batches, block), schema), "lexicalindex"), documents, terms)


def _weight(index: Index, df: Column) -> Column:
    return F.floor(1000 * F.log((F.lit(2.0) * index.documents + 2) / (2.0 * df + 1))).cast("long")


class _Asked:
    """The queries of one pass as arrays: for each term the queries that have it and their weights."""

    def __init__(self, rows: list[tuple[int, str, int]], thresholds: dict[int, int], strata: dict[int, list[int]] | None):
        self.queries = sorted({q for q, _, _ in rows})
        place = {q: k for k, q in enumerate(self.queries)}
        by_term: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for q, term, weight in rows:
            by_term[term].append((place[q], weight))
        self.terms = {t.encode(): (np.array([k for k, _ in x]), np.array([w for _, w in x], np.int64)) for t, x in by_term.items()}
        self.least = np.array([thresholds.get(q, 0) for q in self.queries], np.int64)
        self.strata = None if strata is None else {m: np.array([place[q] for q in qs]) for m, qs in strata.items()}

    def scan(self, k: int):
        return _Scan(self, k)


class _Scan:
    """A task's run over blocks: the k best rows a query so far."""

    def __init__(self, asked: _Asked, k: int):
        self.asked, self.k = asked, k
        self.least = np.maximum(asked.least.copy(), 1)
        self.best: dict[int, list[tuple[int, bool, int]]] = {}

    def block(self, m: int, ids: list, block: Postings) -> None:
        terms, most, runs, tfs, ends, posts = block
        known = self.asked.terms
        here = [(t, known[term]) for t, term in enumerate(terms) if term in known]
        if not here:
            return
        tops = impact(most.astype(np.int64), m)
        reach = np.zeros(len(self.least), np.int64)
        for t, (who, weight) in here:
            reach[who] += weight * tops[t]      # a query has a term once
        go = reach >= self.least
        if self.asked.strata is not None:
            chosen = np.zeros(len(go), bool)
            chosen[self.asked.strata[m]] = True
            go &= chosen
        active = np.flatnonzero(go)
        if not len(active):
            return
        row_of = np.full(len(go), -1)
        row_of[active] = np.arange(len(active))
        adds = impact(tfs.astype(np.int64), m)      # once per (term, tf)
        lengths = np.diff(ends, prepend=0)
        scores = np.zeros((len(active), len(ids)), np.int64)
        for t, (who, weight) in here:
            rows = row_of[who]
            if len(active) < len(go):
                weight, rows = weight[rows >= 0], rows[rows >= 0]
                if not len(rows):
                    continue
            r = slice(runs[t - 1] if t else 0, runs[t])
            docs = posts[(ends[r.start - 1] if r.start else 0):ends[r.stop - 1]]
            scores[np.ix_(rows, docs)] += np.outer(weight, np.repeat(adds[r], lengths[r]))
        enough = scores >= self.least[active, None]
        for row in np.flatnonzero(enough.any(axis=1)):
            self._take(int(active[row]), scores[row], np.flatnonzero(enough[row]), ids)

    def _take(self, query: int, scores: np.ndarray, docs: np.ndarray, ids: list) -> None:
        if len(docs) > self.k:      # the k best and what ties with the last of them
            docs = docs[scores[docs] >= np.partition(scores[docs], -self.k)[-self.k]]
        rows = [(-int(scores[d]), ids[d] is None, ids[d] or 0) for d in docs.tolist()]
        best = self.best[query] = sorted([*self.best.get(query, []), *rows])[:self.k]
        if len(best) == self.k:
            self.least[query] = max(self.least[query], -best[-1][0])

    def rows(self) -> pa.RecordBatch:
        out = [(self.asked.queries[q], None if none else own, -score) for q, best in self.best.items() for score, none, own in best]
        return pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], pa.int64()) for c in range(3)], ["query", "id", "score"])


def _visit(blocks: DataFrame, asked: _Asked, k: int) -> DataFrame:
    """(query, id, score): the k best rows of each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = asked.scan(k)
        for batch in batches:
            for i in range(batch.num_rows):
                m, ids, packed = (c[i].as_py() for c in batch.columns)
                scan.block(m, ids, unpacked(packed))
        yield scan.rows()

    return blocks.select("m", "ids", "packed").mapInArrow(run, "query long, id long, score long")


def _top(rows: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _pass(index: Index, asked: DataFrame, k: int) -> DataFrame:
    """Ranked rows of the queries of one pass; ``asked`` has (query, term, times), stored."""
    per_block = index.blocks.select("m", F.size("ids").alias("docs"), F.explode(F.arrays_zip("terms", "most", "df")).alias("t")).select("m", "docs", "t.*")
    wanted = asked.select(F.col("term").alias("terms")).distinct()
    seen = stored(per_block.join(wanted, "terms", "left_semi").groupBy("m", F.col("terms").alias("term")).agg(
        F.max("most").alias("most"), F.sum("df").alias("df")), "strata")
    frequent = seen.groupBy("term").agg(F.sum("df").alias("df"))
    weighed = stored(asked.join(frequent, "term").select("query", "term", (F.col("times") * _weight(index, F.col("df"))).alias("w")), "weights")
    reach = weighed.join(seen, "term").groupBy("query", "m").agg(
        F.sum(F.col("w") * F.expr("(1000000000L * most) div (1000L * most + 12L * m)")).alias("bound")).where("bound > 0")
    sizes = index.blocks.groupBy("m").agg(F.sum(F.size("ids")).alias("docs"))
    reach = stored(reach.join(sizes, "m"), "bounds")
    # the strata with the greatest bounds, up to the first that brings the documents to FIRST
    down = Window.partitionBy("query").orderBy(F.desc("bound"), "m").rowsBetween(Window.unboundedPreceding, -1)
    first = reach.withColumn("before", F.coalesce(F.sum("docs").over(down), F.lit(0))).where(F.col("before") < FIRST)
    strata = {m: list(qs) for m, qs in first.groupBy("m").agg(F.collect_list("query")).collect()}
    rows = [tuple(r) for r in weighed.where("w > 0").collect()]
    if not rows:
        return index.blocks.sparkSession.createDataFrame([], "query long, id long, score long, rank int")
    opening = _visit(index.blocks.where(F.col("m").isin(list(strata))), _Asked(rows, {}, strata), k)
    found = {q: score for q, score in _top(opening, k).where(F.col("rank") == k).select("query", "score").collect()}
    # every other stratum that can still matter to a query
    spark = index.blocks.sparkSession
    least = spark.createDataFrame([(q, found.get(q, 1)) for q in sorted({r[0] for r in rows})], "query long, least long")
    open_strata = stored(reach.join(least, "query").where("bound >= least").select("m").distinct(), "openstrata")
    return _top(_visit(index.blocks.join(open_strata, "m", "left_semi"), _Asked(rows, found, None), k), k)


def search(index: Index, queries: DataFrame, id_col: str = "item_id", text_col: str = "text", k: int = K, pass_terms: int = PASS_TERMS) -> DataFrame:
    """(id, rank, doc_id, score): each query's ``k`` documents with the highest score above 0.

    A query is one row: rows with repeated or null ids are ranked apart, each with its id.  Equal scores go
    by ascending document id, null ids last; documents that tie with equal ids are all ranked.  A query
    without a known term has no rows; an empty table of either kind gives none.  Terms repeated in a
    query count as often.  Other columns are not read.
    """
    named = stored(queries.select(F.col(id_col).alias("own"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn(
        "query", F.monotonically_increasing_id()), "queries")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for query, text in zip(*(c.to_pylist() for c in batch.columns)):
                counts = Counter(terms_of(text))
                yield pa.RecordBatch.from_arrays([pa.array([query] * len(counts), pa.int64()), pa.array(list(counts), pa.string()),
                                                  pa.array(list(counts.values()), pa.int64())], ["query", "term", "times"])

    asked = stored(named.select("query", "text").mapInArrow(split, "query long, term string, times long"), "asked")
    passes = max(1, -(-asked.count() // pass_terms))
    found = None
    for p in range(passes):
        own = asked if passes == 1 else asked.where(F.pmod(F.xxhash64("query"), F.lit(passes)) == p)
        ranked = _pass(index, own, k)
        ranked = ranked if passes == 1 else stored(ranked, "ranked")
        found = ranked if found is None else found.unionByName(ranked)
    return found.join(named.select("query", "own"), "query").select(F.col("own").alias(id_col), F.col("rank").cast("int").alias("rank"),
                                                                    F.col("id").alias("doc_id"), "score")
