"""Repeated substrings: every byte that a long string covers which also starts earlier.

Which strings can repeat is found by anchors: of each window of ``length`` bytes the k-gram with
the least hash.  Equal windows have equal anchors, so a window can only repeat among the places of its
anchor's k-gram.  An anchor's context is the stretch of all windows that share the anchor.

* k-grams that occur once are out.
* Equal contexts of a k-gram are one, with its first place: all windows of the others repeat it.
* Contexts of one k-gram that differ are put into shards.  A shard's suffix array is made by induced
  sorting; neighbours in it with a common prefix of ``length`` bytes are equal windows, and all but
  the first one in (id, position) order repeat.
* A k-gram with more than ``CROWD`` differing contexts (a very common line) would make a shard that
  grows with the corpus.  Its contexts are cut into windows, each with a key of its own, and go
  through the same step as equal contexts.

Contexts and k-grams are compared by 64-bit hashes of each, that is by 128 bits; windows in shards byte
by byte.  Scale: anchors are about 2 / (length - k + 2) of all bytes; they are counted with combining
before the shuffle, and only repeated ones are stored.  Texts move twice, compressed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import RID, by_key, stored, with_rid
from ledgerlake.llm.hashing import CHUNK, Prefix, mix, pressed, text_chunks
from ledgerlake.llm.suffix import common_prefixes, suffix_array

LENGTH, GRAM = 100, 28
CROWD = 4096
#: Bytes of contexts that are sorted together.
SHARD = 2 * 2**20
#: Order of null ids: before all others.
FIRST = -(2**63)


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` keys."""
    out, have = keys, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(row, k-gram hash, context hash, first window, last window) of each context; windows are counted
    from the row's start."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    prefix = Prefix(data)
    grams = prefix.runs(gram)
    # the leftmost least of the hashes' upper halves
    keys = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    chosen = (_least(keys, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    fits = np.zeros(len(chosen), bool)  # windows that end within their row
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        fits[a:max(a, b - length + 1)] = True
    p = np.flatnonzero(fits)
    if not len(p):
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    row = np.repeat(np.arange(len(offsets) - 1), np.maximum(np.diff(offsets) - length + 1, 0))
    new = np.ones(len(p), bool)
    chosen = chosen[p]
    new[1:] = (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    lo, hi = p[at], p[np.append(at[1:], len(p)) - 1]
    a, r = chosen[at], row[at]
    context = mix(prefix.of(lo, hi + length) + mix(((a - lo) << 32 | (hi - lo)).astype(np.uint64)))
    return r, grams[a], context, lo - offsets[r], hi - offsets[r]


def _contexts(column: pa.Array, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Contexts of all rows of a column; texts longer than a chunk are read in overlapping stretches."""
    for first, data, offsets in text_chunks(column):
        if len(offsets) == 2 and len(data) > CHUNK:
            for s in range(0, len(data) - length + 1, CHUNK):
                part = data[s:s + CHUNK + length - 1]
                r, g, c, lo, hi = anchors(part, np.array([0, len(part)]), length, gram)
                yield r + first, g, c, lo + s, hi + s
        else:
            r, g, c, lo, hi = anchors(data, offsets, length, gram)
            yield r + first, g, c, lo, hi


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def find_repeats(contexts: list[bytes], windows: list[int], length: int) -> list[np.ndarray]:
    """For contexts in order of their places, each with its number of windows: which of its windows
    (offsets) have an equal window in an earlier context.  By the suffix array of all contexts."""
    sizes = np.array([len(c) + 1 for c in contexts])
    ends = np.cumsum(sizes)
    raw = np.frombuffer(b"\0".join(contexts) + b"\0" * 9, np.uint8)
    t = np.zeros(ends[-1] + 1, np.int16)
    t[:-1] = raw[:ends[-1]].astype(np.int16) + 2
    t[ends - 1] = 1
    owner = np.repeat(np.arange(len(contexts)), sizes)
    offset = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
    order = suffix_array(t, length)
    order = order[order < ends[-1]]
    order = order[offset[order] < np.array(windows)[owner[order]]]
    same = np.zeros(len(order), bool)
    same[1:] = common_prefixes(raw, order[1:], order[:-1], length) >= length
    run = np.flatnonzero(~same)
    first = np.repeat(np.minimum.reduceat(order, run), np.diff(np.append(run, len(order)))) if len(order) else order
    again = np.sort(order[order != first])
    cut = np.searchsorted(owner[again], np.arange(len(contexts) + 1))
    return [offset[again[a:b]] for a, b in zip(cut[:-1], cut[1:])]


def _ranges(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive numbers."""
    breaks = np.flatnonzero(np.diff(offsets) != 1)
    return offsets[np.append(0, breaks + 1)], offsets[np.append(breaks, len(offsets) - 1)]


def _shards(rows: DataFrame, length: int) -> DataFrame:
    """Repeated windows (row id, lo, hi) of rows (h, id, row id, lo, bytes), sorted by h in each task."""
    def settle(held: list[tuple]) -> pa.RecordBatch:
        held.sort(key=lambda x: x[1:4])
        found = find_repeats([x[4] for x in held], [len(x[4]) - length + 1 for x in held], length)
        out: list[tuple[int, int, int]] = []
        for x, again in zip(held, found):
            if len(again):
                out += [(x[2], x[3] + int(a), x[3] + int(b)) for a, b in zip(*_ranges(again))]
        return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in range(3)], [RID, "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            for x in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= SHARD and x[0] != last:
                    yield settle(held)
                    held, size = [], 0
                held.append(x)
                size, last = size + len(x[4]), x[0]
        if held:
            yield settle(held)

    return rows.select("h", "id", RID, "lo", "bytes").mapInArrow(run, f"{RID} long, lo long, hi long")


def repeated_windows(docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """(row id, lo, hi): starts lo..hi of ``length``-byte strings that also start earlier.  ``docs`` carries
    the row id and a column ``id`` (long) that orders rows; rows with the same id go by row id."""
    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, g, _, _, _ in _contexts(batch.column(0), length, gram):
                yield pa.RecordBatch.from_arrays([_longs(g)], ["h"])

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for r, g, c, lo, hi in _contexts(batch.column(1), length, gram):
                yield pa.RecordBatch.from_arrays([_longs(g), _longs(c), _longs(ids[r]), _longs(lo << 24 | (hi - lo))], ["h", "c", RID, "span"])

    text = F.col(text_col).cast("string")
    counted = docs.select(text).mapInArrow(grams, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    live = stored(counted.where("n > 1").select("h"), "livegrams")
    every = by_key(docs.select(RID, text).mapInArrow(contexts, f"h long, c long, {RID} long, span long"), live, "h", "left_semi")
    ids = docs.select(RID, "id")
    every = stored(every.join(ids, RID).select("h", "c", "id", RID, F.shiftright("span", 24).alias("lo"), (
        F.shiftright("span", 24) + F.col("span").bitwiseAND(2**24 - 1)).alias("hi")), "liveanchors")

    # equal contexts: all but the first repeat
    firsts = stored(every.groupBy("h", "c").agg(F.min(F.struct("id", RID, "lo", "hi")).alias("f"), F.count(F.lit(1)).alias("n")), "firsts")
    again = every.join(firsts.where("n > 1"), ["h", "c"]).where(
        (F.col(RID) != F.col(f"f.{RID}")) | (F.col("lo") != F.col("f.lo"))).select(RID, "lo", "hi")

    # differing contexts of a k-gram: their texts
    differing = firsts.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    wanted = firsts.join(stored(differing, "differing"), "h").select("h", "f.*", (F.col("k") > crowd).alias("crowded"))
    lists = wanted.groupBy(RID, "id").agg(F.collect_list(F.struct("h", "lo", "hi", "crowded")).alias("xs"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "c", "id", RID, "lo", "bytes"]
        for batch in batches:
            for rid, doc, xs, z in zip(*(c.to_pylist() for c in batch.columns)):
                raw = zstandard.ZstdDecompressor().decompress(z)
                plain = [x for x in xs if not x["crowded"]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x["h"] for x in plain], pa.int64()), pa.nulls(len(plain), pa.int64()), pa.array([doc] * len(plain), pa.int64()),
                     pa.array([rid] * len(plain), pa.int64()), pa.array([x["lo"] for x in plain], pa.int64()),
                     pa.array([raw[x["lo"]:x["hi"] + length] for x in plain], pa.binary())], names)
                for x in xs:
                    if x["crowded"]:
                        own = Prefix(np.frombuffer(raw[x["lo"]:x["hi"] + length], np.uint8))
                        p = np.arange(x["hi"] - x["lo"] + 1)
                        left, right = own.of(p, p + length // 2), own.of(p + length // 2, p + length)
                        yield pa.RecordBatch.from_arrays(
                            [_longs(left), _longs(right), pa.array(np.full(len(p), doc)), pa.array(np.full(len(p), rid)),
                             pa.array(p + x["lo"]), pa.nulls(len(p), pa.binary())], names)

    texts = by_key(pressed(docs, text_col), lists, RID).select(RID, "id", "xs", "z")
    pieces = stored(texts.mapInArrow(cut, f"h long, c long, id long, {RID} long, lo long, bytes binary"), "contexts")
    shards = pieces.where(F.col("bytes").isNotNull()).repartition("h").sortWithinPartitions("h")
    windows = pieces.where(F.col("bytes").isNull()).drop("bytes")
    first_windows = stored(windows.groupBy("h", "c").agg(F.min(F.struct("id", RID, "lo")).alias("f"), F.count(F.lit(1)).alias("n")).where("n > 1"), "firstwindows")
    crowd_again = windows.join(first_windows, ["h", "c"]).where(
        (F.col(RID) != F.col(f"f.{RID}")) | (F.col("lo") != F.col("f.lo"))).select(RID, "lo", F.col("lo").alias("hi"))
    return again.unionByName(_shards(shards, length)).unionByName(crowd_again)


def _spans(ranges: list[dict], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal covered runs of bytes."""
    lo = np.array([r["lo"] for r in ranges], np.int64)
    hi = np.array([r["hi"] for r in ranges], np.int64)
    order = np.argsort(lo, kind="stable")
    lo, reach = lo[order], np.maximum.accumulate(hi[order] + length)
    new = np.flatnonzero(np.append(True, lo[1:] > reach[:-1]))
    return lo[new], reach[np.append(new[1:], len(lo)) - 1]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept), one row per row of ``docs``.

    A text is its UTF-8 bytes, null counts as empty.  A byte is removed if a ``length``-byte string of
    the same text covers it that also starts earlier: in a row with a smaller id (null ids come
    first, rows with the same id in table order) or earlier in the same text.  ``kept`` is the rest,
    as bytes, null where nothing is removed.  An empty table gives no rows, and further columns of any
    name are not read.
    """
    tagged = docs if RID in docs.columns else with_rid(docs)
    tagged = tagged.select(RID, F.col(id_col).alias("own"), F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST)).alias("id"),
                           F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    lists = repeated_windows(tagged, "text", length, gram, crowd).groupBy(RID).agg(F.collect_list(F.struct("lo", "hi")).alias("xs"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for rid, xs, z in zip(*(c.to_pylist() for c in batch.columns)):
                raw = zstandard.ZstdDecompressor().decompress(z)
                a, b = _spans(xs, length)
                kept = b"".join(raw[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(raw)]))
                rows.append((rid, len(raw) - len(kept), len(a), hashlib.sha256(kept).hexdigest(), kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                                             [RID, "n_removed", "n_spans", "sha", "kept"])

    changed = by_key(pressed(tagged, "text"), lists, RID).select(RID, "xs", "z").mapInArrow(
        cut, f"{RID} long, n_removed long, n_spans long, sha string, kept binary")
    rows = tagged.select(RID, F.col("own").alias(id_col), F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    return rows.join(changed, RID, "left").select(
        id_col, "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256"), "kept")
