"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Each shard has ``POINTS`` points on a ring of 64-bit hashes.  A row belongs to the first point at or after the
hash of its key.  A shard holds no more rows than its bound; those that overflow, the last of the
shard's own in ring order, continue clockwise to the next shards with room.  Own rows come first: a shard
takes in others only up to what its own rows leave.

With bounds that add up to the number of rows, as here by default, all shards are full: their counts are at
most one apart.  A row stays where its hash puts it unless its shard is over its bound, so a further
shard, or further rows, move few rows.

Scale: rows are put in ring order by a range shuffle (over ties too, so a key that a third of all rows
share lies in many partitions), without their texts.  The rows of a ring segment then have consecutive
ranks, so the plan needs one count a segment and one a partition; it is a list of runs of ranks, whose
length depends on the ring and not on the corpus, and each row's shard and slot follow from its rank.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerlake.llm.common import RID, by_key, stored, with_rid
from ledgerlake.llm.order import PLACE, SHIFT, first_ranks, in_order

SHARDS, POINTS = 24, 256
#: Bytes that a row counts besides its text.
FRAME = 8


class Run(NamedTuple):
    """``rows`` rows from ``rank`` that go to ``shard``, there from ``slot``; ``home`` is the shard their hash names."""

    rank: int
    rows: int
    shard: int
    slot: int
    home: int


def ring(shards: int, points: int = POINTS) -> tuple[np.ndarray, np.ndarray]:
    """Points of the ring in ascending order and their shards.  A shard's points depend on its number alone."""
    spots = sorted((int.from_bytes(hashlib.sha256(f"{s}:{k}".encode()).digest()[:8], "big", signed=True), s)
                   for s in range(shards) for k in range(points))
    return np.array([p for p, _ in spots], np.int64), np.array([s for _, s in spots], np.int32)


def segments(keys: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Segment of each hash; the last, after all points, belongs to the first point."""
    return np.searchsorted(points, keys, "left")


def bounds(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Most rows a shard may hold: an equal part, the first shards one more, and a share ``slack`` on top."""
    return [int((rows // shards + (s < rows % shards)) * (1 + slack)) for s in range(shards)]


def plan(counts: list[int], owners: list[int], room: list[int]) -> list[Run]:
    """Where the rows of each segment go, by rank in ring order.  ``counts`` has one segment more than
    ``owners``: the one after the last point, which is the first point's."""
    owners = [*owners, owners[0]]
    firsts = np.concatenate([[0], np.cumsum(counts)]).tolist()
    room, parts, over = list(room), [], {}
    for seg in [len(counts) - 1, *range(len(counts) - 1)]:      # clockwise from the last point
        shard = owners[seg]
        own = min(counts[seg], room[shard])
        room[shard] -= own
        if own:
            parts.append((firsts[seg], own, shard, shard))
        if own < counts[seg]:
            over[seg] = (firsts[seg] + own, counts[seg] - own, shard)
    waiting: deque[tuple[int, int, int]] = deque()
    for lap in range(2):
        for seg in [len(counts) - 1, *range(len(counts) - 1)]:
            if lap == 0 and seg in over:
                waiting.append(over[seg])
            shard = owners[seg]
            while waiting and room[shard]:
                rank, n, home = waiting.popleft()
                k = min(n, room[shard])
                room[shard] -= k
                parts.append((rank, k, shard, home))
                if k < n:
                    waiting.appendleft((rank + k, n - k, home))
    if waiting:
        raise ValueError("the bounds hold fewer rows than there are")
    slots: dict[int, int] = {}
    runs = []
    for rank, n, shard, home in sorted(parts):
        runs.append(Run(rank, n, shard, slots.get(shard, 0), home))
        slots[shard] = slots.get(shard, 0) + n
    return runs


def shard_rows(docs: DataFrame, key: str = "doc_id", text_col: str = "text", shards: int = SHARDS, points: int = POINTS,
               slack: float = 0.0, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, size, text_crc32, shard, slot, home) and the columns of ``keep``, one row per row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus ``FRAME``, ``text_crc32`` its unsigned checksum; a null text counts as
    empty.  ``slot`` numbers a shard's rows from 0 in ring order.  Null keys share one place on the ring;
    rows of one key, repeated rows included, are ordered by size, checksum and place in the table, so any
    number of them may share a key, and they are dealt on when their shard is full.  Other columns are
    not read.  No rows give no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("own"), (F.octet_length(text) + FRAME).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"),
                       F.xxhash64(F.col(key)).alias("at"), F.monotonically_increasing_id().alias("tie"), *(F.col(c).alias(f"keep_{c}") for c in keep))
    order = ["at", "size", "crc", "tie"]
    rows = in_order(rows, order, order, "ringorder")
    spots, owners = ring(shards, points)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(spots) + 1, np.int64)
        for batch in batches:
            total += np.bincount(segments(batch.column(0).to_numpy(), spots), minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["seg", "n"])

    counts = [0] * (len(spots) + 1)
    for seg, n in rows.select("at").mapInArrow(count, "seg long, n long").groupBy("seg").agg(F.sum("n").alias("n")).collect():
        counts[seg] = n
    runs = plan(counts, owners.tolist(), bounds(sum(counts), shards, slack))
    ranks, table = first_ranks(rows), np.array(runs, np.int64).reshape(-1, 5)
    kept = [f"keep_{c}" for c in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select("own", "size", "crc", *kept).schema)
    types = [to_arrow_type(f.dataType) for f in rows.select("own", "size", "crc", *kept).schema]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spot = batch.column(0).to_numpy()
            first = np.array([ranks[p] for p in np.unique(spot >> SHIFT).tolist()], np.int64)
            rank = first[np.unique(spot >> SHIFT, return_inverse=True)[1]] + (spot & ((1 << SHIFT) - 1))
            run = table[np.searchsorted(table[:, 0], rank, "right") - 1]
            slot = run[:, 3] + rank - run[:, 0]
            own = [c.cast(t) for c, t in zip(batch.columns[1:], types)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(run[:, 2].astype(np.int32)), pa.array(slot), pa.array(run[:, 4].astype(np.int32))],
                                             ["own", "size", "crc", *kept, "shard", "slot", "home"])

    placed = rows.select(PLACE, "own", "size", "crc", *kept).mapInArrow(place, f"{schema}, shard int, slot long, home int")
    return placed.select(F.col("own").alias(key), "size", F.col("crc").alias("text_crc32"), "shard", "slot", "home",
                         *(F.col(f"keep_{c}").alias(c) for c in keep))


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", text_col: str = "text", shards: int = SHARDS, points: int = POINTS,
                 slack: float = 0.0, rows_a_task: int = 200_000) -> None:
    """Write the rows of ``docs``, all columns, to one folder a shard, files in order of slots.

    A shard's rows are written by many tasks, each a stretch of slots; texts move once.  ``shard`` and
    ``slot`` are added; a column of ``docs`` with one of those names is an error."""
    if {"shard", "slot"} & set(docs.columns):
        raise ValueError("docs has a column named shard or slot")
    tagged = docs if RID in docs.columns else with_rid(docs)
    placed = stored(shard_rows(tagged, key, text_col, shards, points, slack, keep=(RID,)).select(RID, "shard", "slot"), "placed")
    rows = by_key(tagged, placed, RID).withColumn("stretch", F.expr(f"slot div {rows_a_task}"))
    (rows.repartition("shard", "stretch").sortWithinPartitions("shard", "slot").drop(RID, "stretch")
     .write.partitionBy("shard").parquet(path))
