"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted at once, each with a cost per bin.  Lengths are placed in
descending order, each piece into the open bin that it leaves fullest.  Where none has room a new
bin of the size with the least cost is opened: cost per token of the bin, plus the room that
no remaining length could use.  In the end each bin is exchanged for the cheapest size that still
holds its contents.

Scale: a piece is at most the largest sequence length L, so the corpus enters the plan as a histogram
of at most L lengths, and equal bins are planned together as a run of bins.  The plan has a number of
lines that depends on L and not on the corpus; it is made on the driver.  Documents find their bins by
their rank among the pieces of their length: ranks are counted in about sqrt(n) slices of a length,
so a length that a third of all documents share is not sorted in one task.  Documents longer than
L are cut into full pieces, each a bin of its own, and a last shorter piece.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import RID, stored, with_rid

#: Permitted sequence lengths and the cost of one bin of each: its tokens plus a fixed share a sequence.
CAPACITIES = (512, 1024, 2048, 4096)
OVERHEAD = 16


class Line(NamedTuple):
    """``pieces`` pieces of ``length``, ranks from ``rank``: ``each`` a bin, into bins from ``bin`` of
    ``size`` tokens, the first of a bin at ``offset``."""

    length: int
    rank: int
    pieces: int
    bin: int
    each: int
    offset: int
    size: int = 0


class Run(NamedTuple):
    """``bins`` bins from ``first``, all of one size and with the same contents of ``used`` tokens."""

    first: int
    bins: int
    size: int
    used: int


def _opening(length: int, capacities: tuple[int, ...], costs: Mapping[int, float], lengths: list[int], below: int) -> int:
    """The bin size to open for a piece: least cost per token used, if the room it leaves is filled by
    as many pieces of the same length as fit, and then by one of the lengths still to come."""
    best = None
    for size in capacities:
        if size < length:
            continue
        used = size // length * length
        at = bisect.bisect_right(lengths, size - used, 0, below)
        used += lengths[at - 1] if at else 0
        price = (costs[size] / used, size)
        best = min(best, price) if best else price
    return best[1]


def plan(histogram: Mapping[int, int], capacities: tuple[int, ...] = CAPACITIES,
         costs: Mapping[int, float] | None = None) -> tuple[list[Line], list[Run]]:
    """Best-fit decreasing over a histogram {length: pieces}: lines of the plan, and the final bins.

    Pure and deterministic; the number of lines is bounded by the largest capacity."""
    costs = costs or {c: c + OVERHEAD for c in capacities}
    capacities = tuple(sorted(capacities))
    lengths = sorted(k for k, n in histogram.items() if n)
    room: dict[int, list[Run]] = {}  # runs of open bins by the room they have
    rooms: list[int] = []  # sorted keys of room
    lines: list[Line] = []
    bins = 0

    def put(run: Run) -> None:
        left = run.size - run.used
        if left not in room:
            bisect.insort(rooms, left)
            room[left] = []
        heapq.heappush(room[left], run)

    def fill(run: Run, length: int, rank: int, left: int) -> int:
        """Put pieces into a run of bins, as many a bin as fit; returns the number of pieces placed."""
        each = (run.size - run.used) // length
        full, rest = divmod(min(left, run.bins * each), each)
        if full:
            lines.append(Line(length, rank, full * each, run.first, each, run.used))
            put(Run(run.first, full, run.size, run.used + each * length))
        if rest:
            lines.append(Line(length, rank + full * each, rest, run.first + full, rest, run.used))
            put(Run(run.first + full, 1, run.size, run.used + rest * length))
        if (taken := full + (rest > 0)) < run.bins:
            put(Run(run.first + taken, run.bins - taken, run.size, run.used))
        return full * each + rest

    for k in range(len(lengths) - 1, -1, -1):
        length, rank, left = lengths[k], 0, histogram[lengths[k]]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                run = heapq.heappop(room[rooms[at]])
                if not room[rooms[at]]:
                    del room[rooms[at]], rooms[at]
            else:
                size = _opening(length, capacities, costs, lengths, k)
                run = Run(bins, -(-left // (size // length)), size, 0)
                bins += run.bins
            done = fill(run, length, rank, left)
            rank, left = rank + done, left - done
    downsized = sorted(r._replace(size=min((c for c in capacities if c >= r.used), key=lambda c: (costs[c], c)))
                       for runs in room.values() for r in runs)
    return _by_size(lines, downsized), downsized


def _by_size(lines: list[Line], runs: list[Run]) -> list[Line]:
    """Cut lines where the final size of their bins changes."""
    starts, out = [r.first for r in runs], []
    for line in lines:
        while line.pieces:
            run = runs[bisect.bisect_right(starts, line.bin) - 1]
            here = min(line.pieces, (run.first + run.bins - line.bin) * line.each)
            out.append(line._replace(pieces=here, size=run.size))
            line = line._replace(rank=line.rank + here, pieces=line.pieces - here, bin=line.bin + here // line.each)
    return out


def pieces_of(docs: DataFrame, length_col: str, largest: int) -> DataFrame:
    """(row id, id.., piece, start, length): a document's pieces; one of no tokens has none."""
    n = F.col(length_col)
    count = F.ceil(n / F.lit(largest)).cast("long")
    return docs.where(n > 0).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), count - 1))).withColumn(
        "start", F.col("piece") * largest).withColumn("length", F.least(F.lit(largest), n - F.col("start")).cast("int"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacities: tuple[int, ...] = CAPACITIES,
         costs: Mapping[int, float] | None = None) -> DataFrame:
    """(id, piece, start, length, bin_id, bin_size, bin_offset), one row per piece of a document.

    A document's tokens are its runs of non-white characters.  ``start`` is the piece's first token
    in the document, ``bin_offset`` its first place in the bin.  Every token of every document is in
    exactly one piece; a null text, or one without tokens, has none.  Equal rows are packed each,
    pieces of one length in order of their rows.  An empty table gives no rows, and further columns of any
    name are not read.
    """
    largest = max(capacities)
    docs = docs if RID in docs.columns else with_rid(docs)
    counted = docs.select(RID, F.col(id_col).alias("id"),
                          F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"\S+")).alias("n"))
    pieces = stored(pieces_of(counted, "n", largest), "pieces")
    # at most `largest` rows
    histogram = {r["length"]: r["count"] for r in pieces.where(F.col("length") < largest).groupBy("length").count().collect()}
    lines, runs = plan(histogram, capacities, costs)
    spark = docs.sparkSession
    sizes = spark.createDataFrame([(n, max(1, round(c ** 0.5))) for n, c in histogram.items()], "length int, slices int")
    sliced = pieces.where(F.col("length") < largest).join(F.broadcast(sizes), "length").withColumn(
        "slice", F.pmod(F.xxhash64(RID), F.col("slices")))
    ranges = sliced.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "base", F.sum("n").over(Window.partitionBy("length").orderBy("slice")) - F.col("n"))
    # the lines that the ranks of a slice lie in
    table = spark.createDataFrame(lines, "length int, first_rank long, pieces long, first_bin long, each long, first_offset int, bin_size int")
    lines_of = ranges.join(F.broadcast(table), "length").where(
        (F.col("first_rank") < F.col("base") + F.col("n")) & (F.col("first_rank") + F.col("pieces") > F.col("base"))).drop("n")
    ranked = sliced.withColumn("k", F.row_number().over(Window.partitionBy("length", "slice").orderBy(RID)) - 1)
    at = F.col("base") + F.col("k") - F.col("first_rank")
    placed = ranked.join(lines_of, ["length", "slice"]).where((at >= 0) & (at < F.col("pieces"))).select(
        "id", "piece", "start", "length", (F.col("first_bin") + F.floor(at / F.col("each"))).alias("bin_id"), "bin_size",
        (F.col("first_offset") + (at % F.col("each")) * F.col("length")).cast("int").alias("bin_offset"))
    planned = sum(r.bins for r in runs)
    # a full piece is a bin of the largest size; these are numbered after the planned ones
    full = pieces.where(F.col("length") == largest).select(
        "id", "piece", "start", "length", (F.lit(planned) + F.monotonically_increasing_id()).alias("bin_id"),
        F.lit(largest).alias("bin_size"), F.lit(0).alias("bin_offset"))
    return placed.unionByName(full).withColumnRenamed("id", id_col)
