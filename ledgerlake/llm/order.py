"""Tables put in one order over all their partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import stored

#: Place of a row: its partition, shifted, and its number there.  Grows along the order.
PLACE = "__ledgerlake_place"
SHIFT = 33


def in_order(df: DataFrame, ranges: Sequence[str | Column], order: Sequence[str | Column], name: str) -> DataFrame:
    """``df`` sorted by ``order`` over all partitions, stored, with the column ``PLACE``.

    ``ranges`` cut the table into partitions: the first columns of ``order``, or prefixes of them.
    They reach beyond the hot key of the data, so rows of one key are dealt over many partitions.
    The table is written once, so places stay as they are when executors are lost."""
    return stored(df.repartitionByRange(*ranges).sortWithinPartitions(*order).withColumn(PLACE, F.monotonically_increasing_id()), name)


def first_ranks(rows: DataFrame) -> dict[int, int]:
    """Partition -> rank of its first row, of a table of ``in_order``: one number a partition."""
    counts = rows.groupBy(F.shiftright(PLACE, SHIFT).alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    first, ranks = 0, {}
    for part, n in sorted(counts):
        ranks[part] = first
        first += n
    return ranks
