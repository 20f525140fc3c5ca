"""Order-dependent building blocks that stay parallel under key skew.

A plain ``Window.partitionBy(key).orderBy(ts)`` puts every row of a key
into one task.  When one key may hold a third of all rows that task is the
whole job, so running sums and lags here are computed in two levels:

1. rows are cut into ordered chunks ``(key, chunk)`` (chunk = order value
   bucket); the in-chunk window runs per ``(key, chunk)`` in parallel;
2. a per-``(key, chunk)`` aggregate (one row per chunk, small) carries the
   offset / last row of every earlier chunk, joined back on ``(key, chunk)``.

The result equals the single-window form exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, (str, Column)) else list(x)


def _names(x) -> list[str]:
    return [c for c in _cols(x)]


def bucket(order_col, width: int) -> Column:
    """Chunk id for an integral or timestamp order column: ``floor(v / width)``.

    Timestamps are bucketed on epoch seconds, longs on their value.
    """
    c = F.col(order_col) if isinstance(order_col, str) else order_col
    return F.floor(c / F.lit(width)).cast("long")


def ts_bucket(ts_col, seconds: int) -> Column:
    c = F.col(ts_col) if isinstance(ts_col, str) else ts_col
    return F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("long")


def _join_null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Inner join on ``cols`` where NULL matches NULL, as window partitions group them."""
    r = right.select(*[F.col(c).alias("_r_" + c) for c in cols],
                     *[c for c in right.columns if c not in cols])
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(r["_r_" + c])
        cond = e if cond is None else cond & e
    return left.join(r, cond, "inner").drop(*["_r_" + c for c in cols])


def running_sum(df: DataFrame, keys: Sequence[str] | str | None, order: Sequence[str] | str,
                value: str | Column, out: str, chunk: Column) -> DataFrame:
    """Inclusive running sum of ``value`` per ``keys`` in ``order``.

    ``order`` must be a total order within a key (add a unique tie breaker);
    ``chunk`` must be non-decreasing in ``order`` within a key.
    """
    keys = _names(keys)
    order = _names(order)
    v = F.col(value) if isinstance(value, str) else value
    d = df.withColumn("_chunk", chunk).withColumn("_v", v)
    wi = (Window.partitionBy(*keys, "_chunk").orderBy(*order)
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = d.withColumn("_in", F.sum("_v").over(wi))
    # chunk totals from the windowed rows: already partitioned by (keys, chunk),
    # so no second shuffle and the input is read once (the exchange is reused)
    tot = inner.groupBy(*keys, "_chunk").agg(F.sum("_v").alias("_ct"))
    wk = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*keys, "_chunk", F.coalesce(F.sum("_ct").over(wk), F.lit(0)).alias("_off"))
    res = _join_null_safe(inner, off, [*keys, "_chunk"])
    return res.withColumn(out, F.col("_in") + F.col("_off")).drop("_chunk", "_v", "_in", "_off")


def chunked_lag(df: DataFrame, keys: Sequence[str] | str | None, order: Sequence[str] | str,
                values: Sequence[str], chunk: Column, prefix: str = "prev_") -> DataFrame:
    """``lag(v, 1)`` per key in order for each of ``values``, as ``prev_<v>`` columns."""
    keys = _names(keys)
    order = _names(order)
    values = list(values)
    d = df.withColumn("_chunk", chunk)
    wi = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    for v in values:
        d = d.withColumn(prefix + v, F.lag(v, 1).over(wi))
    d = d.withColumn("_first", F.row_number().over(wi) == 1)
    # last row of each chunk, from the windowed rows (same partitioning: no new shuffle)
    ordkey = F.struct(*[F.col(o) for o in order])
    last = d.groupBy(*keys, "_chunk").agg(
        F.max_by(F.struct(*[F.col(v).alias(v) for v in values]), ordkey).alias("_last"))
    wk = Window.partitionBy(*keys).orderBy("_chunk")
    carry = last.select(*keys, "_chunk", F.lag("_last", 1).over(wk).alias("_carry"))
    res = _join_null_safe(d, carry, [*keys, "_chunk"])
    for v in values:
        res = res.withColumn(prefix + v, F.when(F.col("_first"), F.col("_carry." + v))
                             .otherwise(F.col(prefix + v)))
    return res.drop("_chunk", "_first", "_carry")


def latest_by_key(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str] | str) -> DataFrame:
    """The row with the greatest ``order`` per key (ties: any one).

    ``max_by`` aggregates partially on the map side, so a hot key is reduced
    before the shuffle instead of gathered into one task.
    """
    keys = _names(keys)
    order = _names(order)
    others = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in others]), F.struct(*[F.col(o) for o in order])).alias("_r"))
    return agg.select(*keys, *[F.col("_r." + c).alias(c) for c in others])
