"""P*, J*, A*, O*, X*: filters, joins, aggregates, sorts and set operations.

Everything here is a thin, declarative DataFrame expression so Catalyst can
push filters into the parquet scan, prune columns and pick join strategies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.scalar import coalesce_text, row_text, size_pretty
from ledgerlake.sources.io import stage_table


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- predicates
def point_lookup(df: DataFrame, col: str, value) -> DataFrame:
    """Case-sensitive equality; pushed to the scan as EqualTo."""
    return df.where(F.col(col) == F.lit(value))


def prefix_search(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """``LIKE 'p%'``; pushed as StringStartsWith."""
    return df.where(F.col(col).startswith(prefix))


def substring_search(df: DataFrame, col: str, s: str) -> DataFrame:
    """``LIKE '%s%'``; pushed as StringContains."""
    return df.where(F.col(col).contains(s))


def ci_lookup(df: DataFrame, col: str, value: str, stored_upper: str | None = None) -> DataFrame:
    """P5: ``upper(col) = upper(value)``; with a stored upper column (T7) it is pushable."""
    target = F.upper(F.lit(value))
    if stored_upper:
        return df.where(F.col(stored_upper) == target)
    return df.where(F.upper(F.col(col)) == target)


def between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Inclusive on both ends."""
    return df.where(F.col(col).between(F.lit(lo), F.lit(hi)))


def in_list(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """P8 / P15."""
    return df.where(F.col(col).isin(list(values)))


def regex_exclude(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """``col !~ pattern`` (NULL drops out, as in SQL)."""
    return df.where(~F.col(col).rlike(pattern))


def tag(df: DataFrame, name: str, value) -> DataFrame:
    """A constant column in front of the table's columns."""
    return df.select(F.lit(value).alias(name), "*")


# ---------------------------------------------------------------- joins
def natural_join(left: DataFrame, right: DataFrame, expect: Sequence[str] | None = None,
                 how: str = "inner") -> DataFrame:
    """Join on all common column names, key columns once.

    ``expect`` guards against a silently changed common-column set.
    """
    common = [c for c in left.columns if c in set(right.columns)]
    if expect is not None and sorted(common) != sorted(expect):
        raise ValueError(f"natural join columns {common} differ from expected {list(expect)}")
    if not common:
        raise ValueError("natural join without common columns is a cross join")
    return left.join(right, on=common, how=how)


def semi(left: DataFrame, right: DataFrame, keys: Sequence[str] | dict) -> DataFrame:
    """EXISTS. ``keys`` = shared names or {left_name: right_name}."""
    return left.join(right, on=_key_cond(left, right, keys), how="left_semi")


def anti(left: DataFrame, right: DataFrame, keys: Sequence[str] | dict) -> DataFrame:
    """NOT EXISTS (NULL keys never match, so such left rows are kept)."""
    return left.join(right, on=_key_cond(left, right, keys), how="left_anti")


def _key_cond(left, right, keys):
    if isinstance(keys, dict):
        cond = None
        for lk, rk in keys.items():
            e = left[lk] == right[rk]
            cond = e if cond is None else cond & e
        return cond
    return list(keys)


def left_with_default(left: DataFrame, right: DataFrame, keys, col: str, default: str,
                      out: str, fmt: str | None = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """J6 + P13: left outer join on a (composite) key, NULL replaced by a text default."""
    j = left.join(right, on=_key_cond(left, right, keys), how="left")
    return j.withColumn(out, coalesce_text(right[col] if isinstance(keys, dict) else F.col(col),
                                           default, fmt))


def full_compare(df: DataFrame, part_col: str, a, b, key: str, cols: Sequence[str]) -> DataFrame:
    """Full outer join of two filtered subsets of one table on ``key``."""
    l = df.where(F.col(part_col) == F.lit(a)).select(*[F.col(c).alias("a_" + c) for c in cols])
    r = df.where(F.col(part_col) == F.lit(b)).select(*[F.col(c).alias("b_" + c) for c in cols])
    return l.join(r, F.col("a_" + key) == F.col("b_" + key), "full")


def cross_count(left: DataFrame, right: DataFrame) -> DataFrame:
    """J9 as a count: ``count(*)`` of a cross join is ``count(l) * count(r)``;
    no pair is ever produced."""
    lc = left.agg(F.count(F.lit(1)).alias("_l"))
    rc = right.agg(F.count(F.lit(1)).alias("_r"))
    return lc.crossJoin(rc).select((F.col("_l") * F.col("_r")).alias("n"))


def with_strategy(df: DataFrame, strategy: str | None) -> DataFrame:
    """Join strategy hint for the side it is applied to (hash, merge or
    broadcast; a replicated nested loop is not offered, it pairs every row)."""
    if not strategy:
        return df
    names = {"hash": "shuffle_hash", "merge": "merge", "broadcast": "broadcast", "shuffle_hash": "shuffle_hash"}
    return df.hint(names[strategy])


def plan_bytes(df: DataFrame) -> int:
    """The planner's estimate of a table's size, from file sizes and statistics."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


#: Largest side, in bytes of the planner's estimate, that a broadcast hint is given for.
MAX_BROADCAST_BYTES = 256 * 2 ** 20


#: Bytes of a table in a join's memory that are broadcast at a time, what a row costs there besides its values,
#: and the parts by a row's hash that slices are made of.
SLICE_BYTES, ROW_BYTES, SLICE_PARTS = 128 * 2 ** 20, 64, 4096


def _slice_part(df: DataFrame) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, T.MapType)]), F.lit(SLICE_PARTS))


def broadcast_slices(right: DataFrame, slice_bytes: int = SLICE_BYTES) -> int | None:
    """Into how many slices by a row's hash a table must be cut so that each takes ``slice_bytes`` at most
    when it is broadcast; None if copies of a row make a slice too large.  Counted from the rows, as file sizes
    say little about memory."""
    def width(f):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0)) + 16
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 16
        return F.lit(16)
    bytes_ = sum([width(f).cast("long") for f in right.schema], F.lit(ROW_BYTES).cast("long"))
    parts = {r.part: r.n for r in right.select(_slice_part(right).alias("part"), bytes_.alias("b")).groupBy("part").agg(F.sum("b").alias("n")).collect()}
    slices = max(1, -(-sum(parts.values()) // slice_bytes))
    while slices <= SLICE_PARTS:
        sizes = [0] * slices
        for p, n in parts.items():
            sizes[p % slices] += n
        if max(sizes) <= slice_bytes:
            return slices
        slices += 1 + slices // 8
    return None


def _strategy_and_slices(right: DataFrame, how: str, strategy: str | None, max_broadcast_bytes: int, slice_bytes: int) -> tuple[str | None, int]:
    if strategy != "broadcast":
        return strategy, 1
    if plan_bytes(right) > max_broadcast_bytes:
        return "merge", 1
    slices = broadcast_slices(right, slice_bytes)
    # only an inner join is the union of its slices' joins
    return ("merge", 1) if slices is None or (slices > 1 and how != "inner") else ("broadcast", slices)


def usable_strategy(right: DataFrame, strategy: str | None, max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
                    how: str = "inner", slice_bytes: int = SLICE_BYTES) -> str | None:
    """The strategy that ``hinted_join`` will ask for: ``broadcast`` only while the
    right side's estimated size is within the bound and it can be cut into slices that fit, else a sort merge join."""
    return _strategy_and_slices(right, how, strategy, max_broadcast_bytes, slice_bytes)[0]


def hinted_join(left: DataFrame, right: DataFrame, on, how: str, strategy: str | None,
                max_broadcast_bytes: int = MAX_BROADCAST_BYTES, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Join with a chosen strategy (hint on the right side), see ``usable_strategy``.

    A right side that takes more than ``slice_bytes`` in memory is broadcast in slices, one after another: the
    driver and the executors hold one at a time, and its join is staged.  The result is then to be used by its
    columns' names, and ``right`` must give the same rows each time."""
    strategy, slices = _strategy_and_slices(right, how, strategy, max_broadcast_bytes, slice_bytes)
    if slices == 1:
        return left.join(with_strategy(right, strategy), on, how)
    out, part = None, _slice_part(right)
    for k in range(slices):
        j = left.join(with_strategy(right.where(part % slices == k), strategy), on, how)
        names = j.columns
        j = stage_table(j.toDF(*[f"c{i}" for i in range(len(names))]), "join_slice")
        out = j if out is None else out.unionByName(j)
    return out.toDF(*names)


def enrich(child: DataFrame, parent: DataFrame, fk: dict, cols: Sequence[str],
           check_count: bool = False) -> DataFrame:
    """Pull ``cols`` from the parent over a foreign key (inner join).

    With ``check_count`` the row count must not change: a child without a parent, or
    a parent key that occurs twice, raises while the join runs (no extra job).
    """
    p = parent.select(*[F.col(pk).alias("_p_" + pk) for pk in fk.values()], *cols)
    if check_count:
        names = [c for c in p.columns if c.startswith("_p_")]
        twice = F.raise_error(F.lit("enrich changed the row count: a parent key occurs twice"))
        p = p.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*cols)).alias("_v"))
        p = p.select(*names, F.struct(F.when(F.col("_n") > 1, twice.cast("int")).alias("_e"), "_v").alias("_v"))
    cond = None
    for ck, pk in fk.items():
        e = child[ck] == p["_p_" + pk]
        cond = e if cond is None else cond & e
    if check_count:
        alone = F.raise_error(F.lit("enrich changed the row count: a row without a parent")).cast("int")
        j = child.join(p, cond, "left")
        j = j.where(F.coalesce(F.when(F.col("_v").isNull(), alone), F.col("_v._e")).isNull())
        return j.select(*[child[c] for c in child.columns], *[F.col(f"_v._v.{c}").alias(c) for c in cols])
    out = child.join(p, cond, "inner").drop(*["_p_" + pk for pk in fk.values()])
    return out


# ---------------------------------------------------------------- aggregates
def bounds(df: DataFrame, col: str) -> DataFrame:
    """A2: min and max of a column."""
    return df.agg(F.min(col).alias("min_" + col), F.max(col).alias("max_" + col))


def sales_report(goods: DataFrame, sales: DataFrame) -> DataFrame:
    """A3: ``sum(qty * price)`` per good name.

    Quantities are summed per good before the join (partial aggregation on
    the map side), so the join sees one row per good instead of every sale
    and a hot good is reduced before any shuffle.  Exact: the price is
    constant per good, so ``sum(q * p) = p * sum(q)`` in decimal arithmetic.
    """
    per_good = (sales.where(F.col("good_id").isNotNull())
                .groupBy("good_id").agg(F.sum(F.col("sales_qty").cast("long")).alias("_qty")))
    j = per_good.join(goods, per_good["good_id"] == goods["goods_id"], "inner")
    return (j.groupBy("good_name")
            .agg(F.sum(F.col("good_price") * F.col("_qty")).cast("decimal(38,2)").alias("sum_sale")))


def table_profile(df: DataFrame, text_cols: Sequence[str], size_metrics: dict | None = None) -> DataFrame:
    """One aggregate pass, then a lateral unpivot (``stack``) into
    ``(metric, bytes, bytes_pretty, bytes_per_row)`` rows."""
    size_metrics = size_metrics or {}
    aggs = [F.count(F.lit(1)).alias("ct"),
            F.sum(F.length(row_text(*text_cols))).cast("long").alias("txt_len")]
    for name, expr in size_metrics.items():
        aggs.append(expr.cast("long").alias(name))
    x = df.agg(*aggs)
    entries = [("true", "live_rows_in_text_representation", "txt_len")]
    entries += [("true", n, n) for n in size_metrics]
    entries += [("false", "row_count", "ct")]
    stack = "stack({}, {}) as (is_size, metric, nr)".format(
        len(entries), ", ".join(f"{a}, '{b}', cast({c} as bigint)" for a, b, c in entries))
    rows = x.selectExpr("ct", stack)
    return rows.select(
        "metric", F.col("nr").alias("bytes"),
        F.when(F.col("is_size"), size_pretty("nr")).alias("bytes_pretty"),
        F.when(F.col("is_size"), (F.col("nr") / F.nullif(F.col("ct"), F.lit(0))).cast("long"))
        .alias("bytes_per_row"))


def unpivot_metrics(df: DataFrame, spec: Sequence[tuple[str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """``CROSS JOIN LATERAL (VALUES ...)`` = one row per (metric, value)."""
    stack = "stack({}, {}) as (metric, value)".format(
        len(spec), ", ".join(f"'{m}', cast({e} as bigint)" for m, e in spec))
    return df.selectExpr(*keep, stack)


def joined_length(df: DataFrame, expr: Column, sep: str = ",") -> DataFrame:
    """A5: ``length(array_to_string(array(SELECT expr ...), sep))`` without
    building the string: ``sum(length) + (count - 1) * len(sep)``."""
    return df.agg((F.sum(F.length(expr)).cast("long")
                   + (F.count(expr) - 1) * F.lit(len(sep))).alias("joined_length"))


# ---------------------------------------------------------------- ordering
def sort(df: DataFrame, spec: Sequence) -> DataFrame:
    """O1/O2: spec items are names or (name, 'desc'|'asc'); DESC puts NULL first."""
    cols = []
    for s in spec:
        if isinstance(s, str):
            cols.append(F.col(s).asc_nulls_last())
        else:
            n, d = s
            cols.append(F.col(n).desc_nulls_first() if d == "desc" else F.col(n).asc_nulls_last())
    return df.orderBy(*cols)


def top(df: DataFrame, n: int, spec: Sequence) -> DataFrame:
    """O3: top-k (TakeOrderedAndProject); always ordered so it is deterministic."""
    return sort(df, spec).limit(n)


# ---------------------------------------------------------------- set operations
def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """``EXCEPT`` (also spelled MINUS): distinct rows of a not in b, null-safe."""
    return a.subtract(b)


def merge_sources(sources: dict, tag_col: str = "source") -> DataFrame:
    """Several publishers' tables read as one, tagged by source."""
    out = None
    for name, df in sources.items():
        t = tag(df, tag_col, name)
        out = t if out is None else out.unionByName(t)
    return out
