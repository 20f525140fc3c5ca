"""UPDATE, UPDATE ... FROM, DELETE, MERGE and ADD COLUMN as pure
DataFrame -> DataFrame functions (decision D2).  Writing a new version is
``ledgerlake.sources.versioned``'s job.

Uniqueness rules (UPDATE FROM / MERGE: a target row may match at most one
source row) are checked inside the plan with ``raise_error``, so they cost
no extra job and no driver round trip.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def update(df: DataFrame, where: Column | None, set_: dict) -> DataFrame:
    """``UPDATE df SET c = expr WHERE pred``; every SET sees old values.

    A NULL predicate leaves the row unchanged.
    """
    cond = F.coalesce(where, F.lit(False)) if where is not None else F.lit(True)
    cols = []
    for c in df.columns:
        if c in set_:
            cols.append(F.when(cond, set_[c]).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def repeat_update(df: DataFrame, col: str, suffix: str, times: int) -> DataFrame:
    """``UPDATE t SET c = c || suffix`` run ``times`` times = one projection."""
    out = df
    for _ in range(times):
        out = update(out, None, {col: F.concat(F.col(col), F.lit(suffix))})
    return out


def delete(df: DataFrame, where: Column) -> DataFrame:
    """T4: ``DELETE WHERE pred``; rows whose predicate is NULL stay."""
    return df.where(~F.coalesce(where, F.lit(False)))


def add_column(df: DataFrame, name: str, dtype: str) -> DataFrame:
    """T6 step 1: ``ALTER TABLE ADD COLUMN`` (all NULL)."""
    return df.withColumn(name, F.lit(None).cast(dtype))


def _unique_source(src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows with the number of rows of their key, counted by an aggregate that combines
    before the shuffle.  A row with a NULL key matches nothing, so it counts alone; such rows are
    spread by content."""
    null = None
    for k in keys:
        null = F.col(k).isNull() if null is None else null | F.col(k).isNull()
    alone = F.when(null, F.xxhash64(*[F.col(c) for c in src.columns])).otherwise(F.lit(0).cast("long"))
    counts = src.where(~null).groupBy(*keys).agg(F.count(F.lit(1)).alias("_src_n")).withColumn("_alone", F.lit(0).cast("long"))
    return src.withColumn("_alone", alone).join(counts, [*keys, "_alone"], "left").select(
        *src.columns, F.coalesce("_src_n", F.lit(1).cast("long")).alias("_src_n"))


def update_from(df: DataFrame, src: DataFrame, keys: dict, cols: dict) -> DataFrame:
    """``UPDATE df SET c = src.x FROM src WHERE df.k = src.k``.

    ``keys`` maps df key -> src key, ``cols`` maps df column -> src column.
    A df row matching several source rows raises.
    """
    sk = list(keys.values())
    s = _unique_source(src.select(*sk, *set(cols.values())), sk)
    s = s.select(*[F.col(k).alias("_sk_" + k) for k in sk],
                 *[F.col(v).alias("_sv_" + v) for v in set(cols.values())], "_src_n")
    cond = None
    for dk, k in keys.items():
        e = df[dk] == s["_sk_" + k]
        cond = e if cond is None else cond & e
    j = df.join(s, cond, "left")
    matched = F.col("_src_n").isNotNull()
    guard = F.when(F.col("_src_n") > 1, F.raise_error(F.lit("UPDATE FROM: more than one source row per target row")))
    out = []
    for c in df.columns:
        if c in cols:
            new = F.when(matched, F.col("_sv_" + cols[c])).otherwise(F.col(c))
            out.append(F.coalesce(guard, new).cast(df.schema[c].dataType).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


@dataclass
class Clause:
    """One MERGE clause: ``kind`` is matched / not_matched / not_matched_by_source;
    ``action`` is delete / update / insert; ``values`` maps target column -> Column."""
    kind: str
    action: str
    condition: Column | None = None
    values: dict = field(default_factory=dict)


def merge(target: DataFrame, source: DataFrame, on: dict, clauses: Sequence[Clause],
          source_prefix: str = "src_") -> DataFrame:
    """T5: ``MERGE INTO target USING source ON ...`` with ordered clauses.

    Source columns are visible as ``src_<name>``.  The first clause whose kind
    and condition hold wins; a matched row with no true clause is kept as is;
    an unmatched source row with no true clause inserts nothing.  A target row
    matched by more than one source row raises.  NULL keys never match.
    """
    sk = list(on.values())
    src = _unique_source(source, sk)
    s = src.select(*[F.col(c).alias(source_prefix + c) for c in source.columns], "_src_n") \
        .withColumn("_s", F.lit(True))
    t = target.withColumn("_t", F.lit(True))
    cond = None
    for tk, skey in on.items():
        e = t[tk] == s[source_prefix + skey]
        cond = e if cond is None else cond & e
    j = t.join(s, cond, "full")
    flags = {
        "matched": F.col("_t").isNotNull() & F.col("_s").isNotNull(),
        "not_matched": F.col("_t").isNull() & F.col("_s").isNotNull(),
        "not_matched_by_source": F.col("_t").isNotNull() & F.col("_s").isNull(),
    }
    act = None
    for i, cl in enumerate(clauses):
        c = flags[cl.kind]
        if cl.condition is not None:
            c = c & F.coalesce(cl.condition, F.lit(False))
        act = F.when(c, F.lit(i)) if act is None else act.when(c, F.lit(i))
    act = act.otherwise(F.lit(-1)) if act is not None else F.lit(-1)
    guard = F.when(F.col("_t").isNotNull() & (F.col("_src_n") > 1),
                   F.raise_error(F.lit("MERGE: a target row matches more than one source row")))
    j = j.withColumn("_act", F.coalesce(guard.cast("int"), act))
    keep = F.col("_t").isNotNull()
    for i, cl in enumerate(clauses):
        if cl.action == "delete":
            keep = keep & (F.col("_act") != i)
        elif cl.action == "insert":
            keep = keep | (F.col("_act") == i)
    out = []
    for c in target.columns:
        e = None
        for i, cl in enumerate(clauses):
            if cl.action == "update" and c in cl.values:
                v = cl.values[c]
            elif cl.action == "insert":
                v = cl.values.get(c, F.lit(None))
            else:
                continue
            e = F.when(F.col("_act") == i, v) if e is None else e.when(F.col("_act") == i, v)
        e = F.col(c) if e is None else e.otherwise(F.col(c))
        out.append(e.cast(target.schema[c].dataType).alias(c))
    return j.where(keep).select(*out)
