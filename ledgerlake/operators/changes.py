"""Change logs and replicas.

A change log (decision D3) has columns ``seq, commit_ts, op, key, before,
after``; ``op`` is I (insert), U (update), D (delete) or T (truncate, no
key).  ``key``/``before``/``after`` are structs.

Applying a log never gathers a key's history in one task: the latest change
per key is a ``max_by`` aggregate (partial on the map side), truncation is a
one-row aggregate, and base and changes meet in one full outer join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.scalar import ratio_pct
from ledgerlake.operators.ordered import bucket, running_sum

#: Orders per chunk in the ordered fold of identity='full'; a chunk holds at most so many changes.
FULL_CHUNK = 2 ** 18


def make_log(df: DataFrame, seq: Column, op: Column, key: dict, after: dict,
             before: dict | None = None, commit_ts: Column | None = None) -> DataFrame:
    """Build change rows from a table of events (one row = one change).

    ``key``/``after``/``before`` map field name -> Column; ``before`` is only
    needed for identity 'full' or row-level consumers such as the mart.
    """
    k = F.struct(*[c.alias(n) for n, c in key.items()])
    a = F.struct(*[c.alias(n) for n, c in after.items()])
    b = F.struct(*[c.alias(n) for n, c in (before or after).items()])
    ts = commit_ts if commit_ts is not None else F.lit(None).cast("timestamp_ntz")
    return df.select(seq.cast("long").alias("seq"), ts.alias("commit_ts"), op.alias("op"),
                     F.when(op != "T", k).alias("key"),
                     (F.when(op.isin("U", "D"), b) if before else F.when(F.lit(False), b)).alias("before"),
                     F.when(op.isin("I", "U"), a).alias("after"))


def publish(before: DataFrame, after: DataFrame, key: Sequence[str], start_seq: int = 0) -> DataFrame:
    """The changes that turn table ``before`` into table ``after``, as a change
    log that ``apply_changes`` takes: ``seq, commit_ts, op, key, before, after``.

    Full outer join on the key; I where only after exists, D where only before
    exists, U where a non-key column differs (NULL-safe).  Equal rows emit
    nothing.  ``seq`` counts up from ``start_seq``; each key changes once, so any
    order of the changes gives the same table.
    """
    key = list(key)
    cols = before.columns
    vals = [c for c in cols if c not in key]
    b = before.select(*key, F.struct(*cols).alias("before"))
    a = after.select(*key, F.struct(*cols).alias("after"))
    j = b.join(a, on=key, how="full")
    same = F.lit(True)
    for v in vals:
        same = same & F.col("before." + v).eqNullSafe(F.col("after." + v))
    op = F.when(F.col("before").isNull(), "I").when(F.col("after").isNull(), "D").when(~same, "U")
    changes = j.select(op.alias("op"), F.struct(*key).alias("key"), "before", "after").where(F.col("op").isNotNull())
    return changes.select((F.monotonically_increasing_id() + F.lit(start_seq)).alias("seq"),
                          F.lit(None).cast("timestamp_ntz").alias("commit_ts"), "op", "key", "before", "after")


def _after_truncate(changes: DataFrame) -> DataFrame:
    """Changes after the last truncate, plus a flag telling whether one exists."""
    last_t = changes.where(F.col("op") == "T").agg(F.max("seq").alias("_tseq"))
    # one row by construction: safe to broadcast
    c = changes.crossJoin(F.broadcast(last_t))
    return c.where(F.col("_tseq").isNull() | (F.col("seq") > F.col("_tseq")))


def apply_changes(base: DataFrame, changes: DataFrame, identity: str = "key") -> DataFrame:
    """M1: the replica after applying ``changes`` to ``base``.

    identity='key'  : rows are identified by ``key``; the latest change per
                      key wins (I/U upsert its ``after`` image, D removes).
    identity='full' : rows are identified by their whole value (tables
                      without a key): D removes one equal row, U removes one
                      row equal to ``before`` and adds ``after``, I adds, in
                      order: a removal finds only rows that are there at its
                      seq, and one that finds none does nothing (an update then
                      still adds its ``after``, as with identity='key').
    identity='none' : only inserts can be replicated; an update or delete
                      raises, as an apply worker stops on them.
    A truncate clears ``base`` and every earlier change.
    """
    cols = base.columns
    last_t = changes.where(F.col("op") == "T").agg(F.max("seq").alias("_tseq"))
    live = _after_truncate(changes).drop("_tseq")
    base_live = base.crossJoin(F.broadcast(last_t)).where(F.col("_tseq").isNull()).drop("_tseq")

    if identity == "none":
        bad = F.raise_error(F.lit("replica identity none: cannot replicate UPDATE or DELETE"))
        ins = live.select(F.when(F.col("op").isin("U", "D"), bad.cast("boolean")).alias("_err"), "after") \
            .where(F.col("_err").isNull() | F.col("_err"))
        return base_live.unionByName(ins.select("after.*").select(*cols))

    if identity == "full":
        rem = live.where(F.col("op").isin("U", "D")).select((F.col("seq") * 2).alias("_o"), "before.*")
        add = live.where(F.col("op").isin("I", "U")).select((F.col("seq") * 2 + 1).alias("_o"), "after.*")
        moves = rem.select(*cols, "_o", F.lit(-1).alias("_n")).unionByName(add.select(*cols, "_o", F.lit(1).alias("_n")))
        # per row value: how far the running count falls below its start; a removal
        # that finds no row is a fall below zero, which is given back
        run = running_sum(moves, cols, "_o", "_n", "_run", bucket("_o", FULL_CHUNK))
        falls = run.groupBy(*cols).agg(F.sum("_n").alias("_sum"), F.least(F.min("_run"), F.lit(0)).alias("_low"))
        start = base_live.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
        u = start.select(*cols, "_c", F.lit(0).alias("_sum"), F.lit(0).alias("_low")).unionByName(
            falls.select(*cols, F.lit(0).alias("_c"), "_sum", "_low"))
        g = u.groupBy(*cols).agg(F.sum("_c").alias("_c"), F.sum("_sum").alias("_sum"), F.sum("_low").alias("_low"))
        left = (F.col("_c") + F.col("_sum") - F.least(F.lit(0), F.col("_c") + F.col("_low"))).cast("int")
        return g.withColumn("_left", left).where(F.col("_left") > 0).select(
            *cols, F.explode(F.array_repeat(F.lit(1), F.col("_left"))).alias("_x")).drop("_x")

    # the latest change per key; truncates are the group without a key
    latest = changes.groupBy("key").agg(F.max_by(F.struct("seq", "op", "after"), "seq").alias("_l"))
    key_names = [f.name for f in changes.schema["key"].dataType.fields]
    after_only = [f.name for f in changes.schema["after"].dataType.fields if f.name not in key_names]
    latest = latest.where(F.col("_l.op") != "T").crossJoin(F.broadcast(last_t)).select(      # one row by construction
        *[F.col("key." + k).alias("_k_" + k) for k in key_names], F.col("_l.after").alias("_after"),
        ((F.col("_l.op") != "D") & (F.col("_tseq").isNull() | (F.col("_l.seq") > F.col("_tseq")))).alias("_there"))
    cond = F.lit(True)
    for k in key_names:
        cond = cond & (base_live[k] == latest["_k_" + k])
    j = base_live.withColumn("_b", F.lit(True)).join(latest, cond, "full")
    changed = F.col("_there").isNotNull()
    out = [F.when(changed, F.col("_k_" + c)).otherwise(F.col(c)).alias(c) if c in key_names
           else F.when(changed, F.col("_after." + c)).otherwise(F.col(c)).alias(c) if c in after_only
           else F.col(c) for c in cols]
    return j.where(F.coalesce("_there", "_b")).select(*out)


def as_of(base: DataFrame, changes: DataFrame, upto: Column | int) -> DataFrame:
    """M7: the table as of a commit point: only changes with ``seq <= upto``
    (or a timestamp bound when a Column over ``commit_ts`` is given)."""
    if isinstance(upto, Column):
        c = changes.where(upto)
    else:
        c = changes.where(F.col("seq") <= F.lit(upto))
    return apply_changes(base, c)


class Snapshot:
    """M7 isolation: ``repeatable`` pins the newest seq once at open;
    ``committed`` re-reads the newest seq on every read."""

    def __init__(self, base: DataFrame, changes_reader, mode: str = "repeatable"):
        self.base, self.reader, self.mode = base, changes_reader, mode
        self.pin = self._newest() if mode == "repeatable" else None

    def _newest(self) -> int:
        v = self.reader().agg(F.max("seq")).first()[0]
        return -1 if v is None else int(v)

    def read(self) -> DataFrame:
        upto = self.pin if self.mode == "repeatable" else self._newest()
        return as_of(self.base, self.reader(), upto)


def churn_report(changes: DataFrame) -> DataFrame:
    """Superseded row versions (updates + deletes) against live keys."""
    live = _after_truncate(changes).where(F.col("op") != "T")
    dead = live.agg(F.count(F.when(F.col("op").isin("U", "D"), 1)).alias("dead"),
                    F.count(F.lit(1)).alias("changes"))
    latest = live.groupBy("key").agg(F.max_by("op", "seq").alias("_op"))
    alive = latest.agg(F.count(F.when(F.col("_op") != "D", 1)).alias("live"))
    r = dead.crossJoin(alive)
    return r.select("changes", "dead", "live", ratio_pct("dead", "live").alias("dead_pct"))
