"""M3-M5, V6: a summary mart (sum of qty * price per good name) kept up to
date from the sales change log.

Rules of the maintained mart (row trigger semantics):
  INSERT           add qty * price to the name's row, creating it if absent
  DELETE           amount = qty * price: remove the row when sum = amount,
                   subtract when sum > amount, do nothing when sum < amount
                   or the row is absent
  UPDATE same good add (new qty - old qty) * price
  UPDATE new good  DELETE(old row) then INSERT(new row)
  TRUNCATE         empty the mart
The price is the one in force when the event happens (price history), so
old sales keep their old price; the key is the good's *name*.

Two evaluation modes:
  delta  algebraic sum and row count per name (exact while no delete is
         ignored, e.g. with constant prices); a pure partial aggregate.
  exact  the ordered rules above, over steps with a unique order ``o``.
         Steps are range-partitioned by ``o`` into chunks of about
         ``CHUNK_ROWS`` rows.  Running sums inside each (name, chunk) give, in
         one parallel pass, the chunk's total and the entering sum from which
         none of its deletes is ignored.  These are one small row per (name,
         chunk); a running sum over them finds each name's first chunk with an
         ignored delete.  Only those chunks are folded step by step, all names
         at once, and so on: there are at most as many folds as chunks, however
         many deletes are ignored, and names without one need none.
"""

from __future__ import annotations

import decimal

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.operators.changes import _after_truncate
from ledgerlake.sources.io import stage_table

AMOUNT = "decimal(38,2)"
CHUNK_ROWS = 500_000
NEG_INF_SEQ = -(2 ** 62)


def price_history(goods: DataFrame, changes: DataFrame | None = None) -> DataFrame:
    """``(good_id, good_name, price, valid_from, valid_to)`` intervals.

    ``goods``: goods_id, good_name, good_price (valid from the beginning);
    ``changes``: good_id, seq, price (a new price from that seq on).
    """
    base = goods.select(F.col("goods_id").alias("good_id"), "good_name",
                        F.col("good_price").alias("price"), F.lit(NEG_INF_SEQ).cast("long").alias("valid_from"))
    if changes is not None:
        names = goods.select(F.col("goods_id").alias("good_id"), "good_name")
        base = base.unionByName(changes.join(names, "good_id").select(
            "good_id", "good_name", F.col("price").cast(goods.schema["good_price"].dataType).alias("price"),
            F.col("seq").cast("long").alias("valid_from")))
    # per-good history: a handful of rows per good
    w = Window.partitionBy("good_id").orderBy("valid_from")
    return base.withColumn("valid_to", F.lead("valid_from").over(w))


def steps(log: DataFrame, prices: DataFrame) -> DataFrame:
    """Split every sales change into per-name steps ``(good_name, o, kind, amt, cnt)``.

    ``o`` orders steps (seq * 2 + sub) and is unique, as ``seq`` is; ``cnt`` is the
    change in live sales.
    """
    return priced_steps(_after_truncate(log).where(F.col("op") != "T"), prices)


def priced_steps(live: DataFrame, prices: DataFrame, *carried: str) -> DataFrame:
    """``steps`` of changes that are not truncates, with some of their columns; also on a stream."""
    b, a = F.col("before"), F.col("after")

    def st(sub, kind, good, qty, cnt):
        return F.struct(F.lit(sub).alias("sub"), F.lit(kind).alias("kind"), good.cast("long").alias("good_id"),
                        qty.cast("long").alias("qty"), F.lit(cnt).alias("cnt"))

    same = b.getField("good_id").eqNullSafe(a.getField("good_id"))
    arr = (F.when(F.col("op") == "I", F.array(st(0, "ADD", a.good_id, a.sales_qty, 1)))
           .when(F.col("op") == "D", F.array(st(0, "DEL", b.good_id, b.sales_qty, -1)))
           .when((F.col("op") == "U") & same,
                 F.array(st(0, "ADD", a.good_id, a.sales_qty - b.sales_qty, 0)))
           .when(F.col("op") == "U", F.array(st(0, "DEL", b.good_id, b.sales_qty, -1),
                                             st(1, "ADD", a.good_id, a.sales_qty, 1))))
    s = live.select("seq", *carried, F.explode(arr).alias("s")).select("seq", *carried, "s.*")
    j = s.join(prices, (s.good_id == prices.good_id) & (s.seq >= prices.valid_from)
               & (prices.valid_to.isNull() | (s.seq < prices.valid_to)), "inner")
    amt = (F.col("qty") * F.col("price")).cast(AMOUNT)
    out = j.select("good_name", (F.col("seq") * 2 + F.col("sub")).alias("o"), "kind",
                   amt.alias("amt"), "cnt", *carried)
    # NULL quantity: an insert adds 0, a delete cannot match (documented deviation)
    return (out.where(~((F.col("kind") == "DEL") & F.col("amt").isNull()))
            .withColumn("amt", F.coalesce("amt", F.lit(0).cast(AMOUNT))))


def apply_delta(st: DataFrame) -> DataFrame:
    """M4: per-name algebraic fold; the row exists while it has live sales."""
    signed = F.when(F.col("kind") == "ADD", F.col("amt")).otherwise(-F.col("amt"))
    g = st.groupBy("good_name").agg(F.sum(signed).cast(AMOUNT).alias("sum_sale"),
                                    F.sum("cnt").alias("_n"))
    return g.where(F.col("_n") > 0).select("good_name", "sum_sale")


def _fold(rows: pd.DataFrame) -> pd.DataFrame:
    """The rules, step by step, over one chunk of a name that is entered with a sum."""
    rows = rows.sort_values("o")
    total = enter = rows["enter"].iloc[0]
    there = bool(rows["was"].iloc[0])
    for kind, amt in zip(rows["kind"], rows["amt"]):
        if kind == "ADD":
            total, there = total + amt, True
        elif there and total >= amt:
            total -= amt
            there = total != 0
    return pd.DataFrame({"good_name": rows["good_name"].iloc[:1], "chunk": rows["chunk"].iloc[:1],
                         "total": [decimal.Decimal(total - enter)], "there": [there]})


def apply_exact(spark: SparkSession, st: DataFrame, chunk_rows: int = CHUNK_ROWS, rows: int | None = None) -> DataFrame:
    """M3: ordered fold per name, evaluated in parallel (see module doc).

    ``rows`` is about the number of steps, if known.  Two steps of a name with the
    same ``o`` raise."""
    return exact_passes(spark, st, chunk_rows, rows)[0]


def exact_passes(spark: SparkSession, st: DataFrame, chunk_rows: int = CHUNK_ROWS,
                 rows: int | None = None) -> tuple[DataFrame, int]:
    """``apply_exact`` and the number of folds it took."""
    chunks = 1 + (st.count() if rows is None else rows) // chunk_rows
    st = (st.select("good_name", "o", "kind", "amt").repartitionByRange(chunks, "o")
          .withColumn("chunk", F.spark_partition_id()))
    st = stage_table(st, "mart_steps")
    w = Window.partitionBy("good_name", "chunk").orderBy("o")
    signed = F.when(F.col("kind") == "ADD", F.col("amt")).otherwise(-F.col("amt"))
    once = F.when(F.lag("o").over(w) == F.col("o"), F.raise_error(F.lit("mart: two steps with the same order")).cast(AMOUNT))
    run = F.sum(signed).over(w.rowsBetween(Window.unboundedPreceding, 0))
    inside = st.select("good_name", "chunk", "o", "kind", F.coalesce(once, run).cast(AMOUNT).alias("run"))
    # a delete is ignored if the sum after it would be negative; ``low`` is the least of those sums
    per_chunk = inside.groupBy("good_name", "chunk").agg(
        F.max_by("run", "o").alias("total"), F.min(F.when(F.col("kind") == "DEL", F.col("run"))).alias("low"),
        F.max_by("kind", "o").alias("last"))
    per_chunk = stage_table(per_chunk.withColumn("there", F.lit(None).cast("boolean")), "mart_chunks")
    so_far = Window.partitionBy("good_name").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    folds = 0
    while True:
        enter = F.coalesce(F.sum("total").over(so_far), F.lit(0)).cast(AMOUNT)
        known = per_chunk.withColumn("enter", enter)
        # does the name have a row after the chunk?
        after = F.coalesce(F.col("there"), (F.col("last") == "ADD") | (F.col("enter") + F.col("total") != 0))
        known = known.withColumn("after", after)
        known = known.withColumn("was", F.coalesce(F.lag("after").over(Window.partitionBy("good_name").orderBy("chunk")), F.lit(False)))
        wrong = F.col("there").isNull() & (F.col("enter") + F.col("low") < 0)
        first = known.where(wrong).groupBy("good_name").agg(F.min_by(F.struct("chunk", "enter", "was"), "chunk").alias("f"))
        first = stage_table(first.select("good_name", "f.*"), "mart_first")
        if first.isEmpty():
            break
        folds += 1
        numbers = [r.chunk for r in first.select("chunk").distinct().collect()]      # at most the number of chunks
        todo = st.where(F.col("chunk").isin(numbers)).join(first, ["good_name", "chunk"])
        folded = todo.groupBy("good_name", "chunk").applyInPandas(
            _fold, f"good_name string, chunk int, total {AMOUNT}, there boolean")
        new = folded.select("good_name", "chunk", F.col("total").alias("_t"), F.col("there").alias("_h"))
        per_chunk = stage_table(per_chunk.join(new, ["good_name", "chunk"], "left").select(
            "good_name", "chunk", F.coalesce("_t", "total").cast(AMOUNT).alias("total"), "low", "last",
            F.coalesce("_h", "there").alias("there")), "mart_chunks")
    out = known.groupBy("good_name").agg(F.sum("total").cast(AMOUNT).alias("sum_sale"), F.max_by("after", "chunk").alias("there"))
    return out.where("there").select("good_name", "sum_sale"), folds


def mart_apply(spark: SparkSession, log: DataFrame, prices: DataFrame, mode: str = "exact") -> DataFrame:
    st = steps(log, prices)
    if mode != "exact":
        return apply_delta(st)
    return apply_exact(spark, st, rows=log.count())


def mart_init(goods: DataFrame, sales: DataFrame) -> DataFrame:
    """M5: initial mart = the sales report."""
    from ledgerlake.operators.relational import sales_report
    return sales_report(goods, sales)


def mart_drift(report: DataFrame, mart: DataFrame) -> DataFrame:
    """V6: names whose report sum and mart sum differ (NULL-safe)."""
    r = report.select("good_name", F.col("sum_sale").alias("report_sum"))
    m = mart.select("good_name", F.col("sum_sale").alias("mart_sum"))
    j = r.join(m, "good_name", "full")
    return j.where(~F.col("report_sum").eqNullSafe(F.col("mart_sum")))
