"""M6: ledger balances (account / teller / branch) from a history of deltas.

Balances are partial aggregates per level joined to the start balances;
the running balance per account (the value a transaction "returns") is a
chunked running sum, so one very busy account is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.ordered import running_sum, ts_bucket

AMOUNT = "decimal(38,2)"


def _level(start: DataFrame, history: DataFrame, id_col: str, hist_col: str) -> DataFrame:
    sums = history.groupBy(F.col(hist_col).alias(id_col)).agg(F.sum("delta").alias("_d"))
    if start is None:
        return sums.select(id_col, F.col("_d").cast(AMOUNT).alias("balance"))
    j = start.join(sums, id_col, "full")
    return j.select(id_col, (F.coalesce(F.col("balance"), F.lit(0)) + F.coalesce(F.col("_d"), F.lit(0)))
                    .cast(AMOUNT).alias("balance"))


def ledger_apply(accounts: DataFrame | None, tellers: DataFrame | None, branches: DataFrame | None,
                 history: DataFrame) -> dict:
    """New balances per level: start balance + sum of deltas.

    ``history``: aid, tid, bid, delta (decimal), ts.  Start tables:
    (aid|tid|bid, balance); ``None`` means every start balance is 0.
    """
    return {"account": _level(accounts, history, "aid", "aid"),
            "teller": _level(tellers, history, "tid", "tid"),
            "branch": _level(branches, history, "bid", "bid")}


def running_balance(history: DataFrame, accounts: DataFrame | None, order=("ts", "event_id"),
                    chunk_seconds: int = 86400) -> DataFrame:
    """Balance of the account after each history row, ordered by ``order``."""
    r = running_sum(history, "aid", list(order), "delta", "_run", ts_bucket("ts", chunk_seconds))
    if accounts is not None:
        r = r.join(accounts.withColumnRenamed("balance", "_start"), "aid", "left")
        start = F.coalesce(F.col("_start"), F.lit(0))
    else:
        start = F.lit(0)
    return r.withColumn("balance", (start + F.col("_run")).cast(AMOUNT)).drop("_run", "_start")
