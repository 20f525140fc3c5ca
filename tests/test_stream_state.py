"""The mart as keyed state against the rules step by step."""

import random

import numpy as np
import pytest

from ledgerlake.streaming.state import fold, mart_stream_state

LOG = ("seq long, commit_ts timestamp_ntz, op string, key struct<id:long>, before struct<good_id:long,sales_qty:int>, "
       "after struct<good_id:long,sales_qty:int>")


def by_hand(total, there, steps):
    for add, amount in steps:
        if add:
            total, there = total + amount, True
        elif there and total >= amount:
            total -= amount
            there = total != 0
    return total, there


def test_fold_equals_the_rules_step_by_step():
    rng = random.Random(1)
    for _ in range(3000):
        steps = [(rng.random() < 0.5, rng.choice([0, 1, 2, 5, 5, 9, -3])) for _ in range(rng.randrange(1, 14))]
        start = rng.choice([(0, False), (0, True), (7, True), (-2, True)])
        adds, amounts = np.array([a for a, _ in steps]), np.array([x for _, x in steps], np.int64)
        assert fold(*start, adds, amounts) == by_hand(*start, steps), (start, steps)


def sales(rng, n, truncates=()):
    """Change rows in order, also deletes and updates of sales that never were."""
    out = []
    for seq in range(n):
        image = (rng.randrange(6), rng.randrange(1, 9))
        op = "T" if seq in truncates else rng.choice("IIDU")
        out.append((seq, None, op, None if op == "T" else (seq,), image if op in "DU" else None,
                    (rng.randrange(6), rng.randrange(1, 9)) if op == "U" else image if op == "I" else None))
    return out


def expected(log, prices):
    mart = {}
    for _, _, op, _, before, after in log:
        if op == "T":
            mart = {}
            continue
        steps = []
        if op == "U" and before[0] == after[0]:
            steps = [(after[0], True, after[1] - before[1])]
        else:
            steps = [(before[0], False, before[1])] if before else []
            steps += [(after[0], True, after[1])] if after else []
        for good, add, qty in steps:
            name, price = prices[good]
            total, there = by_hand(*mart.get(name, (0, False)), [(add, qty * price)])
            mart[name] = (total, there)
    return sorted((name, total) for name, (total, there) in mart.items() if there)


@pytest.mark.parametrize("truncates", [(), (25,), (0, 30, 55)])
def test_state_survives_stops_and_restarts(spark, scratch, truncates):
    from ledgerlake.operators.mart import price_history
    from ledgerlake.streaming.jobs import file_stream
    rng = random.Random(len(truncates))
    names = {g: (f"good {g % 4}", 100 + 50 * g) for g in range(6)}      # two goods may share a name
    goods = spark.createDataFrame([(g, n, p) for g, (n, p) in names.items()],
                                  "goods_id long, good_name string, cents long").selectExpr("goods_id", "good_name", "cast(cents as decimal(12,2)) as good_price")
    log, root = sales(rng, 80, truncates), scratch("state")
    got, folder = None, f"{root}/in"
    for start in range(0, 80, 20):
        for part in (log[start:start + 10], log[start + 10:start + 20]):        # two files, one a micro-batch
            spark.createDataFrame(part, LOG).coalesce(1).write.mode("append").parquet(folder)
        schema = spark.createDataFrame([], LOG).schema
        got = mart_stream_state(spark, file_stream(spark, folder, schema, files_a_batch=1), spark.read.schema(schema).parquet(folder),
                                price_history(goods), f"{root}/mart", f"{root}/ck")
        assert sorted((r.good_name, int(r.sum_sale)) for r in got.collect()) == expected(log[:start + 20], names)


def test_unknown_truncate_stops_before_its_batch_and_resumes(spark, scratch):
    from ledgerlake.operators.mart import price_history
    from ledgerlake.streaming.jobs import file_stream
    root = scratch("late")
    folder, schema = f"{root}/in", spark.createDataFrame([], LOG).schema
    goods = spark.createDataFrame([(1, "one", 2)], "goods_id long, good_name string, c long").selectExpr("goods_id", "good_name", "cast(c as decimal(12,2)) as good_price")
    spark.createDataFrame([(0, None, "I", (0,), None, (1, 3))], LOG).write.parquet(folder)
    early = spark.read.schema(schema).parquet(folder).collect()
    spark.createDataFrame([(1, None, "T", None, None, None), (2, None, "I", (2,), None, (1, 4))], LOG).coalesce(1).write.mode("append").parquet(folder)

    def run(log):
        return mart_stream_state(spark, file_stream(spark, folder, schema, files_a_batch=1), log, price_history(goods), f"{root}/mart", f"{root}/ck")

    with pytest.raises(Exception, match="truncate came"):
        run(spark.createDataFrame(early, schema))
    assert [(r.good_name, int(r.sum_sale)) for r in run(spark.read.schema(schema).parquet(folder)).collect()] == [("one", 8)]
