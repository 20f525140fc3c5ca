"""Mappings from the driver tables to the operators' data model.

goods  = part     (goods_id = p_partkey, good_name = p_name, good_price = p_retailprice)
sales  = lineitem (good_id = l_partkey, sales_qty = l_quantity)
Money is decimal from the first projection on (decision D5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.sources.io import stage_table
from ledgerlake.sources.tables import load

PRICE = "decimal(12,2)"
MONEY = "decimal(18,2)"


def goods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("goods_id"), F.col("p_name").alias("good_name"),
        F.col("p_retailprice").cast(PRICE).alias("good_price"))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").alias("good_id"),
                     F.col("l_quantity").cast("int").alias("sales_qty"),
                     F.col("l_shipdate").alias("sales_time"))


# ---------------------------------------------------------------- sales change logs
# A line's position is its number, from 1, among all lines in the order of SLOT, the keys and the other
# columns; it stays below LINE_PHASE, and 4 phases * 2 (step order) fit a long.
SLOT = "l_orderkey * 8 + l_linenumber"
LINE_PHASE = 2 ** 59
CHUNK_LINES = 500_000
#: Equal lines, read in a row, that stay in one chunk.
SAME_LINES = 2 ** 16


def _change(df: DataFrame, seq, op: str, before=None, after=None) -> DataFrame:
    img = "struct<good_id:bigint,sales_qty:int>"

    def s(x):
        if x is None:
            return F.lit(None).cast(img)
        return F.struct(x[0].cast("long").alias("good_id"), x[1].cast("int").alias("sales_qty"))
    return df.select(seq.cast("long").alias("seq"), F.col("l_shipdate").alias("commit_ts"),
                     F.lit(op).alias("op"),
                     F.struct(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber"))
                     .alias("key"), s(before).alias("before"), s(after).alias("after"))


def lines(spark: SparkSession, sf_dir: str, chunk_lines: int = CHUNK_LINES, same_lines: int = SAME_LINES) -> DataFrame:
    """lineitem with a unique position ``pos``.  Lines may share (l_orderkey, l_linenumber), however
    many; such lines are numbered by all their columns, so equal ones are interchangeable.

    Lines are sorted once, into ordered chunks of about ``chunk_lines`` which cut through keys too: equal lines
    are told apart by where they were read, or by a part of ``same_lines`` of those read in a row.  A line's
    position is its place in its chunk after the lines of the chunks before."""
    li = load(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    order = ["_slot", *keys, *[c for c in li.columns if c not in keys], "_tie"]
    tie = F.floor(F.monotonically_increasing_id() / same_lines)
    cut = li.withColumn("_slot", F.expr(SLOT)).withColumn("_tie", tie).repartitionByRange(1 + li.count() // chunk_lines, *order)
    # the number of a row of a task is the task's, the chunk's, and from bit 33 down the row's in the task
    placed = stage_table(cut.sortWithinPartitions(*order[:-1]).withColumn("_at", F.monotonically_increasing_id()).select(*li.columns, "_at"), "lines")
    chunk, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(2 ** 33 - 1)
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    # one row a chunk
    sizes = placed.groupBy(chunk.alias("_chunk")).agg(F.count(F.lit(1)).alias("_n"))
    sizes = stage_table(sizes.select("_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")), "line_chunks")
    out = placed.join(F.broadcast(sizes), chunk == F.col("_chunk"))
    return out.select(*li.columns, (F.col("_before") + place + 1).alias("pos"))


def mart_log(spark: SparkSession, sf_dir: str, ordered: bool = True) -> DataFrame:
    """Sales log over the whole lineitem table: a first load that a truncate at seq 0
    undoes, then four phases:
    0 insert every line; 1 qty + 1 where returnflag A and linenumber 2;
    2 move to good l_suppkey where linestatus F and linenumber 3;
    3 delete where returnflag R and linenumber 4.
    Without ``ordered`` all changes of a phase share one seq: enough for sums, and no line is numbered."""
    li = lines(spark, sf_dir) if ordered else load(spark, sf_dir, "lineitem").withColumn("pos", F.lit(1).cast("long"))
    q = F.col("l_quantity").cast("int")
    pos = F.col("pos")
    upd = (F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 2)
    mov = (F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 3)
    dele = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 4)
    part = F.col("l_partkey")
    first = _change(li.where(F.col("l_linenumber") == 1), pos - F.lit(LINE_PHASE), "I", after=(part, q * 2))
    empty = spark.range(1).select(*[F.lit({"seq": 0, "op": "T"}.get(f.name)).cast(f.dataType).alias(f.name) for f in first.schema])
    return (first.unionByName(empty).unionByName(_change(li, pos, "I", after=(part, q)))
            .unionByName(_change(li.where(upd), F.lit(LINE_PHASE) + pos, "U", (part, q), (part, q + 1)))
            .unionByName(_change(li.where(mov), F.lit(2 * LINE_PHASE) + pos, "U", (part, q), (F.col("l_suppkey"), q)))
            .unionByName(_change(li.where(dele), F.lit(3 * LINE_PHASE) + pos, "D", before=(part, q))))


def price_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert every line in order of its position, then delete the returned lines
    (returnflag R).  Halfway through the inserts prices rise so far (see
    ``price_steps``) that many of the deletes exceed what the mart holds."""
    li = lines(spark, sf_dir)
    q = F.col("l_quantity").cast("int")
    return (_change(li, F.col("pos"), "I", after=(F.col("l_partkey"), q))
            .unionByName(_change(li.where(F.col("l_returnflag") == "R"), F.lit(LINE_PHASE) + F.col("pos"), "D",
                                 before=(F.col("l_partkey"), q))))


def price_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Goods with p_size <= 10 cost 20 times as much from half of the order keys on."""
    p = load(spark, sf_dir, "part").where(F.col("p_size") <= 10)
    li = load(spark, sf_dir, "lineitem")
    half = li.agg(F.floor(F.max("l_orderkey") / 2).alias("k"))
    # the position of the first line from there on; one row by construction, as is half
    first = li.crossJoin(F.broadcast(half)).agg((F.count_if(F.expr(SLOT) < F.col("k") * 8) + 1).alias("seq"))
    return p.crossJoin(F.broadcast(first)).select(
        F.col("p_partkey").alias("good_id"), F.col("seq"),
        (F.col("p_retailprice").cast(PRICE) * 20).cast(PRICE).alias("price"))


# ---------------------------------------------------------------- replica logs from events
ACCOUNT = "struct<account_id:bigint>"


def account_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replica start: one row per customer (account_id, balance, last_event)."""
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("account_id"), F.col("c_acctbal").cast(PRICE).alias("balance"),
        F.lit("base").alias("last_event"))


def event_log(events: DataFrame) -> DataFrame:
    """Change log from events: signup = insert, error = delete, others = update
    of the user's account row (key user_id, after image (balance, last_event))."""
    from ledgerlake.operators.changes import make_log
    op = (F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D")
          .otherwise("U"))
    return make_log(events, F.col("event_id"), op, {"account_id": F.col("user_id")},
                    {"balance": F.col("value").cast(PRICE), "last_event": F.col("event_type")},
                    commit_ts=F.col("ts"))


def truncated(log: DataFrame, seq: int) -> DataFrame:
    """The log with a TRUNCATE in place of the change at ``seq``."""
    t = log.where(F.col("seq") == seq).select(*[
        (F.lit("T") if c == "op" else F.lit(None) if c in ("key", "before", "after") else F.col(c)).cast(log.schema[c].dataType).alias(c)
        for c in log.columns])
    return log.where(F.col("seq") != seq).unionByName(t)


def segment_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of a table without a key, (segment, zone): every event inserts, deletes or moves
    one row; many find no row to delete."""
    names = F.array(*[F.lit(x) for x in ("AUTOMOBILE", "BUILDING", "MACHINERY", "nowhere")])
    img = F.struct(F.element_at(names, (F.col("user_id") % 4 + 1).cast("int")).alias("segment"), (F.col("event_id") % 3).cast("int").alias("zone"))
    new = F.struct(F.lit("moved").alias("segment"), (F.col("event_id") % 3).cast("int").alias("zone"))
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type").isin("error", "view"), "D").otherwise("U")
    ev = load(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("seq"), F.col("ts").alias("commit_ts"), op.alias("op"), F.lit(None).cast("struct<id:int>").alias("key"),
                     F.when(op != "I", img).alias("before"), F.when(op == "I", img).when(op == "U", new).alias("after"))
