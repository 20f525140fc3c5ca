"""Named queries: one per operator family of the inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole driver
tables; the matching DuckDB text lives in ``ledgerlake.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators import relational as R
from ledgerlake.plans import domain, loglines
from ledgerlake.sources.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@query("sales_report")
def sales_report(spark, d):
    return R.sales_report(domain.goods(spark, d), domain.sales(spark, d))


def _t(spark, d, name):
    return load(spark, d, name)


# ------------------------------------------------------------------ joins (J)
@query("inner_on")
def inner_on(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = _t(spark, d, "customer").select("c_custkey", "c_name")
    return o.join(c, o.o_custkey == c.c_custkey, "inner")


@query("inner_natural")
def inner_natural(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    c = _t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return R.natural_join(o, c, expect=["o_custkey"])


@query("inner_comma")
def inner_comma(spark, d):
    o, c, n = (_t(spark, d, x) for x in ("orders", "customer", "nation"))
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return j.select("o_orderkey", "c_name", "n_name")


@query("semi_orders")
def semi_orders(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return R.semi(o, _t(spark, d, "lineitem"), {"o_orderkey": "l_orderkey"})


@query("anti_orders")
def anti_orders(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return R.anti(o, _t(spark, d, "lineitem"), {"o_orderkey": "l_orderkey"})


@query("left_default")
def left_default(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey")
    last = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    j = R.left_with_default(o, last, {"o_orderkey": "l_orderkey"}, "last_ship", "not shipped yet!",
                            "last_ship_text")
    return j.select("o_orderkey", "last_ship_text")


def _boarding(li):
    """Lines as boarding passes: boarding_time is NULL for open lines."""
    return li.select("l_orderkey", "l_linenumber",
                     F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("boarding_time"))


@query("null_after_left")
def null_after_left(spark, d):
    o = _t(spark, d, "orders").where(F.col("o_orderstatus") == "P").select("o_orderkey")
    b = _boarding(_t(spark, d, "lineitem"))
    j = o.join(b, o.o_orderkey == b.l_orderkey, "left")
    return j.where(F.col("boarding_time").isNull()).select("o_orderkey", "l_linenumber")


@query("right_join")
def right_join(spark, d):
    n = _t(spark, d, "nation").where(F.col("n_name") >= "M")
    r = _t(spark, d, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "right").select("n_name", "r_name")


@query("cross_count")
def cross_count(spark, d):
    return R.cross_count(_t(spark, d, "customer"), _t(spark, d, "nation"))


@query("full_compare")
def full_compare(spark, d):
    pairs = _t(spark, d, "lineitem").select("l_suppkey", "l_partkey").distinct()
    return R.full_compare(pairs, "l_suppkey", 1, 2, "l_partkey", ["l_partkey"])


@query("lateral_lookup")
def lateral_lookup(spark, d):
    o = _t(spark, d, "orders").alias("o")
    c = _t(spark, d, "customer")
    sub = c.where(F.col("c_custkey") == F.col("o.o_custkey").outer()).select("c_name", "c_mktsegment")
    return o.lateralJoin(sub).select("o_orderkey", "c_name", "c_mktsegment")


@query("boarding_call")
def boarding_call(spark, d):
    f = _t(spark, d, "orders").where(F.col("o_orderstatus") == "P")
    s = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    c = _t(spark, d, "customer").select("c_custkey", "c_name")
    bp = _boarding(_t(spark, d, "lineitem").where(F.col("l_returnflag") == "N")).select(
        F.col("l_orderkey").alias("bp_orderkey"), F.col("l_linenumber").alias("bp_linenumber"),
        "boarding_time")
    j = (f.join(s, s.l_orderkey == f.o_orderkey)
         .join(c, c.c_custkey == f.o_custkey)
         .join(bp, (bp.bp_orderkey == s.l_orderkey) & (bp.bp_linenumber == s.l_linenumber), "left")
         .where(F.col("boarding_time").isNull()))
    j = R.sort(j, [("o_orderdate", "desc")])
    return j.select("c_custkey", "c_name", "l_orderkey", "l_linenumber",
                    F.coalesce(F.date_format("boarding_time", "yyyy-MM-dd HH:mm:ss"),
                               F.lit("not boarded yet!")).alias("boarding"))


@query("join_strategies")
def join_strategies(spark, d):
    """The same join under each strategy gives the same rows."""
    out = None
    for strategy in ("broadcast", "merge", "shuffle_hash"):
        li = _t(spark, d, "lineitem").select("l_orderkey", "l_extendedprice")
        o = _t(spark, d, "orders").select("o_orderkey")
        j = R.hinted_join(li, o, li.l_orderkey == o.o_orderkey, "inner", strategy)
        agg = j.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("revenue"))
        agg = agg.select(F.lit(R.usable_strategy(o, strategy)).alias("strategy"), "n", "revenue")
        out = agg if out is None else out.unionByName(agg)
    return out


# ------------------------------------------------------------------ filters (P)
@query("point")
def point(spark, d):
    return R.point_lookup(_t(spark, d, "customer"), "c_name", "Customer#000000042")


@query("prefix")
def prefix(spark, d):
    return R.prefix_search(_t(spark, d, "customer"), "c_name", "Customer#0000001")


@query("infix")
def infix(spark, d):
    return R.substring_search(_t(spark, d, "documents"), "text", "mentoi").select("doc_id", "lang")


@query("ci_match")
def ci_match(spark, d):
    return R.ci_lookup(_t(spark, d, "customer"), "c_name", "customer#000000042")


@query("compound")
def compound(spark, d):
    o = _t(spark, d, "orders")
    return o.where((F.col("o_orderstatus") == "F")
                   & (F.col("o_orderdate") > F.lit("1996-01-01 00:00:00").cast("timestamp_ntz"))
                   & (F.col("o_orderdate") < F.lit("1996-03-01 00:00:00").cast("timestamp_ntz")))


@query("between_day")
def between_day(spark, d):
    o = _t(spark, d, "orders")
    lo = F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit("1996-01-05 00:00:00").cast("timestamp_ntz")
    return o.where(F.col("o_orderdate").between(lo, hi))


@query("in_list")
def in_list(spark, d):
    return R.in_list(_t(spark, d, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"]) \
        .select("o_orderkey", "o_orderpriority")


@query("regex_out")
def regex_out(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "source", "lang")
    return R.regex_exclude(docs, "source", "^src1").where(F.col("lang") != "en")


@query("distinct_status")
def distinct_status(spark, d):
    return _t(spark, d, "orders").select("o_orderstatus").distinct()


@query("distinct_pairs")
def distinct_pairs(spark, d):
    return _t(spark, d, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query("top_orders")
def top_orders(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return R.top(o, 10, [("o_totalprice", "desc"), "o_orderkey"])


@query("except_days")
def except_days(spark, d):
    a = _t(spark, d, "orders").select(F.to_date("o_orderdate").alias("d"))
    b = _t(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("d"))
    return R.except_distinct(a, b)


@query("minus_alias")
def minus_alias(spark, d):
    o = _t(spark, d, "orders")
    c = _t(spark, d, "customer")
    return spark.sql("SELECT o_custkey AS k FROM {o} MINUS "
                     "SELECT c_custkey AS k FROM {c} WHERE c_mktsegment = 'BUILDING'", o=o, c=c)


@query("bounds")
def bounds(spark, d):
    return R.bounds(_t(spark, d, "orders"), "o_orderdate")


@query("joined_length")
def joined_length(spark, d):
    c = _t(spark, d, "customer")
    return R.joined_length(c, F.concat(F.col("c_custkey").cast("string"), F.col("c_name")))


@query("profile_rows")
def profile_rows(spark, d):
    c = _t(spark, d, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(12,2)"))
    return R.table_profile(c, ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
                           {"name_bytes": F.sum(F.length("c_name"))})


@query("cte_chain")
def cte_chain(spark, d):
    names = R.regex_exclude(_t(spark, d, "customer").select("c_name", "c_mktsegment"),
                            "c_mktsegment", "^AUTO").where(F.col("c_mktsegment") != "BUILDING")
    return names.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ scalar (F)
@query("size_pretty")
def size_pretty_q(spark, d):
    from ledgerlake.functions.scalar import size_pretty
    o = _t(spark, d, "orders")
    b = (F.round("o_totalprice").cast("long") * F.col("o_orderkey"))
    return o.select("o_orderkey", b.alias("bytes"), size_pretty(b).alias("pretty"))


@query("day_trunc")
def day_trunc(spark, d):
    from ledgerlake.functions.scalar import day
    return (_t(spark, d, "orders").groupBy(day("o_orderdate").alias("day"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("case_nullif")
def case_nullif(spark, d):
    from ledgerlake.functions.scalar import ratio_pct
    o = _t(spark, d, "orders")
    state = (F.when(F.col("o_orderstatus") == "F", "finished")
             .when(F.col("o_orderstatus") == "O", "open").otherwise("other"))
    g = o.groupBy("o_orderpriority").agg(
        F.sum(F.when(state == "finished", 1).otherwise(0)).cast("long").alias("finished"),
        F.sum(F.when(state != "finished", 1).otherwise(0)).cast("long").alias("unfinished"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("_total"))
    return g.select("o_orderpriority", "finished", "unfinished",
                    ratio_pct("finished", "unfinished").alias("pct"),
                    (F.col("_total") / F.nullif(F.col("finished"), F.lit(0))).cast("decimal(18,2)")
                    .alias("per_finished"))


@query("series_md5")
def series_md5(spark, d):
    from ledgerlake.sources.tables import series
    o = _t(spark, d, "orders").select("o_orderkey")
    s = series(spark, 1, o.agg(F.coalesce(F.max("o_orderkey"), F.lit(0))).first()[0])
    keys = s.join(o, s.i == o.o_orderkey).select("i")       # the series' numbers that are keys
    return keys.select("i", F.md5(F.col("i").cast("string")).alias("h"))


@query("synth_rows")
def synth_rows(spark, d):
    """As many made-up rows as the orders' keys reach, joined to the orders."""
    from ledgerlake.sources.tables import synth_rows as synth
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey")
    rows = synth(spark, 1, o.agg(F.coalesce(F.max("o_orderkey"), F.lit(0))).first()[0])
    return rows.join(o, rows.id == o.o_orderkey).select("id", "random_text", "o_custkey")


@query("views_sql")
def views_sql(spark, d):
    """the driver tables as views, read by a qualified query."""
    from ledgerlake.sources.tables import register_views
    register_views(spark, d, ["customer", "nation"])
    return spark.sql("SELECT n.n_name, count(*) AS customers FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name")


# ------------------------------------------------------------------ DML (T)
@query("update_where")
def update_where(spark, d):
    from ledgerlake.operators.dml import update
    o = _t(spark, d, "orders")
    pred = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 300000)
    return update(o, pred, {"o_orderstatus": F.lit("F"), "o_orderpriority": F.lit("1-URGENT")})


@query("bulk_rewrite")
def bulk_rewrite(spark, d):
    from ledgerlake.operators.dml import repeat_update
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return repeat_update(o, "o_orderpriority", "x", 20)


@query("update_from")
def update_from(spark, d):
    from ledgerlake.operators.dml import add_column, update_from as upd
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    o = add_column(add_column(o, "n_lines", "bigint"), "total_qty", "bigint")
    src = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("int")).cast("long").alias("q"))
    return upd(o, src, {"o_orderkey": "l_orderkey"}, {"n_lines": "n", "total_qty": "q"})


@query("delete_where")
def delete_where(spark, d):
    from ledgerlake.operators.dml import delete
    o = _t(spark, d, "orders")
    return delete(o, (F.col("o_orderpriority") == "5-LOW") & (F.col("o_totalprice") < 100000))


def _merge_input(spark, d):
    from ledgerlake.operators.dml import Clause
    t = (_t(spark, d, "customer").where(F.col("c_mktsegment") != "BUILDING")
         .select("c_custkey", "c_name", F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal"),
                 "c_mktsegment"))
    s = (_t(spark, d, "orders").where(F.col("o_orderstatus") == "F").groupBy("o_custkey")
         .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("delta"),
              F.count(F.lit(1)).alias("n")))
    clauses = [
        Clause("matched", "delete", F.col("src_n") >= 8),
        Clause("matched", "update", None, {"c_acctbal": F.col("c_acctbal") + F.col("src_delta")}),
        Clause("not_matched", "insert", None, {"c_custkey": F.col("src_o_custkey"),
                                               "c_name": F.lit("new customer"),
                                               "c_acctbal": F.col("src_delta"),
                                               "c_mktsegment": F.lit("BUILDING")}),
    ]
    return t, s, clauses


@query("merge_clauses")
def merge_clauses(spark, d):
    from ledgerlake.operators.dml import merge
    target, source, clauses = _merge_input(spark, d)
    return merge(target, source, {"c_custkey": "o_custkey"}, clauses)


# ------------------------------------------------------------------ io (S) and checks (V)
def _scratch(spark, name):
    from ledgerlake.session import scratch_path
    return scratch_path(spark, name)


@query("copy_roundtrip")
def copy_roundtrip(spark, d):
    from ledgerlake.schemas import DRIVER
    from ledgerlake.sources.io import copy_in, copy_out
    path = copy_out(_t(spark, d, "customer"), _scratch(spark, "copy"))
    return copy_in(spark, path, DRIVER["customer"])


@query("export_restore")
def export_restore(spark, d):
    from ledgerlake.sources.io import export_schema, restore
    path = _scratch(spark, "export")
    export_schema(spark, {n: _t(spark, d, n) for n in ("customer", "nation", "region")}, path)
    restored = restore(spark, path, ["customer"])
    if set(restored) != {"customer"}:
        raise AssertionError("selective restore brought back other tables")
    return restored["customer"]


@query("restore_catalog")
def restore_catalog(spark, d):
    """S11 into a database of the catalog; the tables that were not asked for stay absent."""
    import uuid
    from ledgerlake.sources.bucketed import restore_tables
    from ledgerlake.sources.io import export_schema
    path, db = _scratch(spark, "export"), f"restored_{uuid.uuid4().hex[:8]}"
    export_schema(spark, {n: _t(spark, d, n) for n in ("customer", "nation", "region")}, path)
    restore_tables(spark, path, ["nation", "region"], db)
    names = sorted(t.name for t in spark.catalog.listTables(db))
    rows = spark.table(f"{db}.nation").join(spark.table(f"{db}.region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select("n_name", "r_name", F.lit(",".join(names)).alias("tables"))


@query("bucketed_join")
def bucketed_join(spark, d):
    """Orders and lines bucketed by the order's key, joined and summed without a shuffle."""
    from ledgerlake.sources.bucketed import bucket_count, save_bucketed
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    li = _t(spark, d, "lineitem").select("l_orderkey", F.col("l_quantity").cast("int").alias("qty"))
    buckets = bucket_count(o, li, least=8)
    o, li = save_bucketed(o, ["o_orderkey"], buckets), save_bucketed(li, ["l_orderkey"], buckets)
    return o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_orderkey", "o_custkey", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("qty").alias("total_qty"))


@query("tree_diff")
def tree_diff_q(spark, d):
    """V1 by digests: only ranges that differ are compared row by row."""
    from ledgerlake.operators.digests import tree_diff
    return tree_diff(_t(spark, d, "orders"), update_where(spark, d), ["o_orderkey"])


@query("table_diff")
def table_diff_q(spark, d):
    from ledgerlake.operators.checks import table_diff
    return table_diff(_t(spark, d, "orders"), update_where(spark, d))


@query("rule_violations")
def rule_violations(spark, d):
    from ledgerlake.operators.checks import check_rows
    li = _t(spark, d, "lineitem")
    rules = {
        "quantity_positive": F.col("l_quantity") > 0,
        "discount_range": F.col("l_discount").between(0.0, 0.1),
        "tax_not_above_discount": F.col("l_tax") <= F.col("l_discount"),
        "flag_domain": F.col("l_returnflag").isin("A", "N", "R"),
        "shipped_after_1996": F.col("l_shipdate") >= F.lit("1996-01-01 00:00:00").cast("timestamp_ntz"),
    }
    return check_rows(li, rules, ["l_orderkey", "l_linenumber"])


@query("dup_keys")
def dup_keys(spark, d):
    from ledgerlake.operators.checks import check_unique
    return check_unique(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("fk_orphans")
def fk_orphans(spark, d):
    from ledgerlake.operators.checks import check_fk
    o, c, li = (_t(spark, d, x) for x in ("orders", "customer", "lineitem"))
    a = check_fk(o, c, {"o_custkey": "c_custkey"}).select(F.lit("orders_customer").alias("fk"),
                                                          F.col("o_orderkey").alias("k"))
    b = check_fk(o, li, {"o_orderkey": "l_orderkey"}).select(F.lit("orders_have_lines").alias("fk"),
                                                             F.col("o_orderkey").alias("k"))
    return a.unionByName(b)


@query("fingerprints")
def fingerprints(spark, d):
    from ledgerlake.operators.checks import fingerprint
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.to_date("o_orderdate").alias("day"),
                                      F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    return fingerprint(o, "o_orderstatus")


@query("checked_load")
def checked_load(spark, d):
    from ledgerlake.operators.checks import assert_counts, is_equal
    from ledgerlake.sources.versioned import VersionedTable
    src = _t(spark, d, "customer")
    t = VersionedTable(spark, _scratch(spark, "checked"))
    t.commit_if(src, [lambda w: assert_counts(w, src),
                      lambda w: None if is_equal(w, src) else (_ for _ in ()).throw(ValueError("diff"))])
    return t.read()


@query("migrate_enrich")
def migrate_enrich(spark, d):
    from ledgerlake.operators.relational import enrich
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    o = _t(spark, d, "orders")
    return enrich(li, o, {"l_orderkey": "o_orderkey"}, ["o_orderdate", "o_custkey"], check_count=True)


@query("upper_layout")
def upper_layout(spark, d):
    from ledgerlake.operators.layout import layout
    from ledgerlake.operators.relational import ci_lookup
    c = _t(spark, d, "customer")
    path = layout(c, ["c_name_upper"], _scratch(spark, "layout"), {"c_name_upper": F.upper("c_name")})
    stored = spark.read.schema(c.schema.add("c_name_upper", "string")).parquet(path)
    return ci_lookup(stored, "c_name", "customer#000000042", stored_upper="c_name_upper").drop("c_name_upper")


@query("trigram_find")
def trigram_find(spark, d):
    from ledgerlake.operators.layout import read_trigram_index, trigram_search, write_trigram_index
    docs = _t(spark, d, "documents")
    path = _built(spark, d, "trigram", lambda p: write_trigram_index(docs, "doc_id", "text", p), "documents")
    index = read_trigram_index(spark, path, "doc_id")
    return trigram_search(spark, index, docs, "doc_id", "text", "mentoi").select("doc_id")


#: Substrings that ``trigram_appended`` looks for: rare, common, with blanks, folded.
PATTERNS = ("mentoi", "tion", "a b", "Ent", "zzyqx")


@query("trigram_appended")
def trigram_appended(spark, d):
    """T8 under upkeep: a first load and three batches, found through the parts of the index."""
    from functools import reduce

    from ledgerlake.sources.gramindex import GramIndex
    docs = _t(spark, d, "documents").select("doc_id", "text")
    index = GramIndex(spark, _scratch(spark, "grams"), "doc_id", "text")
    turn = F.pmod(F.xxhash64("doc_id"), F.lit(12))      # 9, 1, 1 and 1 of twelve shares
    for batch in (turn < 9, turn == 9, turn == 10, turn == 11):
        index.append(docs.where(batch))
    return reduce(DataFrame.unionByName, [index.search(docs, p).select(F.lit(p).alias("pattern"), "doc_id") for p in PATTERNS])


# ------------------------------------------------------------------ partitions
def _order_spec():
    import datetime as dt
    from ledgerlake.operators.partitions import PartitionSpec
    bounds = PartitionSpec.monthly(dt.datetime(1995, 1, 1), dt.datetime(2000, 1, 1))
    return PartitionSpec.range("o_orderdate", bounds, default="p_default")


_BUILT: dict[tuple, str] = {}


def _built(spark, d, name, build, table):
    """Path of a layout of a driver table: built at first use in an application, and again when
    the table's files have changed."""
    from ledgerlake.sources import fs
    key = (spark.sparkContext.applicationId, d, name, fs.signature(spark, f"{d.rstrip('/')}/{table}.parquet"))
    if key not in _BUILT:
        path = _scratch(spark, name)
        build(path)
        _BUILT[key] = path
    return _BUILT[key]


def _write_orders(spark, d, path):
    from ledgerlake.operators.partitions import write_partitioned
    return write_partitioned(spark, _t(spark, d, "orders"), _order_spec(), path)


def _orders_partitioned(spark, d):
    from ledgerlake.operators.partitions import PartitionedTable
    path = _built(spark, d, "orders_part", lambda p: _write_orders(spark, d, p), "orders")
    return PartitionedTable(spark, path, _order_spec())


@query("range_part")
def range_part(spark, d):
    return _orders_partitioned(spark, d).read_partition("p1996_03")


@query("default_part")
def default_part(spark, d):
    return _orders_partitioned(spark, d).read_partition("p_default")


@query("pruned_read")
def pruned_read(spark, d):
    import datetime as dt
    t = _orders_partitioned(spark, d)
    return t.read_pruned(dt.datetime(1996, 3, 15), dt.datetime(1996, 5, 10, 12, 0))


@query("zoned_read")
def zoned_read(spark, d):
    """T9, T13 in a zone: daily bounds at +03, an irregular last one and DEFAULT; the read
    goes over two local midnights."""
    import datetime as dt
    from ledgerlake.operators.partitions import PartitionedTable, PartitionSpec, write_partitioned
    days = PartitionSpec.daily(dt.datetime(1996, 1, 1), dt.datetime(1996, 2, 1))
    spec = PartitionSpec.range("placed_at", [*days, ("p_rest", dt.datetime(1996, 2, 1), dt.datetime(1996, 11, 1))], zone="Europe/Moscow")
    # several hours of the day: order times are at midnight
    o = _t(spark, d, "orders").select("o_orderkey", F.timestamp_micros(
        F.unix_micros(F.col("o_orderdate").cast("timestamp")) + (F.col("o_orderkey") % 24) * 3_600_000_000).alias("placed_at"))
    path = _built(spark, d, "orders_zoned", lambda p: write_partitioned(spark, o, spec, p), "orders")
    t = PartitionedTable(spark, path, spec).read_pruned(dt.datetime(1996, 1, 14, 20, 30), dt.datetime(1996, 1, 16, 22, 0), with_part=True)
    return t.select("o_orderkey", F.col("placed_at").cast("timestamp_ntz").alias("placed_at"), "part")


# ------------------------------------------------------------------ tables by file
#: Files of the small copies of driver tables.
FILES = 32


@query("compound_zones")
def compound_zones(spark, d):
    """The compound filter over orders laid out by three columns; files are chosen by the zones of two."""
    import datetime as dt
    from ledgerlake.sources.filetable import FileTable
    cols = ["o_orderstatus", "o_orderdate", "o_custkey"]
    path = _built(spark, d, "orders_zones", lambda p: FileTable(spark, p).create(_t(spark, d, "orders"), cols, cols, FILES), "orders")
    lo, hi = dt.datetime(1996, 1, 1), dt.datetime(1996, 3, 1)
    got = FileTable(spark, path).read({"o_orderstatus": ("F", "F"), "o_orderdate": (lo, hi)})
    return got.where((F.col("o_orderdate") > F.lit(lo)) & (F.col("o_orderdate") < F.lit(hi)))


def _orders_by_file(spark, d, name):
    from ledgerlake.sources.filetable import FileTable
    return FileTable(spark, _scratch(spark, name)).create(_t(spark, d, "orders"), ["o_totalprice", "o_orderdate"], ["o_totalprice"], FILES)


@query("update_files")
def update_files(spark, d):
    """T1 by file: only files whose zones reach above the price are searched."""
    t = _orders_by_file(spark, d, "update_files")
    t.update((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 300000),
             {"o_orderstatus": F.lit("F"), "o_orderpriority": F.lit("1-URGENT")}, within={"o_totalprice": (300000.0, None)})
    return t.read()


@query("delete_files")
def delete_files(spark, d):
    """T4 by file."""
    t = _orders_by_file(spark, d, "delete_files")
    t.delete((F.col("o_orderpriority") == "5-LOW") & (F.col("o_totalprice") < 100000), within={"o_totalprice": (None, 100000.0)})
    return t.read()


@query("merge_files")
def merge_files(spark, d):
    """T5 by file: the MERGE of ``merge_clauses`` on a table of many files."""
    from ledgerlake.sources.filetable import FileTable
    target, source, clauses = _merge_input(spark, d)
    t = FileTable(spark, _scratch(spark, "merge_files")).create(target, ["c_custkey"], ["c_custkey"], FILES)
    t.merge(source, {"c_custkey": "o_custkey"}, clauses)
    return t.read()


@query("read_sound")
def read_sound(spark, d):
    """V7: a table by file from which the files of one load are lost: what is left is read, and the report names as many
    lost rows as the load had."""
    from ledgerlake.sources import fs
    from ledgerlake.sources.filetable import FileTable
    o = _t(spark, d, "orders")
    t = FileTable(spark, _scratch(spark, "read_sound")).create(o.where(F.col("o_orderstatus") != "P"), ["o_orderkey"])
    sound = {r.file for r in t.files().select("file").collect()}
    t.append(o.where(F.col("o_orderstatus") == "P"))
    for name in {r.file for r in t.files().select("file").collect()} - sound:
        fs.delete(spark, f"{t.root}/{name}")
    rows, report = t.read_sound()
    lost = report.agg(F.coalesce(F.sum(F.col("rows") - F.col("rows_read")), F.lit(0)).alias("lost"))
    return rows.crossJoin(F.broadcast(lost))       # one row by construction


@query("moved_rows")
def moved_rows(spark, d):
    t = _write_orders(spark, d, _scratch(spark, "orders_moved"))
    where = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
    t.update(where, {"o_orderdate": F.col("o_orderdate") + F.expr("INTERVAL 400 DAYS")})
    return t.read(with_part=True).select("o_orderkey", "o_orderdate", "part")


@query("list_part")
def list_part(spark, d):
    from ledgerlake.operators.partitions import PartitionSpec, write_partitioned
    spec = PartitionSpec.list("l_returnflag", {"accepted": ["A"], "none": ["N"], "returned": ["R"]})
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    t = write_partitioned(spark, li, spec, _scratch(spark, "lines_part"))
    return t.read_partition("returned")


@query("hash_part")
def hash_part(spark, d):
    from ledgerlake.operators.partitions import PartitionSpec, write_partitioned
    t = write_partitioned(spark, _t(spark, d, "orders"), PartitionSpec.hash("o_custkey", 10),
                          _scratch(spark, "orders_hash"))
    return t.read_key(42)


# ------------------------------------------------------------------ mart (M3-M5)
@query("mart_delta")
def mart_delta(spark, d):
    from ledgerlake.operators import mart
    return mart.mart_apply(spark, domain.mart_log(spark, d, ordered=False), mart.price_history(domain.goods(spark, d)), "delta")


@query("mart_exact")
def mart_exact(spark, d):
    from ledgerlake.operators import mart
    return mart.mart_apply(spark, domain.mart_log(spark, d), mart.price_history(domain.goods(spark, d)), "exact")


@query("mart_price_change")
def mart_price_change(spark, d):
    from ledgerlake.operators import mart
    prices = mart.price_history(domain.goods(spark, d), domain.price_steps(spark, d))
    return mart.mart_apply(spark, domain.price_change_log(spark, d), prices, "exact")


# ------------------------------------------------------------------ replicas
AS_OF = "2024-01-15 00:00:00"


@query("replica_apply")
def replica_apply(spark, d):
    from ledgerlake.operators.changes import apply_changes
    return apply_changes(domain.account_base(spark, d), domain.event_log(_t(spark, d, "events")))


@query("as_of_view")
def as_of_view(spark, d):
    from ledgerlake.operators.changes import as_of
    log = domain.event_log(_t(spark, d, "events"))
    return as_of(domain.account_base(spark, d), log,
                 F.col("commit_ts") <= F.lit(AS_OF).cast("timestamp_ntz"))


@query("as_of_archive")
def as_of_archive(spark, d):
    """M7 from stored states: the account table as of the last change up to a time, from the nearest state before it."""
    from ledgerlake.sources.archive import LogArchive
    log = domain.event_log(_t(spark, d, "events"))
    low, high, n = log.agg(F.min("seq"), F.max("seq"), F.count(F.lit(1))).first()
    archive = LogArchive(spark, _scratch(spark, "archive"), every=1 + (n or 0) // 5).create(domain.account_base(spark, d), log.schema)
    half = (low + high) // 2 if n else 0
    archive.append(log.where(F.col("seq") <= half))
    archive.append(log.where(F.col("seq") > half))
    upto = log.where(F.col("commit_ts") <= F.lit(AS_OF).cast("timestamp_ntz")).agg(F.max("seq")).first()[0]
    return archive.as_of(-1 if upto is None else upto)


@query("merged_replicas")
def merged_replicas(spark, d):
    from ledgerlake.operators.changes import apply_changes
    ev = _t(spark, d, "events")
    empty = domain.account_base(spark, d).where(F.lit(False))
    first = ev.where(F.col("event_type").isin("click", "view"))
    second = ev.where(~F.col("event_type").isin("click", "view"))
    return R.merge_sources({"node1": apply_changes(empty, domain.event_log(first)),
                          "node2": apply_changes(empty, domain.event_log(second))})


def _summaries(spark, d):
    """An older and a newer state of a per-user summary."""
    ev = _t(spark, d, "events")

    def summary(df):
        return df.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"),
                                         F.sum(F.col("value").cast("decimal(12,2)")).cast("decimal(18,2)").alias("total"))
    before = summary(ev.where((F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
                              & (F.col("event_type") != "error")))
    after = summary(ev.where(F.col("ts") >= F.lit("2024-01-05").cast("timestamp_ntz")))
    return before, after


@query("publish_diff")
def publish_diff(spark, d):
    from ledgerlake.operators.changes import publish
    ch = publish(*_summaries(spark, d), ["user_id"])
    return ch.select("op", "key.user_id", F.col("before.n").alias("before_n"), F.col("before.total").alias("before_total"),
                     F.col("after.n").alias("after_n"), F.col("after.total").alias("after_total"))


@query("publish_apply")
def publish_apply(spark, d):
    """S14 -> M1: applying the published changes to the older state gives the newer one."""
    from ledgerlake.operators.changes import apply_changes, publish
    before, after = _summaries(spark, d)
    return apply_changes(before, publish(before, after, ["user_id"]))


@query("replica_truncated")
def replica_truncated(spark, d):
    """M1 with a TRUNCATE in the middle of the log."""
    from ledgerlake.operators.changes import apply_changes
    log = domain.event_log(_t(spark, d, "events"))
    return apply_changes(domain.account_base(spark, d), domain.truncated(log, _middle_event(spark, d)))


def _middle_event(spark, d):
    return _t(spark, d, "events").agg(F.floor((F.min("event_id") + F.max("event_id")) / 2)).first()[0]


@query("replica_full")
def replica_full(spark, d):
    """M1 with replica identity 'full' on a table with duplicate rows."""
    from ledgerlake.operators.changes import apply_changes
    base = _t(spark, d, "customer").select(F.col("c_mktsegment").alias("segment"), (F.col("c_nationkey") % 3).cast("int").alias("zone"))
    return apply_changes(base, domain.segment_log(spark, d), "full")


@query("churn")
def churn(spark, d):
    from ledgerlake.operators.changes import churn_report
    return churn_report(domain.event_log(_t(spark, d, "events")))


# ------------------------------------------------------------------ ledger (M6)
def _history(spark, d):
    ev = _t(spark, d, "events")
    return ev.select(F.col("user_id").alias("aid"), F.col("event_type").alias("tid"),
                     F.to_date("ts").cast("string").alias("bid"),
                     F.col("value").cast("decimal(12,2)").alias("delta"), "ts", "event_id")


def _accounts(spark, d):
    return _t(spark, d, "customer").select(F.col("c_custkey").alias("aid"),
                                           F.col("c_acctbal").cast("decimal(12,2)").alias("balance"))


@query("ledger_balances")
def ledger_balances(spark, d):
    from ledgerlake.operators.ledger import ledger_apply
    lv = ledger_apply(_accounts(spark, d), None, None, _history(spark, d))
    out = None
    for level, df in lv.items():
        x = df.select(F.lit(level).alias("level"), F.col(df.columns[0]).cast("string").alias("id"), "balance")
        out = x if out is None else out.unionByName(x)
    return out


@query("ledger_running")
def ledger_running(spark, d):
    from ledgerlake.operators.ledger import running_balance
    r = running_balance(_history(spark, d), _accounts(spark, d))
    return r.select("event_id", F.col("aid").alias("user_id"), "balance")


# ------------------------------------------------------------------ reports
def _log_text(spark, d, name):
    """Folder of a stored text log."""
    lines = {"checkpoints": loglines.checkpoint_lines, "locks": loglines.lock_lines, "progress": loglines.progress_lines}[name]
    return _built(spark, d, f"log_{name}", lambda p: lines(_t(spark, d, "events")).write.text(p), "events")


def _samples(spark, d):
    path = _built(spark, d, "log_samples", lambda p: loglines.wal_samples(_t(spark, d, "events")).write.parquet(p), "events")
    return spark.read.schema("source string, sample_ts timestamp_ntz, lsn_position string").parquet(path)


@query("log_volume")
def log_volume(spark, d):
    from ledgerlake.operators import reports
    return reports.log_volume(_samples(spark, d)).drop("source")


@query("log_summary")
def log_summary(spark, d):
    from ledgerlake.operators import reports
    return reports.log_volume_summary(reports.log_volume(_samples(spark, d)))


@query("log_summary_at")
def log_summary_at(spark, d):
    """The windows before a given time."""
    import datetime as dt
    from ledgerlake.operators import reports
    return reports.log_volume_summary(reports.log_volume(_samples(spark, d)).where(F.col("sample_ts") <= F.lit(dt.datetime(2024, 1, 15))),
                                      now=dt.datetime(2024, 1, 15))


@query("checkpoints")
def checkpoints(spark, d):
    from ledgerlake.operators import reports
    return reports.checkpoint_report(reports.read_log(spark, _log_text(spark, d, "checkpoints")), 1800)


@query("checkpoint_summary")
def checkpoint_summary(spark, d):
    from ledgerlake.operators import reports
    return reports.checkpoint_summary(checkpoints(spark, d))


@query("lock_waits")
def lock_waits(spark, d):
    from ledgerlake.operators import reports
    return reports.lock_waits(reports.read_log(spark, _log_text(spark, d, "locks")))


@query("log_records")
def log_records(spark, d):
    """Whole records of the stored lock log."""
    from ledgerlake.operators.logrecords import log_records as records
    return records(spark, _log_text(spark, d, "locks")).select("ts", "pid", "level", "message", "detail", "statement")


@query("chains")
def chains(spark, d):
    from ledgerlake.operators import reports
    return reports.blocking_chains(spark, loglines.wait_edges(_t(spark, d, "events")))


@query("load_report")
def load_report(spark, d):
    from ledgerlake.operators import reports
    return reports.load_report(reports.read_log(spark, _log_text(spark, d, "progress")), "click")


# ------------------------------------------------------------------ streams (M2, M4, M8)
def _in_batches(rows, slices, root, job):
    """Append slices of ``rows`` to a folder one after the other; after each, ``job`` reads
    on from its checkpoint.  Returns the last result."""
    from ledgerlake.streaming.jobs import file_stream
    out = None
    for part in slices:
        rows.where(part).write.mode("append").parquet(f"{root}/in")
        out = job(file_stream(rows.sparkSession, f"{root}/in", rows.schema))
    return out


@query("replica_stream")
def replica_stream(spark, d):
    from ledgerlake.streaming.jobs import replicate_stream
    root = _scratch(spark, "replica_stream")
    m = _middle_event(spark, d)
    t = _in_batches(domain.event_log(_t(spark, d, "events")), [F.col("seq") < m, F.col("seq") >= m], root,
                    lambda s: replicate_stream(spark, s, domain.account_base(spark, d), f"{root}/table", f"{root}/_checkpoint"))
    return t.read()


@query("changes_after")
def changes_after(spark, d):
    """S13 without the initial copy: only changes after a start position reach an empty replica."""
    from ledgerlake.streaming.jobs import read_changes, replicate_stream
    root = _scratch(spark, "changes_after")
    log = domain.event_log(_t(spark, d, "events"))
    log.write.parquet(f"{root}/in")
    changes = read_changes(spark, f"{root}/in", log.schema, start_seq=_middle_event(spark, d))
    empty = domain.account_base(spark, d).where(F.lit(False))
    return replicate_stream(spark, changes, empty, f"{root}/table", f"{root}/_checkpoint").read()


def _log_phases():
    seq, one = F.col("seq"), domain.LINE_PHASE
    return [seq <= 0, (seq > 0) & (seq < one), (seq >= one) & (seq < 3 * one), seq >= 3 * one]


@query("mart_stream")
def mart_stream(spark, d):
    from ledgerlake.operators import mart
    from ledgerlake.streaming.jobs import mart_stream as ms
    root = _scratch(spark, "mart_stream")
    prices = mart.price_history(domain.goods(spark, d))
    return _in_batches(domain.mart_log(spark, d, ordered=False), _log_phases(), root,
                       lambda s: ms(spark, s, prices, f"{root}/mart", f"{root}/_checkpoint"))


@query("mart_stream_exact")
def mart_stream_exact(spark, d):
    """M3 as a stream over the lineitem-derived sales log."""
    from ledgerlake.operators import mart
    from ledgerlake.streaming.jobs import mart_stream_exact as mse
    root = _scratch(spark, "mart_stream_exact")
    prices = mart.price_history(domain.goods(spark, d))
    t = _in_batches(domain.mart_log(spark, d), _log_phases(), root,
                    lambda s: mse(spark, s, prices, f"{root}/mart", f"{root}/_checkpoint"))
    return t.read()


@query("mart_stream_state")
def mart_stream_state(spark, d):
    """M3, U1 as keyed state: four starts from one checkpoint."""
    from ledgerlake.operators import mart
    from ledgerlake.streaming.jobs import file_stream
    from ledgerlake.streaming.state import mart_stream_state as mss
    root = _scratch(spark, "mart_stream_state")
    prices = mart.price_history(domain.goods(spark, d))
    log = domain.mart_log(spark, d)
    return _in_batches(log, _log_phases(), root, lambda _: mss(
        spark, file_stream(spark, f"{root}/in", log.schema), spark.read.schema(log.schema).parquet(f"{root}/in"), prices,
        f"{root}/mart", f"{root}/_checkpoint"))


#: Bucket size of the small replica tables, for several splits at every scale.
SMALL_BUCKET = 16 << 10


def _replica_in_batches(spark, d):
    """M2: the accounts kept by a merge-on-read table, from the event log in six batches."""
    from ledgerlake.sources.keyed import KeyedTable, upserts
    log = domain.event_log(_t(spark, d, "events"))
    low, high = log.agg(F.min("seq"), F.max("seq")).first()
    table = KeyedTable(spark, _scratch(spark, "replica_batches"), SMALL_BUCKET).start(domain.account_base(spark, d), ["account_id"])
    step = (high - low) // 6 + 1 if low is not None else 1
    for n in range(6 if low is not None else 0):
        batch = log.where((F.col("seq") >= low + n * step) & (F.col("seq") < low + (n + 1) * step))
        rows, truncate = upserts(batch, table)
        table.append(rows, n, truncate)
        table.compact()
    return table


@query("subscribed_replicas")
def subscribed_replicas(spark, d):
    """Two publishers in one reader, each copied at a position of its log and followed from there."""
    from ledgerlake.streaming.subscribe import Reader, follow_folders, take_snapshot
    root, ev = _scratch(spark, "subscribed"), _t(spark, d, "events")
    empty = domain.account_base(spark, d).where(F.lit(False))
    kinds = F.col("event_type").isin("click", "view")
    logs = {"node1": domain.event_log(ev.where(kinds)), "node2": domain.event_log(ev.where(~kinds))}
    middle = _middle_event(spark, d)
    reader = Reader(spark, f"{root}/reader", empty.schema, ["account_id"])
    for name, log in logs.items():
        log.where(F.col("seq") < middle).write.parquet(f"{root}/{name}")
        take_snapshot(empty, spark.read.schema(log.schema).parquet(f"{root}/{name}"), f"{root}/copy-{name}")
        log.where(F.col("seq") >= middle).write.mode("append").parquet(f"{root}/{name}")
        reader.add(name, f"{root}/copy-{name}")
    schema = next(iter(logs.values())).schema
    if errors := {n: e for n, e in follow_folders(reader, {n: f"{root}/{n}" for n in logs}, schema).items() if e}:
        raise RuntimeError(str(errors))
    return reader.table.read()


@query("replica_batches")
def replica_batches(spark, d):
    return _replica_in_batches(spark, d).read()


@query("replica_keys")
def replica_keys(spark, d):
    """M2: the accounts of one market segment, of which only their buckets are opened."""
    wanted = _t(spark, d, "customer").where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("account_id"))
    return _replica_in_batches(spark, d).read_keys(wanted)


@query("minute_stream")
def minute_stream(spark, d):
    from ledgerlake.streaming.jobs import minute_stream as mstream
    root = _scratch(spark, "minute_stream")
    events = _t(spark, d, "events")
    half = events.agg(F.timestamp_seconds(F.expr("avg(unix_seconds(cast(ts as timestamp)))")).cast("timestamp_ntz")).first()[0]
    cut = F.lit(half).cast("timestamp_ntz")
    return _in_batches(events, [F.col("ts") < cut, F.col("ts") >= cut], root,
                       lambda s: mstream(spark, s, f"{root}/out", f"{root}/_checkpoint"))


@query("mart_drift")
def mart_drift(spark, d):
    """V6: report at current prices over the surviving sales vs the maintained mart."""
    from ledgerlake.operators import mart
    goods = domain.goods(spark, d)
    steps = domain.price_steps(spark, d).select("good_id", F.col("price").alias("new_price"))
    current = (goods.join(steps, goods.goods_id == steps.good_id, "left")
               .select("goods_id", "good_name", F.coalesce("new_price", "good_price").alias("good_price")))
    li = _t(spark, d, "lineitem")
    alive = li.where(F.col("l_returnflag") != "R")
    report = R.sales_report(current, alive.select(F.col("l_partkey").alias("good_id"),
                                                  F.col("l_quantity").cast("int").alias("sales_qty")))
    return mart.mart_drift(report, mart_price_change(spark, d))


# ------------------------------------------------------------------ loads, resets, composite keys
@query("insert_values")
def insert_values(spark, d):
    from ledgerlake.sources.io import append_rows
    return append_rows(spark, _t(spark, d, "region"), [(100, "NOWHERE"), (101, None)])


@query("insert_select")
def insert_select(spark, d):
    """S4 + J15: lines migrated into a declared table, enriched from their orders."""
    from ledgerlake.operators.relational import enrich
    from ledgerlake.sources.io import migrate
    dst = spark.createDataFrame([], "l_orderkey bigint, l_linenumber int, o_orderdate timestamp_ntz").schema
    return migrate(_t(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), dst,
                   lambda df: enrich(df, _t(spark, d, "orders"), {"l_orderkey": "o_orderkey"}, ["o_orderdate"], check_count=True))


@query("create_as")
def create_as(spark, d):
    from ledgerlake.sources.io import materialize
    o = _t(spark, d, "orders").where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey")
    return spark.read.schema(o.schema).parquet(materialize(o, _scratch(spark, "ctas")))


@query("table_reset")
def table_reset(spark, d):
    """A table is loaded, truncated and loaded again; old versions stay readable."""
    from ledgerlake.sources.versioned import VersionedTable
    c = _t(spark, d, "customer")
    t = VersionedTable(spark, _scratch(spark, "reset"))
    first = t.commit(c)
    empty = t.reset(c.schema)
    t.commit(c.where(F.col("c_acctbal") > 0))
    out = None
    for name, version in (("first", first), ("empty", empty), ("last", t.current())):
        n = t.read(version).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("version"), "n")
        out = n if out is None else out.unionByName(n)
    return out


@query("mart_start")
def mart_start(spark, d):
    """M5 then M4: a mart from the sales so far, then the later deltas."""
    from ledgerlake.operators import mart
    goods, sales = domain.goods(spark, d), domain.sales(spark, d)
    early = F.col("sales_time") < F.lit("1997-01-01").cast("timestamp_ntz")
    both = mart.mart_init(goods, sales.where(early)).unionByName(mart.mart_init(goods, sales.where(~early)))
    return both.groupBy("good_name").agg(F.sum("sum_sale").cast("decimal(38,2)").alias("sum_sale"))


@query("cascade")
def cascade(spark, d):
    from ledgerlake.operators.checks import cascade_delete
    o = _t(spark, d, "orders").where(F.col("o_orderpriority") != "5-LOW")
    return cascade_delete(_t(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), o, {"l_orderkey": "o_orderkey"})


def _supplied(spark, d):
    return _t(spark, d, "lineitem").where(F.col("l_returnflag") == "R").select("l_partkey", "l_suppkey").distinct()


@query("semi_composite")
def semi_composite(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("x")
    back = _supplied(spark, d).withColumnsRenamed({"l_partkey": "p", "l_suppkey": "s"})
    return R.semi(li, back, {"l_partkey": "p", "l_suppkey": "s"})


@query("anti_composite")
def anti_composite(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    back = _supplied(spark, d).withColumnsRenamed({"l_partkey": "p", "l_suppkey": "s"})
    return R.anti(li, back, {"l_partkey": "p", "l_suppkey": "s"})


@query("left_composite")
def left_composite(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    back = _t(spark, d, "lineitem").where(F.col("l_returnflag") == "R").groupBy(
        F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s")).agg(F.max("l_shipdate").alias("last_back"))
    j = R.left_with_default(li, back, {"l_partkey": "p", "l_suppkey": "s"}, "last_back", "never returned", "last_back_text")
    return j.select("l_orderkey", "l_linenumber", "last_back_text")


@query("backfill_checked")
def backfill_checked(spark, d):
    """Add columns, backfill them over two keys, then the NOT NULL and composite FK checks."""
    from ledgerlake.operators.checks import check_fk, check_rows, not_null
    from ledgerlake.operators.dml import add_column, update_from as upd
    li = _t(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag").distinct()
    li = add_column(li, "lines", "bigint")
    src = _t(spark, d, "lineitem").where(F.col("l_linestatus") == "F").groupBy(
        F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s")).agg(F.count(F.lit(1)).alias("n"))
    filled = upd(li, src, {"l_partkey": "p", "l_suppkey": "s"}, {"lines": "n"})
    keep = ["l_partkey", "l_suppkey", "l_returnflag"]
    empty = check_rows(filled, not_null("lines"), keep)
    orphans = check_fk(filled, src, {"l_partkey": "p", "l_suppkey": "s"}).select(*keep, F.lit("lines_fk").alias("rule"))
    return empty.unionByName(orphans)


@query("substring_first")
def substring_first(spark, d):
    c = _t(spark, d, "customer")
    return c.groupBy(F.substring("c_mktsegment", 1, 1).alias("letter"), F.substring("c_name", 1, 4).alias("start")).agg(
        F.count(F.lit(1)).alias("n"))
