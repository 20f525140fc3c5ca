"""Declared schemas: driver tables and the small relational fixtures.

Schemas are never inferred; ``load`` reads parquet with these StructTypes.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, I, S, D, B = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.BooleanType()
TS_NTZ = T.TimestampNTZType()
TS = T.TimestampType()


def money(precision: int = 12, scale: int = 2) -> T.DecimalType:
    return T.DecimalType(precision, scale)


def struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in
                         [(f + (True,))[:3] for f in fields]])


DRIVER = {
    "region": struct(("r_regionkey", I), ("r_name", S)),
    "nation": struct(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": struct(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D),
                       ("c_mktsegment", S)),
    "supplier": struct(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "part": struct(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", I),
                   ("p_retailprice", D)),
    "orders": struct(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D),
                     ("o_orderdate", TS_NTZ), ("o_orderpriority", S)),
    "lineitem": struct(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
                       ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
                       ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", TS_NTZ)),
    "events": struct(("event_id", L), ("ts", TS_NTZ), ("user_id", L), ("event_type", S), ("value", D),
                     ("props", S)),
    "documents": struct(("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L)),
    "embeddings": struct(("vec_id", L), ("embedding", T.ArrayType(T.FloatType())), ("label", I)),
    "pages": struct(("page_id", L), ("url", S), ("html", S)),
    "benchmark": struct(("item_id", L), ("text", S)),
    "labels": struct(("doc_id", L), ("quality", I), ("toxic", I)),
    "conversations": struct(("conv_id", L), ("turn", L), ("role", S), ("text", S)),
}

# Mart fixture (goods / sales / good_sum_mart).
GOODS = struct(("goods_id", I, False), ("good_name", S, False), ("good_price", money(12, 2), False))
SALES = struct(("sales_id", L, False), ("good_id", I), ("sales_time", TS), ("sales_qty", I))
MART = struct(("good_name", S, False), ("sum_sale", money(38, 2)))

# Change-log row (decision D3): images are structs of the table's columns.
def change_log(key: T.StructType, image: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("seq", L, False),
        T.StructField("commit_ts", TS_NTZ, True),
        T.StructField("op", S, False),            # I, U, D, T (truncate)
        T.StructField("key", key, True),
        T.StructField("before", image, True),
        T.StructField("after", image, True),
    ])
