"""Access layouts, the user-level side of indexes.

T7  sorted (range-partitioned) copy with optional stored derived columns:
    parquet min/max statistics let a filter skip row groups, and a stored
    ``upper(name)`` column makes a case-insensitive lookup a pushed EqualTo.
T8  trigram table for substring search: candidates by trigram match, then
    a recheck on the text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a column's rank in a z-value.
RANK_BITS = 8


def as_number(df: DataFrame, name: str) -> Column:
    """A number in the order of a column's values: a string's first six bytes, a time's microseconds."""
    c, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    return c.cast("double")


def _rank(points: Column, x: Column, bits: int) -> Column:
    """How many of 2^bits - 1 ascending points are not above x, by binary search."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.element_at(points, at + step) <= x, at + step).otherwise(at))


def z_value(df: DataFrame, cols: Sequence[str], bits: int = RANK_BITS) -> Column:
    """T7 for several columns: the interleaved bits of their approximate ranks, so rows that are near in every
    column get near values.  Ranks come from 2^bits - 1 quantiles a column, one aggregate; nulls go first."""
    if len(cols) * bits > 62:
        raise ValueError("too many columns or bits for a z-value")
    shares = F.array(*[F.lit(k / 2 ** bits) for k in range(1, 2 ** bits)])
    cuts = df.agg(*[F.percentile_approx(as_number(df, c), shares, 10_000).alias(f"q{i}") for i, c in enumerate(cols)]).first()
    z = F.lit(0).cast("long")
    for i, c in enumerate(cols):
        if not cuts[i]:
            continue
        rank = F.when(F.col(c).isNull(), F.lit(0)).otherwise(_rank(F.lit(cuts[i]), as_number(df, c), bits))
        for b in range(bits):
            z = z + F.shiftleft(F.shiftright(rank, b).bitwiseAND(1).cast("long"), b * len(cols) + i)
    return z


def layout(df: DataFrame, sort_cols: Sequence[str], path: str, derived: dict | None = None,
           partitions: int | None = None) -> str:
    """Write ``df`` range-partitioned and sorted by ``sort_cols`` with the
    ``derived`` columns stored next to it."""
    out = df
    for name, expr in (derived or {}).items():
        out = out.withColumn(name, expr)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (out.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols)
     .write.mode("errorifexists").option("compression", "zstd").parquet(path))
    return path


#: Bytes of text whose trigrams a task works on at a time; a longer text stands alone.
GRAM_BYTES = 4 * 2 ** 20


def _code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all texts, and where each text starts among them."""
    wide = pa.types.is_large_string(texts.type)
    _, at, data = texts.buffers()
    at = np.frombuffer(at, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    at = at - at[0]
    if not len(raw) or raw.max() < 128:
        return raw.astype(np.uint32), at
    heads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), "<u4"), heads[at]


def _pairs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Every distinct pair of a trigram (three characters, one row) and the number of a text that holds it, sorted."""
    points, at = _code_points(texts)
    starts = np.repeat(np.arange(len(texts)), np.diff(at))[:max(0, len(points) - 2)]
    inside = np.arange(len(starts)) + 2 < at[starts + 1]
    seen = np.zeros(0x110000, bool)
    seen[points] = True
    chars = np.flatnonzero(seen).astype(np.uint32)
    code = np.zeros(0x110000, np.int64)
    code[chars] = np.arange(len(chars))
    c, n, bits = code[points], len(chars), int(len(texts)).bit_length()
    if n ** 3 << bits >= 2 ** 63:
        # more kinds of characters than a number holds thrice beside a text's number
        tri = np.unique(np.stack([points[:-2][inside], points[1:-1][inside], points[2:][inside], starts[inside].astype(np.uint32)], 1), axis=0)
        return tri[:, :3], tri[:, 3].astype(np.int64)
    both = ((((c[:-2] * n + c[1:-1]) * n + c[2:]) << bits) | starts)[inside]
    both.sort()
    both = both[np.concatenate([[True], both[1:] != both[:-1]])] if len(both) else both
    tri = both >> bits
    return np.stack([chars[tri // (n * n)], chars[tri // n % n], chars[tri % n]], 1) if n else np.zeros((0, 3), np.uint32), both & ((1 << bits) - 1)


def _strings(tri: np.ndarray) -> pa.Array:
    tri = np.ascontiguousarray(tri, dtype="<u4")
    size = (1 + (tri >= 0x80).astype(np.int32) + (tri >= 0x800) + (tri >= 0x10000)).sum(1)
    at = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    data = tri.tobytes().decode("utf-32-le").encode("utf-8")
    return pa.StringArray.from_buffers(len(tri), pa.py_buffer(at.tobytes()), pa.py_buffer(data))


def _gram_lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of ``(span, value, text)``: for each trigram and span of a batch the values of the texts that hold it."""
    for batch in batches:
        size = np.cumsum(pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False).astype(np.int64))
        cuts = np.flatnonzero(np.diff(size // GRAM_BYTES)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(size)]):
            spans, values = (batch.column(k).slice(lo, hi - lo) for k in (0, 1))
            order = pc.sort_indices(spans)
            spans, values = spans.take(order), values.take(order)
            tri, text = _pairs(batch.column(2).slice(lo, hi - lo).take(order))
            if not len(text):
                continue
            of = spans.to_numpy(zero_copy_only=False)[text]
            new = np.concatenate([[True], (tri[1:] != tri[:-1]).any(1) | (of[1:] != of[:-1])])
            first = np.flatnonzero(new)
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(text)).astype(np.int32)), values.take(pa.array(text)))
            yield pa.RecordBatch.from_arrays([pa.array(of[first]), _strings(tri[first]), lists], ["span", "gram", "held"])


def gram_lists(df: DataFrame) -> DataFrame:
    """``(span, tri, held)`` of a table ``(span bigint, value, text)``, spans and texts not null: values of texts by
    their case-folded trigrams (of characters; none below 3).  A trigram and span may have several rows, one
    for each piece of texts that a task worked on; a text's value is held once for each of its trigrams.

    A trigram is stored as a 64-bit hash: longs shuffle and sort faster than strings, and a
    collision can only add a candidate, which the recheck removes."""
    value, text = df.columns[1:]
    out = T.StructType([T.StructField("span", T.LongType()), T.StructField("gram", T.StringType()),
                        T.StructField("held", T.ArrayType(df.schema[value].dataType))])
    lists = df.select("span", value, F.lower(text)).mapInArrow(_gram_lists, out)
    return lists.select("span", F.xxhash64("gram").alias("tri"), "held")


def pattern_trigrams(spark: SparkSession, pattern: str) -> list[int]:
    """A pattern's trigrams (bounded by its length), folded and hashed as in an index."""
    low = spark.range(1).select(F.lower(F.lit(pattern))).first()[0]
    grams = sorted({low[k:k + 3] for k in range(len(low) - 2)})
    return sorted({*spark.range(1).select(F.array(*[F.xxhash64(F.lit(g)) for g in grams])).first()[0]}) if grams else []


#: Folders of a written index, by trigram; a lookup opens only those of its trigrams.
BUCKETS = 64


def trigram_index(df: DataFrame, key: str, col: str) -> DataFrame:
    """``(key, tri, bucket)`` rows, one per distinct trigram (hash) of each text.

    Texts are dealt out by key before the extraction, which costs far more than their
    shuffle.  Keys travel in lists by trigram.  These are rebalanced by bucket and trigram: AQE keeps a trigram's
    lists together and splits the partition of one that a large share of the texts holds."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = df.select(F.lit(0).cast("long").alias("span"), key, col).where(F.col(col).isNotNull()).repartition(n, key)
    lists = gram_lists(texts).withColumn("bucket", F.pmod("tri", F.lit(BUCKETS)).cast("int")).hint("rebalance", "bucket", "tri")
    return lists.sortWithinPartitions("bucket", "tri").select(F.explode("held").alias(key), "tri", "bucket")


def write_trigram_index(df: DataFrame, key: str, col: str, path: str) -> str:
    trigram_index(df, key, col).write.mode("errorifexists").option("compression", "zstd").partitionBy("bucket").parquet(path)
    return path


def read_trigram_index(spark: SparkSession, path: str, key: str, key_type: str = "bigint") -> DataFrame:
    return spark.read.schema(f"{key} {key_type}, tri bigint, bucket int").parquet(path)


def trigram_search(spark: SparkSession, index: DataFrame, df: DataFrame, key: str, col: str,
                   pattern: str) -> DataFrame:
    """Rows of ``df`` whose ``col`` contains ``pattern`` (case-sensitive).

    Candidates are keys holding every distinct trigram of the pattern
    (case-folded, so recall is complete), then the text is rechecked.  Patterns shorter
    than 3 characters fall back to a scan.
    """
    if len(pattern) < 3:
        return df.where(F.col(col).contains(pattern))
    # a literal IN filter pushed into the scan
    grams = pattern_trigrams(spark, pattern)
    hits = index.where(F.col("bucket").isin(sorted({g % BUCKETS for g in grams})) & F.col("tri").isin(grams))
    cand = (hits.groupBy(key).agg(F.count(F.lit(1)).alias("have"))
            .where(F.col("have") == len(grams)).select(key))
    return df.join(cand, key, "left_semi").where(F.col(col).contains(pattern))
