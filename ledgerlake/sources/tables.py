"""Typed table scans, series and synthetic rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.schemas import DRIVER


def load(spark: SparkSession, sf_dir: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """Full scan of one parquet table with its declared schema."""
    schema = schema or DRIVER[name]
    return spark.read.schema(schema).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [load(spark, sf_dir, n) for n in names]


def register_views(spark: SparkSession, sf_dir: str, names=None) -> None:
    for n in names or DRIVER:
        load(spark, sf_dir, n).createOrReplaceTempView(n)


def series(spark: SparkSession, lo, hi) -> DataFrame:
    """``generate_series(lo, hi)`` (inclusive); ``hi`` may be a Column-free int."""
    return spark.range(int(lo), int(hi) + 1).withColumnRenamed("id", "i")


def synth_rows(spark: SparkSession, lo: int, hi: int, seed: int | None = None) -> DataFrame:
    """``(id, md5(random()::text))``; deterministic ``md5(id)`` when seed is None."""
    base = series(spark, lo, hi)
    txt = F.md5(F.col("i").cast("string")) if seed is None else F.md5(F.rand(seed).cast("string"))
    return base.select(F.col("i").cast("int").alias("id"), txt.alias("random_text"))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Reshape to a declared schema (``df.to`` casts and reorders by name)."""
    return df.to(schema)
