"""A training-corpus pipeline over the ``documents`` table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next stage's ``docs``.  All stages but the last return rows of ``documents``, unchanged:

1. quality       documents that the co-trained classifier rejects go
2. exact         of equal texts the row with the largest id stays
3. near          of each near-duplicate component the row with the least id stays
4. benchmark     documents with a ten-word window of a benchmark item go
5. packing       the tokens that are left, in training sequences of several lengths

Null texts count as empty everywhere: the classifier judges them as such, at most one survives the exact
stage, they are linked with nothing, hold no benchmark window, and have no tokens to pack.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm.common import stored
from ledgerlake.llm.decontam import drop_contaminated
from ledgerlake.llm.exact import drop_exact
from ledgerlake.llm.ngrams import drop_near
from ledgerlake.llm.packing import pack
from ledgerlake.llm.quality import keep_good


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, _table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("benchmark", benchmark), ("packing", packing)]

#: A learned classifier has no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the packed pieces."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
