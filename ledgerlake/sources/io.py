"""Inserts, CTAS, text copy out / in, schema export and
selective restore.

The text format is the tab-separated COPY text format: fields separated by a
tab, NULL written as ``\\N``, and backslash, tab, newline and carriage return
escaped with a backslash, so every row stays on one line and files stay
splittable (no multi-line CSV parsing).
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.sources import fs

# Fixed values of the text format.
FIELD_SEP = "\t"
NULL_TEXT = "\\N"
_PLACEHOLDER = "\u0000"     # cannot occur in text values of the format


def append_rows(spark: SparkSession, df: DataFrame, rows: Iterable[tuple]) -> DataFrame:
    """S3: ``INSERT ... VALUES`` = union with a DataFrame of literal rows."""
    return df.unionByName(spark.createDataFrame(list(rows), df.schema))


def migrate(src: DataFrame, dst_schema: T.StructType, enrich=None) -> DataFrame:
    """``INSERT INTO dst SELECT ... FROM src``: optional enrichment (a
    function DataFrame -> DataFrame, e.g. a foreign-key join), then reshape to
    the destination's declared schema; keys are kept as given."""
    out = enrich(src) if enrich is not None else src
    return out.to(dst_schema)


def materialize(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """``CREATE TABLE AS SELECT`` into parquet."""
    df.write.mode(mode).option("compression", "zstd").parquet(path)
    return path


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` once to the shared folder and reading it
    back (computed once, unlike a checkpoint of an uncached plan, and it
    survives the loss of any executor)."""
    from ledgerlake.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _escape(c: Column) -> Column:
    s = c.cast("string")
    s = F.regexp_replace(s, r"\\", r"\\\\")
    s = F.regexp_replace(s, "\t", r"\\t")
    s = F.regexp_replace(s, "\n", r"\\n")
    s = F.regexp_replace(s, "\r", r"\\r")
    return F.coalesce(s, F.lit(NULL_TEXT))


def _unescape(c: Column) -> Column:
    s = F.regexp_replace(c, r"\\\\", _PLACEHOLDER)
    s = F.regexp_replace(s, r"\\t", "\t")
    s = F.regexp_replace(s, r"\\n", "\n")
    s = F.regexp_replace(s, r"\\r", "\r")
    s = F.regexp_replace(s, _PLACEHOLDER, "\\\\")
    return F.when(c == F.lit(NULL_TEXT), F.lit(None).cast("string")).otherwise(s)


def copy_out(df: DataFrame, path: str) -> str:
    """``\\copy table TO file`` in text format."""
    line = F.concat_ws(FIELD_SEP, *[_escape(F.col(c)) for c in df.columns])
    df.select(line.alias("value")).write.mode("errorifexists").text(path)
    return path


def copy_in(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``\\copy table FROM file``: parse, unescape and cast to the declared
    schema.  A row with the wrong field count or a value that does not cast
    raises (ANSI casts), like a failing COPY."""
    n = len(schema.fields)
    raw = spark.read.text(path)
    parts = F.split(F.col("value"), FIELD_SEP, -1)
    bad = F.raise_error(F.concat(F.lit("copy_in: wrong field count in line: "), F.col("value")))
    checked = raw.select(F.when(F.size(parts) != n, bad.cast("array<string>")).otherwise(parts).alias("f"))
    cols = []
    for i, f in enumerate(schema.fields):
        cols.append(_unescape(F.col("f").getItem(i)).cast(f.dataType).alias(f.name))
    return checked.select(*cols)


def fingerprint_of(df: DataFrame) -> DataFrame:
    """One-row (count, order-independent content hash) of a table."""
    h = F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(20,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(h), F.lit(0)).cast("decimal(38,0)").alias("fp"))


def export_schema(spark: SparkSession, tables: dict, path: str) -> dict:
    """Export every table of a schema (zstd parquet) plus a manifest with
    name, schema, row count and content fingerprint per table."""
    manifest = {}
    for name, df in tables.items():
        df.write.mode("errorifexists").option("compression", "zstd").parquet(f"{path}/{name}")
        written = spark.read.schema(df.schema).parquet(f"{path}/{name}")
        row = fingerprint_of(written).first()
        manifest[name] = {"schema": json.loads(df.schema.json()), "rows": int(row["rows"]),
                          "fingerprint": str(row["fp"])}
    fs.write_text(spark, f"{path}/_manifest.json", json.dumps(manifest))
    return manifest


def restore(spark: SparkSession, path: str, tables: Sequence[str], verify: bool = True) -> dict:
    """Restore only the named tables from an export; the others are not
    touched.  With ``verify`` the count and fingerprint must equal the manifest."""
    manifest = json.loads(fs.read_text(spark, f"{path}/_manifest.json"))
    out = {}
    for name in tables:
        if name not in manifest:
            raise KeyError(f"table {name} is not in the export at {path}")
        meta = manifest[name]
        df = spark.read.schema(T.StructType.fromJson(meta["schema"])).parquet(f"{path}/{name}")
        if verify:
            row = fingerprint_of(df).first()
            if int(row["rows"]) != meta["rows"] or str(row["fp"]) != meta["fingerprint"]:
                raise ValueError(f"restore of {name}: count or fingerprint differs from the manifest")
        out[name] = df
    return out
