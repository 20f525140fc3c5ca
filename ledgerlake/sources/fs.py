"""Small file operations on the cluster file system (HDFS, object stores, local).

Uses the Hadoop file system of the running session, so the same code works
for ``hdfs://``, ``s3a://`` and ``file:`` paths.  Only tiny metadata files
(commit markers, manifests) go through here; data is always written by Spark.
A session without a JVM handle (a remote session) cannot write them and raises.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another writer made this version visible first."""


def _jfs(spark: SparkSession, path: str):
    try:
        jvm = spark.sparkContext._jvm
    except Exception as e:
        raise RuntimeError("metadata files need the session's JVM file system") from e
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Make a small file visible at once: it is written beside its place under
    a name of its own, then renamed.  An existing file is never replaced; the
    writer that comes second gets ``CommitConflict``."""
    fs, p = _jfs(spark, path)
    jvm = spark.sparkContext._jvm
    part = jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_{p.getName()}.{uuid.uuid4().hex}")
    out = fs.create(part, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration()) \
        if p.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        # without options a rename fails if the target exists
        files.rename(part, p, spark.sparkContext._gateway.new_array(rename, 0))
    except Exception as e:
        fs.delete(part, False)
        if fs.exists(p):
            raise CommitConflict(f"{path} was committed by another writer") from e
        raise


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _jfs(spark, path)
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _jfs(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _jfs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(os.path.basename(str(s.getPath().toString()).rstrip("/")) for s in fs.listStatus(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _jfs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes below a path; 0 if there is none."""
    fs, p = _jfs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def signature(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of a file or of the files in a folder: changes when they are written anew."""
    fs, p = _jfs(spark, path)
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p))) if fs.exists(p) else ()
