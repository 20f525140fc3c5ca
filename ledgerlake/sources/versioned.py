"""Mutable tables as versioned directories.

Every attempt to write a version has a folder of its own,
``root/v=N-<id>/`` (parquet written by Spark), and ``root/_commits/N`` is the
version's commit marker, naming that folder.  Markers are renamed into place
and never replaced, so a reader resolves the greatest committed N once and
reads only its folder: it never sees a half-written version, leftovers of a
failed attempt are never read, and of two writers of the same version the
second one fails with ``CommitConflict``.  Old versions stay readable until
``vacuum`` is called.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerlake.sources import fs


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._staged: dict[int, str] = {}

    # ------------------------------------------------------------ resolution
    def versions(self) -> list[int]:
        return sorted(int(n) for n in fs.list_names(self.spark, f"{self.root}/_commits") if n.isdigit())

    def current(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def _meta(self, version: int) -> dict:
        return json.loads(fs.read_text(self.spark, f"{self.root}/_commits/{version}"))

    def read(self, version: int | None = None, schema: T.StructType | None = None) -> DataFrame:
        v = self.current() if version is None else version
        if v is None:
            raise FileNotFoundError(f"no committed version under {self.root}")
        meta = self._meta(v)
        schema = schema or T.StructType.fromJson(meta["schema"])
        return self.spark.read.schema(schema).parquet(f"{self.root}/{meta['folder']}")

    # ------------------------------------------------------------ writing
    def staged_path(self, version: int) -> str:
        return f"{self.root}/{self._staged[version]}"

    def stage(self, df: DataFrame, version: int | None = None, partition_by: Sequence[str] = ()) -> int:
        """Write a new, not yet visible version; returns its number."""
        cur = self.current()
        v = version if version is not None else (0 if cur is None else cur + 1)
        self._staged[v] = f"v={v}-{uuid.uuid4().hex[:12]}"
        w = df.write.option("compression", "zstd")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.staged_path(v))
        return v

    def publish(self, v: int, schema: T.StructType, info: dict | None = None) -> int:
        """Make a staged version current by creating its commit marker."""
        meta = {"version": v, "folder": self._staged[v], "schema": json.loads(schema.json()), **(info or {})}
        fs.write_text(self.spark, f"{self.root}/_commits/{v}", json.dumps(meta))
        return v

    def commit(self, df: DataFrame, partition_by: Sequence[str] = ()) -> int:
        v = self.stage(df, partition_by=partition_by)
        return self.publish(v, df.schema)

    def commit_if(self, df: DataFrame, checks: Sequence[Callable[[DataFrame], None]]) -> int:
        """Write, run every check on the written copy, then publish.

        A failing check raises and leaves the old version current.
        """
        v = self.stage(df)
        written = self.spark.read.schema(df.schema).parquet(self.staged_path(v))
        for check in checks:
            check(written)
        return self.publish(v, df.schema)

    def reset(self, schema: T.StructType) -> int:
        """TRUNCATE / recreate = commit an empty version."""
        return self.commit(self.spark.createDataFrame([], schema))

    def vacuum(self, keep: int = 1) -> None:
        """Delete all but the newest ``keep`` versions and the leftovers of failed
        attempts.  Only for times without writers or readers of old versions."""
        alive = self.versions()[-max(1, keep):]
        folders = {self._meta(v)["folder"] for v in alive}
        for old in self.versions()[:-max(1, keep)]:
            fs.delete(self.spark, f"{self.root}/_commits/{old}")
        for name in fs.list_names(self.spark, self.root):
            if name.startswith("v=") and name not in folders:
                fs.delete(self.spark, f"{self.root}/{name}")
