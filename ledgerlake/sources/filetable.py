"""Tables whose files are known, with copy on write by file.

A manifest, itself a table, names each file of a version with its number of rows, a digest of their values and,
for the zone columns, the least and greatest value.  So

* a change finds the files that hold rows it concerns, rewrites those and leaves the others as they are;
* a read by ranges of several columns opens only files whose zones overlap all of them; with ``order`` rows are
  laid out along a space-filling curve, so each of the columns cuts files off;
* a read past damaged files can tell which files and how many rows are gone.

``root/_commits/N`` makes version N visible, renamed into place and never replaced: of two writers the second
fails with ``CommitConflict``.  Manifests are written and filtered by Spark; the driver sees the names of
the files that are read or rewritten.  Old versions stay readable until ``vacuum``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators import dml
from ledgerlake.operators.layout import z_value
from ledgerlake.sources import fs
from ledgerlake.sources.io import stage_table

FILE = "_file"


class FileTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ------------------------------------------------------------ versions
    def versions(self) -> list[int]:
        return sorted(int(n) for n in fs.list_names(self.spark, f"{self.root}/_commits") if n.isdigit())

    def current(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def _commit(self, version: int | None) -> dict:
        v = self.current() if version is None else version
        if v is None:
            raise FileNotFoundError(f"no committed version under {self.root}")
        return json.loads(fs.read_text(self.spark, f"{self.root}/_commits/{v}"))

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self._commit(None)["schema"])

    def _entry_schema(self, schema: T.StructType, zones: Sequence[str]) -> T.StructType:
        ends = [T.StructField(f"{end}_{z}", schema[z].dataType) for z in zones for end in ("lo", "hi")]
        return T.StructType([T.StructField("file", T.StringType()), T.StructField("rows", T.LongType()), T.StructField("digest", T.DecimalType(38, 0)), *ends])

    def files(self, version: int | None = None) -> DataFrame:
        """The manifest: file, rows, digest, and lo_ / hi_ of each zone column (null where a file has no value)."""
        c = self._commit(version)
        return self.spark.read.schema(self._entry_schema(T.StructType.fromJson(c["schema"]), c["zones"])).parquet(f"{self.root}/{c['manifest']}")

    def _publish(self, entries: DataFrame, schema: T.StructType, zones: Sequence[str]) -> int:
        v, manifest = (-1 if self.current() is None else self.current()) + 1, f"manifest={uuid.uuid4().hex[:12]}"
        entries.hint("rebalance").write.option("compression", "zstd").parquet(f"{self.root}/{manifest}")
        fs.write_text(self.spark, f"{self.root}/_commits/{v}", json.dumps(
            {"manifest": manifest, "schema": json.loads(schema.json()), "zones": list(zones)}))
        return v

    # ------------------------------------------------------------ writing
    def _stage(self, rows: DataFrame, schema: T.StructType, zones: Sequence[str], order: Sequence[str] = (), files: int | None = None,
               as_is: bool = False) -> DataFrame:
        """Write rows to new files, with ``as_is`` one a partition that has rows; returns their entries."""
        folder = f"{self.root}/data={uuid.uuid4().hex[:12]}"
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        if order:
            rows = rows.withColumn("_z", z_value(rows, order))
            cut = [files, "_z"] if files else ["_z"]
            rows = rows.repartitionByRange(*cut).sortWithinPartitions("_z").drop("_z")
        elif files:
            rows = rows.repartition(files)
        elif not as_is:
            rows = rows.hint("rebalance")
        rows.write.option("compression", "zstd").parquet(folder)
        back = self.spark.read.schema(schema).parquet(folder)
        ends = [agg(z).alias(f"{end}_{z}") for z in zones for end, agg in (("lo", F.min), ("hi", F.max))]
        return back.groupBy(self._name().alias("file")).agg(F.count(F.lit(1)).alias("rows"), self._digest(schema).alias("digest"), *ends)

    @staticmethod
    def _digest(schema: T.StructType) -> Column:
        """Sum of the rows' hashes: the same in any order, another when a value is."""
        return F.sum(F.xxhash64(*schema.names).cast("decimal(20,0)")).cast("decimal(38,0)")

    @staticmethod
    def _name() -> Column:
        """A file's name below the root."""
        return F.regexp_extract(F.col("_metadata.file_path"), r"(data=[0-9a-f]+/[^/]+)$", 1)

    def create(self, rows: DataFrame, zones: Sequence[str] = (), order: Sequence[str] = (), files: int | None = None) -> FileTable:
        """Write the first version.  ``zones`` are the columns whose ends are kept a file, ``order`` those of the
        space-filling curve."""
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
        self._publish(self._stage(rows, schema, zones, order, files), schema, zones)
        return self

    def _replace(self, gone: Sequence[str], rows: DataFrame, as_is: bool = False) -> int:
        """Put ``rows`` in the place of some files; the others keep their names."""
        c = self._commit(None)
        schema = T.StructType.fromJson(c["schema"])
        new = self._stage(rows, schema, c["zones"], as_is=as_is)
        dropped = self.spark.createDataFrame([(f,) for f in gone], "file string")
        return self._publish(self.files().join(dropped, "file", "left_anti").unionByName(new), schema, c["zones"])

    def append(self, rows: DataFrame, as_is: bool = False) -> int:
        """Add rows in files of their own, with ``as_is`` one a partition."""
        return self._replace([], rows, as_is)

    # ------------------------------------------------------------ reading
    def candidates(self, within: Mapping[str, tuple], version: int | None = None) -> list[str]:
        """Names of the files whose zones overlap all of the closed ranges; None is an open end.  Columns without
        zones cut nothing off."""
        entries, zones = self.files(version), self._commit(version)["zones"]
        for c, (lo, hi) in within.items():
            if c in zones:
                entries = entries.where(F.col(f"hi_{c}").isNotNull())       # else the file has nulls only
                entries = entries if lo is None else entries.where(F.col(f"hi_{c}") >= F.lit(lo))
                entries = entries if hi is None else entries.where(F.col(f"lo_{c}") <= F.lit(hi))
        return sorted(r.file for r in entries.select("file").collect())

    def _open(self, names: Iterable[str], with_file: bool = False, **options: str) -> DataFrame:
        schema, paths = self.schema(), [f"{self.root}/{n}" for n in names]
        kept = [F.col(c) for c in schema.names]
        if not paths:
            return self.spark.createDataFrame([], schema).select(*kept, *([F.lit(None).cast("string").alias(FILE)] if with_file else []))
        rows = self.spark.read.schema(schema).options(**options).parquet(*paths)
        return rows.select(*kept, *([self._name().alias(FILE)] if with_file else []))

    def read(self, within: Mapping[str, tuple] | None = None, version: int | None = None) -> DataFrame:
        """The rows, or those in closed ranges of some columns; only files whose zones overlap are opened."""
        rows = self._open(self.candidates(within or {}, version))
        return self._inside(rows, within)

    @staticmethod
    def _inside(rows: DataFrame, within: Mapping[str, tuple] | None) -> DataFrame:
        for c, (lo, hi) in (within or {}).items():
            rows = rows.where(F.col(c).isNotNull())
            rows = rows if lo is None else rows.where(F.col(c) >= F.lit(lo))
            rows = rows if hi is None else rows.where(F.col(c) <= F.lit(hi))
        return rows

    # ------------------------------------------------------------ changes
    def _holding(self, where: Column, within: Mapping[str, tuple] | None) -> list[str]:
        rows = self._inside(self._open(self.candidates(within or {}), with_file=True), within)
        return sorted(r[0] for r in rows.where(F.coalesce(where, F.lit(False))).select(FILE).distinct().collect())

    @staticmethod
    def _condition(where: Column, within: Mapping[str, tuple] | None) -> Column:
        for c, (lo, hi) in (within or {}).items():
            where = where & (F.lit(True) if lo is None else F.col(c) >= F.lit(lo)) & (F.lit(True) if hi is None else F.col(c) <= F.lit(hi))
        return where

    def update(self, where: Column, set_: dict, within: Mapping[str, tuple] | None = None) -> list[str]:
        """UPDATE of the rows that satisfy ``where`` and lie in the ranges ``within``, which also cut off files.
        Returns the names of the files that were rewritten."""
        names = self._holding(where, within)
        if names:
            self._replace(names, dml.update(self._open(names), self._condition(where, within), set_))
        return names

    def delete(self, where: Column, within: Mapping[str, tuple] | None = None) -> list[str]:
        """T4: DELETE, as ``update``."""
        names = self._holding(where, within)
        if names:
            self._replace(names, dml.delete(self._open(names), self._condition(where, within)))
        return names

    def merge(self, source: DataFrame, on: Mapping[str, str], clauses: Sequence[dml.Clause]) -> list[str]:
        """T5: MERGE as in ``dml.merge``, of the files that hold a matched row or one that a clause for rows without
        a source concerns.  All matches lie in those files, so a source row that finds none there has none.
        Returns the names of the files that were rewritten."""
        source = stage_table(source, "merge_source")
        sides = [cl for cl in clauses if cl.kind == "not_matched_by_source"]
        within = {}
        if not sides:
            zones = [t for t in on if t in self._commit(None)["zones"]]
            if zones:
                row = source.agg(*[f(on[t]).alias(f"{f.__name__}_{t}") for t in zones for f in (F.min, F.max)]).first()
                within = {t: (row[f"min_{t}"], row[f"max_{t}"]) for t in zones if row[f"min_{t}"] is not None}
        target = self._open(self.candidates(within), with_file=True)
        keys = source.select(*[F.col(s).alias("_s_" + s) for s in on.values()]).distinct()
        same = F.lit(True)
        for t, s in on.items():
            same = same & (target[t] == keys["_s_" + s])
        hit = target.join(keys, same, "left_semi").select(FILE)
        if sides:
            wanted = F.lit(False)
            for cl in sides:
                wanted = wanted | (F.lit(True) if cl.condition is None else F.coalesce(cl.condition, F.lit(False)))
            hit = hit.unionByName(target.join(keys, same, "left_anti").where(wanted).select(FILE))
        names = sorted(r[0] for r in hit.distinct().collect())
        rows = dml.merge(self._open(names), source, dict(on), clauses)
        if names or not rows.isEmpty():
            self._replace(names, rows)
        return names

    # ------------------------------------------------------------ damage
    def damage(self) -> DataFrame:
        """V7: (file, rows, rows_read) of the files that are gone, give fewer rows than the manifest says, or give rows
        with other values (then the numbers are equal).  Reads every column of all others past their errors."""
        entries, schema = self.files(), self.schema()
        names = {r.file for r in entries.select("file").collect()}
        there = {f"{d}/{n}" for d in {n.split("/")[0] for n in names} for n in fs.list_names(self.spark, f"{self.root}/{d}")}
        rows = self._open(sorted(names & there), with_file=True, ignoreCorruptFiles="true", ignoreMissingFiles="true")
        read = rows.groupBy(F.col(FILE).alias("file")).agg(F.count(F.lit(1)).alias("rows_read"), self._digest(schema).alias("now"))
        found = entries.select("file", "rows", "digest").join(read, "file", "left")
        return found.where(~F.col("digest").eqNullSafe(F.col("now"))).select("file", "rows", F.coalesce("rows_read", F.lit(0).cast("long")).alias("rows_read"))

    def read_sound(self) -> tuple[DataFrame, DataFrame]:
        """V7: the rows of the files without damage, and the report of the others, stored."""
        report = stage_table(self.damage(), "damage")
        bad = {r.file for r in report.select("file").collect()}
        return self._open([n for n in self.candidates({}) if n not in bad]), report

    def vacuum(self) -> None:
        """Delete what the newest version does not use, file by file.  Only for times without writers or readers of
        older versions."""
        c, names = self._commit(None), {r.file for r in self.files().select("file").collect()}
        for v in self.versions()[:-1]:
            fs.delete(self.spark, f"{self.root}/_commits/{v}")
        for folder in fs.list_names(self.spark, self.root):
            if folder.startswith("manifest=") and folder != c["manifest"]:
                fs.delete(self.spark, f"{self.root}/{folder}")
            elif folder.startswith("data="):
                for n in fs.list_names(self.spark, f"{self.root}/{folder}"):
                    if f"{folder}/{n}" not in names:
                        fs.delete(self.spark, f"{self.root}/{folder}/{n}")
