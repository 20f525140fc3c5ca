"""Range / list / hash partitioned datasets.

A spec turns the source column into a partition name with a Column
expression (range: a balanced comparison tree over the bounds, O(log B)
per row inside codegen; list: ``isin``; hash: ``pmod(xxhash64)``).

Storage: every write has a folder of its own, ``root/v=<attempt>/``, with
one ``part=<name>`` folder per partition it wrote, plus a manifest
``root/_manifest/<seq>`` that maps each partition name to the attempt that
holds it.  Only the partitions an UPDATE touches get a new attempt (row
movement), readers list exactly the manifest's folders, so partition pruning is
a matter of which folders are read, and what a failed write leaves is never
read.  Manifests are renamed into place and never replaced: of two writers the
second one fails.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import quote, unquote
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.dml import update as dml_update
from ledgerlake.sources import fs

PART = "part"
VERSION = "v"


@dataclass
class PartitionSpec:
    kind: str                         # range | list | hash
    column: str
    bounds: list = field(default_factory=list)    # range: [(name, lo, hi)], half-open
    lists: dict = field(default_factory=dict)     # list: {name: [values]}
    modulus: int = 0                              # hash
    default: str | None = None
    zone: str | None = None           # zoned timestamps: bounds are local times in this zone

    # ------------------------------------------------------------ builders
    @classmethod
    def range(cls, column: str, bounds, default: str | None = "p_default", zone: str | None = None):
        b = sorted(bounds, key=lambda x: x[1])
        for (_, _, hi), (_, lo, _) in zip(b, b[1:]):
            if lo < hi:
                raise ValueError("range partitions overlap")
        return cls("range", column, bounds=b, default=default, zone=zone)

    @classmethod
    def list(cls, column: str, lists: dict, default: str | None = None):
        seen = set()
        for vals in lists.values():
            if seen & set(vals):
                raise ValueError("a value is listed in two partitions")
            seen |= set(vals)
        return cls("list", column, lists=dict(lists), default=default)

    @classmethod
    def hash(cls, column: str, modulus: int):
        return cls("hash", column, modulus=modulus)

    @staticmethod
    def monthly(start: dt.datetime, end: dt.datetime, prefix: str = "p"):
        """Bounds ``[first of month, first of next month)`` from start to end."""
        out, cur = [], dt.datetime(start.year, start.month, 1)
        while cur < end:
            nxt = dt.datetime(cur.year + (cur.month == 12), cur.month % 12 + 1, 1)
            out.append((f"{prefix}{cur:%Y_%m}", cur, nxt))
            cur = nxt
        return out

    @staticmethod
    def daily(start: dt.datetime, end: dt.datetime, prefix: str = "p"):
        out, cur = [], dt.datetime(start.year, start.month, start.day)
        while cur < end:
            nxt = cur + dt.timedelta(days=1)
            out.append((f"{prefix}{cur:%Y_%m_%d}", cur, nxt))
            cur = nxt
        return out

    # ------------------------------------------------------------ assignment
    def _key(self, c: Column) -> Column:
        if self.kind == "range" and self.zone:
            # local wall time in the spec's zone
            return F.from_utc_timestamp(c.cast("timestamp"), self.zone).cast("timestamp_ntz")
        return c

    def assign(self, c: Column | None = None) -> Column:
        """Partition name of a value; unmatched list values without a default raise."""
        c = self._key(F.col(self.column) if c is None else c)
        if self.kind == "hash":
            return F.concat(F.lit("p"), F.pmod(F.xxhash64(c), F.lit(self.modulus)).cast("string"))
        if self.kind == "list":
            e = None
            for name, vals in self.lists.items():
                e = F.when(c.isin(list(vals)), F.lit(name)) if e is None else e.when(c.isin(list(vals)), F.lit(name))
            fallback = (F.lit(self.default) if self.default else
                        F.raise_error(F.concat(F.lit(f"no partition of {self.column} for value "),
                                               c.cast("string"))).cast("string"))
            return e.otherwise(fallback)
        return self._range_tree(c)

    def _range_tree(self, c: Column) -> Column:
        b = self.bounds
        fallback = (F.lit(self.default) if self.default else
                    F.raise_error(F.concat(F.lit(f"no partition of {self.column} for value "),
                                           c.cast("string"))).cast("string"))

        def lit(x):
            return F.lit(x).cast("timestamp_ntz") if isinstance(x, dt.datetime) else F.lit(x)

        def build(lo: int, hi: int) -> Column:      # candidates b[lo:hi], value >= b[lo].lo
            if hi - lo == 1:
                return F.when(c < lit(b[lo][2]), F.lit(b[lo][0])).otherwise(fallback)
            mid = (lo + hi) // 2
            return F.when(c < lit(b[mid][1]), build(lo, mid)).otherwise(build(mid, hi))

        return F.when(c.isNull() | (c < lit(b[0][1])), fallback).otherwise(build(0, len(b)))

    def local_range(self, lo, hi) -> tuple:
        """The bounds' view of a closed range of the source column.  For a zoned
        spec ``lo`` and ``hi`` are instants (naive ones in UTC) and the bounds are
        wall times of the zone; where clocks were put back near an end the wall
        time range is a little wider than the instants need."""
        if self.kind != "range" or not self.zone:
            return lo, hi
        zone, turn = ZoneInfo(self.zone), dt.timedelta(hours=3)

        def wall(x: dt.datetime) -> dt.datetime:
            x = x if x.tzinfo else x.replace(tzinfo=dt.timezone.utc)
            return x.astimezone(zone).replace(tzinfo=None)

        return min(wall(lo), wall(lo + turn) - turn), max(wall(hi), wall(hi - turn) + turn)

    def overlapping(self, lo, hi) -> list[str]:
        """Names of the partitions a closed range ``[lo, hi]`` can touch."""
        if self.kind != "range":
            raise ValueError("range pruning needs a range spec")
        lo, hi = self.local_range(lo, hi)
        names = [n for n, a, b in self.bounds if a <= hi and lo < b]
        covered = self.bounds and lo >= self.bounds[0][1] and hi < self.bounds[-1][2] and all(
            x[2] == y[1] for x, y in zip(self.bounds, self.bounds[1:]))
        if self.default and not covered:
            names.append(self.default)
        return names

    def to_json(self) -> str:
        def enc(x):
            return {"ts": x.isoformat()} if isinstance(x, dt.datetime) else x
        return json.dumps({"kind": self.kind, "column": self.column, "modulus": self.modulus,
                           "default": self.default, "zone": self.zone, "lists": self.lists,
                           "bounds": [[n, enc(a), enc(b)] for n, a, b in self.bounds]})


class PartitionedTable:
    """A partitioned dataset with per-partition versions (see module doc)."""

    def __init__(self, spark: SparkSession, root: str, spec: PartitionSpec):
        self.spark, self.root, self.spec = spark, root.rstrip("/"), spec

    # ------------------------------------------------------------ manifest
    def _manifests(self) -> list[int]:
        return sorted(int(n) for n in fs.list_names(self.spark, f"{self.root}/_manifest") if n.isdigit())

    def current(self) -> int | None:
        seqs = self._manifests()
        return seqs[-1] if seqs else None

    def manifest(self) -> dict:
        seqs = self._manifests()
        if not seqs:
            raise FileNotFoundError(f"no manifest under {self.root}")
        return json.loads(fs.read_text(self.spark, f"{self.root}/_manifest/{seqs[-1]}"))

    def _publish(self, parts: dict, schema: T.StructType, info: dict | None = None) -> None:
        seqs = self._manifests()
        seq = seqs[-1] + 1 if seqs else 0
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])      # as files read: nullable
        fs.write_text(self.spark, f"{self.root}/_manifest/{seq}",
                      json.dumps({"parts": parts, "schema": json.loads(schema.json()),
                                  "spec": json.loads(self.spec.to_json()), **(info or {})}))

    def _write(self, df: DataFrame) -> dict[str, str]:
        """Write rows to a fresh folder; returns {partition: attempt}.

        Rebalanced on the partition name: AQE keeps a partition's rows together
        in tasks of its advisory size and cuts a large partition over several,
        so task size does not grow with the table."""
        attempt = uuid.uuid4().hex[:12]
        folder = f"{self.root}/{VERSION}={attempt}"
        (df.withColumn(PART, self.spec.assign()).hint("rebalance", PART).sortWithinPartitions(PART, self.spec.column)
         .write.option("compression", "zstd").partitionBy(PART).parquet(folder))
        names = fs.list_names(self.spark, folder)
        return {unquote(n[len(PART) + 1:]): attempt for n in names if n.startswith(PART + "=")}

    # ------------------------------------------------------------ T9-T11
    def write(self, df: DataFrame, info: dict | None = None) -> "PartitionedTable":
        self._publish(self._write(df), df.schema, info)
        return self

    # ------------------------------------------------------------ reads
    def _schema(self, m: dict) -> T.StructType:
        return T.StructType.fromJson(m["schema"])

    def read(self, parts=None, with_part: bool = False) -> DataFrame:
        m = self.manifest()
        schema = self._schema(m)
        chosen = {p: v for p, v in m["parts"].items() if parts is None or p in set(parts)}
        full = T.StructType(schema.fields + [T.StructField(PART, T.StringType()),
                                             T.StructField(VERSION, T.StringType())])
        if not chosen:
            out = self.spark.createDataFrame([], full)
        else:
            paths = [f"{self.root}/{VERSION}={v}/{PART}={quote(p)}" for p, v in sorted(chosen.items())]
            out = self.spark.read.schema(full).option("basePath", self.root).parquet(*paths)
        out = out.drop(VERSION)
        return out if with_part else out.drop(PART)

    def read_partition(self, name: str, with_part: bool = False) -> DataFrame:
        """One named partition (DEFAULT included)."""
        return self.read([name], with_part)

    def read_pruned(self, lo, hi, with_part: bool = False) -> DataFrame:
        """``col BETWEEN lo AND hi`` reading only overlapping partitions."""
        c = F.col(self.spec.column)
        pred = c.between(F.lit(lo).cast("timestamp_ntz") if isinstance(lo, dt.datetime) else F.lit(lo),
                         F.lit(hi).cast("timestamp_ntz") if isinstance(hi, dt.datetime) else F.lit(hi))
        return self.read(self.spec.overlapping(lo, hi), with_part).where(pred)

    def read_key(self, value, with_part: bool = False) -> DataFrame:
        """Equality read for list / hash specs: one partition."""
        dtype = self._schema(self.manifest())[self.spec.column].dataType
        # the partition name of one literal: a one-row evaluation, then one folder is read
        name = self.spark.range(1).select(self.spec.assign(F.lit(value).cast(dtype))).first()[0]
        return self.read([name], with_part).where(F.col(self.spec.column) == F.lit(value).cast(dtype))

    # ------------------------------------------------------------ T14
    def rewrite(self, touched: list[str], change: Callable[[DataFrame], DataFrame], info: dict | None = None) -> "PartitionedTable":
        """Put ``change`` of the rows in the ``touched`` partitions in their place; the
        other partitions are neither read nor written."""
        m = self.manifest()
        schema = self._schema(m)
        new = change(self.read([p for p in touched if p in m["parts"]])).to(schema)
        parts = {p: v for p, v in m["parts"].items() if p not in set(touched)}
        written = self._write(new)
        if stray := set(written) & set(parts):
            raise ValueError(f"rewrite of {sorted(touched)} produced rows of {sorted(stray)}")
        self._publish({**parts, **written}, schema, info)
        return self

    def update(self, where: Column, set_: dict) -> "PartitionedTable":
        """UPDATE with row movement: only source and target partitions of the
        changed rows get a new version; the others are not rewritten."""
        hit = self.read(None, with_part=True).where(F.coalesce(where, F.lit(False)))
        moved = dml_update(hit, None, set_)
        # partition names that changed rows leave or enter: at most as many as partitions
        names = moved.select(F.explode(F.array(F.col(PART), self.spec.assign())).alias("p")).distinct().collect()
        touched = sorted(r.p for r in names)
        return self.rewrite(touched, lambda rows: dml_update(rows, where, set_)) if touched else self

    def vacuum(self) -> None:
        """Delete attempts and manifests that the newest manifest does not use.  Only for
        times without writers or readers of older manifests."""
        alive = set(self.manifest()["parts"].values())
        for old in self._manifests()[:-1]:
            fs.delete(self.spark, f"{self.root}/_manifest/{old}")
        for name in fs.list_names(self.spark, self.root):
            if name.startswith(VERSION + "=") and name[len(VERSION) + 1:] not in alive:
                fs.delete(self.spark, f"{self.root}/{name}")


def write_partitioned(spark: SparkSession, df: DataFrame, spec: PartitionSpec, root: str) -> PartitionedTable:
    return PartitionedTable(spark, root, spec).write(df)
