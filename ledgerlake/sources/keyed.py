"""Tables with a key that take small batches (M2, M4, M8): merge on read.

A batch is written as a delta: its own rows only, however large the table.  Readers merge a base with the
deltas after it, by one of two rules:

* ``last``  the row of the latest delta stands for its key; a tombstone removes it;
* ``sum``   the value columns of a key's rows are added up.

Rows are dealt into buckets by the hash of the key, and folders are kept a bucket, so a read of some keys
and a compaction open the files of the buckets concerned.  A bucket is compacted when its deltas outgrow its
base: base and deltas become its new base.  Buckets split one after another as the table grows (linear
hashing: the number of buckets tells a key's bucket), so a bucket keeps its size and a compaction
rewrites a bounded share for each byte that came in.

``root/_commits/N`` makes version N visible, renamed into place and never replaced.  Most commits name
their delta only; at least each ``FULL_EVERY``-th lists all folders, so what a small batch writes does not grow with
the table.  Each source that writes has a mark of its own in the commits: a batch number (or position) at or
below the source's last one is skipped, so retries do nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.sources import fs
from ledgerlake.sources.io import stage_table

BUCKET, VERSION, GONE = "_bucket", "_version", "_gone"
#: Bytes of a bucket's base from which the table gets more buckets.
BUCKET_BYTES = 256 << 20
#: Commits between two that list all folders.
FULL_EVERY = 20
#: Deltas of a bucket that are merged however small they are.
MAX_DELTAS = 50


@dataclass(frozen=True)
class State:
    """What a version consists of: ``marks`` is source -> last batch; ``base`` is bucket -> (folder, bytes);
    ``deltas`` are (folder, {bucket: bytes})."""

    version: int
    buckets: int
    marks: dict[str, int] = field(default_factory=dict)
    base: dict[str, tuple[str, int]] = field(default_factory=dict)
    deltas: tuple[tuple[str, dict[str, int]], ...] = ()

    @property
    def batch(self) -> int:
        """Last batch of a table's only source."""
        return self.marks.get("", -1)

    def delta_bytes(self) -> dict[str, tuple[int, int]]:
        """Bucket -> (bytes, number) of its deltas."""
        out: dict[str, tuple[int, int]] = {}
        for _, sizes in self.deltas:
            for b, n in sizes.items():
                x = out.get(b, (0, 0))
                out[b] = (x[0] + n, x[1] + 1)
        return out


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Linear hashing: a key's bucket when there are so many."""
    low = 1 << (buckets.bit_length() - 1)
    h = F.xxhash64(*keys)
    wide = F.pmod(h, F.lit(2 * low))
    return F.when(wide < buckets, wide).otherwise(F.pmod(h, F.lit(low)))


def parent_of(bucket: int) -> int:
    """The bucket that held this one's keys before it was split off."""
    return bucket - (1 << (bucket.bit_length() - 1)) if bucket else 0


class KeyedTable:
    def __init__(self, spark: SparkSession, root: str, bucket_bytes: int = BUCKET_BYTES):
        self.spark, self.root, self.bucket_bytes = spark, root.rstrip("/"), bucket_bytes

    # ------------------------------------------------------------ commits
    def _commits(self) -> list[int]:
        return sorted(int(n) for n in fs.list_names(self.spark, f"{self.root}/_commits") if n.isdigit())

    def current(self) -> int | None:
        seqs = self._commits()
        return seqs[-1] if seqs else None

    def _commit(self, version: int) -> dict:
        return json.loads(fs.read_text(self.spark, f"{self.root}/_commits/{version}"))

    def _publish(self, version: int, content: dict) -> None:
        fs.write_text(self.spark, f"{self.root}/_commits/{version}", json.dumps(content))

    def info(self) -> dict:
        """Schema, keys and rule, as given at the start."""
        return json.loads(fs.read_text(self.spark, f"{self.root}/_table"))

    def state(self, version: int | None = None) -> State:
        """A version, from the newest commit at or below it that lists all folders and the deltas since."""
        seqs = [n for n in self._commits() if version is None or n <= version]
        if not seqs:
            raise FileNotFoundError(f"no committed version under {self.root}")
        later = []
        for n in reversed(seqs):
            c = self._commit(n)
            if "base" in c:
                deltas = [(f, s) for f, s in c["deltas"]] + [tuple(x["delta"]) for x in reversed(later)]
                return State(seqs[-1], c["buckets"], later[0]["marks"] if later else c["marks"],
                             {b: (f, s) for b, (f, s) in c["base"].items()}, tuple(deltas))
            later.append(c)
        raise FileNotFoundError(f"version {seqs[-1]} under {self.root} was vacuumed")

    def _list_all(self, s: State) -> None:
        self._publish(s.version, {"buckets": s.buckets, "marks": s.marks, "base": s.base, "deltas": s.deltas})

    # ------------------------------------------------------------ writing
    def _write(self, rows: DataFrame, buckets: int, kind: str) -> tuple[str, dict[str, int]]:
        folder = f"{kind}={uuid.uuid4().hex[:12]}"
        keys = self.info()["keys"]
        (rows.withColumn(BUCKET, bucket_of(keys, buckets)).hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *keys)
         .write.option("compression", "zstd").partitionBy(BUCKET).parquet(f"{self.root}/{folder}"))
        names = [n for n in fs.list_names(self.spark, f"{self.root}/{folder}") if n.startswith(BUCKET + "=")]
        return folder, {n[len(BUCKET) + 1:]: fs.size(self.spark, f"{self.root}/{folder}/{n}") for n in names}

    def start(self, rows: DataFrame, keys: Sequence[str], rule: str = "last", buckets: int = 1) -> KeyedTable:
        """Write the first rows, one a key, if the table has no version yet."""
        if self.current() is not None:
            return self
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
        if rule not in ("last", "sum"):
            raise ValueError(f"unknown rule {rule}")
        if not fs.exists(self.spark, f"{self.root}/_table"):
            fs.write_text(self.spark, f"{self.root}/_table", json.dumps({"schema": json.loads(schema.json()), "keys": list(keys), "rule": rule}))
        folder, sizes = self._write(rows, buckets, "base")
        self._list_all(State(0, buckets, {}, {b: (folder, n) for b, n in sizes.items()}))
        return self

    def append(self, rows: DataFrame, batch: int | None = None, truncate: bool = False, source: str = "") -> int:
        """Commit a batch: rows of the table's columns, one a key at the most for the rule ``last``, where a
        boolean column ``GONE`` marks tombstones.  With ``truncate`` the table is emptied first.
        Returns the version; a batch of the source that is in already changes nothing."""
        s, info = self.state(), self.info()
        if batch is not None and batch <= s.marks.get(source, batch - 1):
            return s.version
        version = s.version + 1
        gone = F.coalesce(F.col(GONE), F.lit(False)) if GONE in rows.columns else F.lit(False)
        schema = T.StructType.fromJson(info["schema"])
        delta = rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields], gone.alias(GONE), F.lit(version).cast("long").alias(VERSION))
        written = self._write(delta, s.buckets, "delta")
        new = replace(s, version=version, marks=s.marks if batch is None else {**s.marks, source: batch}, deltas=(*s.deltas, written))
        if truncate:
            self._list_all(replace(new, base={}, deltas=(written,)))
        elif version % FULL_EVERY == 0:
            self._list_all(new)
        else:
            self._publish(version, {"delta": written, "marks": new.marks})
        return version

    # ------------------------------------------------------------ reading
    def _files(self, s: State, buckets: Iterable[str] | None) -> tuple[list[str], list[str]]:
        chosen = None if buckets is None else set(buckets)
        base = [f"{self.root}/{f}/{BUCKET}={b}" for b, (f, _) in s.base.items() if chosen is None or b in chosen]
        deltas = [f"{self.root}/{f}/{BUCKET}={b}" for f, sizes in s.deltas for b in sizes if chosen is None or b in chosen]
        return base, deltas

    def read(self, version: int | None = None, buckets: Iterable[str] | None = None) -> DataFrame:
        """The table's rows, of all buckets or some.  Versions stay readable until ``vacuum``."""
        s, info = self.state(version), self.info()
        schema, keys = T.StructType.fromJson(info["schema"]), info["keys"]
        base, deltas = self._files(s, buckets)

        def of(paths: list[str], extra: list[T.StructField]) -> DataFrame:
            full = T.StructType(schema.fields + extra)
            return self.spark.read.schema(full).parquet(*paths) if paths else self.spark.createDataFrame([], full)

        old = of(base, [])
        if not deltas:
            return old
        new = of(deltas, [T.StructField(GONE, T.BooleanType()), T.StructField(VERSION, T.LongType())])
        if info["rule"] == "sum":
            values = [f for f in schema.fields if f.name not in keys]
            return old.unionByName(new.select(*schema.names)).groupBy(*keys).agg(
                *[F.sum(f.name).cast(f.dataType).alias(f.name) for f in values]).select(*schema.names)
        latest = new.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in schema.names if c not in keys], GONE), VERSION).alias("_l"))
        touched = latest.select(*[F.col(k).alias("_k_" + k) for k in keys])
        same = F.lit(True)
        for k in keys:
            same = same & old[k].eqNullSafe(touched["_k_" + k])
        rest = [F.col(c) if c in keys else F.col("_l." + c).alias(c) for c in schema.names]
        return old.join(touched, same, "left_anti").unionByName(latest.where(~F.col("_l." + GONE)).select(*rest))

    def read_keys(self, wanted: DataFrame) -> DataFrame:
        """The rows of some keys; only their buckets' files are opened."""
        s, keys = self.state(), self.info()["keys"]
        names = [str(r[0]) for r in wanted.select(bucket_of(keys, s.buckets)).distinct().collect()]      # at most as many as buckets
        rows = self.read(s.version, names)
        asked = wanted.select(*[F.col(k).alias("_k_" + k) for k in keys]).distinct()
        same = F.lit(True)
        for k in keys:
            same = same & rows[k].eqNullSafe(asked["_k_" + k])
        return rows.join(asked, same, "left_semi")

    # ------------------------------------------------------------ upkeep
    def due(self, s: State) -> tuple[set[str], int]:
        """Buckets whose deltas outgrew their base, those that are to be split, and the number of buckets then."""
        deltas = s.delta_bytes()
        due = {b for b, (n, k) in deltas.items() if n > s.base.get(b, ("", 0))[1] or k >= MAX_DELTAS}
        total = sum(n for _, n in s.base.values()) + sum(n for b, (n, _) in deltas.items() if b in due)
        buckets = min(max(s.buckets, -(-total // self.bucket_bytes)), 2 * s.buckets)      # at most twice at a time
        due |= {str(parent_of(b)) for b in range(s.buckets, buckets)} if due else set()
        return due, buckets if due else s.buckets

    def compact(self, everything: bool = False) -> int:
        """Merge the deltas of the buckets that are due (or of all) into their bases; other buckets are neither
        read nor written.  Returns the version; none is made if nothing is due."""
        s = self.state()
        due, buckets = self.due(s)
        if everything:
            due = set(s.base) | set(s.delta_bytes())
        if not due:
            return s.version
        folder, sizes = self._write(self.read(s.version, due), buckets, "base")
        base = {b: x for b, x in s.base.items() if b not in due} | {b: (folder, n) for b, n in sizes.items()}
        left = [(f, {b: n for b, n in sizes.items() if b not in due}) for f, sizes in s.deltas]
        self._list_all(State(s.version + 1, buckets, s.marks, base, tuple((f, x) for f, x in left if x)))
        return s.version + 1

    def vacuum(self) -> None:
        """Delete what the newest version does not use.  Only for times without writers or readers of older ones."""
        s = self.state()
        if "base" not in self._commit(s.version):
            s = replace(s, version=s.version + 1)
            self._list_all(s)
        for old in self._commits()[:-1]:
            fs.delete(self.spark, f"{self.root}/_commits/{old}")
        alive = {f for f, _ in s.base.values()} | {f for f, _ in s.deltas}
        for name in fs.list_names(self.spark, self.root):
            if name.startswith(("base=", "delta=")) and name not in alive:
                fs.delete(self.spark, f"{self.root}/{name}")


def upserts(changes: DataFrame, table: KeyedTable) -> tuple[DataFrame, bool]:
    """A change log's batch as a delta of a ``last`` table, and whether a truncate empties it first: the latest
    change of each key after the last truncate.  Columns that the log's images lack keep their values."""
    names, keys = [f["name"] for f in table.info()["schema"]["fields"]], table.info()["keys"]
    changes = stage_table(changes, "batch")
    cut = changes.where(F.col("op") == "T").agg(F.max("seq")).first()[0]
    live = changes.where(F.col("op") != "T") if cut is None else changes.where((F.col("op") != "T") & (F.col("seq") > F.lit(cut)))
    last = live.groupBy(*[F.col("key." + k).alias(k) for k in keys]).agg(F.max_by(F.struct("op", "after"), "seq").alias("_l"))
    images = changes.schema["after"].dataType.fieldNames()
    lacking = [c for c in names if c not in keys and c not in images]
    rows = last.select(*keys, *[F.col("_l.after." + c).alias(c) for c in names if c in images and c not in keys], (F.col("_l.op") == "D").alias(GONE))
    if lacking and cut is None:
        held = table.read_keys(rows.select(*keys)).select(*[F.col(k).alias("_k_" + k) for k in keys], *lacking)
        same = F.lit(True)
        for k in keys:
            same = same & rows[k].eqNullSafe(held["_k_" + k])
        rows = rows.join(held, same, "left").drop(*["_k_" + k for k in keys])
    elif lacking:
        rows = rows.select("*", *[F.lit(None).alias(c) for c in lacking])
    return rows, cut is not None
