"""A trigram index that takes new texts.

Postings are kept as blocks: one row holds the keys of one trigram within a range of ``1 << BITS`` keys, as sorted
offsets from the range's start.  A table of texts starts with one part; every ``append`` writes a part of its own
texts only, and a part that has come near the size of the one before it is merged with it.  Part sizes then at least
double from the newest to the oldest, so N texts lie in about log2(N / batch) parts and a posting is rewritten as
many times at most.  A search opens the blocks of its trigrams in all parts, intersects them range by range and
rechecks the candidates on the text.

The index holds every trigram that a key's text ever had.  Rows that are gone from the table need no mark, since
candidates are looked up there; a changed text is appended again.  ``merge(live)`` forgets what is gone.

Keys are whole numbers.  Null keys and null texts are not indexed.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.layout import BUCKETS, gram_lists, pattern_trigrams
from ledgerlake.sources import fs

#: A block covers 2^BITS keys: bounds a block's size and the work of one intersection.
BITS = 12
#: Tasks that the texts of a key range are dealt out to at most, by their contents.
DEALT = 8
SCHEMA = "tri bigint, span bigint, offsets array<smallint>, bucket int"


def _span(key: Column) -> Column:
    return F.shiftright(key, BITS)


def _union(lists: str) -> Column:
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(lists))))


class GramIndex:
    """A trigram index of column ``col`` by whole-number column ``key``, below ``root``."""

    def __init__(self, spark: SparkSession, root: str, key: str, col: str):
        self.spark, self.root, self.key, self.col = spark, root.rstrip("/"), key, col

    # ------------------------------------------------------------ manifest
    def _version(self) -> int:
        return max((int(n) for n in fs.list_names(self.spark, f"{self.root}/_versions") if n.isdigit()), default=0)

    def parts(self) -> list[dict]:
        """Folder and bytes of every part, oldest first."""
        v = self._version()
        return json.loads(fs.read_text(self.spark, f"{self.root}/_versions/{v}")) if v else []

    def _commit(self, seen: int, parts: list[dict]) -> None:
        """Parts as of the next version; of two writers the second gets ``CommitConflict`` and its part stays unread."""
        fs.write_text(self.spark, f"{self.root}/_versions/{seen + 1}", json.dumps(parts))

    # ------------------------------------------------------------ writing
    def _write(self, blocks: DataFrame) -> dict:
        folder = f"part={uuid.uuid4().hex[:12]}"
        # blocks of a bucket lie together and by trigram, so a search reads few row groups of few files
        (blocks.withColumn("bucket", F.pmod("tri", F.lit(BUCKETS)).cast("int")).hint("rebalance", "bucket", "tri")
         .sortWithinPartitions("bucket", "tri", "span").write.option("compression", "zstd").partitionBy("bucket")
         .parquet(f"{self.root}/{folder}"))
        return {"folder": folder, "bytes": fs.size(self.spark, f"{self.root}/{folder}")}

    def _blocks(self, df: DataFrame) -> DataFrame:
        """Texts of a key range meet in a few tasks, each of which lists the range's keys by trigram; a hot
        trigram is as many groups as there are key ranges."""
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        key = F.col(self.key).cast("long")
        texts = df.where(F.col(self.key).isNotNull() & F.col(self.col).isNotNull()).select(
            _span(key).alias("span"), key.bitwiseAND((1 << BITS) - 1).cast("smallint").alias("offset"), F.col(self.col).alias("t"))
        dealt = texts.repartition(n, "span", F.crc32("t").bitwiseAND(DEALT - 1)).sortWithinPartitions("span")
        return gram_lists(dealt).groupBy("tri", "span").agg(_union("held").alias("offsets"))

    def append(self, df: DataFrame) -> None:
        """Add new texts, or the new texts of keys that are there.  Writes what these texts need, and merges the
        newest parts while the next older one is not larger than all of them together."""
        seen, parts = self._version(), self.parts()
        parts.append(self._write(self._blocks(df)))
        self._commit(seen, parts)
        due = 1
        while due < len(parts) and parts[-due - 1]["bytes"] <= sum(p["bytes"] for p in parts[-due:]):
            due += 1
        if due > 1:
            self._merge(seen + 1, parts, due, None)

    def merge(self, live: DataFrame | None = None) -> None:
        """All parts into one; with ``live`` only what keys of that table hold."""
        seen, parts = self._version(), self.parts()
        if len(parts) > 1 or (parts and live is not None):
            self._merge(seen, parts, len(parts), live)

    def _merge(self, seen: int, parts: list[dict], due: int, live: DataFrame | None) -> None:
        rows = self._read(parts[-due:]).groupBy("tri", "span").agg(
            _union("offsets").alias("offsets"))
        if live is not None:
            key = F.col(self.key).cast("long")
            there = live.where(key.isNotNull()).groupBy(_span(key).alias("span")).agg(
                F.collect_set(key.bitwiseAND((1 << BITS) - 1).cast("smallint")).alias("there"))
            rows = rows.join(there, "span").select("tri", "span", F.array_sort(F.array_intersect("offsets", "there")).alias("offsets"))
            rows = rows.where(F.size("offsets") > 0)
        self._commit(seen, parts[:-due] + [self._write(rows)])

    def vacuum(self) -> None:
        """Delete the folders that the newest version doesn't name, once nobody reads or writes older ones."""
        kept = {p["folder"] for p in self.parts()}
        for name in fs.list_names(self.spark, self.root):
            if name.startswith("part=") and name not in kept:
                fs.delete(self.spark, f"{self.root}/{name}")

    # ------------------------------------------------------------ reading
    def _read(self, parts: list[dict]) -> DataFrame:
        """Rows of several parts; a part without a file has none."""
        out = self.spark.createDataFrame([], SCHEMA)
        for p in parts:
            out = out.unionByName(self.spark.read.schema(SCHEMA).parquet(f"{self.root}/{p['folder']}"))
        return out

    def blocks(self) -> DataFrame:
        """(tri, span, offsets, bucket) of all parts; several rows of a trigram and range stand for their union."""
        return self._read(self.parts())

    def candidates(self, pattern: str) -> DataFrame:
        """Keys that hold all trigrams of a pattern, which needs three characters."""
        grams = pattern_trigrams(self.spark, pattern)
        if not grams:
            raise ValueError("a pattern without a trigram has no candidates but all rows")
        hits = self.blocks().where(F.col("bucket").isin(sorted({g % BUCKETS for g in grams})) & F.col("tri").isin(grams))
        # both aggregates use one shuffle; a range is at most one block a trigram and part
        one = hits.repartition("span").groupBy("span", "tri").agg(F.flatten(F.collect_list("offsets")).alias("o"))
        lists = one.groupBy("span").agg(F.collect_list("o").alias("l")).where(F.size("l") == len(grams))
        both = F.aggregate(F.slice("l", 2, F.size("l")), F.array_distinct(F.element_at("l", 1)), F.array_intersect)
        return lists.select("span", F.explode(both).alias("o")).select((F.shiftleft("span", BITS) + F.col("o")).alias(self.key))

    def search(self, df: DataFrame, pattern: str) -> DataFrame:
        """Rows of ``df`` whose text contains ``pattern`` (case-sensitive); shorter patterns than a trigram scan."""
        found = F.col(self.col).contains(pattern)
        if len(pattern) < 3:
            return df.where(found)
        return df.join(self.candidates(pattern), self.key, "left_semi").where(found)
