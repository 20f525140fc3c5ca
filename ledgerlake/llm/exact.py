"""Exact duplicates by deterministic block naming.

Every normalised text is cut into fixed-size blocks.  The distinct blocks are sorted and numbered:
that number is a block's name, and two blocks have the same name only if their contents are equal.
Then adjacent names are paired, the distinct pairs sorted and numbered again, and so on until each
text has one name.  Texts with the same (level, name) are equal, without any trust in a hash.

The texts are read, lower-cased and cut once; the blocks are stored, and the first level is made from
that table.  How a name gets back to its block's row: rows and distinct blocks meet on a 64-bit fingerprint, so
that contents are shuffled once only.  A fingerprint that two different contents share is detected
on the distinct blocks; rows with such a fingerprint meet their names on the content itself.

Scale: distinct blocks are combined before the shuffle, so a block held by a third of the rows is
one row per task.  The way back is an equi join of two stored tables, whose hot keys AQE splits.
After the first level only names (two integers a pair) move.  The number of levels is the binary
logarithm of the longest text's number of blocks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import RID, Scratch, ascii_lower, by_key, stored, with_rid

BLOCK_CHARS = 4096
#: Second half of a pair whose first half is the last name of an odd row.
NO_NAME = -1


def _numbered(distinct: DataFrame, keys: list[str], name: str = "name") -> DataFrame:
    """Names of distinct keys: each partition is sorted and numbered in its own range of integers."""
    return distinct.sortWithinPartitions(*keys).withColumn(name, F.monotonically_increasing_id())


def block_rows(docs: DataFrame, id_col: str, text_col: str, block_chars: int,
               fingerprint: Callable[[Column], Column]) -> DataFrame:
    """One row per block: row id, block index, number of blocks, fingerprint, content; the
    document's id and digest ride on the first block only."""
    norm = docs.select(RID, F.col(id_col).alias("id"),
                       ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("t"))
    cut = F.when(F.col("t") == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all("t", F.lit(rf"(?s).{{1,{block_chars}}}"), F.lit(0)))
    rows = norm.select(RID, "id", F.sha2("t", 256).alias("sha"), cut.alias("cut"))
    rows = rows.select(RID, "id", "sha", F.size("cut").alias("n_blocks"), F.posexplode("cut").alias("i", "block"))
    first = F.col("i") == 0
    return rows.select(RID, "i", "n_blocks", F.when(first, F.col("id")).alias("id"),
                       F.when(first, F.col("sha")).alias("sha"), fingerprint(F.col("block")).alias("fp"), "block")


def _name_blocks(rows: DataFrame) -> DataFrame:
    names = stored(_numbered(rows.select("block", "fp").distinct(), ["block"]).select("fp", "name"), "blocknames")
    shared = stored(names.groupBy("fp").count().where("count > 1").select("fp"), "sharedfp")
    plain = rows.drop("block").join(names, "fp")
    if not shared.isEmpty():
        clear = names.join(shared, "fp", "left_anti")
        plain = rows.drop("block").join(clear, "fp")
        unclear = rows.join(shared, "fp", "left_semi")
        # numbers below NO_NAME, so that they never meet those of the clear blocks
        by_text = _numbered(unclear.select("block").distinct(), ["block"]).withColumn("name", F.lit(NO_NAME - 1) - F.col("name"))
        plain = plain.unionByName(unclear.join(stored(by_text, "blocktexts"), "block").drop("block"))
    return plain


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS,
               fingerprint: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """``docs`` must carry the row id; returns (row id, id, text_sha256, level, name), one row a document."""
    with Scratch() as parts:
        rows = _name_blocks(stored(block_rows(docs, id_col, text_col, block_chars, fingerprint), "blocks"))
        named = parts.keep(stored(rows.select(RID, "i", "n_blocks", "id", "sha", "name"), "named"))
    done = named.where("n_blocks = 1").select(RID, F.lit(0).alias("level"), "name")
    # a document's names, in order; no longer than its own text
    lists = named.where("n_blocks > 1").groupBy(RID).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "name"))), lambda x: x["name"]).alias("names"))
    level = 0
    while True:
        lists = stored(lists, f"level{level}")
        if lists.isEmpty():
            break
        level += 1
        pair = F.transform(F.sequence(F.lit(0), F.size("names") - 1, F.lit(2)),
                           lambda k: F.struct(F.get("names", k).alias("a"),
                                              F.coalesce(F.get("names", k + 1), F.lit(NO_NAME)).alias("b")))
        pairs = lists.select(RID, F.size("names").alias("n"), F.posexplode(pair).alias("i", "p")).select(
            RID, "n", "i", "p.a", "p.b")
        names = stored(_numbered(pairs.select("a", "b").distinct(), ["a", "b"]), "pairnames")
        up = pairs.join(names, ["a", "b"])
        done = done.unionByName(up.where("n <= 2").select(RID, F.lit(level).alias("level"), "name"))
        lists = up.where("n > 2").groupBy(RID).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("i", "name"))), lambda x: x["name"]).alias("names"))
    heads = named.where("i = 0").select(RID, "id", F.col("sha").alias("text_sha256"))
    return stored(heads.join(done, RID), "identity")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS,
                 fingerprint: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: row id, id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty, and all
    empty texts form one group.  Of a group the row with the largest id stays; a null id is
    smaller than any other, and among rows with the same id the later row of the table stays.
    Other columns of ``docs`` are never read.  An empty table gives an empty result.
    """
    ids = identities(docs if RID in docs.columns else with_rid(docs), id_col, text_col, block_chars, fingerprint)
    groups = stored(ids.groupBy("level", "name").agg(
        F.max(F.struct(F.col("id"), F.col(RID).alias("r"))).alias("top"), F.count(F.lit(1)).alias("group_size")), "groups")
    return ids.join(groups, ["level", "name"]).select(
        RID, F.col("id").alias(id_col), F.col("top.id").alias("keep_id"), "group_size",
        (F.col(RID) == F.col("top.r")).alias("kept"), "text_sha256")


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are."""
    tagged = with_rid(docs)
    with Scratch() as parts:
        gone = parts.keep(stored(exact_groups(tagged, id_col, text_col).where(~F.col("kept")).select(RID), "copies"))
    return by_key(tagged, gone, RID, "left_anti").drop(RID)
