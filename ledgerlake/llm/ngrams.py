"""Near duplicates: an exact Jaccard self-join of shingle sets under several token orders.

Texts with the same set are one class, so copies cost one aggregate.  Two classes can only be linked
if their sets share tokens in their prefixes under *every* global order of the tokens.  Candidates come from
the second order, and each has to share enough of its prefixes in the first one too before its sets are
compared:

1. Hash order.  With needed overlap c(n) = ceil(t n), the first n - c + l tokens of two linked sets
   share at least l tokens (l grows with n).  Classes whose prefix has fewer tokens that any other
   class's prefix also has are out; of the others the last such token is kept, which tells for any
   token of the class whether it is in the prefix.
2. Rarest first, by document frequency among the survivors.  Unshared tokens come first in that
   order, so a class with more than n - c of them is out; for the rest, the shared part of the
   prefix is what pairs are found by, and common passages are at the far end of it.

Pairs: each prefix token first ties its holders to one pivot, the one with the fewest unshared
tokens, so a large group of near copies costs one pair a member.  Each such pair is verified.  What
is left are links between classes in different components, found in two ways:

* classes that share a token with at most ``CROWD`` holders meet on that token;
* classes that share only tokens with more holders share one in their prefixes, and both were
  compared with its pivot.  Their overlap is at most the lesser of their overlaps with the pivot plus
  the lesser of what they have besides it, so members of a crowd that are too far from its pivot
  meet nobody.

All pairs are verified on the sets; every link between components is found, and no cap on partners or
candidates exists.

Tokens are 64-bit hashes of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import RID, Scratch, by_key, forget, stored, with_rid
from ledgerlake.llm.graph import components
from ledgerlake.llm.hashing import pressed, shingle_sets, text_chunks, unpress

WIDTH, PERCENT = 5, 80
#: Holders of a token that meet each other without regard to the token's pivot.
CROWD = 32
#: One more token must be shared in the hash-order prefix for so many tokens of a set.
EXTRA = 12


def needed(n, percent: int = PERCENT):
    """Least overlap of a set of n tokens with any set linked to it."""
    return -(-n * percent // 100)


def _sets(docs: DataFrame, text_col: str, width: int, percent: int) -> DataFrame:
    """(row id, n, s1, s2, prefix): size, two sums that identify the set, hash-order prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, s1, s2, prefixes = [], [], [], []
            for _, data, offsets in text_chunks(batch.column(1)):
                for s in shingle_sets(data, offsets, width):
                    n.append(len(s))
                    s1.append(s.sum(dtype=np.uint64))
                    s2.append(np.bitwise_xor.reduce(s * np.uint64(0x9E3779B97F4A7C15) ^ (s >> np.uint64(29))) if len(s) else 0)
                    prefixes.append(s[:len(s) - needed(len(s), percent) + 1 + len(s) // EXTRA])
            yield _batch([batch.column(0), pa.array(n, pa.int64()), _longs(s1), _longs(s2), _lists(prefixes)],
                         [RID, "n", "s1", "s2", "prefix"])

    return docs.select(RID, F.col(text_col).cast("string")).mapInArrow(
        run, f"{RID} long, n long, s1 long, s2 long, prefix array<long>")


def _longs(values: list) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def _batch(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, names)


def _tokens(texts: DataFrame, width: int) -> DataFrame:
    """(cls, n, h, tokens) of rows (cls, n, h, z: compressed text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for _, data, offsets in text_chunks(unpress(batch.column(3))) for s in shingle_sets(data, offsets, width)]
            yield _batch([*batch.columns[:3], _lists(sets)], ["cls", "n", "h", "tokens"])

    return texts.select("cls", "n", "h", "z").mapInArrow(run, "cls long, n long, h long, tokens array<long>")


def _place(token: Column) -> Column:
    """A token's place in hash order: its 64 bits without a sign, as a number that compares alike."""
    return token.bitwiseXOR(F.lit(-2 ** 63))


def _agree() -> Column:
    """Do the sets of a pair share as many tokens in their hash-order prefixes as linked sets must?

    The prefix of a set is its tokens up to place h.  With overlap o >= c(n) both prefixes hold the first
    n - o + l tokens of their sets for the lesser l of the two, which share l tokens at least."""
    x = F.filter("ta", lambda token: _place(token) <= F.col("ha"))
    y = F.filter("tb", lambda token: _place(token) <= F.col("hb"))
    return F.size(F.array_intersect(x, y)) >= F.floor(F.least("na", "nb") / EXTRA) + 1


def _enough(overlap: Column, percent: int, x: str = "x.n", y: str = "y.n") -> Column:
    """Is that overlap of sets of these sizes a link?"""
    return overlap * (100 + percent) >= (F.col(x) + F.col(y)) * percent


def _sides(pairs: DataFrame, live: DataFrame) -> DataFrame:
    """The sets of pairs (a, b)."""
    x, y = (live.select(F.col("cls").alias(i), F.col("n").alias(f"n{i}"), F.col("h").alias(f"h{i}"), F.col("tokens").alias(f"t{i}"),
                        F.col("few").alias(f"f{i}")) for i in "ab")
    return pairs.join(x, "a").join(y.drop("fb"), "b")


def _overlaps(pairs: DataFrame, live: DataFrame) -> DataFrame:
    """(a, b, na, nb, o, oc, rc): sizes, overlap (0 if the hash order rules a link out), overlap in tokens
    with a crowd, and a's other tokens with a crowd."""
    crowd = F.slice("ta", F.col("fa") + 1, F.size("ta"))
    both = _sides(pairs, live).withColumn("oc", F.size(F.array_intersect(crowd, "tb")))
    return both.select("a", "b", "na", "nb", F.when(_agree(), F.size(F.array_intersect("ta", "tb"))).otherwise(0).alias("o"), "oc",
                       (F.size("ta") - F.col("fa") - F.col("oc")).alias("rc"))


def _links(overlaps: DataFrame, percent: int) -> DataFrame:
    return overlaps.where(_enough(F.col("o"), percent, "na", "nb")).select("a", "b")


def _verified(pairs: DataFrame, live: DataFrame, percent: int) -> DataFrame:
    """The pairs that are links; only those that both orders propose are compared."""
    asked = _sides(pairs, live).where(_agree())
    return _links(asked.select("a", "b", "na", "nb", F.size(F.array_intersect("ta", "tb")).alias("o")), percent)


def near_links(docs: DataFrame, text_col: str = "text", width: int = WIDTH, percent: int = PERCENT,
               crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """``docs`` carries the row id.  Returns (row id, n, cls) for every row, cls null without words, and
    verified links (a, b) of classes that span all components of the similarity graph."""
    sets = stored(_sets(docs, text_col, width, percent), "sets")
    classes = stored(sets.where("n > 0").groupBy("n", "s1", "s2").agg(F.min(RID).alias("cls")), "classes")
    members = stored(sets.select(RID, "n", "s1", "s2").join(classes, ["n", "s1", "s2"], "left").select(RID, "n", "cls"), "members")

    # order 1: prefixes in hash order
    heads = by_key(sets, classes.select(F.col("cls").alias(RID)), RID, "left_semi")
    postings = heads.select(F.col(RID).alias("cls"), "n", F.explode("prefix").alias("token"))
    shared = stored(postings.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select("token"), "sharedtokens")
    least = F.floor(F.ceil(F.col("n") * percent / 100) / EXTRA) + 1
    first = by_key(postings, shared, "token", "left_semi").groupBy("cls", "n").agg(
        F.count(F.lit(1)).alias("k"), F.max(_place(F.col("token"))).alias("h")).where(F.col("k") >= least).select("cls", "n", "h")

    # order 2: rarest first among the survivors
    texts = by_key(pressed(docs, text_col).withColumnRenamed(RID, "cls"), first, "cls")
    every = _tokens(texts, width)
    tokens = stored(every, "tokens")
    forget(sets, classes, shared)
    each = tokens.select("cls", "n", "h", F.explode("tokens").alias("token"))
    df = stored(each.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "df")
    spare = F.col("n") - F.ceil(F.col("n") * percent / 100)
    live = by_key(each, df, "token").groupBy("cls", "n", "h").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("t")).withColumn(
        "u", F.col("n") - F.size("t")).where(F.col("u") <= spare).select(
        "cls", "n", "h", "u", F.col("t.token").alias("tokens"),
        F.size(F.filter("t", lambda t: t["df"] <= crowd)).alias("few"))  # tokens with few holders come first
    live = stored(live, "live")
    forget(tokens, df)
    held = live.select("cls", "n", "u", "few", (spare + 1 - F.col("u")).cast("int").alias("p"), F.posexplode("tokens").alias("k", "token"))
    prefix = held.where("k < p")

    # one pivot a token
    ranked = F.struct((F.col("u") / F.col("n")).alias("r"), "cls")
    pivots = stored(prefix.groupBy("token").agg(F.min(ranked).alias("p"), F.count(F.lit(1)).alias("c")).where("c > 1").select(
        "token", F.col("p.cls").alias("pivot")), "pivots")
    tries = prefix.join(pivots, "token").where("cls <> pivot").select(F.col("cls").alias("a"), F.col("pivot").alias("b")).distinct()
    compared = stored(_overlaps(tries, live), "compared")
    links = _links(compared, percent)

    # what the pivots left apart: tokens with holders in several components
    roots = components(links)
    held = held.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    held = stored(held.where("k < few or k < p").select("token", "cls", "n", "u", "root", (F.col("k") < F.col("few")).alias("few")), "held")
    split = held.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("token")
    every, held = held, stored(held.join(split, "token", "left_semi"), "apart")
    forget(every)
    cross = (F.col("x.cls") < F.col("y.cls")) & (F.col("x.root") != F.col("y.root"))
    most = F.least(F.col("x.n") - F.col("x.u"), F.col("y.n") - F.col("y.u"))
    few = held.where("few")
    near = few.alias("x").join(few.alias("y"), "token").where(cross & _enough(most, percent))
    crowded = held.where("not few").join(pivots, "token").join(
        compared.select(F.col("a").alias("cls"), F.col("b").alias("pivot"), "oc", "rc"), ["cls", "pivot"])
    most = F.least(F.col("x.oc"), F.col("y.oc")) + F.least(F.col("x.rc"), F.col("y.rc"))
    far = crowded.alias("x").join(crowded.alias("y"), "token").where(cross & _enough(most, percent))
    ends = [F.col("x.cls").alias("a"), F.col("y.cls").alias("b")]
    pairs = near.select(*ends).unionByName(far.select(*ends)).distinct()
    return members, links.unionByName(_verified(pairs, live, percent))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                percent: int = PERCENT, crowd: int = CROWD) -> DataFrame:
    """(row id, id, n_shingles, component_id, kept), one row per row of ``docs``.

    ``component_id`` is the least id reachable by links, the row's own included (null ids are passed
    over, unless there is no other).  A null text, or one without words, has no shingles and is linked
    with nothing.  ``kept`` marks one row of each component: its least id, the first row on ties.  Texts are
    read whole, however long; an empty table gives no rows, and further columns of any name are not read.
    """
    docs = docs if RID in docs.columns else with_rid(docs)
    with Scratch() as parts:
        members, links = near_links(docs, text_col, width, percent, crowd)
        links = parts.keep(stored(links, "links"))
        parts.keep(members)
    roots = components(links)
    ids = docs.select(RID, F.col(id_col).alias("id")).join(members, RID).join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    # rows without words stand alone, in a number range of their own
    ids = stored(ids.select(RID, "id", "n", F.coalesce("root", "cls", -1 - F.col(RID)).alias("root")), "rooted")
    least = stored(ids.groupBy("root").agg(F.min("id").alias("component_id"), F.min(
        F.struct(F.col("id").isNull().alias("none"), "id", F.col(RID).alias("r"))).alias("top")), "leasts")
    return ids.join(least, "root").select(
        RID, F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", (F.col(RID) == F.col("top.r")).alias("kept"))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, all columns as they are."""
    tagged = with_rid(docs)
    with Scratch() as parts:
        gone = parts.keep(stored(near_groups(tagged, id_col, text_col).where(~F.col("kept")).select(RID), "nearcopies"))
    return by_key(tagged, gone, RID, "left_anti").drop(RID)
