"""Benchmark passages in documents, by a positional inverted index.

The index holds (term id, document row, position), and each document's number of words under a mark of
its own.  A first pass counts the terms that queries have; the second stores postings of each phrase's two
rarest terms only, so a common word costs a counter and no rows.  Each posting, moved back by the term's
offset in the phrase, is a possible start, and the two lists are intersected on (document, start).  What is
left is compared with the document's own words, so results are exact.

Scale: neither pass shuffles more than counts while the query terms are few enough for Spark to broadcast
their stored table, and every later step is linear in postings of rare terms or in real
matches.  Term and window tables are stored, so Spark broadcasts them only below its own size
threshold and shuffles both sides above.  All of it is DataFrame work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import RID, WORD, Scratch, ascii_lower, by_key, stored, with_rid

WINDOW = 10
#: Stands after a document's last word in the index; no word can be that.
MARK = " "


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def build_index(docs: DataFrame, terms: DataFrame, text_col: str = "text") -> DataFrame:
    """Postings (tid, row id, pos) of the words in ``terms`` (term, tid); the term ``MARK`` has every
    document's number of words as its position."""
    words = F.concat(words_of(F.col(text_col)), F.array(F.lit(MARK)))
    return docs.select(RID, F.posexplode(words).alias("pos", "term")).join(terms, "term").select("tid", RID, "pos")


def query_terms(terms: DataFrame) -> DataFrame:
    """(term, tid) of a column ``term``, and the mark with tid -1; stored."""
    numbered = terms.select("term").distinct().sortWithinPartitions("term").withColumn("tid", F.monotonically_increasing_id())
    mark = terms.sparkSession.range(1).select(F.lit(MARK).alias("term"), F.lit(-1).cast("long").alias("tid"))
    return stored(numbered.unionByName(mark), "terms")


def item_windows(items: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, win): every run of ``size`` words; an item with fewer words, but not none, is one run."""
    words = items.select(F.col(id_col).alias("item"), words_of(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    last = F.greatest(F.size("w") - size, F.lit(0))
    return words.select("item", F.explode(F.transform(F.sequence(F.lit(0), last), lambda k: F.slice("w", k + 1, size))).alias("win"))


def phrase_matches(docs: DataFrame, phrases: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Exact places of phrases, (row id, start, phrase), one row each, and the stored index of their rarest
    terms and of the numbers of words.

    ``docs`` carries the row id; ``phrases`` has (phrase: any id, win: array of words, not empty),
    each win once.
    """
    spots = phrases.select("phrase", F.size("win").alias("n"), F.posexplode("win").alias("off", "term"))
    terms = query_terms(spots)
    words = docs.select(F.explode(words_of(F.col(text_col))).alias("term"))
    counts = stored(words.join(terms, "term").groupBy("tid").agg(F.count(F.lit(1)).alias("df")), "counts")
    # a phrase with a term that no document has is not looked up
    known = spots.join(terms, "term").join(counts, "tid", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    rare = known.withColumn("least", F.min("df").over(Window.partitionBy("phrase"))).where("least > 0").withColumn(
        "nth", F.row_number().over(Window.partitionBy("phrase").orderBy("df", "off"))).where("nth <= 2")
    rare = stored(rare.select("phrase", "tid", "off", "n", "nth"), "rareterms")
    searched = stored(terms.join(rare.select("tid").distinct().unionByName(terms.where(F.col("term") == MARK).select("tid")), "tid", "left_semi"), "searched")
    index = stored(build_index(docs, searched, text_col), "index")
    lists = index.join(rare, "tid").select(RID, "phrase", (F.col("pos") - F.col("off")).alias("start"), "nth", "n").where("start >= 0")
    lists = stored(lists, "lists")
    starts = lists.where("nth = 1").select(RID, "phrase", "start", "n")
    second = lists.where("nth = 2").select(RID, "phrase", "start")
    starts = starts.where("n = 1").unionByName(starts.where("n > 1").join(second, [RID, "phrase", "start"])).drop("n")
    starts = stored(starts, "starts")
    # the rest of the phrase, on the documents that have a start
    text = by_key(docs.select(RID, text_col), starts.select(RID).distinct(), RID, "left_semi")
    words = text.select(RID, words_of(F.col(text_col)).alias("w"))
    tries = starts.join(phrases, "phrase").groupBy(RID).agg(F.collect_list(F.struct("phrase", "start", "win")).alias("tries"))
    found = words.join(tries, RID).select(RID, F.explode(F.filter(
        "tries", lambda t: F.slice("w", t["start"] + 1, F.size(t["win"])) == t["win"])).alias("t"))
    return found.select(RID, "t.start", "t.phrase"), index


def proximity_matches(docs: DataFrame, queries: DataFrame, span: int, text_col: str = "text") -> DataFrame:
    """(row id, query, start): places where all terms of a query (query, terms: array) stand within
    ``span`` words, in any order; ``start`` is the first word of such a stretch."""
    asked = queries.select("query", F.explode(F.array_distinct("terms")).alias("term"))
    wanted = queries.select("query", F.size(F.array_distinct("terms")).alias("n"))
    terms = query_terms(asked)
    index = build_index(docs, terms, text_col).join(asked.join(terms, "term"), "tid")
    ahead = Window.partitionBy(RID, "query").orderBy("pos").rangeBetween(0, span - 1)
    return (index.withColumn("seen", F.size(F.collect_set("tid").over(ahead))).join(wanted, "query")
            .where("seen = n").select(RID, "query", F.col("pos").alias("start")))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id",
                  text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: row id, id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit when it lies inside any place of a window of any item.  Null texts have no words,
    documents' and items' alike.  Repeated items count once by id; an item without id hits words but
    is neither counted nor listed.  Empty tables give no rows, or rows without hits.
    """
    docs = docs if RID in docs.columns else with_rid(docs)
    owners = stored(item_windows(items, size, item_col, text_col).distinct(), "itemwindows")
    phrases = stored(owners.select("win").distinct().sortWithinPartitions("win").withColumn(
        "phrase", F.monotonically_increasing_id()), "phrases")
    owners = owners.join(phrases, "win").select("phrase", F.col("item").cast("string").alias("item"))
    matches, index = phrase_matches(docs, phrases, text_col)
    places = stored(matches.join(
        phrases.select("phrase", F.size("win").alias("n")), "phrase"), "places")
    # words covered: each place adds what lies beyond the farthest end before it
    before = Window.partitionBy(RID).orderBy("start", "n", "phrase").rowsBetween(Window.unboundedPreceding, -1)
    covered = (places.withColumn("end", F.col("start") + F.col("n"))
               .withColumn("reach", F.coalesce(F.max("end").over(before), F.lit(0)))
               .groupBy(RID).agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "reach"))).alias("n_hit")))
    listed = places.select(RID, "phrase").distinct().join(owners, "phrase").groupBy(RID).agg(F.collect_set("item").alias("items"))
    hits = covered.join(listed, RID, "left")
    rows = docs.select(RID, F.col(id_col)).join(
        index.where("tid = -1").select(RID, F.col("pos").cast("long").alias("n_words")), RID)
    items_of = F.array_sort(F.coalesce("items", F.array().cast("array<string>")))
    return rows.join(hits, RID, "left").select(
        RID, id_col, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_of).cast("long").alias("n_items"), F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any window of an item, all columns as they are."""
    tagged = with_rid(docs)
    with Scratch() as parts:
        gone = parts.keep(stored(contamination(tagged, items).where("contaminated").select(RID), "contaminated"))
    return by_key(tagged, gone, RID, "left_anti").drop(RID)
