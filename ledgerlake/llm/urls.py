"""URL allow / block lists as a trie over reversed host labels and path segments.

A rule is (host, path, verdict); it fits its host and all subdomains when the url's path starts
with the rule's path.  The longest rule wins: more host labels first, then the longer path.  The
trie walks a host from its last label, and below every host node the path segment by segment, so a
url costs its own length whatever the number of rules.

The trie is broadcast, so the rule list must be small: ``MAX_TRIE_BYTES`` is checked on the driver's
list.  A larger list is a table: ``judge_by_join`` joins each url's own host suffixes to it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import RID, ascii_lower, with_rid

MAX_TRIE_BYTES = 64 * 2**20


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for a null url or one without ``://``."""
    url = F.coalesce(url, F.lit(""))
    return (ascii_lower(F.regexp_extract(url, r"://([^/?#]*)", 1)),
            F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1))


class Node:
    """A trie node: host labels and path segments lead on; ``ends`` holds rules whose path ends inside
    the next segment, by that last piece of theirs."""

    __slots__ = ("labels", "path", "segments", "ends", "longest")

    def __init__(self):
        self.labels: dict[str, Node] = {}
        self.path: Node | None = None
        self.segments: dict[str, Node] = {}
        self.ends: dict[str, Rule] = {}
        self.longest = 0


def build(rules: Iterable[Rule]) -> Node:
    """The trie; of two rules with the same host and path the later one holds."""
    root = Node()
    for rule in rules:
        at = root
        for label in reversed(rule.host.split(".")):
            at = at.labels.setdefault(label, Node())
        at.path = at.path or Node()
        at = at.path
        *whole, end = rule.path.split("/")
        for segment in whole:
            at = at.segments.setdefault(segment, Node())
        at.ends[end] = rule
        at.longest = max(at.longest, len(end))
    return root


def _path_match(at: Node, segments: list[str]) -> Rule | None:
    best = None
    for segment in segments:
        if at.ends:
            best = next((r for k in range(min(at.longest, len(segment)), -1, -1) if (r := at.ends.get(segment[:k]))), best)
        at = at.segments.get(segment)
        if at is None:
            break
    return best


def match(trie: Node, host: str, path: str) -> Rule | None:
    best, at, segments = None, trie, path.split("/")
    for label in reversed(host.split(".")):
        at = at.labels.get(label)
        if at is None:
            break
        if at.path is not None:
            best = _path_match(at.path, segments) or best
    return best


def judge(pages: DataFrame, rules: list[Rule], default: str = "allow", id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) for every row; ``rule`` is null where none fits, and the verdict
    is then ``default`` (also for a null url, or one without a host).  Repeated rows are judged each,
    urls whole however long; an empty table gives no rows, and further columns of any name are not read."""
    if sum(len(r.text) + 200 for r in rules) > MAX_TRIE_BYTES:
        table = pages.sparkSession.createDataFrame([(*r, k) for k, r in enumerate(rules)], "verdict string, host string, path string, position long")
        return judge_by_join(pages, table, default, id_col, url_col)
    trie = pages.sparkSession.sparkContext.broadcast(rules)

    @F.pandas_udf("struct<rule string, verdict string>")
    def look_up(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        root = build(trie.value)
        for hosts, paths in batches:
            found = [match(root, h, p) for h, p in zip(hosts, paths)]
            yield pd.DataFrame({"rule": [r.text if r else None for r in found],
                                "verdict": [r.verdict if r else default for r in found]})

    host, path = host_path(F.col(url_col))
    out = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    return out.withColumn("hit", look_up("host", "path")).select(id_col, "host", "path", "hit.rule", "hit.verdict")


def judge_by_join(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id",
                  url_col: str = "url") -> DataFrame:
    """The same for a rule table of any size: every url meets the rules of its own host suffixes.  Of
    rules with the same host and path the one with the largest ``position`` holds; a table without
    that column has no order, and there the largest verdict holds."""
    last = "position" if "position" in rules.columns else "verdict"
    rules = rules.groupBy("host", "path").agg(F.max_by("verdict", last).alias("verdict"))
    host, path = host_path(F.col(url_col))
    urls = with_rid(pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path")))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, 2**30), "."))
    hits = (urls.select(RID, F.col("path").alias("at"), F.explode(suffixes).alias("host")).join(rules, "host")
            .where(F.startswith("at", "path"))
            .withColumn("n", F.row_number().over(Window.partitionBy(RID).orderBy(
                F.length("host").desc(), F.length("path").desc())))
            .where("n = 1").select(RID, F.concat("host", "path").alias("rule"), "verdict"))
    return urls.join(hits, RID, "left").select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
