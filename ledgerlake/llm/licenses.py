"""License mentions by ordered signature rules.

A text becomes its words, lower-cased and joined by single spaces, so that a rule's regular expression
sees neither punctuation nor line breaks.  Rules are tried on a text only if all their keywords occur
in it (and a text without any gate word is not looked at twice).  Detections of different rules that
touch each other are settled together: one that lies inside another of higher priority, or of the
same priority and longer, is dropped.

All of it is DataFrame work; a document's detections are the only things grouped, and a group is a run
of touching detections within one text.
"""

from __future__ import annotations

import json
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import ANY_CASE_WORD, RID, WORD, ascii_lower, stored, with_rid


class Rule(NamedTuple):
    label: str
    priority: int
    keywords: tuple[str, ...]
    regex: str


#: Base phrases: always reported, never suppressed.
BASE = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}

#: Every rule has one of these in its keywords, or "cc by", so a text without any of them has no
#: detection.
GATE = ("licen", "copyright", "copyleft", "reserved", "public domain", "creative commons", "spdx", "gpl", "warrant", "attribution", "permission",
        "unlicense", "cc0", "redistribut", "advertising", "endorse")

V = r"(?: version| v)?"
#: Families: label, keywords of the name, the name as words, the SPDX id as words.  Every match of a rule
#: has each of its keywords at the start of a word; names that share no such word are families of their own.
FAMILIES = [
    ("agpl-3.0", ("affero",), rf"(?:gnu )?affero general public licen[cs]e{V} v?3(?: 0)?", "agpl 3 0"),
    ("agpl", ("affero",), r"(?:gnu )?affero general public licen[cs]e", "agpl"),
    ("lgpl-2.1", ("lesser",), rf"(?:gnu )?lesser general public licen[cs]e{V} v?2 1", "lgpl 2 1"),
    ("lgpl-3.0", ("lesser",), rf"(?:gnu )?lesser general public licen[cs]e{V} v?3(?: 0)?", "lgpl 3 0"),
    ("lgpl", ("lesser",), r"(?:gnu )?lesser general public licen[cs]e", "lgpl"),
    ("lgpl-2.0", ("library",), rf"(?:gnu )?library general public licen[cs]e{V}(?: 2(?: 0)?)?", "lgpl 2 0"),
    ("gpl-3.0", ("general",), rf"(?:gnu )?general public licen[cs]e{V} v?3(?: 0)?", "gpl 3 0"),
    ("gpl-2.0", ("general",), rf"(?:gnu )?general public licen[cs]e{V} v?2(?: 0)?", "gpl 2 0"),
    ("gpl-1.0", ("general",), rf"(?:gnu )?general public licen[cs]e{V} v?1(?: 0)?", "gpl 1 0"),
    ("gpl", ("general",), r"gnu general public licen[cs]e", "gpl"),
    ("gfdl-1.3", ("documentation",), rf"(?:gnu )?free documentation licen[cs]e{V} v?1 3", "gfdl 1 3"),
    ("gfdl", ("documentation",), r"(?:gnu )?free documentation licen[cs]e", "gfdl"),
    ("apache-2.0", ("apache",), rf"apache(?: software)? licen[cs]e{V} v?2(?: 0)?", "apache 2 0"),
    ("apache-1.1", ("apache",), rf"apache(?: software)? licen[cs]e{V} v?1 1", "apache 1 1"),
    ("apache", ("apache",), r"apache(?: software)? licen[cs]e", "apache"),
    ("mit", ("mit",), r"mit licen[cs]e", "mit"),
    ("mit-0", ("mit",), r"mit no attribution licen[cs]e", "mit 0"),
    ("x11", ("x11",), r"(?:mit )?x11 licen[cs]e", "x11"),
    ("isc", ("isc",), r"isc licen[cs]e", "isc"),
    ("bsd-2-clause", ("bsd",), r"(?:simplified bsd|bsd 2 clause|2 clause bsd) licen[cs]e", "bsd 2 clause"),
    ("bsd-2-clause", ("freebsd",), r"freebsd licen[cs]e", "bsd 2 clause"),
    ("bsd-3-clause", ("bsd",), r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd) licen[cs]e", "bsd 3 clause"),
    ("bsd-4-clause", ("bsd",), r"(?:original bsd|bsd 4 clause|4 clause bsd) licen[cs]e", "bsd 4 clause"),
    ("0bsd", ("bsd",), r"(?:zero clause bsd|0 clause bsd) licen[cs]e", "0bsd"),
    ("0bsd", ("0bsd",), r"0bsd licen[cs]e", "0bsd"),
    ("bsd", ("bsd",), r"bsd(?: style)? licen[cs]e", "bsd"),
    ("mpl-1.1", ("mozilla",), rf"mozilla public licen[cs]e{V} v?1 1", "mpl 1 1"),
    ("mpl-2.0", ("mozilla",), rf"mozilla public licen[cs]e{V} v?2(?: 0)?", "mpl 2 0"),
    ("mpl", ("mozilla",), r"mozilla public licen[cs]e", "mpl"),
    ("epl-1.0", ("eclipse",), rf"eclipse public licen[cs]e{V} v?1(?: 0)?", "epl 1 0"),
    ("epl-2.0", ("eclipse",), rf"eclipse public licen[cs]e{V} v?2(?: 0)?", "epl 2 0"),
    ("epl", ("eclipse",), r"eclipse public licen[cs]e", "epl"),
    ("edl-1.0", ("eclipse",), rf"eclipse distribution licen[cs]e(?:{V} v?1(?: 0)?)?", "edl 1 0"),
    ("eupl-1.2", ("european",), rf"european union public licen[cs]e{V} v?1 2", "eupl 1 2"),
    ("eupl", ("european",), r"european union public licen[cs]e", "eupl"),
    ("cddl-1.0", ("development",), rf"common development and distribution licen[cs]e{V} v?1(?: 0)?", "cddl 1 0"),
    ("cddl", ("development",), r"common development and distribution licen[cs]e", "cddl"),
    ("cpl-1.0", ("common",), rf"common public licen[cs]e(?:{V} v?1(?: 0)?)?", "cpl 1 0"),
    ("ipl-1.0", ("ibm",), rf"ibm public licen[cs]e(?:{V} v?1(?: 0)?)?", "ipl 1 0"),
    ("artistic-2.0", ("artistic",), rf"artistic licen[cs]e{V} v?2(?: 0)?", "artistic 2 0"),
    ("artistic", ("artistic",), r"artistic licen[cs]e", "artistic"),
    ("zlib", ("zlib",), r"zlib(?: libpng)? licen[cs]e", "zlib"),
    ("libpng", ("libpng",), r"libpng licen[cs]e", "libpng"),
    ("boost-1.0", ("boost",), rf"boost software licen[cs]e(?:{V} v?1(?: 0)?)?", "bsl 1 0"),
    ("business-source-1.1", ("business",), rf"business source licen[cs]e(?:{V} v?1 1)?", "busl 1 1"),
    ("elastic-2.0", ("elastic",), rf"elastic licen[cs]e(?:{V} v?2(?: 0)?)?", "elastic 2 0"),
    ("sspl-1.0", ("side",), rf"server side public licen[cs]e(?:{V} v?1(?: 0)?)?", "sspl 1 0"),
    ("python-2.0", ("python",), rf"python(?: software foundation)? licen[cs]e(?:{V} v?2(?: 0)?)?", "python 2 0"),
    ("php-3.01", ("php",), rf"php licen[cs]e(?:{V} v?3 01)?", "php 3 01"),
    ("ruby", ("ruby",), r"ruby licen[cs]e", "ruby"),
    ("postgresql", ("postgresql",), r"postgresql licen[cs]e", "postgresql"),
    ("openssl", ("openssl",), r"openssl licen[cs]e", "openssl"),
    ("unlicense", ("unlicense",), r"the unlicense", "unlicense"),
    ("ms-pl", ("microsoft",), r"microsoft public licen[cs]e", "ms pl"),
    ("ms-rl", ("microsoft",), r"microsoft reciprocal licen[cs]e", "ms rl"),
    ("odbl-1.0", ("database",), rf"open(?: data commons open)? database licen[cs]e(?:{V} v?1(?: 0)?)?", "odbl 1 0"),
    ("odc-by-1.0", ("attribution",), rf"open data commons attribution licen[cs]e(?:{V} v?1(?: 0)?)?", "odc by 1 0"),
    ("pddl-1.0", ("dedication",), r"public domain dedication and licen[cs]e", "pddl 1 0"),
    ("ofl-1.1", ("font",), rf"(?:sil )?open font licen[cs]e(?:{V} v?1 1)?", "ofl 1 1"),
    ("afl-3.0", ("academic",), rf"academic free licen[cs]e(?:{V} v?3(?: 0)?)?", "afl 3 0"),
    ("osl-3.0", ("software",), rf"open software licen[cs]e(?:{V} v?3(?: 0)?)?", "osl 3 0"),
    ("cecill-2.1", ("cecill",), rf"cecill(?: free software)? licen[cs]e(?:{V} v?2 1)?", "cecill 2 1"),
    ("upl-1.0", ("universal",), rf"universal permissive licen[cs]e(?:{V} v?1(?: 0)?)?", "upl 1 0"),
    ("ncsa", ("illinois",), r"(?:university of )?illinois(?: ncsa)?(?: open source)? licen[cs]e", "ncsa"),
    ("w3c", ("w3c",), r"w3c(?: software)?(?: notice and)? licen[cs]e", "w3c"),
    ("wtfpl", ("want",), r"do what the fuck you want to public licen[cs]e", "wtfpl"),
    ("sleepycat", ("sleepycat",), r"sleepycat licen[cs]e", "sleepycat"),
    ("vim", ("vim",), r"vim licen[cs]e", "vim"),
    ("blueoak-1.0.0", ("oak",), r"blue oak model licen[cs]e(?: 1 0 0)?", "blueoak 1 0 0"),
    ("openrail", ("open",), r"(?:creativeml |bigscience )?open ?rail(?: m)? licen[cs]e", "openrail"),
]

#: Creative Commons licenses by their parts; {} is the version.
CC_PARTS = [
    ("cc-by-nc-nd", "cc by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
    ("cc-by-nc-sa", "cc by nc sa", "attribution non ?commercial share ?alike"),
    ("cc-by-nd", "cc by nd", "attribution no ?deriv(?:ative)?s?(?: works)?"),
    ("cc-by-nc", "cc by nc", "attribution non ?commercial"),
    ("cc-by-sa", "cc by sa", "attribution share ?alike"),
    ("cc-by", "cc by", "attribution"),
]
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

#: Sentences that stand in license texts and notices.
SENTENCES = [
    ("mit", 60, ("permission",), r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", 55, ("copyright",), r"the above copyright notice and this permission notice shall be included"),
    ("isc", 60, ("permission",), r"permission to use copy modify and(?: or)? distribute this software for any purpose"),
    ("bsd", 55, ("redistribution", "permitted"), r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", 60, ("endorse", "neither"), r"neither the name of .{1,80}? may be used to endorse or promote products"),
    ("bsd-4-clause", 60, ("advertising",), r"all advertising materials mentioning features or use of this software"),
    ("gpl", 60, ("redistribute", "general"), r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", 62, ("licen", "lesser"), r"modify it under the terms of the gnu lesser general public license"),
    ("agpl", 62, ("licen", "affero"), r"modify it under the terms of the gnu affero general public license"),
    ("apache-2.0", 60, ("licen", "compliance"), r"you may not use this file except in compliance with the license"),
    ("mpl", 60, ("licen", "mozilla"), r"subject to the terms of the mozilla public license"),
    ("unlicense", 60, ("public domain",), r"this is free and unencumbered software released into the public domain"),
    ("public-domain", 40, ("public domain",), r"(?:in|into|to) the public domain"),
    ("public-domain", 45, ("public domain",), r"dedicated to the public domain"),
    ("cc0-1.0", 60, ("cc0",), r"cc0(?: 1 0)?(?: universal)?(?: public domain dedication)?"),
    ("cc", 20, ("creative commons",), r"creative commons licen[cs]e"),
    ("copyright", 20, ("copyright",), r"copyright(?: c| ©)? (?:19|20)[0-9]{2}"),
    ("copyright", 22, ("copyright",), r"copyright(?: c| ©)? (?:19|20)[0-9]{2} (?:19|20)[0-9]{2}"),
    ("copyright", 15, ("copyright",), r"copyrighted material"),
    ("copyleft", 30, ("copyleft",), r"copyleft(?: licen[cs]e)?"),
    ("reserved", 25, ("reserved",), r"(?:some|all) rights (?:are )?reserved"),
    ("no-warranty", 20, ("warrant",), r"without warranty of any kind"),
    ("no-warranty", 22, ("warrant",), r"without warranties or conditions of any kind"),
    ("proprietary", 40, ("permission",), r"(?:reproduced|used|copied|distributed) without(?: the)?(?: prior)?(?: written)? permission"),
    ("proprietary", 40, ("licen",), r"end user licen[cs]e agreement"),
    ("proprietary", 40, ("licen",), r"proprietary(?: software)? licen[cs]e"),
    ("commercial", 35, ("licen", "commercial"), r"commercial licen[cs]e"),
    ("non-commercial", 35, ("licen", "non"), r"licen[cs]ed for non ?commercial use(?: only)?"),
    ("dual", 35, ("licen", "dual"), r"dual licen[cs]ed"),
]

GRANT = r"(?:licen[cs]ed|released|distributed|available|published|covered|made available|provided) (?:under|by)(?: the)?(?: terms of)?(?: the)?"


def _rules() -> list[Rule]:
    """The ordered rules: a family gives a grant, a plain name, an SPDX line and a "see" reference."""
    out = []
    for label, words, name, spdx in FAMILIES:
        more = 2 if any(c.isdigit() for c in label) else 0
        gate = (*words, "licen") if " licen" in name else words  # the rarer word is looked for first
        out += [Rule(label, 80 + more, gate, f"{GRANT} {name}"), Rule(label, 50 + more, gate, name),
                Rule(label, 90 + more, (spdx.split()[0], "spdx"), f"spdx licen[cs]e identifier {spdx}(?: only| or later)?"),
                Rule(label, 70 + more, gate, f"(?:see|refer to|accept|under) (?:the )?{name} for(?: more)? details")]
    for label, short, long in CC_PARTS:
        for version in CC_VERSIONS:
            name = f"{label}-{version.replace(' ', '.')}"
            out += [Rule(name, 84, ("cc by",), f"{GRANT} {short} {version}"), Rule(name, 64, ("cc by",), f"{short} {version}"),
                    Rule(name, 66, ("creative commons", "attribution"), f"creative commons {long} {version}(?: international| unported| generic)?(?: licen[cs]e)?")]
        out += [Rule(label, 62, ("cc by",), short), Rule(label, 58, ("creative commons", "attribution"), f"creative commons {long}(?: licen[cs]e)?")]
    out += [Rule(*x) for x in SENTENCES]
    return list(dict.fromkeys(out))


RULES = _rules()
RULE_TYPE = "array<struct<label: string, priority: int, keywords: array<string>, regex: string, base: boolean>>"


def _table(rules: list[Rule]) -> Column:
    """All rules as one literal; patterns match whole words."""
    every = [Rule(label, 1000, tuple(words.split()), words) for label, words in BASE.items()] + rules
    return F.from_json(F.lit(json.dumps([
        {"label": r.label, "priority": r.priority, "keywords": [f" {k}" for k in r.keywords],
         "regex": f"(?<= )(?:{r.regex})(?= )", "base": k < len(BASE)} for k, r in enumerate(every)])), RULE_TYPE)


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def detections(docs: DataFrame, text_col: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """Every match of every rule: (row id, label, priority, base, start, end), in words of the text,
    ``end`` excluded.  ``docs`` carries the row id."""
    low = F.lower(F.coalesce(text_col, F.lit("")))
    seen = reduce(lambda a, b: a | b, [low.contains(g.split()[0]) for g in GATE])
    worth = docs.where(seen | low.rlike(r"cc[\x00-\x2F\x3A-\x60\x7B-\x7F]+by"))
    words = F.regexp_extract_all(ascii_lower(F.coalesce(text_col, F.lit(""))), F.lit(WORD), F.lit(0))
    line = worth.select(RID, F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")).alias("line"))
    fit = F.filter(_table(rules), lambda r: F.forall(r["keywords"], lambda k: F.contains(F.col("line"), k)))
    tries = line.select(RID, "line", F.posexplode(fit).alias("nth", "rule"))
    # the text around the matches, and the matches themselves
    cut = tries.select(RID, "nth", "rule", F.split("line", F.col("rule.regex"), F.lit(-1)).alias("around"),
                       F.regexp_extract_all("line", F.col("rule.regex"), F.lit(0)).alias("matched")).where(F.size("matched") > 0)
    # lengths in words: of the text before each match, and of the match
    each = cut.select(RID, "nth", "rule.label", "rule.priority", "rule.base", F.posexplode(F.transform(
        F.arrays_zip("around", "matched"), lambda m: F.struct(_spaces(m["around"]).alias("gap"), _spaces(m["matched"]).alias("width")))).alias("k", "m"))
    each = each.where("m.width is not null").select(RID, "nth", "label", "priority", "base", "k", "m.gap", "m.width")
    here = Window.partitionBy(RID, "nth").orderBy("k")
    start = F.sum("gap").over(here) + F.coalesce(F.sum("width").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - 1
    return each.select(RID, "label", "priority", "base", start.alias("start"), (start + F.col("width") + 1).alias("end"))


def settle(found: DataFrame) -> DataFrame:
    """Drop detections that lie inside a better one: higher priority, or as high and longer, or equal
    in both and first by label."""
    order = Window.partitionBy(RID).orderBy("start", "end", "priority", "label")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = found.distinct().withColumn("new", F.when(F.col("start") < reach, 0).otherwise(1)).withColumn(
        "run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    rows = runs.groupBy(RID, "run").agg(F.collect_list(F.struct("label", "priority", "start", "end")).alias("xs"))

    def inside(x: Column, y: Column) -> Column:
        size_x, size_y = x["end"] - x["start"], y["end"] - y["start"]
        better = (y["priority"] > x["priority"]) | ((y["priority"] == x["priority"]) & (
            (size_y > size_x) | ((size_y == size_x) & (y["label"] < x["label"]))))
        return (y["start"] <= x["start"]) & (y["end"] >= x["end"]) & better

    kept = F.filter("xs", lambda x: ~F.exists("xs", lambda y: inside(x, y)))
    return rows.select(RID, F.explode(kept).alias("x")).select(RID, "x.label", "x.priority", "x.start", "x.end")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """One row per row of ``docs``: row id, id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``n_base`` counts all places of the base phrases, ``first_word`` and ``last_word`` are their
    smallest and largest start (null without any).  ``labels`` has the base labels and those of the
    rules' settled detections.  ``score`` is the best kept priority on a scale from 0 (nothing) to 1
    (a base phrase or an SPDX line).  Null and empty texts have no words and no labels.  Repeated rows are
    scanned each, texts whole however long; an empty table gives no rows, and further columns of any
    name are not read.
    """
    docs = docs if RID in docs.columns else with_rid(docs)
    found = stored(detections(docs, text_col, rules), "detections")
    best = settle(found.where(~F.col("base")).drop("base")).select(
        RID, "label", "priority", F.lit(False).alias("base"), "start", "end").unionByName(found.where("base"))
    base = F.col("base")
    got = best.groupBy(RID).agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.least(F.lit(1.0), F.max("priority") / F.lit(100.0)).alias("score"))
    rows = docs.select(RID, F.col(id_col), F.regexp_count(F.coalesce(text_col, F.lit("")), F.lit(ANY_CASE_WORD)).cast("long").alias("n_words"))
    return rows.join(got, RID, "left").select(
        RID, id_col, "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
