"""Small tables with the awkward cases, stored as files, and plain-Python forms of the contracts."""

import random
import re

from ledgerlake.session import scratch_path

LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PLAIN = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return (text or "").translate(LOWER)


def words(text):
    return WORD.findall(lower(text))


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"{rng.choice(['ka', 'lo', 'mi', 'TE', 'su'])}{rng.randrange(vocabulary)}" for _ in range(n))


def edited(text, seed, n):
    rng, w = random.Random(seed), text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def texts():
    """(id, text): nulls, empties, case copies, near copies, repeats, long and odd texts, repeated rows."""
    a, b = prose(1, 120), prose(2, 90)
    rows = [(1, a), (2, a.upper()), (3, edited(a, 3, 2)), (4, edited(a, 4, 30)), (5, b), (6, b + " " + a), (7, None), (8, ""), (9, None),
            (10, " \n\t "), (11, "one"), (12, "one two three"), (13, "ONE two three"), (14, "Été été ÉTÉ naïve"), (15, "ÉTÉ été ÉTÉ naïve"),
            (16, prose(5, 3000)), (17, "x " * 500), (18, "!!! ... ???"), (None, a), (None, "no id"), (20, b), (20, b), (21, "日本語のテキスト です"),
            (22, a + " " + a), (23, edited(b, 9, 1)), (24, "line\x0bone\x1ctwo\u00a0three")]
    rows += [(100 + k, edited(a, 50 + k, k % 5)) for k in range(12)]
    return rows


def documents(spark, rows=None, parts=3, extra=False):
    """Stored documents; with ``extra`` also columns whose names clash with what operators use inside."""
    rows = texts() if rows is None else rows
    df = spark.createDataFrame([(i, t, "en", "src", None if t is None else len(t)) for i, t in rows], PLAIN).repartition(parts)
    if extra:
        for name in ("id", "n", "rid", "h", "c", "cls", "token", "words", "score", "label", "kept", "block", "item", "start", "length", "host", "z"):
            df = df.selectExpr("*", f"'clash' as {name}")
    path = scratch_path(spark, "docs")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def got(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
