"""Records of several lines against one pass over each file."""

import datetime as dt
import os
import random
import re

import pytest

from ledgerlake.operators import logrecords as L
from ledgerlake.session import shared_dir

HEAD = re.compile(r"^(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\.\d{3}) UTC \[(\d+)\][^:]* ([A-Z]+):  (.*)$", re.S)


def expected(text):
    """One pass: (ts, pid, level, message, detail, hint, context, query, statement) of each record."""
    records, section = [], None
    for line in text.split("\n")[:-1] if text.endswith("\n") else text.split("\n"):
        line = line.rstrip("\r")
        m = HEAD.match(line)
        if m and m[3] in L.MAIN_LEVELS:
            records.append({"head": m.groups()[:3], "message": [m[4]]})
            section = "message"
        elif m and m[3] in L.PARTS:
            if not records:
                records.append({"head": (None, None, None)})
            section = m[3].lower()
            records[-1].setdefault(section, []).append(m[4])
        else:
            if not records:
                records.append({"head": (None, None, None)})
                section = "message"
            parts = records[-1].setdefault(section, [])
            parts[-1:] = [parts[-1] + "\n" + line] if parts else [line]
    out = []
    for r in records:
        ts, pid, level = r["head"]
        texts = ["\n".join(r[c]) if c in r else None for c in ("message", *[p.lower() for p in L.PARTS])]
        out.append((None if ts is None else dt.datetime.fromisoformat(ts), None if pid is None else int(pid), level, *[t or None for t in texts]))
    return out


def log(seed, n):
    rng, lines = random.Random(seed), []
    if seed % 2:
        lines += ["cut off at the start", "\tof the file"]
    for k in range(n):
        stamp = f"2025-11-20 17:{k % 60:02d}:44.{k % 1000:03d} UTC [{1000 + k}] app@db "
        lines.append(f"{stamp}{rng.choice(['LOG', 'ERROR', 'FATAL'])}:  process {k} " + "x" * rng.randrange(60))
        for part in rng.sample(L.PARTS, rng.randrange(4)):
            lines.append(f"{stamp}{part}:  {part.lower()} {k}")
            lines += ["\tmore: " + "y" * rng.randrange(200) for _ in range(rng.choice([0, 0, 1, 30]))]
    return "\n".join(lines) + "\n"


@pytest.mark.parametrize("split", [None, 2000, 90])
def test_records_do_not_depend_on_splits(spark, scratch, split):
    folder = f"{shared_dir(spark)}/{scratch('log').rsplit('/', 1)[1]}".removeprefix("file:")
    os.makedirs(folder)
    sizes = (6, 3, 1, 0) if split == 90 else (60, 9, 1, 0)
    want = []
    for i, n in enumerate(sizes):
        text = log(i, n)
        with open(f"{folder}/server-{i}.log", "w") as f:
            f.write(text if n or i % 2 else "")
        want += expected(text) if n or i % 2 else []
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = L.log_lines(spark, folder)
        splits = lines.select("file", "split").distinct().count()
        got = L.log_records(spark, folder).drop("file").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert splits > 10 or not split
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
