"""Repair of the structure of conversations, by iterative-deepening A*.

A conversation is legal when the initials of its roles read ``(s?(ua)+)?``.  Blank rows and rows whose role
and text stood earlier are deleted; any row may be kept (0), given the role user or assistant (3) or deleted
(4), and empty rows may be inserted anywhere (3).  A truncated row that stays costs 3 more.  Of the
cheapest repairs the one whose edits' initials (D, I, K, R) are least in ASCII is chosen.

Search: rows are letters, and the grammar is an automaton of four states.  A depth-first search tries the
edits in ASCII order under a cost bound, so the first accepting path under the least bound that has one is
the answer.  What is left of a row string costs at least the sum of each row's cheapest edit; a table
keeps, for each (row, state) that failed, how much it costs at least, and the next bound is the least
cost that a cut path would have needed.

Scale: rows are sorted by range over all partitions, so a conversation that holds a third of all rows lies
in many of them.  Each partition's part of a conversation is cut into groups of at most ``GROUP`` rows, and
groups into pieces of ``PIECE``.  A group's costs between the four states are composed along the
conversation from its end (16 numbers a group), which gives the exact cost of what follows a piece; with
that, pieces are searched apart, from each state they may be entered in.  No edit string that ends a piece
is a prefix of another, so the least edits of a conversation are the least edits of its pieces.
Texts move twice: into order, and to the task that writes the conversation, which reads them as a stream and
holds one batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerlake.llm.common import stored
from ledgerlake.llm.order import PLACE, in_order

GROUP, PIECE = 4096, 256

#: States: nothing yet, after a system row, after a user row, after an assistant row.
STATES = range(4)
NEXT = (2, 2, 3, 2)
ROLE = ("user", "user", "assistant", "user")
#: A state after that no more rows may come, and the cost of that.
FAR = 1 << 40
END = (0, FAR, FAR, 0)
KEEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3

SPACE = r"\x20\x09-\x0D"


def _edits(letter: str, state: int) -> tuple[tuple[str, int, int], ...]:
    """(edit, cost, state after) of a row in ASCII order of the edits, without insertions."""
    if letter == "x":
        return (("D", DELETE, state),)
    extra = TRUNCATED if letter.isupper() else 0
    keep = KEEP.get(letter.lower(), {}).get(state)
    kept = () if keep is None else (("K", extra, keep),)
    return (("D", DELETE, state), *kept, ("R", REROLE + extra, NEXT[state]))


EDITS = {letter: tuple(_edits(letter, q) for q in STATES) for letter in "xsuaoSUAO"}
LEAST = {letter: min(cost for q in STATES for _, cost, _ in EDITS[letter][q]) for letter in EDITS}


def _after(letter: str, later: tuple[int, ...]) -> tuple[int, ...]:
    """Exact cost from each state before a row, given those after it; at most two insertions help."""
    plain = [min(cost + later[to] for _, cost, to in EDITS[letter][q]) for q in STATES]
    once = [INSERT + plain[NEXT[q]] for q in STATES]
    return tuple(min(plain[q], once[q], INSERT + once[NEXT[q]]) for q in STATES)


def _closing(later: tuple[int, ...]) -> tuple[int, ...]:
    """The same at the end of a conversation, where insertions may follow the last row."""
    once = [INSERT + later[NEXT[q]] for q in STATES]
    return tuple(min(later[q], once[q], INSERT + once[NEXT[q]]) for q in STATES)


@lru_cache(1 << 14)
def costs(letters: str) -> tuple[tuple[int, ...], ...]:
    """Least cost from each state before these rows to each state after them."""
    columns = []
    for to in STATES:
        later = tuple(0 if q == to else FAR for q in STATES)
        for letter in reversed(letters):
            later = _after(letter, later)
        columns.append(later)
    return tuple(tuple(min(FAR, columns[to][q]) for to in STATES) for q in STATES)


def before(matrix, later: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(FAR, min(matrix[q][to] + later[to] for to in STATES)) for q in STATES)


@lru_cache(1 << 14)
def search(letters: str, state: int, later: tuple[int, ...], last: bool) -> tuple[str, int, int]:
    """(edits, state after, cost) of the cheapest and then ASCII-least edits of these rows, entered in
    ``state``, when what follows costs ``later`` by state; insertions after the last row only if ``last``."""
    n = len(letters)
    rest = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        rest[i] = rest[i + 1] + LEAST[letters[i]]
    floor = min(later)
    failed = {}     # (row, state) -> what it costs at least from there, learned from searches that failed

    def least(i: int, q: int) -> int:
        return max(failed.get((i, q), 0), rest[i] + floor)

    def moves(i: int, q: int) -> Iterator[tuple[str, int, int, int]]:
        """(edit, cost, row, state) in ASCII order; the first of a row's own edits is D."""
        steps = EDITS[letters[i]][q] if i < n else ()
        for edit, cost, to in steps[:1]:
            yield edit, cost, i + 1, to
        if i < n or last:
            yield "I", INSERT, i, NEXT[q]
        for edit, cost, to in steps[1:]:
            yield edit, cost, i + 1, to

    bound = least(0, state)
    while bound < FAR:
        # open nodes: row, state, cost so far, moves not tried, least cost from here that was cut off, edit that led here
        stack = [[0, state, 0, moves(0, state), FAR, ""]]
        while stack:
            node = stack[-1]
            i, q, spent = node[:3]
            if i == n and spent + later[q] <= bound:
                return "".join(x[5] for x in stack), q, spent
            for edit, cost, row, to in node[3]:
                reach = cost + least(row, to)
                if spent + reach <= bound:
                    stack.append([row, to, spent + cost, moves(row, to), FAR, edit])
                    break
                node[4] = min(node[4], reach)
            else:
                stack.pop()
                need = min(node[4], later[q]) if i == n else node[4]
                failed[i, q] = max(failed.get((i, q), 0), need)
                if stack:
                    stack[-1][4] = min(stack[-1][4], spent - stack[-1][2] + need)
                else:
                    bound = need
    raise ValueError("rows that can't be repaired")


def group_path(letters: str, state: int, later: tuple[int, ...], last: bool) -> tuple[str, int]:
    """Edits of a group and the state after it: piece by piece, with the exact cost of what follows."""
    pieces = [letters[i:i + PIECE] for i in range(0, len(letters), PIECE)]
    goals, follows = [later], _closing(later) if last else later
    for piece in reversed(pieces[1:]):
        follows = before(costs(piece), follows)
        goals.append(follows)
    path = []
    for piece, goal in zip(pieces, reversed(goals)):
        edits, state, _ = search(piece, state, goal, last and goal is goals[0])
        path.append(edits)
    return "".join(path), state


def group_costs(letters: str) -> tuple[tuple[int, ...], ...]:
    total = None
    for i in range(0, len(letters), PIECE):
        own = costs(letters[i:i + PIECE])
        total = own if total is None else tuple(
            tuple(min(FAR, min(row[k] + own[k][to] for k in STATES)) for to in STATES) for row in total)
    return total


def _faults(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, initial, blank, truncated) in order, stored."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    named = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), value(role).alias("role"), value(text).alias("text"))
    marked = named.select(
        "*", (~F.col("text").rlike(f"[^{SPACE}]")).alias("blank"),
        (~F.col("text").rlike(rf"[.!?][{SPACE}]*+\z")).alias("truncated"))
    return in_order(marked, ["conv", "turn", "role", F.substring("text", 1, 16)], ["conv", "turn", "role", "text"], "turns")


def _letters(turns: DataFrame) -> DataFrame:
    """(conv, place, letters): each partition's part of a conversation in groups of letters, stored."""
    print_of = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    lean = turns.select("conv", PLACE, F.substring("role", 1, 1).alias("initial"), "blank", "truncated", print_of.alias("p"))
    again = lean.groupBy("conv", "p").agg(F.min(PLACE).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = again.select(F.col("conv").alias("c"), F.col("p").alias("q"), "first")
    lean = lean.join(again.hint("merge"), F.col("conv").eqNullSafe(F.col("c")) & (F.col("p") == F.col("q")), "left")
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise(F.lit("o"))
    letter = F.when(F.col("blank") | (F.col("first") < F.col(PLACE)), F.lit("x")).when(F.col("truncated"), F.upper(known)).otherwise(known)
    grouped = lean.groupBy("conv", F.expr(f"{PLACE} div {GROUP}").alias("group")).agg(
        F.array_sort(F.collect_list(F.struct(PLACE, letter.alias("letter")))).alias("x"))
    return stored(grouped.select("conv", F.col("x")[0][PLACE].alias("place"), F.array_join("x.letter", "").alias("letters")), "letters")


def _chain_back(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("place")
    later, out = END, []
    for nth, (place, flat) in enumerate(zip(rows["place"][::-1], rows["costs"][::-1])):
        out.append((place, list(later), nth == 0))
        matrix = [flat[4 * q:4 * q + 4] for q in STATES]
        later = before(matrix, _closing(later) if nth == 0 else later)
    return pd.DataFrame(out, columns=["place", "later", "last"])


def _chain_on(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("place")
    state, out = 0, []
    for place, to in zip(rows["place"], rows["states"]):
        out.append((place, state))
        state = int(to[state])
    return pd.DataFrame(out, columns=["place", "state"])


def _paths(letters: DataFrame) -> DataFrame:
    """(conv, place, letters, path) of every group.  Conversations of one group are searched at once; those of
    several get the cost of what follows first and the state they are entered in afterwards."""
    several = letters.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("conv").alias("c"))
    several = stored(several, "several")
    same = F.col("conv").eqNullSafe(F.col("c"))

    def single(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rows["path"] = [group_path(x, 0, END, True)[0] for x in rows.pop("letters")]
            yield rows

    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rows["costs"] = [[c for row in group_costs(x) for c in row] for x in rows.pop("letters")]
            yield rows

    def ways(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = [[group_path(x, q, tuple(int(c) for c in later), bool(last)) for q in STATES]
                     for x, later, last in zip(rows["letters"], rows["later"], rows["last"])]
            yield pd.DataFrame({"place": rows["place"], "paths": [[p for p, _ in f] for f in found], "states": [[s for _, s in f] for f in found]})

    whole = letters.join(several, same, "left_anti")
    plain = whole.select("place", "letters").mapInPandas(single, "place long, path string")
    parts = stored(letters.join(several, same, "left_semi"), "parts")
    conv = parts.schema["conv"].dataType.simpleString()
    flat = parts.select("conv", "place", "letters").mapInPandas(matrices, f"conv {conv}, place long, costs array<long>")
    goals = flat.groupBy("conv").applyInPandas(_chain_back, "place long, later array<long>, last boolean")
    found = stored(parts.join(goals, "place").select("place", "letters", "later", "last").mapInPandas(
        ways, "place long, paths array<string>, states array<int>"), "ways")
    entered = parts.select("conv", "place").join(found.select("place", "states"), "place").groupBy("conv").applyInPandas(
        _chain_on, "place long, state int")
    chosen = found.join(entered, "place").select("place", F.element_at("paths", F.col("state") + 1).alias("path"))
    return letters.join(plain.unionByName(chosen), "place").select("conv", "place", "letters", "path")


def _stream(turns: DataFrame, paths: DataFrame, convs: DataFrame) -> DataFrame:
    """Each conversation's mark, and its groups' edits ahead of their rows, in one task and in order."""
    none = lambda name, kind: F.lit(None).cast(kind).alias(name)
    turn = turns.schema["turn"].dataType.simpleString()
    marks = convs.select("conv", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("at"), none("turn", turn), none("role", "string"),
                         none("text", "string"), none("blank", "boolean"))
    groups = paths.select("conv", F.lit(1).alias("kind"), F.col("place").alias("at"), none("turn", turn), F.col("letters").alias("role"),
                          F.col("path").alias("text"), none("blank", "boolean"))
    rows = turns.select("conv", F.lit(2).alias("kind"), F.col(PLACE).alias("at"), "turn", "role", "text", "blank")
    return marks.unionByName(groups).unionByName(rows).repartition("conv").sortWithinPartitions("conv", "at", "kind")


def _play(batches: Iterator[pa.RecordBatch]):
    """(conv, turn, letter, blank, initial, edits, role, text) of the rows of a stream in order: ``edits`` are
    the row's own with insertions before it and, at the end, after it.  A conversation starts with its
    conv and None."""
    letters = path = ""
    k = at = 0
    for batch in batches:
        for conv, kind, _, turn, role, text, blank in zip(*(c.to_pylist() for c in batch.columns)):
            if kind == 0:
                yield conv, None, None, None, None, None, None, None
            elif kind == 1:
                letters, path, k, at = role, text, 0, 0
            else:
                end = at
                while path[end] == "I":
                    end += 1
                end += 1
                k += 1
                if k == len(letters):
                    end = len(path)
                yield conv, turn, letters[k - 1], blank, role[:1], path[at:end], role, text
                at = end


def _repaired(initial_state: int, edits: str, role: str, text: str) -> tuple[list[tuple[str, str, str]], int]:
    """(edit, role, text) of what a row becomes, with the insertions around it, and the state after."""
    state, out = initial_state, []
    for edit in edits:
        if edit == "D":
            continue
        if edit == "K":
            out.append((edit, role, text))
            state = KEEP[role[0]][state]
        else:
            out.append((edit, ROLE[state], "" if edit == "I" else text))
            state = NEXT[state]
    return out, state


def _prepared(rows: DataFrame, conv: str, turn: str, role: str, text: str, convs: DataFrame | None) -> DataFrame:
    turns = _faults(rows, conv, turn, role, text)
    paths = _paths(_letters(turns))
    convs = (rows if convs is None else convs).select(F.col(conv).alias("conv")).distinct()
    return _stream(turns, stored(paths, "paths"), convs)


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired conversations: (conv, nth, turn, role, text, edit), rows numbered from 0.  ``edit`` is K
    (as it was), R (other role) or I (inserted, without a turn).

    Conversations are taken by turn, null turns first, rows of one turn by role and text.  Null
    roles and texts are one space; an empty role, or one with another initial, can't be kept.  A null
    conversation is one like others; very long texts pass as they are; other columns are not read.
    Of equal rows the first stays.  No rows give no rows.
    """
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth = state = 0
        out = []
        for x in _play(batches):
            if x[5] is None:
                nth = state = 0
                continue
            done, state = _repaired(state, x[5], x[6], x[7])
            for edit, new_role, new_text in done:
                out.append((x[0], nth, None if edit == "I" else x[1], new_role, new_text, edit))
                nth += 1
            if len(out) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), arrow)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), arrow)], names)

    stream = _prepared(rows, conv, turn, role, text, None)
    names = ["conv", "nth", "turn", "role", "text", "edit"]
    arrow = [to_arrow_type(stream.schema["conv"].dataType), pa.int64(), to_arrow_type(stream.schema["turn"].dataType), pa.string(), pa.string(), pa.string()]
    return stream.mapInArrow(run, f"conv {kinds[conv]}, nth long, turn {kinds[turn]}, role string, text string, edit string").withColumnRenamed("conv", conv)


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
LEGAL = {"su", "ua", "au"}


def audit(rows: DataFrame, convs: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> DataFrame:
    """One row per conversation of ``convs`` (default: of ``rows``): conv, gaps in its turns, rows whose first
    fault is blank, duplicate or truncated, illegal neighbours, cost, audit (the edits) and the hash of the
    repaired ``role:text`` lines.  Nulls and ties as in ``repair``; one without rows has zeros."""
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], None
        for c, t, letter, blank, initial, edits, r, x in _play(batches):
            if edits is None:
                if held:
                    out.append(held.row())
                    if len(out) >= 2000:
                        yield table(out)
                        out = []
                held = _Digest(c)
            else:
                held.add(t, letter, blank, initial, edits, r, x)
        if held:
            out.append(held.row())
        if out:
            yield table(out)

    stream = _prepared(rows, conv, turn, role, text, convs)
    own = to_arrow_type(stream.schema["conv"].dataType)

    def table(out: list[tuple]) -> pa.RecordBatch:
        types = [own, *[pa.int64()] * len(NAMES), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), types)], ["conv", *NAMES, "audit", "repaired_sha256"])

    longs = ", ".join(f"{n} long" for n in NAMES)
    return stream.mapInArrow(run, f"conv {kinds[conv]}, {longs}, audit string, repaired_sha256 string").withColumnRenamed("conv", conv)


class _Digest:
    """What one conversation's rows add up to, fed one by one."""

    def __init__(self, conv):
        self.conv, self.least, self.most, self.turns, self.state, self.before = conv, None, None, 0, 0, None
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.cost = 0
        self.edits, self.sha, self.lines = [], hashlib.sha256(), 0

    def add(self, turn, letter, blank, initial, edits, role, text):
        if turn is not None and (self.most is None or turn != self.most):
            self.least, self.most, self.turns = turn if self.least is None else self.least, turn, self.turns + 1
        if letter == "x":
            self.faults["blank" if blank else "duplicate"] += 1
        elif letter.isupper():
            self.faults["truncated"] += 1
        if self.before is not None and self.before + initial not in LEGAL:
            self.illegal += 1
        self.before = initial
        self.edits.append(edits)
        stays = edits.rstrip("I").endswith(("K", "R")) and letter.isupper()
        self.cost += DELETE * edits.count("D") + INSERT * edits.count("I") + REROLE * edits.count("R") + (TRUNCATED if stays else 0)
        done, self.state = _repaired(self.state, edits, role, text)
        for _, r, x in done:
            self.sha.update(("\n" if self.lines else "").encode() + f"{r}:{x}".encode())
            self.lines += 1

    def row(self) -> tuple:
        gaps = 0 if self.most is None else int(self.most - self.least + 1 - self.turns)
        return (self.conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.edits), self.sha.hexdigest())


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of (conv_id, turn, role, text) as the contract damages them: by the remainder of a checksum a
    row goes (0), loses its text (1) or its sentence ends (2), comes twice (3) or is the user's (4)."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(value("conv_id"), F.lit(":"), value("turn")).cast("binary")) % 20
    text: Column = F.when(k == 1, F.lit("")).when(k == 2, F.regexp_replace(value("text"), "[.!?]", "")).otherwise(value("text"))
    rows = conversations.select("conv_id", "turn", F.when(k == 4, F.lit("user")).otherwise(value("role")).alias("role"), text.alias("text"), k.alias("k"))
    return rows.where("k <> 0").withColumn("copy", F.explode(F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).select(
        "conv_id", "turn", "role", "text")
