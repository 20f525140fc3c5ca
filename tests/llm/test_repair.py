"""Conversation repair against an exhaustive search."""

import hashlib
import random
import zlib

from ledgerlake.llm import repair as R
from ledgerlake.session import scratch_path

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}


def least_edits(rows):
    """(cost, edits, lines) of rows (role, text, must go, truncated), trying everything, cheapest and then ASCII-least."""
    best = {0: (0, "", ())}
    for role, text, gone, cut in rows:
        more = {}

        def offer(state, way, more=more):
            if state not in more or way < more[state]:
                more[state] = way
        for q, (cost, path, lines) in best.items():
            for k in range(4):
                offer(q, (cost + 4, path + "D", lines))
                if not gone:
                    extra = 3 if cut else 0
                    to, name = NEXT[q]
                    offer(to, (cost + 3 + extra, path + "R", (*lines, f"{name}:{text}")))
                    keep = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((role[:1], q))
                    if keep:
                        offer(keep, (cost + extra, path + "K", (*lines, f"{role}:{text}")))
                q, name = NEXT[q]
                cost, path, lines = cost + 3, path + "I", (*lines, f"{name}:")
        best = more
    ends = []
    for q, (cost, path, lines) in best.items():
        for _ in range(4):
            if q in (0, 3):
                ends.append((cost, path, lines))
            q, name = NEXT[q]
            cost, path, lines = cost + 3, path + "I", (*lines, f"{name}:")
    return min(ends)


def expected(rows):
    """The audit of rows (conv, turn, role, text) that are not damaged any more."""
    out, space = {}, "\x20\x09\x0a\x0b\x0c\x0d"
    for conv in {r[0] for r in rows}:
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, counts, marked = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, []
        for _, role, text in own:
            blank, again = not text.strip(space), (role, text) in seen
            seen.add((role, text))
            cut = not text.rstrip(space).endswith((".", "!", "?"))
            counts["blank" if blank else "duplicate" if again else "truncated"] += blank or again or cut
            marked.append((role, text, blank or again, cut))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, edits, lines = least_edits(marked)
        out[conv] = (gaps, *counts.values(), illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def stored_rows(spark, rows, parts=3, extra=False):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    if extra:
        df = df.selectExpr("*", *(f"'clash' as {n}" for n in ("conv", "kind", "at", "edit", "nth", "letters", "path", "place", "c", "q", "k", "copy")))
    path = scratch_path(spark, "turns")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def audits(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def awkward(seed, convs, most):
    rng = random.Random(seed)
    rows = []
    for c in [None, *range(convs)]:
        for t in range(rng.randrange(most)):
            turn = rng.choice([t, t, t, t + 2, None])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool", "User"])
            text = rng.choice([None, "", " \t\n", "short.", "Why?", "cut", "a longer one\nwith lines! ", " ", "end. ", f"text {rng.randrange(9)}."])
            rows += [(c, turn, role, text)] * rng.choice([1, 1, 1, 2, 3])
    return rows


def test_search_is_cheapest_and_least():
    rng = random.Random(3)
    names = {"s": "system", "u": "user", "a": "assistant", "o": "tool", "x": "user"}
    for _ in range(400):
        letters = "".join(rng.choice("xsuaouaUASO") for _ in range(rng.randrange(9)))
        rows = [(names[x.lower()], "", x == "x", x.isupper()) for x in letters]
        path, _, cost = R.search(letters, 0, R.END, True)
        assert (cost, path) == least_edits(rows)[:2], letters


def test_pieces_give_the_edits_of_the_whole(monkeypatch):
    rng = random.Random(4)
    cases = ["".join(rng.choice("xsuaouaUA") for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    whole = [R.search(x, 0, R.END, True)[:2] for x in cases]
    for size in (1, 2, 7):
        monkeypatch.setattr(R, "PIECE", size)
        assert [R.group_path(x, 0, R.END, True) for x in cases] == whole


def test_audit_equals_exhaustive_search(spark):
    rows = awkward(5, 60, 12)
    assert audits(R.audit(stored_rows(spark, rows, extra=True))) == expected(rows)


def test_hot_conversation_over_many_partitions_and_groups(spark, monkeypatch):
    """Most rows in one conversation, groups of 16 rows, pieces of 4: the same as in one piece."""
    rng = random.Random(6)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["yes.", "no", f"line {t}.", ""])) for t in range(700)] + awkward(8, 20, 6)
    monkeypatch.setattr(R, "GROUP", 16)
    monkeypatch.setattr(R, "PIECE", 4)
    assert audits(R.audit(stored_rows(spark, rows))) == expected(rows)


def test_repaired_rows_are_legal_and_hash_to_the_audit(spark):
    rows = awkward(9, 30, 10)
    table = stored_rows(spark, rows)
    want = expected(rows)
    lines = {}
    for r in sorted(R.repair(table).collect(), key=lambda r: (repr(r.conv_id), r.nth)):
        lines.setdefault(r.conv_id, []).append(r)
    for conv, audit in want.items():
        own = lines.get(conv, [])
        assert [r.nth for r in own] == list(range(len(own)))
        initials = "".join(r.role[:1] for r in own)
        assert initials.removeprefix("s") == "ua" * (len(initials) // 2)
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in own).encode()).hexdigest() == audit[-1]
        assert all((r.edit == "I") <= (r.turn is None and r.text == "") for r in own)


def test_damage_and_lost_conversations(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"Say {t}. Then!") for c in range(40) for t in range(3)] + [(None, None, None, None)]
    table = stored_rows(spark, rows)
    want = []
    for c, t, role, text in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if k == 1 else text.replace(".", "").replace("!", "") if k == 2 else text
        want += [(c, t, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    assert sorted(map(repr, (tuple(r) for r in R.damaged(table).collect()))) == sorted(map(repr, want))
    got = audits(R.audit(R.damaged(table), convs=table))
    assert set(got) == {c for c, *_ in rows}
    gone = R.audit(table.where("conv_id = 3 and turn > 5"), convs=table.where("conv_id = 3"))
    assert audits(gone) == {3: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_empty_table_and_very_long_texts(spark):
    assert R.audit(stored_rows(spark, [])).collect() == [] and R.repair(stored_rows(spark, [])).collect() == []
    rows = [(1, 0, "user", "word " * 400_000 + "."), (1, 1, "assistant", " " * 300_000 + "x" + " " * 300_000), (1, 2, "user", "!" * 200_000)]
    assert audits(R.audit(stored_rows(spark, rows))) == expected(rows)
