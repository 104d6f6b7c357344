"""Conversation repair against a plain programme over costs and audits, and against all edits."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest

from ferrylog.llm import conversations

SPACE = " \t\n\x0b\f\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if draw == 4 else role
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(draw, 1)
    return out


def plain_repair(kinds):
    """``kinds`` of ``(initial, fault)``: cost, audit and what each edit leaves, by a programme over strings."""
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {("", len(kinds)): (0, "", ()), ("a", len(kinds)): (0, "", ())}
    best["u", len(kinds)] = (3, "I", ("a",))
    best["s", len(kinds)] = (6, "II", ("u", "a"))
    for i in range(len(kinds) - 1, -1, -1):
        initial, fault = kinds[i]
        extra, own = 3 * (fault == "truncated"), {}
        for state in ("", "s", "u", "a"):
            ways = []
            c, a, p = best[state, i + 1]
            ways.append((c + 4, "D" + a, (None, *p)))
            if fault not in ("blank", "duplicate"):
                if initial == follow[state] or initial == "s" and state == "":
                    c, a, p = best[initial, i + 1]
                    ways.append((c + extra, "K" + a, ("K", *p)))
                c, a, p = best[follow[state], i + 1]
                ways.append((c + 3 + extra, "R" + a, ("R" + follow[state], *p)))
            own[state] = min(ways)
        for _ in range(3):
            for state in own:
                c, a, p = own[follow[state]]
                own[state] = min(own[state], (c + 3, "I" + a, (follow[state], *p)))
        for state in own:
            best[state, i] = own[state]
    return best["", 0]


def plain_report(rows):
    convs = {r[0] for r in rows}
    out = set()
    for conv in convs:
        own = [r for r in plain_damage(rows) if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1], r[2], hashlib.md5(r[3].encode()).digest()))
        seen, faults = set(), []
        for _, _, role, text in own:
            bare = text.strip(SPACE)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[2][:1] for r in own]
        cost, audit, parts = plain_repair(list(zip(initials, faults)))
        names, lines, rest = {"u": "user", "a": "assistant"}, [], iter(own)
        for edit, part in zip(audit, parts):
            if edit == "I":
                lines.append(names[part] + ":")
            else:
                _, _, role, text = next(rest)
                if edit != "D":
                    lines.append((names[part[1]] if edit == "R" else role) + ":" + text)
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        out.add((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                 hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def some_rows(seed, convs=60, longest=30):
    rng = np.random.default_rng(seed)
    roles = ["user", "assistant", "system", "tool", "User", "", None]
    texts = ["Yes.", "No!", "cut off", "", " \t", None, "Why?", "long " * 2000 + "."]
    rows = []
    for c in range(convs):
        for t in range(int(rng.integers(1, longest))):
            role = rng.choice(roles, p=[.35, .3, .1, .1, .05, .05, .05])
            text = rng.choice(texts, p=[.1, .1, .1, .05, .05, .05, .1, .45])
            text = None if text is None else text if text in texts[:7] else f"{t} {text}"
            turn = None if rng.random() < 0.05 else int(t if rng.random() < 0.9 else t // 2 * 3)
            rows.append((None if c == 0 else c * 7, turn, role, text))
    return rows


@pytest.mark.parametrize("block, lane", [(50_000, 256), (7, 3), (40, 5), (1, 1)])
def test_against_plain(spark, monkeypatch, block, lane):
    monkeypatch.setattr(conversations, "BLOCK", block)
    monkeypatch.setattr(conversations, "LANE", lane)
    rows = some_rows(block)
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, cost string").repartition(3)
    got = conversations.report(df)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    out = [tuple(r) for r in got.collect()]
    assert len(out) == len({r[0] for r in rows}) and set(out) == plain_report(rows)


def test_all_edit_sequences_of_short_conversations():
    """The plain programme itself, against every sequence of edits."""
    legal, names = re.compile("(s?(ua)+)?"), "DIKR"
    for kinds in itertools.product([("s", ""), ("u", ""), ("a", "truncated"), ("u", "blank"), ("t", "")], repeat=2):
        found = []
        for n in range(2, 7):
            for edits in itertools.product(names, repeat=n):
                if sum(e != "I" for e in edits) != 2:
                    continue
                for roles in itertools.product("ua", repeat=sum(e in "IR" for e in edits)):
                    cost, out, rows, new = 0, "", iter(kinds), iter(roles)
                    for e in edits:
                        if e == "I":
                            cost, out = cost + 3, out + next(new)
                            continue
                        initial, fault = next(rows)
                        if e != "D" and fault == "blank":
                            cost = 99
                        cost += {"D": 4, "K": 0, "R": 3}[e] + (3 if fault == "truncated" and e != "D" else 0)
                        out += {"D": "", "K": initial}.get(e) if e != "R" else next(new)
                    if legal.fullmatch(out):
                        found.append((cost, "".join(edits)))
        assert min(found) == plain_repair(kinds)[:2]


def test_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(conversations, "BLOCK", 500)
    rng = np.random.default_rng(3)
    rows = [(1, t, str(rng.choice(["user", "assistant"])), f"text {t if rng.random() < .9 else t % 50}.") for t in range(6000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    assert {tuple(r) for r in conversations.report(df).collect()} == plain_report(rows)
    done = conversations.repaired_rows(conversations.repair(conversations.damage(df))).orderBy("row_no", "part").collect()
    assert re.fullmatch("(ua)+", "".join(r.role[0] for r in done))


def test_nothing_left(spark):
    dropped = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(5, dropped, "user", "Hi."), (5, dropped, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in conversations.report(df).collect()] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    assert conversations.report(df.limit(0)).count() == 0


def test_twin(spark):
    """The SQL twin on rows with nulls, other roles and repeats."""
    import duckdb

    from checks.compare import compare

    rows = [r for r in some_rows(11, convs=25, longest=9)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    con = duckdb.connect()
    con.register("conversations", df.toArrow())
    assert compare(con, conversations.report(df), conversations.REPAIR_SQL) is None
