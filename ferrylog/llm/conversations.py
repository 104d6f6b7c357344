"""Conversation structure repair: the cheapest edits that give a legal order of roles.

A legal conversation is an optional system turn and then user and assistant in turns,
``(s?(ua)+)?`` in initials. Rows are kept, given another role or deleted, and empty user
or assistant rows are inserted. Places before rows and what may come next there are the
nodes of a graph, edits are its arcs; costs to the end come from a dynamic programme,
and the arcs on cheapest paths are ranked by the 1, 2, 4, ... edits that begin with them.
The least arc of each node starts the path whose edits are ASCII-least, and pointers that
double with the ranks spell that path out.

Rows are numbered over all conversations and handled in blocks of equal size, so a
conversation may span any number of blocks: each block first sums its open ends up in a
4 x 4 table of costs, and these small tables are chained per conversation.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ferrylog.operators.numbering import number_rows
from ferrylog.session import materialize

#: Rows of a block, and of a lane: the rows that one step of the dynamic programme follows on.
BLOCK, LANE = 50_000, 256

# White space, ends of a whole text, faults, edits in ASCII order and their costs.
SPACE, STOPS = " \t\n\x0b\f\r", (".", "!", "?")
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
EDITS = "DIKR"
DELETE, INSERT, KEEP, REROLE, HALF_TEXT = 4, 3, 0, 3, 3
LEGAL_PAIRS = ("su", "ua", "au")

# What may follow: at the start, behind a system turn, behind a user turn, behind an assistant turn.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: Where the only role that can be put in leads: an assistant turn behind a user turn, else a user turn.
_NEXT = np.array([_USER, _USER, _ASSISTANT, _USER])
_NEVER = 1 << 40
#: Cost of what is missing at the end of a conversation, all of it inserted.
_END = np.array([0, 2 * INSERT, INSERT, 0])


def _row_costs():
    """By kind of row and state: cost of keeping it, where that leads, and cost of another role."""
    keep, to, rerole = np.full((9, 4), _NEVER), np.zeros((9, 4), np.int64), np.full(9, _NEVER)
    moves = {"s": {_START: _SYSTEM}, "u": {q: _USER for q in (_START, _SYSTEM, _ASSISTANT)}, "a": {_USER: _ASSISTANT}, "": {}}
    for half in (0, 1):
        for k, role in enumerate(moves):
            kind = 1 + k + 4 * half
            rerole[kind] = REROLE + HALF_TEXT * half
            for state, leads in moves[role].items():
                keep[kind, state], to[kind, state] = KEEP + HALF_TEXT * half, leads
    return keep, to, rerole


_KEEP, _TO, _REROLE = _row_costs()


def _kinds(initial: np.ndarray, fault: np.ndarray) -> np.ndarray:
    """0 for a row that must go, else 1 to 4 by role, and 5 to 8 if its text is truncated."""
    role = np.select([initial == "s", initial == "u", initial == "a"], [1, 2, 3], 4)
    return np.where((fault == BLANK) | (fault == DUPLICATE), 0, role + 4 * (fault == TRUNCATED))


# --- cost programme -----------------------------------------------------------

def _back(kind, after):
    """Costs before rows from the costs behind them, ``(rows, .., 4 states)``; rows to insert come first."""
    wide = (slice(None),) + (None,) * (after.ndim - 2)
    to = np.broadcast_to(_TO[kind][wide], after.shape)
    row = np.minimum(after + DELETE, _KEEP[kind][wide] + np.take_along_axis(after, to, -1))
    row = np.minimum(row, _REROLE[kind][(slice(None),) + (None,) * (after.ndim - 1)] + after[..., _NEXT])
    return np.minimum(row, np.minimum(row[..., _NEXT] + INSERT, row[..., _NEXT[_NEXT]] + 2 * INSERT))


class _Lanes:
    """Rows of the segments of a block, in lanes that are handled side by side."""

    def __init__(self, kind, first):
        """``first`` row of every segment, and the number of rows at the end."""
        self.kind = kind
        size = np.diff(first)
        lanes = -(-size // LANE)
        self.segment = np.repeat(np.arange(len(size)), lanes)
        opening = np.append(0, np.cumsum(lanes))
        number = np.arange(len(self.segment)) - opening[self.segment]
        self.start = first[self.segment] + number * LANE
        self.size = np.minimum(LANE, first[self.segment + 1] - self.start)
        self.before_end = lanes[self.segment] - 1 - number  # lanes behind this one in its segment
        self.opening = opening

    def run(self, after, keep_rows=False):
        """Costs before the lanes from those behind them; with ``keep_rows`` those behind and before each row."""
        after = after.copy()
        if keep_rows:
            behind, before = np.empty((len(self.kind), 4), np.int64), np.empty((len(self.kind), 4), np.int64)
        for t in range(int(self.size.max(initial=0)) - 1, -1, -1):
            own = np.flatnonzero(self.size > t)
            rows = self.start[own] + t
            if keep_rows:
                behind[rows] = after[own]
            after[own] = _back(self.kind[rows], after[own])
            if keep_rows:
                before[rows] = after[own]
        return (behind, before) if keep_rows else after

    def tables(self):
        """``[lane, end state, state]``: cheapest way through each lane."""
        unit = np.where(np.eye(4, dtype=bool), 0, _NEVER)
        return self.run(np.broadcast_to(unit, (len(self.start), 4, 4)))

    def through(self, segment, tables):
        """``[state, end state]`` of a whole segment."""
        lanes = range(self.opening[segment], self.opening[segment + 1])
        out = np.where(np.eye(4, dtype=bool), 0, _NEVER)
        for lane in lanes:
            out = np.minimum((out[:, :, None] + tables[lane].T[None, :, :]).min(1), _NEVER)
        return out

    def ends(self, tables, at_end):
        """Costs behind each lane from those behind its segment."""
        out = np.empty((len(self.start), 4), np.int64)
        for k in range(int(self.before_end.max(initial=-1)) + 1):
            own = np.flatnonzero(self.before_end == k)
            out[own] = at_end[self.segment[own]] if k == 0 else (tables[own + 1] + out[own + 1][:, :, None]).min(1)
        return out


# --- ranking of paths -----------------------------------------------------------

def _optimal_arcs(kind, behind, before, first):
    """``(node, label, target)`` of the arcs on cheapest paths, by node.

    Node ``4 * row + state`` stands before the row; behind the rows come four ends for
    every segment. The labels of a node's arcs differ.
    """
    n = len(kind)
    segment = np.repeat(np.arange(len(first) - 1), np.diff(first))
    last = np.zeros(n, bool)
    last[first[1:] - 1] = True
    onward = np.where(last, n + segment, np.arange(n) + 1) * 4
    own, state = np.arange(n) * 4, np.arange(4)
    goes_on = np.broadcast_to(onward[:, None], (n, 4))
    arcs = [(behind + DELETE, goes_on + state),
            (before[:, _NEXT] + INSERT, own[:, None] + _NEXT),
            (_KEEP[kind] + np.take_along_axis(behind, _TO[kind], 1), goes_on + _TO[kind]),
            (_REROLE[kind][:, None] + behind[:, _NEXT], goes_on + _NEXT)]
    found = [np.nonzero(cost == before) for cost, _ in arcs]
    node = np.concatenate([own[r] + q for r, q in found])
    label = np.repeat(np.arange(4), [len(r) for r, _ in found])
    target = np.concatenate([to[r, q] for (r, q), (_, to) in zip(found, arcs)])
    order = np.lexsort((label, node))
    return node[order], label[order], target[order]


def _least_paths(node, label, target, nodes):
    """Label of the least path's first arc from every node (-1 at ends), and its pointers of 1, 2, 4, ... arcs.

    Arcs are ranked by 1, 2, 4, ... labels: an arc's rank and that of the least arc
    where its 2**k labels lead give its rank over twice as many.
    """
    head = np.flatnonzero(np.append(True, node[1:] != node[:-1])) if len(node) else np.zeros(0, np.int64)
    has = node[head]
    rank, reached = label + 1, target
    least = np.full(nodes, -1)
    least[has] = head  # labels of a node differ, so its least arc is its first
    pointers = []
    while True:
        pointer = np.arange(nodes)
        pointer[has] = reached[least[has]]
        pointers.append(pointer)
        if not len(has) or (least[pointer] < 0).all():
            break
        further = np.where(least[reached] >= 0, rank[least[reached]], 0)
        rank = np.unique(rank * (rank.max() + 1) + further, return_inverse=True)[1].reshape(-1) + 1
        best = np.minimum.reduceat(rank, head)
        least[has] = np.flatnonzero(rank == np.repeat(best, np.diff(np.append(head, len(rank)))))
        reached = pointer[reached]
    first = np.full(nodes, -1)
    first[has] = label[least[has]]
    return first, pointers


def _on_path(starts, pointers, first):
    """Nodes of the paths from ``starts``, doubled pointers laid end to end."""
    on = np.zeros(len(first), bool)
    on[starts] = True
    some = starts
    for pointer in reversed(pointers):
        more = pointer[some]
        some = np.unique(np.concatenate([some, more[first[more] >= 0]]))
        on[more] = True
    on[some] = True
    return on


def _segments(block: pa.Table):
    block = block.combine_chunks().sort_by("row_no")
    conv = pc.dictionary_encode(block["conv_id"].combine_chunks(), null_encoding="encode").indices.to_numpy()
    first = np.append(np.flatnonzero(np.append(True, conv[1:] != conv[:-1])), len(conv))
    initial = np.array(block["initial"].to_pylist(), dtype=object)
    return block, first, _kinds(initial, block["fault"].to_numpy())


def _open(first):
    """Segments that may go on in another block."""
    return sorted({0, len(first) - 2})


def _sum_up(block: pa.Table) -> pa.Table:
    """The open ends of a block as tables of costs."""
    block, first, kind = _segments(block)
    wanted = _open(first)
    some = np.concatenate([np.arange(first[s], first[s + 1]) for s in wanted])
    lanes = _Lanes(kind[some], np.append(0, np.cumsum([first[s + 1] - first[s] for s in wanted])))
    tables = lanes.tables()
    rows = pa.array([int(first[s]) for s in wanted])
    return pa.table({"conv_id": block["conv_id"].take(rows), "block": block["block"].take(rows),
                     "segment": pa.array(wanted, pa.int32()), "row_no": block["row_no"].take(rows),
                     "costs": pa.array([lanes.through(i, tables).reshape(-1).tolist() for i in range(len(wanted))], pa.list_(pa.int64()))})


def _chain_back(conv: pa.Table) -> pa.Table:
    """Costs behind each part of one conversation."""
    conv = conv.sort_by("row_no")
    costs = [np.array(c).reshape(4, 4) for c in conv["costs"].to_pylist()]
    ends = [_END]
    for c in costs[:0:-1]:
        ends.append((c + ends[-1][None, :]).min(1))
    n = len(costs)
    return pa.table({"block": conv["block"], "segment": conv["segment"], "last": pa.array([k == n - 1 for k in range(n)]),
                     "ends": pa.array([e.tolist() for e in reversed(ends)], pa.list_(pa.int64()))})


def _chain_on(conv: pa.Table) -> pa.Table:
    """State in which the path of one conversation enters each part."""
    conv = conv.sort_by("row_no")
    entry, state = [], _START
    parts = list(zip(conv["block"].to_pylist(), conv["segment"].to_pylist(), conv["entry"].to_pylist(), conv["leaves"].to_pylist()))
    keys = list(dict.fromkeys((b, s) for b, s, _, _ in parts))
    leaves = {(b, s, e): x for b, s, e, x in parts}
    for b, s in keys:
        entry.append(state)
        state = leaves[b, s, state]
    return pa.table({"block": pa.array([b for b, _ in keys], pa.int64()), "segment": pa.array([s for _, s in keys], pa.int32()),
                     "entry": pa.array(entry, pa.int32())})


_BEFORE = {(0, s): "" for s in range(4)} | {(1, _USER): "u", (1, _ASSISTANT): "a", (2, _ASSISTANT): "ua", (2, _USER): "au"}


def _edit(block: pa.Table, ends: pa.Table) -> pa.Table:
    """Edits of every row of a block; those of its open ends for each state they may be entered in."""
    block, first, kind = _segments(block)
    segments, n = len(first) - 1, len(kind)
    at_end, last = np.tile(_END, (segments, 1)), np.ones(segments, bool)
    for e in ends.to_pylist():
        at_end[e["segment"]], last[e["segment"]] = e["ends"], e["last"]
    lanes = _Lanes(kind, first)
    behind, before = lanes.run(lanes.ends(lanes.tables(), at_end), keep_rows=True)
    # A cost that leads nowhere is never equal to another.
    label, pointers = _least_paths(*_optimal_arcs(kind, behind, before, first), 4 * (n + segments))
    opened = np.zeros(segments, bool)
    opened[_open(first)] = True
    of_row = np.repeat(np.arange(segments), np.diff(first))
    out = []
    for entry in range(4):
        some = np.flatnonzero(opened if entry else np.ones(segments, bool))
        on = _on_path(first[some] * 4 + entry, pointers, label)
        states = on[:4 * n].reshape(n, 4)
        labels = label[:4 * n].reshape(n, 4)
        rows = np.flatnonzero(states.any(1))
        inserts = (states & (labels == 1))[rows].sum(1)
        state = np.argmax((states & (labels != 1))[rows], 1)  # where the row itself is met
        own = labels[rows, state]
        leaves = np.argmax(on[4 * n:].reshape(segments, 4), 1)
        closing = np.isin(rows, first[1:] - 1)
        exits = np.where(closing, leaves[of_row[rows]], -1)
        tail = np.where(closing & last[of_row[rows]], np.where(exits == _USER, 1, np.where(exits == _SYSTEM, 2, 0)), 0)
        is_open = opened[of_row[rows]]
        cost = INSERT * (inserts + tail) + np.select([own == 0, own == 3], [DELETE, REROLE], KEEP)
        cost = cost + np.where((kind[rows] > 4) & (own != 0), HALF_TEXT, 0)
        out.append(pa.table({
            "conv_id": block["conv_id"].take(pa.array(rows)), "row_no": block["row_no"].take(pa.array(rows)),
            "block": block["block"].take(pa.array(rows)),
            "segment": pa.array(np.where(is_open, of_row[rows], -1).astype(np.int32)),
            "entry": pa.array(np.where(is_open, entry, _START).astype(np.int32)),
            "leaves": pa.array(np.where(closing & is_open, exits, -1).astype(np.int32)),
            "edits": pa.array(["I" * a + EDITS[b] + "I" * c for a, b, c in zip(inserts.tolist(), own.tolist(), tail.tolist())]),
            "before": pa.array([_BEFORE[a, s] for a, s in zip(inserts.tolist(), state.tolist())]),
            "role_to": pa.array(["a" if s == _USER else "u" for s in state.tolist()]),
            "after": pa.array([("", "a", "ua")[c] for c in tail.tolist()]),
            "cost": pa.array(cost.astype(np.int64))}))
    return pa.concat_tables(out)


# --- Spark jobs -------------------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` with faults put in by a checksum of id and turn.

    Nulls are one blank, in the checksum as in role and text. Of 20 remainders 0 drops
    the row, 1 empties its text, 2 takes its stops, 3 repeats it and 4 makes it the user's.
    """
    def shown(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    draw = F.crc32(F.encode(F.concat(shown("conv_id"), F.lit(":"), shown("turn")), "UTF-8")) % 20
    text = F.when(draw == 1, "").when(draw == 2, F.translate(shown("text"), ".!?", "")).otherwise(shown("text"))
    rows = conversations.where(draw != 0).select(
        "conv_id", "turn", F.when(draw == 4, "user").otherwise(shown("role")).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(draw == 3, 2).otherwise(1))).alias("copy"))
    return rows.drop("copy")


def _number(rows: DataFrame) -> DataFrame:
    """Rows in the order of their conversations; equal rows are told apart so that they can be spread."""
    keyed = rows.select("conv_id", "turn", "role", "text", F.unhex(F.md5(F.encode("text", "UTF-8"))).alias("text_key"),
                        F.monotonically_increasing_id().alias("copy"))
    return number_rows(keyed, ["conv_id", "turn", "role", "text_key", "copy"], "row_no").drop("copy")


def _judge(placed: DataFrame) -> DataFrame:
    """``(conv_id, row_no, block, initial, fault)``: the first fault of every row."""
    bare = F.btrim("text", F.lit(SPACE))
    facts = placed.select("conv_id", "row_no", "role", "text_key", (bare == "").alias("blank"),
                          (~F.right(bare, F.lit(1)).isin(*STOPS)).alias("truncated"))
    seen = (facts.groupBy(F.col("conv_id").alias("__conv"), F.col("role").alias("__role"), F.col("text_key").alias("__key"))
                 .agg(F.min("row_no").alias("first"), F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1))
    same = (F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("role") == F.col("__role")) & (F.col("text_key") == F.col("__key")))
    repeated = F.coalesce(F.col("row_no") > F.col("first"), F.lit(False))
    fault = F.when(F.col("blank"), BLANK).when(repeated, DUPLICATE).when(F.col("truncated"), TRUNCATED).otherwise(SOUND)
    return facts.join(seen, same, "left").select(
        "conv_id", "row_no", F.floor((F.col("row_no") - 1) / F.lit(BLOCK)).alias("block"),
        F.left("role", F.lit(1)).alias("initial"), fault.cast("int").alias("fault"))


def repair(rows: DataFrame) -> DataFrame:
    """The cheapest edits of every row, ASCII-least among equals.

    ``rows`` are ``(conv_id, turn, role, text)``; role and text without nulls. They are
    taken by turn, nulls first, then role and checksum of the text. Returns ``(conv_id,
    row_no, turn, role, text, fault, edits, before, role_to, after, cost)``: ``before``
    and ``after`` are initials of rows put in around the row, and ``edits`` all edits
    there. A null id is a conversation of its own; an empty table gives no rows. Memory
    is bounded by a block and, for the longest conversation, by 16 numbers a block.
    """
    placed = _number(rows)
    judged = materialize(_judge(placed), "judged")
    conv = judged.schema["conv_id"].dataType.simpleString()
    sums = judged.groupBy("block").applyInArrow(
        _sum_up, f"conv_id {conv}, block long, segment int, row_no long, costs array<long>")
    ends = sums.groupBy("conv_id").applyInArrow(_chain_back, "block long, segment int, last boolean, ends array<long>")
    edits = materialize(judged.groupBy("block").cogroup(ends.groupBy("block")).applyInArrow(
        _edit, f"conv_id {conv}, row_no long, block long, segment int, entry int, leaves int, edits string, "
               "before string, role_to string, after string, cost long"), "edits")
    entered = edits.where("leaves >= 0").groupBy("conv_id").applyInArrow(_chain_on, "block long, segment int, entry int")
    chosen = (edits.where("segment < 0").unionByName(edits.where("segment >= 0").join(entered, ["block", "segment", "entry"], "left_semi"))
                   .select("row_no", "edits", "before", "role_to", "after", "cost"))
    return (placed.drop("text_key").join(judged.select("row_no", "fault"), "row_no").join(chosen, "row_no")
                  .select("conv_id", "row_no", "turn", "role", "text", "fault", "edits", "before", "role_to", "after", "cost"))


def _new_rows(initials):
    return F.transform(F.split(initials, ""), lambda r: F.struct(
        F.when(r == "u", "user").otherwise("assistant").alias("role"), F.lit("").alias("text")))


def _own_rows():
    role = F.when(F.contains("edits", F.lit("K")), F.col("role")).when(F.col("role_to") == "u", "user").otherwise("assistant")
    own = F.when(F.contains("edits", F.lit("D")), F.array().cast("array<struct<role:string,text:string>>")).otherwise(
        F.array(F.struct(role.alias("role"), F.col("text").alias("text"))))
    none = F.array().cast("array<struct<role:string,text:string>>")
    return F.concat(F.when(F.col("before") == "", none).otherwise(_new_rows(F.col("before"))), own,
                    F.when(F.col("after") == "", none).otherwise(_new_rows(F.col("after"))))


def repaired_rows(repairs: DataFrame) -> DataFrame:
    """``(conv_id, row_no, part, role, text)``: the legal conversations, in order of ``row_no`` and ``part``."""
    return repairs.select("conv_id", "row_no", F.posexplode(_own_rows()).alias("part", "r")).select(
        "conv_id", "row_no", "part", "r.role", "r.text")


_REPORT = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
           ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]


class _Report:
    """Figures of one conversation while its rows go by in order."""

    def __init__(self):
        self.faults, self.illegal, self.cost, self.audit, self.sha = np.zeros(4, np.int64), 0, 0, [], hashlib.sha256()
        self.turns, self.low, self.turn, self.initial, self.empty = 0, None, None, None, True

    def add(self, turns, initials, faults, edits, costs, lines):
        self.faults += np.bincount(faults, minlength=4)
        before = [self.initial, *initials[:-1]]
        self.illegal += sum(b + a not in LEGAL_PAIRS for b, a in zip(before, initials) if b is not None)
        self.initial = initials[-1]
        for turn in turns:
            if turn is not None and turn != self.turn:
                self.turns, self.turn = self.turns + 1, turn
                self.low = turn if self.low is None else self.low
        self.cost += int(costs.sum())
        self.audit.append("".join(edits))
        for line in lines:
            if line is not None:
                self.sha.update((line if self.empty else "\n" + line).encode())
                self.empty = False

    def row(self):
        gaps = 0 if self.low is None else self.turn - self.low + 1 - self.turns
        return [gaps, *self.faults[1:].tolist(), self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest()]


def _reports(batches):
    """One row for every conversation; rows come sorted, and only their figures are held."""
    current = now = None

    def out():
        return pa.RecordBatch.from_arrays([current] + [pa.array([v], kind) for v, (_, kind) in zip(now.row(), _REPORT)],
                                          names=["conv_id"] + [name for name, _ in _REPORT])

    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv_id")
        codes = pc.dictionary_encode(conv, null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        first = np.append(np.flatnonzero(np.append(True, codes[1:] != codes[:-1])), len(codes))
        columns = [batch.column(c).to_pylist() for c in ("turn", "initial", "edits", "lines")]
        faults, costs = batch.column("fault").to_numpy(), batch.column("cost").to_numpy()
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            name = conv.slice(a, 1)
            if now is None or not name.equals(current):
                if now is not None:
                    yield out()
                current, now = name, _Report()
            turns, initials, edits, lines = (c[a:b] for c in columns)
            now.add(turns, initials, faults[a:b], edits, costs[a:b], lines)
    if now is not None:
        yield out()


def report(conversations: DataFrame) -> DataFrame:
    """Damage, repair, and figures of every conversation of the table.

    One row for each ``conv_id``, also where no row is left: zeros, an empty audit and
    the checksum of nothing. Columns besides ``conv_id, turn, role, text`` are not read.
    A checksum must see a conversation's rows one after another, so they stream through
    one task, without being held.
    """
    conversations = conversations.select("conv_id", "turn", "role", "text")
    repairs = repair(damage(conversations))
    lines = F.array_join(F.transform(_own_rows(), lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    has = ~F.contains("edits", F.lit("D")) | (F.col("before") != "") | (F.col("after") != "")
    conv = repairs.schema["conv_id"].dataType.simpleString()
    told = (repairs.select("conv_id", "row_no", "turn", F.left("role", F.lit(1)).alias("initial"), "fault", "edits", "cost",
                           F.when(has, lines).alias("lines"))
                   .repartition("conv_id").sortWithinPartitions("conv_id", "row_no")
                   .mapInArrow(_reports, f"conv_id {conv}, gaps long, blank long, duplicate long, truncated long, "
                                         "illegal long, cost long, audit string, repaired_sha256 string"))
    told = told.withColumnRenamed("conv_id", "__conv")
    nothing = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    return (conversations.select("conv_id").distinct()
            .join(told, F.col("conv_id").eqNullSafe(F.col("__conv")), "left")
            .select("conv_id", *[F.coalesce(name, nothing.get(name, F.lit(0).cast("long"))).alias(name) for name, _ in _REPORT]))


#: States 1 to 4 stand at the start and behind a system, user and assistant turn.
REPAIR_SQL = """WITH RECURSIVE bytes AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), range(8)),
           lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
           regexp_extract_all(hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))), '..'),
           lambda h: CAST('0x' || h AS BIGINT))), lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]))) % 20 AS draw
  FROM conversations, bytes),
damaged AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
         CASE draw WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM drawn, (VALUES (1), (2)) AS copies(copy) WHERE draw <> 0 AND (copy = 1 OR draw = 3)),
placed AS (
  SELECT *, left(role, 1) AS initial, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) - 1 AS i,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM damaged),
judged AS (
  SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS earlier,
         CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
rows AS (
  SELECT *, fault NOT IN ('blank', 'duplicate') AS stays, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS extra FROM judged),
costs AS (
  SELECT DISTINCT conv_id, n AS i, [0, 6, 3, 0] AS d FROM rows
  UNION ALL
  SELECT conv_id, i, [least(w[1], 3 + w[3], 6 + w[4]), least(w[2], 3 + w[3], 6 + w[4]), least(w[3], 3 + w[4]), least(w[4], 3 + w[3])]
  FROM (SELECT r.conv_id, r.i, [
          least(4 + d[1], CASE WHEN stays AND initial = 's' THEN extra + d[2] WHEN stays AND initial = 'u' THEN extra + d[3] END,
                CASE WHEN stays THEN 3 + extra + d[3] END),
          least(4 + d[2], CASE WHEN stays AND initial = 'u' THEN extra + d[3] END, CASE WHEN stays THEN 3 + extra + d[3] END),
          least(4 + d[3], CASE WHEN stays AND initial = 'a' THEN extra + d[4] END, CASE WHEN stays THEN 3 + extra + d[4] END),
          least(4 + d[4], CASE WHEN stays AND initial = 'u' THEN extra + d[3] END, CASE WHEN stays THEN 3 + extra + d[3] END)] AS w
        FROM costs c JOIN rows r ON r.conv_id IS NOT DISTINCT FROM c.conv_id AND r.i = c.i - 1)),
paths AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 1 AS q, '' AS audit, CAST(NULL AS VARCHAR) AS body FROM rows
  UNION ALL
  SELECT conv_id, CASE edit WHEN 'I' THEN i ELSE i + 1 END,
         CASE edit WHEN 'D' THEN q WHEN 'K' THEN kept ELSE onward END, audit || edit,
         CASE edit WHEN 'D' THEN body ELSE concat_ws(chr(10), body, CASE edit WHEN 'K' THEN role WHEN 'I' THEN CASE onward WHEN 3 THEN 'user' ELSE 'assistant' END
                   ELSE CASE onward WHEN 3 THEN 'user' ELSE 'assistant' END END || ':' || CASE edit WHEN 'I' THEN '' ELSE text END) END
  FROM (SELECT p.conv_id, p.i, p.q, p.audit, p.body, p.onward, r.role, r.text,
               CASE WHEN p.q = 1 AND r.initial = 's' THEN 2 WHEN r.initial = 'u' THEN 3 ELSE 4 END AS kept,
               CASE WHEN h.d[p.q] = 4 + a.d[p.q] THEN 'D'
                    WHEN h.d[p.q] = 3 + h.d[p.onward] THEN 'I'
                    WHEN stays AND (p.q = 1 AND initial = 's' AND h.d[1] = extra + a.d[2] OR p.q <> 3 AND initial = 'u' AND h.d[p.q] = extra + a.d[3]
                                    OR p.q = 3 AND initial = 'a' AND h.d[3] = extra + a.d[4]) THEN 'K' ELSE 'R' END AS edit
        FROM (SELECT *, CASE q WHEN 3 THEN 4 ELSE 3 END AS onward FROM paths) p
        JOIN costs h ON h.conv_id IS NOT DISTINCT FROM p.conv_id AND h.i = p.i
        LEFT JOIN rows r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i
        LEFT JOIN costs a ON a.conv_id IS NOT DISTINCT FROM p.conv_id AND a.i = p.i + 1
        WHERE r.i IS NOT NULL OR p.q IN (2, 3))),
done AS (
  SELECT p.conv_id, p.audit, sha256(coalesce(p.body, '')) AS sha, c.d[1] AS cost
  FROM paths p JOIN costs c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.i = 0
  WHERE p.q IN (1, 4) AND NOT EXISTS (SELECT 1 FROM rows r WHERE r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i)),
figures AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY conv_id)
SELECT o.conv_id, coalesce(f.gaps, 0) AS gaps, coalesce(f.blank, 0) AS blank, coalesce(f.duplicate, 0) AS duplicate,
       coalesce(f.truncated, 0) AS truncated, coalesce(f.illegal, 0) AS illegal, CAST(coalesce(d.cost, 0) AS BIGINT) AS cost,
       coalesce(d.audit, '') AS audit, coalesce(d.sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM o.conv_id"""
