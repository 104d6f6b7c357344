"""Apply an ordered change log to a table.

Each change is a compare-and-set: an INSERT lands only where the key is absent,
an UPDATE or DELETE only where the stored row equals the before image. A change
that hits nothing is no error.

With a key, and updates that keep it, keys are independent: the changes of a key
fold over its row. Three cases need more, each exact and without a cap:

* a key with very many changes follows the chain of changes that land, found by
  pointer doubling over its states, "no row" among them (``_fold_hot``);
* updates that move a row to another key tie keys together; many of them are settled
  first by what is known of each key alone (``_settle``). Keys that are still tied fold
  as one component, and a component too large for one task is applied in two halves of
  the log (``_fold_tied``);
* a table without a key is a bag of rows, and every row follows its own chain of
  changes, found by pointer doubling (``_fold_bag``).

All use one equality: values are equal as Spark compares them, NULL equals NULL, and
maps are equal with equal entries. A NULL in a key is a value like any other. The
limits choose the way, never the result.
"""

from __future__ import annotations

from functools import reduce
from typing import Optional, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ferrylog.functions.images import ABSENT, align, has_map, has_null, identity, pack
from ferrylog.operators.carry import CHUNK, carry_forward
from ferrylog.operators.components import component_labels
from ferrylog.operators.numbering import number_rows
from ferrylog.schema import DELETE, INSERT, UPDATE
from ferrylog.session import is_empty, materialize, materialize_while

ORDER = ("file", "pos", "row_no")
HOT_LIMIT = 10_000   # changes of one key (or component) folded in one array or call
OPS_PER_GROUP = 50_000  # changes of tied keys per Python call, about
LINKS = 50_000       # numbers of a log whose chains are followed in one Python call
TIED = 20            # times the limit: changes of a component that are folded in one call, as digests
ROUNDS = 6           # rounds that settle updates which move keys
POSSIBLE = 16        # rows that a key may have by then, told apart up to so many
_N = "__n"           # number of a change in a log that is applied in halves


def prepare_changes(changes: DataFrame, schema, order=ORDER, null_match="safe") -> DataFrame:
    """Align images with the target and drop the image a change does not use.

    ``null_match="never"``: a NULL in a before image matches nothing, so those
    changes are no-ops and leave the log here.
    """
    if null_match not in ("safe", "never"):
        raise ValueError("null_match is 'safe' or 'never'")
    op = F.col("op")
    ops = (changes.where(op.isin(INSERT, UPDATE, DELETE))
                  .select(*order, "op",
                          F.when(op != INSERT, align("before", schema)).alias("before"),
                          F.when(op != DELETE, align("after", schema)).alias("after"))
                  .where(F.when(op == INSERT, F.col("after").isNotNull())
                          .otherwise(F.col("before").isNotNull()))
                  .where((op != UPDATE) | F.col("after").isNotNull()))
    if null_match == "never":
        ops = ops.where((op == INSERT) | ~has_null("before", schema))
    return ops


def apply_changes(target: DataFrame, changes: DataFrame, keys: Optional[Sequence[str]] = None,
                  null_match="safe", order=ORDER, hot_limit=HOT_LIMIT) -> DataFrame:
    """The target after all changes, in log order. ``order`` must be unique."""
    ops = prepare_changes(changes, target.schema, order, null_match)
    if not keys:
        return _fold_bag(target, ops, list(order))
    return _fold_keyed(target, ops, list(keys), list(order), hot_limit)


# --- keyed tables -----------------------------------------------------------

def _with_key(ops, keys):
    image = F.coalesce(F.col("before"), F.col("after"))
    return ops.withColumns({k: image.getField(k) for k in keys})


def _match(left, right, keys, how):
    """Join on keys in which NULL equals NULL; the keys are those of the left side."""
    right = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"__right_{k}"]) for k in keys])
    return left.join(right, same, how).drop(*[f"__right_{k}" for k in keys])


def _fold_keyed(target, ops, keys, order, hot_limit, settled=False):
    moved = ~F.struct(*[F.col("before").getField(k) for k in keys]).eqNullSafe(
        F.struct(*[F.col("after").getField(k) for k in keys]))
    ops = _with_key(ops, keys).withColumn("moved", (F.col("op") == UPDATE) & moved)
    special = (ops.groupBy(*keys)
                  .agg(F.count(F.lit(1)).alias("n"), F.count_if("moved").alias("moved")))
    most = special.agg(F.max("n").alias("n"), F.sum("moved").alias("moved")).first()
    if not most.moved and (most.n or 0) <= hot_limit:
        return _fold_grouped(target, ops, keys, order)
    if not settled and most.moved > hot_limit:
        return _fold_moving(target, ops, keys, order, hot_limit)

    parts, rest_target, rest_ops = [], target, ops
    if most.moved:
        tied = _tied_keys(ops, keys)
        parts.append(_fold_tied(_match(target, tied, keys, "inner"), _match(ops, tied, keys, "inner"),
                                target.schema, keys, order, hot_limit))
        rest_target = _match(rest_target, tied, keys, "left_anti")
        rest_ops = _match(rest_ops, tied, keys, "left_anti")
        special = _match(special, tied, keys, "left_anti")
    if most.n > hot_limit:
        # Few by nature: each has more than hot_limit changes of its own.
        hot = materialize(special.where(F.col("n") > hot_limit).select(*keys), "hot-keys")
        parts.append(_fold_hot(_match(rest_target, hot, keys, "left_semi"),
                               _match(rest_ops, hot, keys, "left_semi"), target.schema, keys, order))
        rest_target = _match(rest_target, hot, keys, "left_anti")
        rest_ops = _match(rest_ops, hot, keys, "left_anti")
    out = _fold_grouped(rest_target, rest_ops, keys, order)
    for part in parts:
        out = out.unionByName(part)
    return out


def _in_order(steps, order, maps):
    """Sorted steps. The order is unique, so what follows it in a step never decides; maps forbid the plain sort."""
    if not maps:
        return F.sort_array(steps)

    def compare(a, b):
        sign = F.lit(0)
        for name in reversed(order):
            sign = F.when(a[name] < b[name], F.lit(-1)).when(a[name] > b[name], F.lit(1)).otherwise(sign)
        return sign

    return F.array_sort(steps, compare)


def _fold_grouped(target, ops, keys, order):
    """All changes of a key in one array, folded over the stored row.

    Full outer join: a key may be only stored, only changed, or both.
    """
    maps = has_map(target.schema)
    step = F.struct(*order, "op", "before", "after")
    logs = ops.groupBy(*keys).agg(_in_order(F.collect_list(step), order, maps).alias("__log"))
    image_type = target.schema.simpleString()
    stored = target.select(*keys, pack(target.columns).alias("__row"))

    def equal(row, image):
        if maps:
            return identity(row, target.schema) == identity(image, target.schema)
        return row.eqNullSafe(image)

    def advance(row, c):
        lands = F.when(c["op"] == INSERT, row.isNull()).otherwise(row.isNotNull() & equal(row, c["before"]))
        return F.when(lands, c["after"]).otherwise(row)

    # Both branches of the outer join meet as one nullable struct.
    start = F.col("__row").cast(image_type)
    folded = F.when(F.col("__log").isNull(), start).otherwise(
        F.aggregate("__log", start, advance))
    # A generator evaluates the fold once; a filter on it would be pushed below
    # the projection and fold every log twice.
    return (_match(stored, logs, keys, "full_outer")
                  .select(F.inline(F.array_compact(F.array(folded)))))


def _fold_hot(target, ops, schema, keys, order):
    """Fold keys with many changes, however many: pointers instead of arrays.

    The state of a key is the digest of its row, or ABSENT. A change leaves the state
    of its before image and arrives at that of its after image; after it has landed,
    the next one to land is the first later change that leaves where it arrived.
    """
    kind = T.StructType([schema[k] for k in keys])
    key = identity(pack(keys), kind).alias("kid")
    ops = number_rows(ops.select(key, *order, "after", identity("before", schema).alias("i"),
                                 identity("after", schema).alias("o")), order, "n")
    stored = target.select(key, pack(schema.names).alias("row"))
    start = materialize(ops.select("kid").distinct().join(stored, "kid", "left")
                           .withColumn("s", identity("row", schema)), "hot-start")
    leaves = ops.select("kid", F.col("i").alias("id"), (-2 * F.col("n")).alias("t"), F.col("n").alias("leave"))
    arrives = ops.select("kid", F.col("o").alias("id"), (-2 * F.col("n") - 1).alias("t"),
                         F.lit(None).cast("long").alias("leave"))
    ahead = _next_leave(leaves, arrives, ["kid", "id"])
    nodes = _chase(ahead.select(((-F.col("t") - 1) / 2).cast("long").alias("n"), "next"))
    first = (leaves.groupBy("kid", F.col("id").alias("s")).agg(F.min("leave").alias("n"))
                   .join(nodes, "n").select("kid", "s", F.col("end").alias("n")))
    ends = (start.join(first, ["kid", "s"], "left")
                 .join(ops.select("n", "o", "after"), "n", "left")
                 .withColumn("o", F.coalesce("o", "s")).where(F.col("o") != ABSENT))
    kept = ends.where(F.col("o") == F.col("s")).select("row.*")
    changed = ends.where(F.col("o") != F.col("s"))
    rows = changed.groupBy("kid").agg(F.first("after").alias("row")).select("row.*")
    return kept.unionByName(rows)


# --- chains -----------------------------------------------------------------

def _next_leave(leaves, arrives, by, chunk=CHUNK):
    """For each arrival at a row, the next change that leaves that row.

    Both carry a time ``t`` that runs backwards, so the wanted change is the latest
    one before the arrival.
    """
    timeline = carry_forward(leaves.unionByName(arrives), "leave", "t", by, out="next", chunk=chunk)
    return timeline.where("leave IS NULL").select(*by, "t", "next")


def _follow(pdf: pd.DataFrame) -> pd.DataFrame:
    """Follow the chains of some consecutive numbers as far as they stay among them."""
    pdf = pdf.sort_values("n")
    n, to = pdf["n"].to_numpy("int64"), pdf["next"].fillna(-1).to_numpy("int64")
    place = np.minimum(np.searchsorted(n, to), len(n) - 1)
    at = np.where(n[place] == to, place, np.arange(len(n)))
    while not np.array_equal(ahead := at[at], at):
        at = ahead
    return pd.DataFrame({"n": n, "next": pd.Series(to[at]).where(to[at] >= 0).astype("Int64"), "end": n[at]})


def _chase(nodes: DataFrame, links: int = LINKS) -> DataFrame:
    """``(n, end)``: follow ``nodes(n, next)`` to the last number of each chain.

    Chains are followed inside runs of ``links`` numbers first. Only numbers that are
    entered from another run take part in the rounds: each doubles the reach of their
    pointers with one equi join on unique ids, so the rounds are the logarithm of the
    longest chain.
    """
    run = F.floor(F.col("n") / F.lit(links)).alias("run")
    followed, more = materialize_while(
        nodes.select("n", F.col("next").cast("long").alias("next")).groupBy(run).applyInPandas(_follow, "n long, next long, end long"),
        "chain", F.col("next").isNotNull())
    if not more:
        return followed.select("n", "end")
    unfinished = F.col("next").isNotNull()
    entered = followed.where(unfinished).select(F.col("next").alias("n")).distinct()
    nodes, more = materialize_while(followed.join(entered, "n", "left_semi"), "chain", unfinished)
    while more:
        ahead = nodes.select(F.col("n").alias("next"), F.col("next").alias("next2"),
                             F.col("end").alias("end2"))
        nodes, more = materialize_while(nodes.where(~unfinished).unionByName(
            nodes.where(unfinished).join(ahead, "next")
                 .select("n", F.col("next2").alias("next"), F.col("end2").alias("end"))),
            "chain", unfinished)
    last = nodes.select(F.col("n").alias("next"), F.col("end").alias("__last"))
    return followed.join(last, "next", "left").select("n", F.coalesce("__last", "end").alias("end"))


# --- updates that move keys -------------------------------------------------

_MISSES, _OPEN, _LANDS = range(3)
_STORED, _LEAVES, _ARRIVES, _STAYS = range(4)
_NO_ROW = 0          # in place of a hash


def _fold_moving(target, ops, keys, order, limit):
    """Keys that updates move rows from or to, once what can be settled of these is; the others as ever."""
    ends = [F.struct(*[F.col(image).getField(k).alias(k) for k in keys]).alias("k") for image in ("before", "after")]
    moves = ops.where("moved")
    names = materialize(moves.select(ends[0]).union(moves.select(ends[1])).distinct().select("k.*"), "moving-keys")
    log = [*order, "op", "before", "after"]
    rest = _fold_keyed(_match(target, names, keys, "left_anti"), _match(ops, names, keys, "left_anti").select(log), keys, order, limit)
    rows = materialize(_match(target, names, keys, "left_semi").dropDuplicates(keys), "moving-rows")
    own = _numbered(_match(ops, names, keys, "left_semi").select(log), order).select(_N, "op", "before", "after")
    return _fold_keyed(rows, _settle(rows, own, keys, limit), keys, [_N], limit, settled=True).unionByName(rest)


def _outlook(batches):
    """What is known of the two sides of updates that move a row; rows come by key, in log order.

    A side lands where the key has the wanted row, and leaves another there if the other side
    lands too. The rows that a key may have by then are followed, from the stored one.
    """
    key, may = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        kid = np.frombuffer(batch.column("kid").cast(pa.binary(16)).buffers()[1], "int64", 2 * batch.num_rows).reshape(-1, 2)
        n, side, want, becomes, other = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n", "side", "want", "becomes", "other"))
        new = np.append(key is None or not np.array_equal(kid[0], key), (kid[1:] != kid[:-1]).any(axis=1))
        key = kid[-1].copy()
        # A stored row whose key comes to an end with it tells nothing.
        rows = np.flatnonzero((side != _STORED) | ~np.append(new[1:], False))
        # A key may begin with a row that was left out: it ended there, and the next one is new itself.
        out = [], [], []
        for i, begins, s, w, t, o in zip(rows.tolist(), *(c[rows].tolist() for c in (new, side, want, becomes, other))):
            if begins:
                may = {_NO_ROW}
            if s == _STORED:
                may = {t}
                continue
            own = _OPEN if may is None else _MISSES if w not in may else _LANDS if len(may) == 1 else _OPEN
            if may is not None and own != _MISSES and o != _MISSES:
                if o == _LANDS:
                    may.discard(w)
                may.add(t)
                if len(may) > POSSIBLE:
                    may = None
            if s != _STAYS:
                out[0].append(i)
                out[1].append(own if s == _LEAVES else None)
                out[2].append(own if s == _ARRIVES else None)
        yield pa.RecordBatch.from_arrays([pa.array(n[np.array(out[0], "int64")], pa.int64()), pa.array(out[1], pa.int8()), pa.array(out[2], pa.int8())], ["n", "b", "a"])


def _settle(target, ops, keys, limit):
    """The log, by ``_N``, without updates that are known to miss, and with those that are known to land as a DELETE and an INSERT.

    Both say the same about each key, and neither ties keys. Each round tells more of every
    key from what the round before told of the other ends of its updates; what no round
    tells, or ``ROUNDS`` do not, stays as it is. Images are compared within one key only, by
    64 bits of their digests.
    """
    schema = target.schema
    kind = T.StructType([schema[k] for k in keys])

    def kid(image):
        return F.when(F.col(image).isNotNull(), identity(F.struct(*[F.col(image).getField(k).alias(k) for k in keys]), kind))

    def short(image):
        return F.when(F.col(image).isNotNull(), F.xxhash64(identity(image, schema))).otherwise(F.lit(_NO_ROW).cast("bigint"))

    steps = materialize(ops.select(F.col(_N).alias("n"), kid("before").alias("kb"), kid("after").alias("ka"),
                                   short("before").alias("i"), short("after").alias("o")), "settle-steps")
    none, no_row = lambda kind: F.lit(None).cast(kind), F.lit(_NO_ROW).cast("bigint")
    code = lambda value: F.lit(value).cast("byte")
    stored = materialize(target.select(pack(schema.names).alias("row")).select(kid("row").alias("kid"), short("row").alias("becomes")), "settle-rows")
    stored = stored.select("kid", F.lit(-1).cast("bigint").alias("n"), code(_STORED).alias("side"), no_row.alias("want"), "becomes",
                           code(_LANDS).alias("other"))
    moved = F.coalesce(F.col("kb") != F.col("ka"), F.lit(False))
    misses = (F.coalesce("b", F.lit(_OPEN)) == _MISSES) | (F.coalesce("a", F.lit(_OPEN)) == _MISSES)
    known, last = None, None
    for _ in range(ROUNDS):
        live = steps.withColumns({"b": none("byte"), "a": none("byte")}) if known is None else steps.join(known, "n", "left").where(~misses)
        other = lambda c: F.when(moved, F.coalesce(c, code(_OPEN))).otherwise(code(_LANDS))
        # An update that keeps its key is one side; so are an INSERT and a DELETE.
        at_before = F.struct(F.col("kb").alias("kid"), "n", F.when(moved, code(_LEAVES)).otherwise(code(_STAYS)).alias("side"), F.col("i").alias("want"),
                             F.when(moved, no_row).otherwise(F.col("o")).alias("becomes"), other("a").alias("other"))
        at_after = F.struct(F.col("ka").alias("kid"), "n", F.when(moved, code(_ARRIVES)).otherwise(code(_STAYS)).alias("side"), no_row.alias("want"),
                            F.col("o").alias("becomes"), other("b").alias("other"))
        sides = live.select(F.inline(F.array_compact(F.array(F.when(F.col("kb").isNotNull(), at_before),
                                                             F.when(moved | F.col("kb").isNull(), at_after)))))
        told = (sides.unionByName(stored).repartition("kid").sortWithinPartitions("kid", "n").mapInArrow(_outlook, "n long, b byte, a byte")
                     .groupBy("n").agg(F.max("b").alias("b"), F.max("a").alias("a")))
        known = materialize(told if known is None else told.unionByName(known.where(misses)), "settled")
        still = known.where(~misses & ((F.col("b") == _OPEN) | (F.col("a") == _OPEN))).count()
        if still <= limit or still == last:
            break
        last = still
    lands = (F.col("b") == _LANDS) & (F.col("a") == _LANDS)
    image = schema.simpleString()
    delete = F.struct(F.lit(DELETE).alias("op"), F.col("before"), none(image).alias("after"))
    insert = F.struct(F.lit(INSERT).alias("op"), none(image).alias("before"), F.col("after"))
    met = ops.join(known.withColumnRenamed("n", _N), _N, "left").where(~misses)
    return materialize(met.select(_N, F.inline(F.when(F.coalesce(lands, F.lit(False)), F.array(delete, insert))
                                                .otherwise(F.array(F.struct("op", "before", "after"))))), "settled-log")


def _tied_keys(ops, keys):
    """Component of every key that an update ties to another key."""
    moves = materialize(ops.where("moved").select(
        F.struct(*[F.col("before").getField(k).alias(k) for k in keys]).alias("a"),
        F.struct(*[F.col("after").getField(k).alias(k) for k in keys]).alias("b")), "moves")
    kind = ops.select(*keys).schema
    # Keys that share a short hash are folded together, which does not change what they become.
    short = lambda key: F.xxhash64(identity(key, kind))
    labels = component_labels(moves.select(short("a").alias("src"), short("b").alias("dst")))
    names = moves.select(F.col("a").alias("k")).union(moves.select("b")).distinct().withColumn("id", short("k"))
    return materialize(names.join(labels, "id").select("k.*", "component"), "tied-keys")


def _fold_components(pdf_rows: pd.DataFrame, pdf_ops: pd.DataFrame) -> pd.DataFrame:
    """Sequential compare-and-set over the keys of some components; components share
    no key, so one pass over their merged log keeps them apart."""
    rows = dict(zip(pdf_rows["kid"], pdf_rows["id"]))
    for op in pdf_ops.sort_values("n").itertuples():
        if op.op == INSERT:
            rows.setdefault(op.ka, op.o)
        elif rows.get(op.kb) == op.i:
            if op.op == DELETE:
                del rows[op.kb]
            elif op.ka == op.kb or op.ka not in rows:
                del rows[op.kb]
                rows[op.ka] = op.o
    return pd.DataFrame({"id": pd.Series(list(rows.values()), dtype=object)})


def _numbered(ops, order):
    """Changes with their number in the log; in a part of a numbered log they keep the one they have."""
    return materialize(ops, "numbered") if order == [_N] else number_rows(ops, order, _N)


def _fold_tied(target, ops, schema, keys, order, limit):
    sizes = ops.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    large = materialize(sizes.where(F.col("n") > TIED * limit).select("component"), "large-components")
    out = None
    if not is_empty(large):
        out = _fold_halves(target.join(large, "component", "left_semi").select(*schema.names),
                           ops.join(large, "component", "left_semi"), keys, order, limit)
        target = target.join(large, "component", "left_anti")
        ops = ops.join(large, "component", "left_anti")
    ops = _numbered(ops, order)

    def kid(image):
        key = F.struct(*[F.col(image).getField(k).alias(k) for k in keys])
        return F.when(F.col(image).isNotNull(), identity(key, T.StructType([schema[k] for k in keys])))

    # Many small components share a task; the number of groups grows with the log.
    groups = max(ops.count() // OPS_PER_GROUP, 1) * 8
    group = F.pmod(F.xxhash64("component"), F.lit(groups)).alias("g")
    steps = ops.select(group, F.col(_N).alias("n"), "op", kid("before").alias("kb"), kid("after").alias("ka"),
                       identity("before", schema).alias("i"), identity("after", schema).alias("o"))
    stored = target.select("component", pack(schema.names).alias("row"))
    rows = stored.select(group, kid("row").alias("kid"), identity("row", schema).alias("id"))
    ends = (rows.groupBy("g").cogroup(steps.groupBy("g"))
                .applyInPandas(_fold_components, "id binary"))
    images = (stored.select(identity("row", schema).alias("id"), "row")
                    .unionByName(ops.select(identity("after", schema).alias("id"),
                                            F.col("after").alias("row")).where("row IS NOT NULL"))
                    .groupBy("id").agg(F.first("row").alias("row")))
    folded = ends.join(images, "id").select("row.*")
    return folded if out is None else out.unionByName(folded)


def _fold_halves(target, ops, keys, order, limit):
    """Apply the earlier half of the log, then the later: each has fewer ties."""
    ops = _numbered(ops.select(*order, "op", "before", "after"), order)
    half = ops.agg(F.percentile_approx(_N, 0.5)).first()[0]
    out = materialize(target, "half")
    for part in (ops.where(F.col(_N) <= half), ops.where(F.col(_N) > half)):
        out = materialize(_fold_keyed(out, part.select(_N, "op", "before", "after"), keys, [_N], limit), "half")
    return out


# --- tables without a key ---------------------------------------------------

def _fold_bag(target, ops, order, chunk=CHUNK):
    """Every row equal to the before image is hit; equal rows move together.

    ``next`` of a change is the first later change whose before image is the row
    it leaves behind. Following ``next`` to its end gives the final row; doubling
    the pointers takes log2(longest chain) rounds of equi joins.
    """
    schema = target.schema
    ops = number_rows(ops.select(*order, "op", "after", identity("before", schema).alias("i"),
                                 identity("after", schema).alias("o")), order, "n")
    leaves = ops.where(F.col("op") != INSERT).select(
        F.col("i").alias("id"), (-2 * F.col("n")).alias("t"), F.col("n").alias("leave"))
    arrives = ops.where(F.col("op") != DELETE).select(
        F.col("o").alias("id"), (-2 * F.col("n") - 1).alias("t"), F.lit(None).cast("long").alias("leave"))
    ahead = _next_leave(leaves, arrives, ["id"], chunk)
    nodes = _chase(ahead.select(((-F.col("t") - 1) / 2).cast("long").alias("n"), "next")
                        .unionByName(ops.where(F.col("op") == DELETE).select(
                            "n", F.lit(None).cast("long").alias("next"))))

    first = leaves.groupBy("id").agg(F.min("leave").alias("n")).join(nodes, "n").select("id", "end")
    stored = target.select(pack(schema.names).alias("stored"))
    stored = stored.withColumn("id", identity("stored", schema)).join(first, "id", "left")
    untouched = stored.where("end IS NULL").select("stored.*")
    ends = (stored.where("end IS NOT NULL").select("end")
                  .unionByName(ops.where(F.col("op") == INSERT).select("n")
                                  .join(nodes, "n").select("end")))
    # What the last change of a chain leaves behind; nothing, if that is a DELETE.
    images = ops.where(F.col("op") != DELETE).select(F.col("n").alias("end"), F.col("after").alias("row"))
    return untouched.unionByName(ends.join(images, "end").select("row.*"))


# --- all-column match -------------------------------------------------------

def match_before_image(target: DataFrame, images: DataFrame, null_match="safe") -> DataFrame:
    """Stored rows equal to some image in every column, duplicates included.

    Images are made distinct first, so a repeated image cannot multiply rows.
    """
    names = target.columns
    wanted = images.select(*[F.col(c).alias(f"__{c}") for c in names])
    if null_match == "never":
        wanted = wanted.dropna("any")
    wanted = wanted.distinct()
    same = None
    for c in names:
        equal = target[c].eqNullSafe(wanted[f"__{c}"])
        same = equal if same is None else same & equal
    return target.join(wanted, same, "left_semi")
