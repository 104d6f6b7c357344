"""Connected components of an edge list, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ferrylog.session import gathered, materialize, materialize_counted, materialize_while

#: Edges (both directions counted) up to which the rounds are few and small.
FEW = 1_000_000


def connected_components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every end of ``edges(src, dst)``; a component's label is its least id."""
    both, n = _both_ways(edges)
    if n <= FEW:
        return _least_labels(both, n)
    labels = materialize(_contracted_labels(both, n, FEW), "labels")
    least = labels.groupBy("component").agg(F.min("id").alias("least"))
    return labels.join(least, "component").select("id", F.col("least").alias("component"))


def component_labels(edges: DataFrame, few: int = FEW) -> DataFrame:
    """``(id, component)`` for every end of ``edges(src, dst)``; the label is any id of the component.

    While there are more than ``few`` edges, every node gives way to the one of its
    neighbours, or itself, that comes first in an order drawn anew each round. A constant
    share of the nodes goes, so all rounds together write and shuffle no more than a small
    multiple of the edges. What is left is labelled by least ids.
    """
    return _contracted_labels(*_both_ways(edges), few)


def _both_ways(edges: DataFrame) -> tuple[DataFrame, int]:
    """The edges in both directions, and their number."""
    return materialize_counted(edges.union(edges.select("dst", "src")).distinct(), "edges")


def _contracted_labels(both: DataFrame, n: int, few: int) -> DataFrame:
    rounds = []
    while n > few:
        drawn = lambda c: F.struct(F.xxhash64(F.lit(len(rounds)), c).alias("h"), F.col(c).alias("id"))
        rounds.append(materialize(
            both.groupBy(F.col("src").alias("id")).agg(F.min(drawn("dst")).alias("near"))
                .select("id", F.least(drawn("id"), "near")["id"].alias("component")), "gives-way"))
        ends = [rounds[-1].select(F.col("id").alias(c), F.col("component").alias(f"__{c}")) for c in ("src", "dst")]
        both, n = materialize_counted(both.join(ends[0], "src").join(ends[1], "dst")
                                          .select(F.col("__src").alias("src"), F.col("__dst").alias("dst"))
                                          .where("src <> dst").distinct(), "edges")
    labels = _least_labels(both, n)
    for gone in reversed(rounds):
        later = labels.select(F.col("id").alias("component"), F.col("component").alias("__last"))
        labels = gone.join(later, "component", "left").select("id", F.coalesce("__last", "component").alias("component"))
    return labels


def _least_labels(both: DataFrame, n: int) -> DataFrame:
    """Labels by the least id of each component of the ``n`` edges ``both(src, dst)``, which has both directions.

    Each round takes the least label among the neighbours and then the label of
    that label, so long paths shrink by doubling. Rounds are written out.
    """
    labels = materialize(gathered(both.groupBy(F.col("src").alias("id"))
                                      .agg(F.least(F.col("id"), F.min("dst")).alias("component")), n), "labels")
    more = True
    while more:
        near = (both.join(labels.withColumnRenamed("id", "dst"), "dst")
                    .groupBy(F.col("src").alias("id")).agg(F.min("component").alias("near")))
        step = (labels.join(near, "id")
                      .select("id", "component", F.least("component", "near").alias("new")))
        root = labels.select(F.col("id").alias("new"), F.col("component").alias("root"))
        step = step.join(root, "new").select("id", "component", F.least("new", "root").alias("new"))
        step, more = materialize_while(gathered(step, n), "labels", F.col("component") != F.col("new"))
        labels = step.select("id", F.col("new").alias("component"))
    return labels
