"""Consolidating pairwise matches into groups: minimum labels, pointer jumping, a checkpoint each round.

State per round is the set of edges between labels. Every endpoint takes the smallest label among itself and its
neighbours (a partial aggregation, so a hub with millions of edges is combined before the shuffle), the resulting
pointers are jumped until each points to a root, and the edges are rewritten to these labels with loops and repeats
dropped. The rounds end when no label changes, that is when no edge is left. Edges shrink geometrically, so the pointer tables of
all rounds together are about the size of the first; composing them from the last to the first gives the final labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from movelane.session import cut_lineage


def decided_edges(pairs: DataFrame, threshold: float = 0.85) -> DataFrame:
    """(a, b) with a < b for each unordered pair of different moves whose last outcome links them.

    Of the rows for a pair, in either order, the last scored_at counts (null is earliest; rows that tie are settled by
    the larger total, then decision). It links if decision reads merge, or if decision is null and total reaches
    ``threshold``. A null on either side is no pair.
    """
    rows = pairs.filter("left_move_id <> right_move_id").select(
        F.least("left_move_id", "right_move_id").alias("a"), F.greatest("left_move_id", "right_move_id").alias("b"),
        F.struct("scored_at", "total", "decision").alias("last"),
    )
    last = rows.groupBy("a", "b").agg(F.max("last").alias("last"))
    word = F.lower(F.regexp_replace("last.decision", r"(?U)^\s+|\s+$", ""))
    return last.filter(F.when(F.col("last.decision").isNotNull(), word == "merge").otherwise(F.col("last.total") >= threshold)).select("a", "b")


def _pointers(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    return both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label"))


def _jump(pointers: DataFrame) -> DataFrame:
    """(node, label, moved): every pointer follows the pointer of what it points to."""
    onward = pointers.select(F.col("node").alias("label"), F.col("label").alias("next"))
    return pointers.select("node", "label").join(onward, "label", "left").select("node", F.coalesce("next", "label").alias("label"), (F.col("next") < F.col("label")).alias("moved"))


def _roots(pointers: DataFrame) -> DataFrame:
    """``pointers`` jumped until none moves: every node points to the root of its tree.

    A jump doubles the reach, so a path of n pointers takes log n of them; half-jumped labels would only shift a long
    chain along itself. Written before each pair of jumps, since a join with itself doubles what a table comes from.
    """
    pointers = cut_lineage(pointers)
    while True:
        pointers = cut_lineage(_jump(_jump(pointers)))
        if pointers.filter("moved").isEmpty():
            return pointers.select("node", "label")


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): label is the smallest node it is linked with, at any distance.

    No edges give no rows; loops are ignored; repeated edges count once.
    """
    edges = cut_lineage(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    tables: list[DataFrame] = []
    for _ in range(max_rounds):
        if edges.isEmpty():
            break
        pointers = _roots(_pointers(edges))
        tables.append(pointers)
        left = pointers.select(F.col("node").alias("a"), F.col("label").alias("x"))
        right = pointers.select(F.col("node").alias("b"), F.col("label").alias("y"))
        edges = edges.join(left, "a").join(right, "b").filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        edges = cut_lineage(edges)
    else:
        raise RuntimeError(f"labels still change after {max_rounds} rounds")
    if not tables:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).limit(0)
    labels = tables[-1]
    for table in reversed(tables[:-1]):
        onward = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = table.join(onward, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
    return labels


def refine(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` after further ``edges`` (a, b) between labels, or between nodes that have none yet."""
    merged = cut_lineage(connected_components(edges))
    onward = merged.select(F.col("node").alias("label"), F.col("label").alias("next"))
    known = labels.join(onward, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
    fresh = merged.join(labels.select("node"), "node", "left_anti")
    return cut_lineage(known.unionByName(fresh))


def move_groups(pairs: DataFrame, threshold: float = 0.85) -> DataFrame:
    """(move_id, group_id) of every move with a link; group_id is the smallest move_id of its group."""
    return connected_components(decided_edges(pairs, threshold)).select(F.col("node").alias("move_id"), F.col("label").alias("group_id"))
