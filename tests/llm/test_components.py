import random

import pytest

from movelane.llm.components import connected_components, decided_edges, move_groups

PAIRS = "left_move_id long, right_move_id long, to_firm_id long, total decimal(5,4), decision string, scored_at timestamp"


def brute(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("kind", ["chain", "long chain", "shuffled chain", "star", "random", "repeats"])
def test_components_match_union_find(spark, kind):
    rng = random.Random(kind)
    ids = list(range(1, 200))
    if kind == "shuffled chain":
        rng.shuffle(ids)
    edges = {
        "chain": list(zip(ids, ids[1:])), "long chain": [(i, i + 1) for i in range(4000)], "shuffled chain": list(zip(ids, ids[1:])), "star": [(7, x) for x in range(100, 400)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(220)], "repeats": [(3, 4), (4, 3), (3, 4), (5, 5)],
    }[kind]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == brute([(a, b) for a, b in edges if a != b])


def test_no_edges_no_rows(spark):
    empty = spark.createDataFrame([], PAIRS)
    assert move_groups(empty).columns == ["move_id", "group_id"]
    assert move_groups(empty).count() == 0


def test_last_outcome_counts_in_either_order(spark):
    rows = [
        (1, 2, 9, "0.9", "distinct", "2025-01-02"), (2, 1, 9, "0.1", " Merge ", "2025-01-03"),  # the later one links
        (3, 4, 9, "0.9", "merge", "2025-01-01"), (4, 3, 9, "0.9", "ambiguous", "2025-02-01"),  # the later one does not
        (5, 6, 9, "0.85", None, "2025-01-01"), (7, 8, 9, "0.8499", None, "2025-01-01"), (9, 10, 9, None, None, "2025-01-01"),
        (11, 11, 9, "1.0", "merge", "2025-01-01"), (None, 12, 9, "1.0", "merge", "2025-01-01"), (12, None, None, None, "merge", None),
        (13, 14, None, None, "merge", None), (13, 14, None, None, "merge", None),
    ]
    frame = spark.createDataFrame([(a, b, f, t, d, s) for a, b, f, t, d, s in rows], "left_move_id long, right_move_id long, to_firm_id long, total string, decision string, scored_at string").selectExpr("left_move_id", "right_move_id", "to_firm_id", "cast(total as decimal(5,4)) total", "decision", "cast(scored_at as timestamp) scored_at")
    assert {(r.a, r.b) for r in decided_edges(frame).collect()} == {(1, 2), (5, 6), (13, 14)}
    # Columns that the operator uses for itself don't get in its way.
    clash = frame.selectExpr("*", "1 as a", "2 as b", "3 as node", "4 as label", "5 as last")
    assert {(r.move_id, r.group_id) for r in move_groups(clash).collect()} == {(1, 1), (2, 1), (5, 5), (6, 5), (13, 13), (14, 13)}
