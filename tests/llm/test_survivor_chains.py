"""Currency over chains of any length and over cycles."""

import datetime as dt

from movelane.llm import survivor

MOVES = "move_id long, source_slug string, fields map<string, struct<value string, span_start int, span_end int, quality string>>, self_confidence double, extracted_at timestamp, group_ref long"
SOURCES = "register_version int, config struct<slug string, reliability_tier int>, notes string"


def test_the_latest_of_a_chain_of_ten(spark):
    move = lambda i, value, day, group: (i, "good", {"title": (value, 0, 1, "exact")}, 0.5, dt.datetime(2025, 1, day) if day else None, group)
    steps = [move(100 + 2 * i + j, f"v{i + j}", 1 + j, 10 + i) for i in range(9) for j in (0, 1)]
    undated = [move(1 + i, f"v{i}", None, 1) for i in range(10)]
    frame = spark.createDataFrame(steps + undated, MOVES)
    got = survivor.surviving_values(frame, spark.createDataFrame([(1, ("good", 1), None)], SOURCES)).filter("group_ref = 1").collect()
    assert [(r.move_id, r.value) for r in got] == [(10, "v9")]


def test_a_cycle_is_one_step():
    assert survivor.chain_depths([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("x", "a")]) == {"x": 0, "a": 1, "b": 1, "c": 1, "d": 2, "e": 3}
    assert survivor.chain_depths([(f"{i:05}", f"{i + 1:05}") for i in range(20_000)])["20000"] == 20_000
