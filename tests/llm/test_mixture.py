import os

import pytest

from movelane.llm import encode, mixture

TARGETS = "plan string, source string, target_share double, max_repeats int, size_factor double"


def sized(spark, rows):
    return spark.createDataFrame(rows, "source string, doc_id long, tokens long")


def test_running_tokens_match_one_pass(spark):
    rows = [("s" if i % 3 else "t", i, i % 7 + 1) for i in range(500)]
    one = {(r.source, r.doc_id): r.before for r in mixture.running_tokens(sized(spark, rows), 10**9).collect()}
    many = {(r.source, r.doc_id): r.before for r in mixture.running_tokens(sized(spark, rows), 16).collect()}
    assert one == many
    assert min(v for (s, _), v in one.items() if s == "s") == 0


def test_shares_and_repeat_limits(spark):
    rows = [("big", i, 100) for i in range(90)] + [("small", 1000 + i, 100) for i in range(10)]
    targets = spark.createDataFrame([("p", "big", 0.5, 1, 1.0), ("p", "small", 0.4, 3, 1.0), ("p", "absent", 0.1, 5, 1.0), ("p", "big", 0.5, 1, 1.0)], TARGETS)
    got = mixture.assign_positions(sized(spark, rows), targets).collect()
    used = {}
    for r in got:
        used[r.source] = used.get(r.source, 0) + r.tokens
        assert 0 <= r.position <= 1
    assert used == {"big": 5000, "small": 3000}  # the small source is capped at three passes
    assert max(r.copy for r in got if r.source == "small") == 2
    assert len({(r.doc_id, r.copy) for r in got}) == len(got)


def test_curriculum_brings_large_sources_early(spark):
    rows = [("big", i, 10) for i in range(300)] + [("small", 1000 + i, 10) for i in range(100)]
    targets = spark.createDataFrame([("p", "big", 0.75, 1, 1.0), ("p", "small", 0.25, 1, 1.0)], TARGETS)
    for strength, early in ((1.0, True), (0.0, False)):
        got = mixture.assign_positions(sized(spark, rows), targets, strength).collect()
        first = [r for r in got if r.position < 0.5]
        share = sum(r.source == "small" for r in first) / len(first)
        assert (share < 0.2) if early else abs(share - 0.25) < 0.02


@pytest.mark.skipif(not os.path.exists(encode.TOKENIZERS), reason="no vocabulary here")
def test_training_order_and_report(spark):
    docs = spark.createDataFrame([(1, "one two three", "a"), (2, None, "a"), (3, "", "a"), (4, "four five", "b"), (5, "six", None), (4, "four five", "b")], "doc_id long, text string, source string")
    docs = docs.selectExpr("*", "'x' as plan", "1 as tokens", "2 as range", "3 as h", "4 as before")
    targets = spark.createDataFrame([("p", "a", 0.5, 2, 1.0), ("p", "b", 0.5, None, None), ("q", "c", 1.0, 2, 1.0), (None, "a", 1.0, 1, 1.0), ("p", "d", None, 1, 1.0)], TARGETS)
    order = mixture.training_order(docs, targets).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    assert {r.doc_id for r in order} == {1, 4}
    report = {(r.plan, r.source): r for r in mixture.mixture_report(docs, targets).collect()}
    assert abs(sum(r.actual_share for (p, _), r in report.items() if p == "p") - 1) < 1e-9
    assert report["q", "c"].used == 0 and report["q", "c"].actual_share == 0
    assert mixture.training_order(docs.limit(0), targets).count() == 0
    assert mixture.training_order(docs, targets.limit(0)).count() == 0
