import os

import numpy as np
import pytest

from movelane.llm import boilerplate
from movelane.llm.boilerplate_training import fit, label, labelled

PAGE = """Home | News | Jobs | Search
This site stores small files on your computer. Accept all / Reject all
Alder LLP hires Maria Example from Birch & Co
By Peter Writer

The firm has hired Maria Example as a partner in its tax group in Paris, the firm said in May.
Background
Clients had asked for a senior name since the spring. "We answer the phone," she said.
Work on privacy notices, cookies and newsletters has grown into a practice of its own, Example said.
- Ada Person, Jakarta
* Bo Person (Hong Kong)
Advertisement
Neither firm would comment on the terms.
Share: Facebook X LinkedIn WhatsApp Email
Read next
1. Cedar Law names Otto Example managing partner
Dogwood & Co promotes 3 in Tokyo. The decision came a week after a review.
Back to top
© 2024 Outlet. All rights reserved."""
BODY = [5, 6, 7, 8, 9, 10, 12]


def test_body_of_a_page(spark):
    frame = spark.createDataFrame([(1, PAGE, "Alder LLP hires Maria Example from Birch & Co")], "item_id long, body_text string, headline string").selectExpr("*", "1 as line_no", "2 as text", "3 as key")
    assert [r.line_no for r in boilerplate.body_lines(frame).orderBy("line_no").collect()] == BODY


def test_edges(spark):
    long = "The court heard that " + "very " * 60_000 + "long sentences are fine."
    rows = [(1, None, None), (2, "", "x"), (3, " \n\t\n ", None), (4, long, None), (None, PAGE, None), (5, PAGE, None), (5, PAGE, None)]
    frame = spark.createDataFrame(rows, "item_id long, body_text string, headline string")
    got = [(r.item_id, r.line_no) for r in boilerplate.body_lines(frame).collect()]
    assert sorted(x for x in got if x[0] == 5) == sorted([(5, n) for n in BODY] * 2)
    assert {x[0] for x in got} == {4, 5, None}
    assert boilerplate.body_lines(frame.limit(0)).count() == 0


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    scores, step, start = rng.normal(size=(6, 5, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    sizes = np.array([5, 1, 3, 4, 2, 5])
    for page, path in enumerate(boilerplate.viterbi(scores, sizes, start, step)):
        n = sizes[page]
        paths = np.array(np.meshgrid(*[range(3)] * n)).reshape(n, -1).T
        value = lambda p: start[p[0]] + sum(scores[page, i, s] for i, s in enumerate(p)) + sum(step[a, b] for a, b in zip(p, p[1:]))
        assert np.isclose(value(path), max(value(p) for p in paths))


def test_training_separates_what_it_saw():
    pages = labelled([PAGE] * 4)
    assert len(pages) == 4
    model = fit([PAGE] * 4, [None] * 4, [s for _, s in pages], rounds=60)
    (numbers, path), = model.decode([PAGE], [None])
    assert [n for n, s in zip(numbers, path) if s == boilerplate.BODY] == BODY


def test_held_out_accuracy():
    """Pages of another scale than the model was trained on, against the annotation guide."""
    path = "/root/testdata/sf0.001/raw_items.parquet"
    if not os.path.exists(path):
        pytest.skip("no tables here")
    import pyarrow.parquet as pq

    rows = [r for r in pq.read_table(path, columns=["headline", "body_text"]).to_pylist() if r["body_text"]]
    found = boilerplate.Model.load().decode([r["body_text"] for r in rows], [r["headline"] for r in rows])
    right = total = 0
    for row, (numbers, states) in zip(rows, found):
        lines = row["body_text"].split("\n")
        for n, s in zip(numbers, states):
            want = label(lines[n])
            if want is not None:
                total += 1
                right += (want == boilerplate.BODY) == (s == boilerplate.BODY)
    assert total > 500 and right / total > 0.99
