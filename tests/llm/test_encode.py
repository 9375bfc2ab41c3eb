import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from movelane.llm import encode

PATH = f"{encode.TOKENIZERS}/byte_bpe_50k.tiktoken"
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary here")
TEXTS = [
    "Hello, world!  It's 2025 – we'll see.", "", " ", "\n\n  tabs\tand\r\nlines \n", "中文文本，没有空格。", "naïve café ſ ﬁ", "👩🏽‍💼 emoji", "<|endoftext|> is text", "x" * 50_000, " a  b   c    d ",
    "don't 'S 'LL CAN'T", " ​zero", "١٢٣ Ⅷ ½", " " * 40 + "indent", "a" + "\n" * 30 + "b", "\x00\x01null",
]


def reference():
    tokenizers = pytest.importorskip("tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(f"{encode.TOKENIZERS}/byte_bpe_50k.json")
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def run(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r.ids for r in encode.encode_documents(frame).collect()}


def test_same_ids_as_the_public_tokenizer(spark):
    one = reference()
    assert run(spark, TEXTS) == {i: one(t) for i, t in enumerate(TEXTS)}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs", "Cn"]), max_size=60), min_size=20, max_size=40))
def test_round_trip(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encoded = encode.encode_documents(frame)
    assert {r.doc_id: r.text for r in encode.decode_documents(encoded).collect()} == dict(enumerate(texts))


def test_null_empty_and_repeated_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (4, "a b"), (None, "a b")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "2 as word", "3 as pos", "4 as ids", "5 as digest")
    got = [(r.doc_id, r.ids) for r in encode.encode_documents(frame).collect()]
    ids = reference()("a b")
    assert sorted(got, key=str) == sorted([(1, []), (2, []), (3, ids), (4, ids), (None, ids)], key=str)
    assert encode.encode_documents(frame.limit(0)).count() == 0


def test_counts_agree_with_ids(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    counts = {r.doc_id: r.tokens for r in encode.token_counts(frame).collect()}
    assert counts == {i: len(x) for i, x in run(spark, TEXTS).items() if x}


def test_decoding_rejects_unknown_ids(spark):
    with pytest.raises(Exception, match="unknown token id"):
        encode.decode_documents(spark.createDataFrame([(1, [10**6])], "doc_id long, ids array<int>")).collect()
