"""Encoding of a corpus with a public tokenizer: one global dictionary of distinct words.

Texts are cut into pre-tokens with their positions by a JVM expression; each distinct pre-token is encoded once (Arrow
batches of distinct words only); its ids are joined back by word and put together by position. Python sees the
vocabulary of the corpus, not the corpus. The dictionary is written, so its size is measured before the join is planned:
a small one is broadcast, one whose share of a task fits in memory is hashed, a larger one is merged and may spill.
Frequent words make the join skewed on one side only, which AQE splits.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from movelane.session import broadcast_bytes, cut_lineage, written_bytes

TOKENIZERS = "/opt/tokenizers"
# The split of the byte-level vocabularies; (?U) gives \s its Unicode meaning.
PRE_TOKEN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_encoders: dict = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> id of a rank file."""
    with open(path, "rb") as file:
        return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, filter(None, map(bytes.strip, file)))}


def word_encoder(path: str):
    """bytes of one pre-token -> ids; the vocabulary is read once per Python worker, where the driver's path or the job's files have it."""
    if path not in _encoders:
        import tiktoken

        _encoders[path] = tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=read_ranks(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))), special_tokens={})
    encoding = _encoders[path]
    return lambda word: encoding._encode_single_piece(word)


def pre_tokens(text: Column) -> Column:
    """The pre-tokens of a text in order; none for an empty text."""
    return F.regexp_extract_all(text, F.lit(PRE_TOKEN), F.lit(0))


def _texts(documents: DataFrame, text: str, key: str) -> DataFrame:
    """(key, digest, text) of the texts that are not empty, once each; copies are dropped before anything is shuffled."""
    return documents.filter(F.length(text) > 0).select(F.col(key).alias("key"), F.xxhash64(text).alias("digest"), F.col(text).alias("text")).dropDuplicates(["key", "digest"])


def _distinct_words(documents: DataFrame, text: str) -> DataFrame:
    return documents.filter(F.length(text) > 0).select(F.explode(pre_tokens(F.col(text))).alias("word")).distinct()


def encode_words(words: DataFrame, path: str) -> DataFrame:
    """(word, ids) of ``words``, which are distinct. On a cluster the vocabulary travels with the job."""
    context = words.sparkSession.sparkContext
    if not context.master.startswith("local"):
        context.addFile(path)

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = word_encoder(path)
        for batch in batches:
            yield pd.Series([one(word.encode()) for word in batch], dtype=object)

    return words.select("word", encode("word").alias("ids"))


#: A task may hash this much of a dictionary, as written; in memory it is some ten times that.
HASHED_BYTES = 16 * 2**20


def _dictionary(words: DataFrame) -> DataFrame:
    """``words`` written, as the side of a join that its measured size allows: see the module's text."""
    spark, table = words.sparkSession, cut_lineage(words)
    size = written_bytes(table)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Below the session's threshold Spark broadcasts by the measured size; beyond the hashed one it sorts and may spill.
    return table.hint("shuffle_hash") if broadcast_bytes(spark) < size <= HASHED_BYTES * tasks else table


def encode_documents(documents: DataFrame, path: str | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, ids) of each document, without special tokens.

    Null and empty texts give an empty list; blank texts give the ids of their white space. Strings that are special to
    a tokenizer are ordinary text. Rows that repeat both key and text come out once. The ids of one document are one row, so
    a document has to fit in a task; nothing else does.
    """
    path = path or f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
    dictionary = _dictionary(encode_words(_distinct_words(documents, text), path))
    # Where the dictionary is broadcast, texts lie by document when they are cut, and stay there until they are whole again.
    words = _texts(documents, text, key).select("key", "digest", F.posexplode(pre_tokens(F.col("text"))).alias("pos", "word"))
    placed = words.join(dictionary, "word").select("key", "digest", F.struct("pos", "ids").alias("piece"))
    whole = placed.groupBy("key", "digest").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    ids = whole.select(F.col("key").alias(key), F.flatten(F.transform("pieces", lambda p: p["ids"])).alias("ids"))
    empty = documents.filter(F.coalesce(F.length(text), F.lit(0)) == 0).select(key).distinct().select(key, F.array().cast("array<int>").alias("ids"))
    return ids.unionByName(empty)


def token_counts(documents: DataFrame, path: str | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, tokens): the number of ids of each document that has any; needs neither positions nor ids in the shuffle."""
    path = path or f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
    words = documents.filter(F.length(text) > 0).select(F.col(key).alias("key"), F.explode(pre_tokens(F.col(text))).alias("word"))
    sizes = _dictionary(encode_words(_distinct_words(documents, text), path).select("word", F.size("ids").cast("long").alias("n")))
    return words.join(sizes, "word").groupBy("key").agg(F.sum("n").alias("tokens")).withColumnRenamed("key", key)


def token_table(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(id, bytes) of a rank file: fixed by the vocabulary, about 50,000 rows."""
    ranks = read_ranks(path or f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    return spark.createDataFrame([(i, bytearray(word)) for word, i in ranks.items()], "id int, bytes binary")


def decode_documents(encoded: DataFrame, path: str | None = None, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text): the exact inverse of ``encode_documents`` by a join with the table of token bytes.

    Empty lists give an empty text, null lists a null one; an unknown id raises when the text is read.
    """
    table = token_table(encoded.sparkSession, path)
    pieces = encoded.select(F.col(key).alias("key"), F.posexplode(ids).alias("pos", "id"))
    placed = pieces.join(table, "id", "left").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("pos", F.hex(F.coalesce("bytes", F.raise_error(F.lit("unknown token id")))).alias("hex")))).alias("p"))
    text = placed.select(F.col("key").alias(key), F.decode(F.unhex(F.array_join(F.transform("p", lambda x: x["hex"]), "")), "UTF-8").alias("text"))
    rest = encoded.filter(F.coalesce(F.size(ids), F.lit(0)) <= 0).select(key, F.when(F.col(ids).isNotNull(), F.lit("")).alias("text"))
    return text.unionByName(rest)
