"""The same ingest as a stream: items once per url, gated, late ones within two weeks, and runs of empty batches.

State is bounded by the watermark; what comes later than that is caught by the sink, which appends only urls that it
lacks, so a replayed batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from movelane.operators.gate import language_gate
from movelane.operators.upkeep import insert_absent
from movelane.session import exists

LATENESS = "14 days"
STREAK_STATE, STREAK_ROWS = "streak int", "source string, at timestamp, streak int"


def once_per_url(items: DataFrame, at: str = "published_at", lateness: str = LATENESS) -> DataFrame:
    """The first item of each url within the watermark."""
    return items.withWatermark(at, lateness).dropDuplicatesWithinWatermark(["url"])


def gated(items: DataFrame) -> DataFrame:
    """``items`` with passed and reason of the language gate; native columns, so it runs inside the scan's stage."""
    g = language_gate(F.col("headline"), F.col("body_text"), F.col("tier"))
    return items.withColumn("_g", g).select(*items.columns, F.col("_g.passed").alias("passed"), F.col("_g.reason").alias("reason"))


def counts_per_window(items: DataFrame, at: str, window: str, *keys: str, lateness: str = LATENESS) -> DataFrame:
    """Items per tumbling window and keys, emitted when the watermark has passed the window."""
    return items.withWatermark(at, lateness).groupBy(F.window(at, window), *keys).agg(F.count("*").alias("items"))


def open_counts(items: DataFrame, at: str, window: str, *keys: str) -> DataFrame:
    """Items per tumbling window and keys so far, open windows too: to be written in update mode and merged.

    No row is too late, so the state grows with the windows and keys, not with the rows.
    """
    return items.groupBy(F.window(at, window), *keys).agg(F.count("*").alias("items"))


def upsert_into(spark: SparkSession, folder: str, keys: list[str]):
    """A foreachBatch sink that keeps the newest row per ``keys``; each batch writes the whole table anew under its number.

    A batch starts from the newest table before its number, so running it again gives the same table. ``latest`` finds it.
    """

    def write(batch: DataFrame, number: int) -> None:
        before = latest(spark, folder, number)
        if before is None:
            merged = batch
        else:
            held = spark.read.schema(batch.schema).parquet(before)
            same = [held[k].eqNullSafe(batch[k]) for k in keys]
            merged = held.join(batch, same, "left_anti").unionByName(batch)
        merged.write.mode("overwrite").parquet(f"{folder}/{number}")

    return write


def latest(spark: SparkSession, folder: str, before: int = 2**62) -> str | None:
    """The folder of the newest complete table that ``upsert_into`` has written, null if there is none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return None
    done = [int(n) for n in (f.getPath().getName() for f in files.listStatus(path)) if n.isdigit() and int(n) < before and files.exists(path.suffix(f"/{n}/_SUCCESS"))]
    return f"{folder}/{max(done)}" if done else None


def empty_streaks(polls: DataFrame) -> DataFrame:
    """(source, at, streak) per poll (source, at, new_items): how many polls in a row have brought nothing."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        streak = state.get[0] if state.exists else 0
        rows = pd.concat(list(batches)).sort_values("at")
        out = []
        for at, n in zip(rows["at"], rows["new_items"]):
            streak = 0 if n > 0 else streak + 1
            out.append((key[0], at, streak))
        state.update((streak,))
        yield pd.DataFrame(out, columns=["source", "at", "streak"])

    return polls.groupBy("source").applyInPandasWithState(step, STREAK_ROWS, STREAK_STATE, "append", GroupStateTimeout.NoTimeout)


def store(spark: SparkSession, folder: str):
    """A foreachBatch sink that appends the rows whose url the folder lacks; running a batch again appends nothing."""

    def write(batch: DataFrame, number: int) -> None:
        held = spark.read.parquet(folder).select("url") if exists(spark, f"{folder}/_SUCCESS") else spark.createDataFrame([], "url string")
        insert_absent(held, batch, "url", [c for c in batch.columns if c != "url"][:1]).write.mode("append").parquet(folder)

    return write
