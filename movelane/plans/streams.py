"""Streaming queries run to the end of what is there, so that their rows can be compared."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from movelane.plans.registry import Registry
from movelane.session import shared_folder, table
from movelane.streaming import ingest

query = Registry()


def _all_of(spark, root: str, name: str):
    """The table as a stream of its files, whether it is one file or a folder of them."""
    jvm, path = spark.sparkContext._jvm, f"{root}/{name}.parquet"
    at = jvm.org.apache.hadoop.fs.Path(path)
    single = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isFile()
    reader = spark.readStream.schema(table(spark, root, name).schema)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(root) if single else reader.parquet(path)


def _run(spark, stream, mode: str = "append"):
    """Runs a stream over what is there into a folder all executors share, and reads that."""
    folder = f"{shared_folder(spark)}/streams/{uuid.uuid4().hex}"
    stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


@query("SELECT DISTINCT url FROM raw_items")
def stream_once_per_url(spark, root):
    rows = _all_of(spark, root, "raw_items").select("url", F.col("arrived_at").alias("published_at"))
    return _run(spark, ingest.once_per_url(rows, lateness="4000 days").select("url"))


@query("SELECT item_id FROM raw_items WHERE access_level = 'summary'")
def stream_filter(spark, root):
    return _run(spark, _all_of(spark, root, "raw_items").filter("access_level = 'summary'").select("item_id"))


@query()
def stream_gate(spark, root):
    rows = _all_of(spark, root, "raw_items").select("item_id", "headline", "body_text", F.lit(None).cast("int").alias("tier"))
    return _run(spark, ingest.gated(rows).select("item_id", "passed", "reason"))


@query()
def stream_windows(spark, root):
    # Windows that the watermark hasn't passed are emitted too, so counts are updated at the sink, not appended once.
    rows = _all_of(spark, root, "raw_items").select("source_slug", "arrived_at")
    counts = ingest.open_counts(rows, "arrived_at", "7 days", "source_slug").select("window.start", "source_slug", "items")
    folder = f"{shared_folder(spark)}/streams/{uuid.uuid4().hex}"
    sink = ingest.upsert_into(spark, f"{folder}/out", ["start", "source_slug"])
    counts.writeStream.foreachBatch(sink).option("checkpointLocation", f"{folder}/state").outputMode("update").trigger(availableNow=True).start().awaitTermination()
    found = ingest.latest(spark, f"{folder}/out")
    return spark.read.schema(counts.schema).parquet(found) if found else spark.createDataFrame([], counts.schema)


QUERIES, SQL = query.queries, query.sql
