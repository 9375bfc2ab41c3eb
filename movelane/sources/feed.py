"""Feeds: RSS and Atom files to items, one file per row, parsed in Arrow batches.

Parsing is per file and needs no shuffle; what follows (dates, windows, one item per url) is columns. Downloading is
left to whatever fills the folder.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from movelane.functions.html import strip_tags, unescape
from movelane.operators.timestamps import normalise_timestamps
from movelane.session import files_of

MAX_SUMMARY = 4000
SCHEMA = "file string, place int, url string, title string, published string, updated string, summary string, error string"


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1].lower()


def parse_feed(text: str) -> list[dict]:
    """Entries of an RSS or Atom document in order; raises ParseError on text that is no XML."""
    entries = []
    for node in ElementTree.fromstring(text).iter():
        if _local(node.tag) not in ("item", "entry"):
            continue
        found: dict = {}
        for child in node:
            name, value = _local(child.tag), "".join(child.itertext()).strip()
            if name == "link":
                value = value or (child.get("href") or "")
                if child.get("rel") in (None, "alternate"):
                    found.setdefault("link", value)
            elif value:
                found.setdefault(name, value)
        entries.append({
            "url": found.get("link") or (found.get("guid") if str(found.get("guid", "")).startswith("http") else None), "title": found.get("title"),
            "published": found.get("pubdate") or found.get("published") or found.get("date"), "updated": found.get("updated"),
            "summary": next((found[k] for k in ("encoded", "content", "summary", "description") if found.get(k)), None),
        })
    return entries


def parse_files(files: DataFrame) -> DataFrame:
    """SCHEMA rows of (file, value); a file that cannot be parsed is one row with its error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        types = [pa.string(), pa.int32()] + [pa.string()] * 6
        for batch in batches:
            rows = []
            for file, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    rows += [(file, i, e["url"], e["title"], e["published"], e["updated"], e["summary"], None) for i, e in enumerate(parse_feed(value or ""))]
                except ElementTree.ParseError as error:
                    rows.append((file, 0, None, None, None, None, None, str(error)))
            columns = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return files.select("file", "value").mapInArrow(run, SCHEMA)


def read_feeds(spark: SparkSession, paths: list[str] | str, since: str | None = None, access: str = "summary", zone: str = "UTC", date_order: str = "DMY", strict: bool = False) -> DataFrame:
    """Items (file, url, headline, published_at, published_at_is_estimated, body_text) of feed files.

    Entries without link or title are skipped, entries published before ``since`` too; the date is the published, else
    the updated one, else the time of reading as an estimate. The body is the first stated content, tags stripped, at
    most MAX_SUMMARY characters; none where ``access`` is headline_only. A url comes once, from the first file. A file that
    is no XML is left out and listed by ``broken_files``; with ``strict`` it raises when it is read.
    """
    files = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    parsed = parse_files(files)
    if strict:
        parsed = parsed.filter(F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("no feed: "), "file", F.lit(": "), "error")).cast("boolean")).otherwise(F.lit(True)))
    rows = parsed.filter("url <> '' and title <> ''").withColumn("stamp", F.coalesce("published", "updated"))
    rows = normalise_timestamps(rows, "stamp", F.lit(zone), F.lit(date_order))
    body = F.when(F.lit(access) != "headline_only", F.substring(strip_tags(unescape(F.col("summary"))), 1, MAX_SUMMARY))
    items = rows.select("file", "place", "url", strip_tags(unescape(F.col("title"))).alias("headline"), F.coalesce(F.timestamp_micros("utc_micros"), F.current_timestamp()).alias("published_at"), F.col("utc_micros").isNull().alias("published_at_is_estimated"), F.when(body != "", body).alias("body_text"))
    if since:
        items = items.filter(F.col("published_at") >= F.lit(since).cast("timestamp"))
    first = items.groupBy("url").agg(F.min_by(F.struct("file", "headline", "published_at", "published_at_is_estimated", "body_text"), F.struct("file", "place")).alias("i"))
    return first.select("i.file", "url", "i.headline", "i.published_at", "i.published_at_is_estimated", "i.body_text")


def broken_files(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(file, error) of the feed files that are no XML."""
    files = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return parse_files(files).filter("error is not null").select("file", "error")


def _full_path(spark: SparkSession, path: str) -> str:
    """``path`` as the files of a scan are named, so that pages of one name in two folders stay two."""
    files, where = files_of(spark, path)
    return re.sub("^file:/+", "file:/", files.makeQualified(where).toString())


def read_pages(spark: SparkSession, pages: list[str], since: str | None = None, max_pages: int = 20, **options) -> DataFrame:
    """Items of the numbered pages of one feed, newest first, up to the page on which the stop rule holds.

    Without ``since`` only the first page. With it, pages are taken in order until one is empty or its newest item is
    older; all are parsed in one job, the rule is applied to the per-page maxima.
    """
    if since is None:
        return read_feeds(spark, pages[:1], None, **options)
    order = spark.createDataFrame([(_full_path(spark, p), i) for i, p in enumerate(pages[:max_pages])], "name string, page int")
    items = read_feeds(spark, pages[:max_pages], None, **options).withColumn("name", F.regexp_replace("file", "^file:/+", "file:/"))
    newest = items.groupBy("name").agg(F.max("published_at").alias("newest"))
    stops = order.join(newest, "name", "left").filter(F.col("newest").isNull() | (F.col("newest") < F.lit(since).cast("timestamp"))).agg(F.coalesce(F.min("page"), F.lit(max_pages)).alias("stop"))
    kept = order.join(F.broadcast(stops), F.col("page") < F.col("stop")).select("name")
    return items.join(kept, "name", "left_semi").drop("name").filter(F.col("published_at") >= F.lit(since).cast("timestamp"))
