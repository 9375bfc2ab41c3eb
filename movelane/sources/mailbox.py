"""Exported messages to items: the links of newsletters from listed senders."""

from __future__ import annotations

import email
import email.policy
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from movelane.functions.html import strip_tags, strip_tracking, unescape

_ANCHOR = re.compile(r"<a\b[^>]*?href=[\"']([^\"']+)[\"'][^>]*>(.*?)</a>", re.IGNORECASE | re.DOTALL)
#: Housekeeping links of newsletters.
SKIPPED = r"(?i)unsubscribe|preferences|privacy|view[-_ ]?(?:in[-_ ]?browser|online)|mailto:|facebook\.com|twitter\.com|linkedin\.com|/login|/account"
MIN_WORDS = 4
SCHEMA = "sender string, sent string, url string, anchor string"


def parse_message(raw: bytes) -> list[tuple]:
    """(sender, date header, url, anchor text) of every link of a message."""
    message = email.message_from_bytes(raw, policy=email.policy.default)
    part = message.get_body(("html", "plain"))
    text = part.get_content() if part else ""
    sender = email.utils.parseaddr(str(message.get("From", "")))[1].lower()
    return [(sender, str(message.get("Date", "")), url, anchor) for url, anchor in _ANCHOR.findall(text)]


def read_mailbox(spark: SparkSession, path: str, senders: list[str], url_pattern: str | None = None) -> DataFrame:
    """Items (url, headline, published_at, published_at_is_estimated) of the messages under ``path`` from ``senders``.

    A sender is an address or a domain; without any, nothing is read. Anchors need MIN_WORDS words; tracking parameters
    are stripped; the date is the sending date, an estimate. A url comes once, with its earliest date.
    """
    if not senders:
        raise ValueError("a mailbox is read only for listed senders")
    from movelane.operators.timestamps import normalise_timestamps

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row for raw in batch.column(0).to_pylist() for row in parse_message(raw or b"")]
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], [f.split()[0] for f in SCHEMA.split(", ")])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.eml").option("recursiveFileLookup", "true").load(path)
    links = files.select("content").mapInArrow(run, SCHEMA)
    listed = F.col("sender").isin([s.lower() for s in senders]) | F.substring_index("sender", "@", -1).isin([s.lower() for s in senders])
    rows = links.filter(listed & ~F.col("url").rlike(SKIPPED)).select("sent", strip_tracking(unescape(F.col("url"))).alias("url"), unescape(strip_tags(F.col("anchor"))).alias("headline"))
    rows = rows.filter(F.size(F.split("headline", " ")) >= MIN_WORDS)
    if url_pattern:
        rows = rows.filter(F.col("url").rlike(url_pattern))
    rows = normalise_timestamps(rows, "sent", F.lit("UTC"), F.lit("DMY"))
    first = rows.groupBy("url").agg(F.min_by(F.struct("headline", "utc_micros"), F.struct(F.coalesce("utc_micros", F.lit(2**62)), "headline")).alias("i"))
    return first.select("url", "i.headline", F.timestamp_micros("i.utc_micros").alias("published_at"), F.lit(True).alias("published_at_is_estimated"))
