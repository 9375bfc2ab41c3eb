"""Sitemaps: urls with dates from index and url-set files, headlines rebuilt from slugs, bulk stamps distrusted."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from movelane.functions.html import headline_from_slug, unescape

#: A file's stamps are distrusted if it has this many and one of them has more than this share.
BULK_STAMPS, BULK_SHARE = 10, 0.5


def trusted_lastmod(urls: DataFrame, file: str = "file", lastmod: str = "lastmod") -> DataFrame:
    """``urls`` with ``trusted``: false where most of a file's urls carry the same stamp."""
    days = urls.filter(F.col(lastmod).isNotNull()).groupBy(file, lastmod).agg(F.count("*").alias("n"))
    files = days.groupBy(file).agg(F.sum("n").alias("n"), F.max("n").alias("top")).select(file, ((F.col("n") < BULK_STAMPS) | (F.col("top") <= BULK_SHARE * F.col("n"))).alias("trusted"))
    return urls.join(files, file, "left").withColumn("trusted", F.coalesce("trusted", F.lit(True)))


def parse_sitemaps(files: DataFrame, text: str = "value", file: str = "file") -> DataFrame:
    """(file, url, lastmod, is_index) of the entries of sitemap files; a file that is no sitemap has none."""
    block = F.explode(F.regexp_extract_all(F.col(text), F.lit(r"(?is)<(?:url|sitemap)\b[^>]*>.*?</(?:url|sitemap)>"), F.lit(0)))
    rows = files.select(F.col(file).alias("file"), block.alias("b"))
    field = lambda tag: unescape(F.trim(F.regexp_extract("b", rf"(?is)<{tag}\b[^>]*>\s*(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?\s*</{tag}>", 1)))
    stamp = F.to_date(F.expr("try_to_timestamp(substring(stamp, 1, 10), 'yyyy-MM-dd')"))
    out = rows.select("file", field("loc").alias("url"), field("lastmod").alias("stamp"), F.col("b").rlike(r"(?i)^<sitemap\b").alias("is_index"))
    return out.filter("url <> ''").select("file", "url", stamp.alias("lastmod"), "is_index")


def read_sitemaps(spark: SparkSession, paths: list[str], include: str | None = None, exclude: str | None = None, child_pattern: str | None = None, max_files: int = 25) -> DataFrame:
    """Items (url, headline, published_on, date_is_estimated, headline_is_derived) of sitemap files.

    Of an index only the children that match ``child_pattern`` and are among ``paths`` are read, ``max_files`` at most.
    A distrusted or missing stamp gives the middle of the year that the url names, else today, as an estimate.
    """
    kept = [p for p in paths if not child_pattern or re.search(child_pattern, p)][:max_files]
    files = spark.read.text(kept, wholetext=True).withColumn("file", F.col("_metadata.file_path"))
    urls = trusted_lastmod(parse_sitemaps(files).filter("not is_index"))
    if include:
        urls = urls.filter(F.col("url").rlike(include))
    if exclude:
        urls = urls.filter(~F.col("url").rlike(exclude))
    date, estimated = publication_date(F.when(F.col("trusted"), F.col("lastmod")), F.col("url"))
    return urls.select("url", headline_from_slug(F.col("url")).alias("headline"), date.alias("published_on"), estimated.alias("date_is_estimated"), F.lit(True).alias("headline_is_derived")).filter("headline is not null").dropDuplicates(["url"])


def publication_date(lastmod: Column, url: Column) -> tuple[Column, Column]:
    """(date, is_estimated): the stamp, else 1 July of the year in the url, else today."""
    year = F.regexp_extract(url, r"/((?:19|20)\d\d)(?:/|-|$)", 1).try_cast("int")
    return F.coalesce(lastmod, F.when(year.isNotNull(), F.make_date(year, F.lit(7), F.lit(1))), F.current_date()), lastmod.isNull()
