"""Article pages to title and body, with a parquet cache of what has been read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from movelane.functions.html import body_of, html_to_text, title_of
from movelane.operators.upkeep import insert_absent
from movelane.session import exists


def parse_articles(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(url, title, body) of article pages; nulls where a page has none."""
    rows = pages.select(F.col(url).alias("url"), title_of(F.col(page)).alias("title"), html_to_text(F.col(page)).alias("text"))
    return rows.select("url", "title", body_of(F.col("text"), F.coalesce("title", F.lit(""))).alias("body"))


class ArticleCache:
    """url -> title and body in a folder; a missing folder counts as empty, a url is parsed once.

    A folder that cannot be read raises: taken for empty, everything in it would be parsed and appended again.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self) -> DataFrame:
        schema = "url string, title string, body string"
        return self.spark.read.schema(schema).parquet(self.folder) if exists(self.spark, self.folder) else self.spark.createDataFrame([], schema)

    def add(self, pages: DataFrame) -> DataFrame:
        """Parses the pages that the cache lacks, appends them, and returns the articles of all given urls."""
        missing = pages.join(self.read().select("url"), "url", "left_anti")
        fresh = insert_absent(self.read(), parse_articles(missing).select("url", "title", "body"), "url", ["title"])
        fresh.write.mode("append").parquet(self.folder)
        return self.read().join(pages.select("url").distinct(), "url", "left_semi")
