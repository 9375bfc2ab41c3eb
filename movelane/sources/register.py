"""The source register: validated when it is loaded, so that a broken entry stops a run before it starts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from movelane.operators import integrity

ADAPTERS = ["feed", "paginated_feed", "sitemap", "imap"]


def register_problems(sources: DataFrame) -> DataFrame:
    """(rule, id): unknown adapters, tiers outside 1 to 3, missing feed urls, tier 1 without a firm, repeated versions."""
    flat = sources.select("register_version", "config.*")
    rules = {
        "known_adapter": F.col("adapter").isin(ADAPTERS),
        "tier_in_range": F.col("reliability_tier").between(1, 3),
        "feed_has_url": ~F.col("adapter").isin("feed", "paginated_feed") | F.col("feed_url").isNotNull(),
        "tier_one_has_firm": (F.col("reliability_tier") != 1) | F.col("firm_name").isNotNull(),
        "named": F.coalesce(F.trim("slug") != "", F.lit(False)),
    }
    return integrity.violations(flat, "slug", rules).unionByName(integrity.duplicates(flat, ["slug", "register_version"], "one_entry_per_version"))


def load_register(sources: DataFrame) -> DataFrame:
    """The highest version of each slug; raises with the first problems if there are any."""
    problems = register_problems(sources).limit(20).collect()
    if problems:
        raise ValueError("source register: " + ", ".join(f"{p.rule} ({p.id})" for p in problems))
    return sources.groupBy(F.col("config.slug").alias("slug")).agg(F.max_by("config", "register_version").alias("config"))


def write_report(rows: DataFrame, folder: str, **header: str) -> None:
    """Rows and run header as JSON lines, for runs without a store."""
    extra = [F.lit(v).alias(k) for k, v in header.items()]
    rows.select("*", *extra).write.mode("overwrite").json(folder)
