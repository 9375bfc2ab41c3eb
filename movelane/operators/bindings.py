"""The engine's entities derived from the domain tables, as DataFrames and as SQL for the checks.

A move is a row of extracted_moves with its fields as columns; a value that only says it is missing is null. A source
is the highest registered version of its slug. Items, firms and runs are the tables themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from movelane.session import table

# Field texts that state nothing, trimmed and in lower case.
UNSTATED = ["", "-", "n/a", "not stated", "none given", "unknown", "undisclosed", "tbc"]
FIELDS = {
    "from_firm": "from_firm", "title_to": "title_to", "practice_text": "practice_text", "office": "office_jurisdiction",
    "move_type": "move_type", "partner_tier": "partner_tier",
}
_LIST = ", ".join(f"'{x}'" for x in UNSTATED)

SOURCES_SQL = """src AS (
    SELECT slug, tier, active, blocked_reason, hours, access_type, feed_url, firm_name, adapter, base_url, focus FROM (
        SELECT config.slug AS slug, config.reliability_tier AS tier, config.active AS active, blocked_reason, config.poll_interval_hours AS hours,
               config.access_type AS access_type, config.feed_url AS feed_url, config.firm_name AS firm_name, config.adapter AS adapter, config.base_url AS base_url,
               config.jurisdiction_focus AS focus, row_number() OVER (PARTITION BY config.slug ORDER BY register_version DESC) AS n FROM sources) WHERE n = 1)"""
MOVES_SQL = (
    "mv AS (SELECT move_id, item_id, source_slug, person_name, to_firm_id, announced_date, extracted_at, extractor_version, group_ref, CAST(len(dropped) AS INTEGER) AS n_dropped, "
    "CASE WHEN self_confidence > 1 THEN self_confidence / 100 ELSE self_confidence END AS confidence, "
    + ", ".join(f"CASE WHEN lower(trim(fields['{key}'].value)) IN ({_LIST}) THEN NULL ELSE trim(fields['{key}'].value) END AS {name}" for name, key in FIELDS.items())
    + " FROM extracted_moves)"
)
RUNS_SQL = "run AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY logged_at DESC) AS n FROM pipeline_runs) WHERE n = 1)"


def stated(value: Column) -> Column:
    """The trimmed value, or null if it states nothing."""
    text = F.trim(value)
    return F.when(~F.lower(text).isin(UNSTATED), text)


def moves(spark, root: str) -> DataFrame:
    rows = table(spark, root, "extracted_moves")
    confidence = F.when(F.col("self_confidence") > 1, F.col("self_confidence") / 100).otherwise(F.col("self_confidence"))
    return rows.select(
        "move_id", "item_id", "source_slug", "person_name", "to_firm_id", "announced_date", "extracted_at", "extractor_version", "group_ref",
        F.size("dropped").alias("n_dropped"), confidence.alias("confidence"), *[stated(F.col("fields")[key]["value"]).alias(name) for name, key in FIELDS.items()],
    )


def sources(spark, root: str) -> DataFrame:
    rows = table(spark, root, "sources").filter("config.slug is not null")
    best = F.max_by(F.struct("config", "blocked_reason"), F.col("register_version"))
    return rows.groupBy(F.col("config.slug").alias("slug")).agg(best.alias("r")).select(
        "slug", F.col("r.config.reliability_tier").alias("tier"), F.col("r.config.active").alias("active"), "r.blocked_reason", F.col("r.config.poll_interval_hours").alias("hours"),
        "r.config.access_type", "r.config.feed_url", "r.config.firm_name", "r.config.adapter", "r.config.base_url", F.col("r.config.jurisdiction_focus").alias("focus"),
    )


def runs(spark, root: str) -> DataFrame:
    rows = table(spark, root, "pipeline_runs")
    rest = [c for c in rows.columns if c not in ("run_id", "logged_at")]
    return rows.groupBy("run_id").agg(F.max_by(F.struct(*rest, "logged_at"), F.col("logged_at")).alias("r")).select("run_id", "r.*")


def with_sql(*parts: str) -> str:
    """WITH clause of the given named queries."""
    return "WITH " + ", ".join(parts) + " "
