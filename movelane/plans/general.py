"""Queries of the general operators that this repository adds to the reference's, and their SQL."""

from __future__ import annotations

from movelane.operators import changes, timestamps
from movelane.session import table


def p1_found(spark, root):
    return timestamps.normalised_instants(table(spark, root, "sources"), table(spark, root, "raw_items"), table(spark, root, "fetches"))


def p5_found(spark, root):
    return changes.ingested_by_run(table(spark, root, "raw_items"), table(spark, root, "pipeline_runs"))


QUERIES = {f.__name__: f for f in (p1_found, p5_found)}
SQL = {
    "p5_found": """
        WITH last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY logged_at DESC NULLS LAST) AS n FROM pipeline_runs) WHERE n = 1),
        runs AS (SELECT run_id, campaign_id, started_at, lag(started_at) OVER (PARTITION BY campaign_id ORDER BY started_at, run_id) AS after
                 FROM last WHERE stage = 'ingest' AND status = 'succeeded'),
        items AS (SELECT item_id, campaign_id, arrived_at, content_hash, lag(content_hash) OVER w AS before, row_number() OVER w AS n
                  FROM raw_items WINDOW w AS (PARTITION BY campaign_id, url ORDER BY arrived_at, item_id))
        SELECT r.run_id, i.item_id FROM runs r JOIN items i ON i.campaign_id = r.campaign_id
        WHERE i.arrived_at <= r.started_at AND (r.after IS NULL OR i.arrived_at > r.after) AND (i.n = 1 OR i.content_hash IS DISTINCT FROM i.before)""",
}
