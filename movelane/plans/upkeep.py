"""Sinks, scans for work, integrity and maintenance over the domain tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from movelane.operators import bindings, integrity, upkeep
from movelane.operators.bindings import MOVES_SQL, RUNS_SQL, SOURCES_SQL, with_sql
from movelane.plans.registry import Registry
from movelane.session import table

query = Registry()

NOW = "TIMESTAMP '2026-04-05 00:00:00'"


def now():
    return F.lit("2026-04-05 00:00:00").cast("timestamp")


@query("SELECT url, CAST(lastmod AS DATE) AS lastmod, trusted FROM (SELECT i.url, i.arrived_at AS lastmod, b.n < 10 OR b.top * 2 <= b.n AS trusted FROM raw_items i JOIN (SELECT source_slug, CAST(sum(n) AS BIGINT) AS n, max(n) AS top FROM (SELECT source_slug, CAST(arrived_at AS DATE) AS d, count(*) AS n FROM raw_items GROUP BY ALL) GROUP BY source_slug) b ON b.source_slug = i.source_slug)")
def s04_bulk_lastmod(spark, root):
    from movelane.sources.sitemap import trusted_lastmod

    rows = table(spark, root, "raw_items").select("url", F.col("source_slug").alias("file"), F.to_date("arrived_at").alias("lastmod"))
    return trusted_lastmod(rows).select("url", "lastmod", "trusted")


@query(with_sql(SOURCES_SQL, "lp AS (SELECT source_slug AS slug, max(arrived_at) AS last_at FROM raw_items GROUP BY 1)") + f"SELECT src.slug, lp.last_at FROM src LEFT JOIN lp ON lp.slug = src.slug WHERE src.active AND (lp.last_at IS NULL OR epoch(lp.last_at) + src.hours * 3600 <= epoch({NOW}))")
def s10_due_sources(spark, root):
    last = table(spark, root, "raw_items").groupBy(F.col("source_slug").alias("slug")).agg(F.max("arrived_at").alias("last_at"))
    return upkeep.due(bindings.sources(spark, root), last, now())


@query("SELECT item_id, arrived_at FROM raw_items i WHERE body_text IS NOT NULL AND NOT EXISTS (SELECT 1 FROM extracted_moves m WHERE m.item_id = i.item_id) ORDER BY arrived_at DESC, item_id LIMIT 100")
def s11_pending_items(spark, root):
    rows = table(spark, root, "raw_items").filter("body_text is not null").select("item_id", "arrived_at").join(table(spark, root, "extracted_moves").select("item_id"), "item_id", "left_anti")
    return rows.orderBy(F.desc("arrived_at"), "item_id").limit(100)


_CUT = "TIMESTAMP '2025-06-01 00:00:00'"


@query(f"SELECT url, min_by(item_id, {{'a': arrived_at, 'i': item_id}}) AS item_id FROM raw_items WHERE arrived_at >= {_CUT} AND url NOT IN (SELECT url FROM raw_items WHERE arrived_at < {_CUT}) GROUP BY url")
def k01_insert_absent(spark, root):
    rows = table(spark, root, "raw_items").select("url", "item_id", "arrived_at")
    early = F.col("arrived_at") < F.lit("2025-06-01 00:00:00").cast("timestamp")
    return upkeep.insert_absent(rows.filter(early), rows.filter(~early), "url", ["arrived_at", "item_id"]).select("url", "item_id")


@query("SELECT coalesce(a.slug, b.slug) AS slug, CASE WHEN b.slug IS NOT NULL THEN b.tier ELSE a.tier END AS tier, coalesce(a.firm_name, b.firm_name) AS firm_name FROM (SELECT config.slug AS slug, config.reliability_tier AS tier, config.firm_name AS firm_name FROM sources WHERE register_version = 1) a FULL JOIN (SELECT config.slug AS slug, config.reliability_tier AS tier, config.firm_name AS firm_name FROM sources WHERE register_version = 2) b ON a.slug = b.slug")
def k02_upsert(spark, root):
    rows = table(spark, root, "sources").select("register_version", F.col("config.slug").alias("slug"), F.col("config.reliability_tier").alias("tier"), F.col("config.firm_name").alias("firm_name"))
    return upkeep.upsert(rows.filter("register_version = 1"), rows.filter("register_version = 2"), "slug", ["tier"], ["firm_name"])


@query("SELECT a.config.slug AS slug, a.config.active AND b.slug IS NOT NULL AS active FROM sources a LEFT JOIN (SELECT DISTINCT config.slug AS slug FROM sources WHERE register_version >= 2) b ON b.slug = a.config.slug WHERE a.register_version = 1")
def k03_deactivate_missing(spark, root):
    rows = table(spark, root, "sources").select("register_version", F.col("config.slug").alias("slug"), F.col("config.active").alias("active"))
    return upkeep.deactivate_missing(rows.filter("register_version = 1").select("slug", "active"), rows.filter("register_version >= 2"), "slug")


@query(with_sql(RUNS_SQL) + "SELECT run_id, campaign_id, stage, status, items_fetched, errors FROM run")
def k05_run_ledger(spark, root):
    return bindings.runs(spark, root).select("run_id", "campaign_id", "stage", "status", "items_fetched", "errors")


_MOVE_RULES = {
    "promotion_within_one_firm": "NOT (move_type = 'promotion' AND from_firm IS NOT NULL) OR lower(from_firm) = lower(to_firm)",
    "destination_required": "to_firm IS NOT NULL OR move_type = 'retirement'",
    "same_firm_only_for_promotion": "from_firm IS NULL OR to_firm IS NULL OR lower(from_firm) <> lower(to_firm) OR move_type = 'promotion'",
    "plausible_date": "announced_date BETWEEN DATE '1990-01-01' AND DATE '2100-12-31'",
    "confidence_is_a_fraction": "self_confidence BETWEEN 0 AND 1",
    "in_house_leaves_a_firm": "NOT (move_type = 'in_house_exit' AND from_firm IS NULL)",
    "known_move_type": "move_type IN ('lateral', 'promotion', 'in_house_exit', 'firm_launch', 'merger_absorbed', 'retirement')",
}
_RULE_ROWS = "mr AS (SELECT m.move_id, m.announced_date, m.self_confidence, nullif(trim(m.fields['from_firm'].value), '') AS from_firm, nullif(trim(m.fields['to_firm'].value), '') AS to_firm, m.fields['move_type'].value AS move_type FROM extracted_moves m)"


@query(with_sql(_RULE_ROWS) + " UNION ALL ".join(f"SELECT '{name}' AS rule, CAST(move_id AS VARCHAR) AS id FROM mr WHERE NOT ({rule})" for name, rule in _MOVE_RULES.items()))
def i01_move_rules(spark, root):
    text = lambda f: F.when(F.trim(F.col("fields")[f]["value"]) != "", F.trim(F.col("fields")[f]["value"]))
    rows = table(spark, root, "extracted_moves").select("move_id", "announced_date", "self_confidence", text("from_firm").alias("from_firm"), text("to_firm").alias("to_firm"), F.col("fields")["move_type"]["value"].alias("move_type"))
    return integrity.violations(rows, "move_id", {name: F.expr(rule) for name, rule in _MOVE_RULES.items()})


_SPAN_RULE = "f.value.span_end > f.value.span_start AND len(string_split(trim(f.value.value), ' ')) <= 25"


@query(f"SELECT 'span_and_excerpt' AS rule, move_id || ':' || f.key AS id FROM (SELECT move_id, unnest(map_entries(fields)) AS f FROM extracted_moves) WHERE NOT ({_SPAN_RULE})")
def i11_evidence_rules(spark, root):
    rows = table(spark, root, "extracted_moves").select("move_id", F.explode("fields").alias("key", "f")).select(F.concat_ws(":", F.col("move_id").cast("string"), "key").alias("id"), "f.*")
    return integrity.violations(rows, "id", {"span_and_excerpt": (F.col("span_end") > F.col("span_start")) & (F.size(F.split(F.trim("value"), " ")) <= 25)})


_SOURCE_RULES = {
    "feed_needs_a_url": "access_type <> 'feed' OR feed_url IS NOT NULL",
    "poll_interval_floor": "hours >= 1",
    "tier_one_is_a_firm": "tier <> 1 OR firm_name IS NOT NULL",
    "blocked_is_inactive": "blocked_reason IS NULL OR NOT active",
}


@query(with_sql(SOURCES_SQL) + " UNION ALL ".join(f"SELECT '{name}' AS rule, slug AS id FROM src WHERE NOT ({rule})" for name, rule in _SOURCE_RULES.items()))
def i13_source_rules(spark, root):
    return integrity.violations(bindings.sources(spark, root), "slug", {name: F.expr(rule) for name, rule in _SOURCE_RULES.items()})


@query(with_sql(SOURCES_SQL) + "SELECT 'known_jurisdiction' AS rule, slug AS id FROM (SELECT slug, unnest(focus) AS code FROM src) WHERE code NOT IN (SELECT hq_jurisdiction FROM firms WHERE hq_jurisdiction IS NOT NULL)")
def i15_known_jurisdictions(spark, root):
    rows = bindings.sources(spark, root).select("slug", F.explode("focus").alias("code"))
    return integrity.dangling(rows, "slug", "code", table(spark, root, "firms").filter("hq_jurisdiction is not null"), "hq_jurisdiction", "known_jurisdiction")


_RUN_RULES = {
    "finished_after_start": "finished_at >= started_at",
    "running_is_unfinished": "status <> 'running' OR finished_at IS NULL",
    "done_is_finished": "status NOT IN ('succeeded', 'failed') OR finished_at IS NOT NULL",
    "unchanged_within_fetched": "items_unchanged <= items_fetched",
}


@query(with_sql(RUNS_SQL) + " UNION ALL ".join(f"SELECT '{name}' AS rule, run_id AS id FROM run WHERE NOT ({rule})" for name, rule in _RUN_RULES.items()))
def i18_run_rules(spark, root):
    return integrity.violations(bindings.runs(spark, root), "run_id", {name: F.expr(rule) for name, rule in _RUN_RULES.items()})


@query("SELECT 'unique_url' AS rule, url AS id FROM raw_items GROUP BY url HAVING count(*) > 1 UNION ALL SELECT 'unique_slug', config.slug FROM sources GROUP BY 2 HAVING count(*) > 1 UNION ALL SELECT 'move_has_item', CAST(move_id AS VARCHAR) FROM extracted_moves WHERE item_id NOT IN (SELECT item_id FROM raw_items) UNION ALL SELECT 'move_has_source', CAST(move_id AS VARCHAR) FROM extracted_moves WHERE source_slug IS NOT NULL AND source_slug NOT IN (SELECT config.slug FROM sources)")
def i20_keys(spark, root):
    items, sources, moves = table(spark, root, "raw_items"), table(spark, root, "sources").select(F.col("config.slug").alias("slug")), table(spark, root, "extracted_moves")
    parts = [
        integrity.duplicates(items.select("url"), ["url"], "unique_url"), integrity.duplicates(sources, ["slug"], "unique_slug"),
        integrity.dangling(moves.select("move_id", "item_id"), "move_id", "item_id", items, "item_id", "move_has_item"), integrity.dangling(moves.select("move_id", "source_slug"), "move_id", "source_slug", sources, "slug", "move_has_source"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


_QUEUE_SQL = "qu AS (SELECT left_move_id || '-' || right_move_id || '-' || coalesce(CAST(epoch_us(scored_at) AS VARCHAR), '') AS id, left_move_id AS move_id, right_move_id AS related_move_id, CASE WHEN lower(trim(decision)) = 'ambiguous' THEN 'dedupe_ambiguous' ELSE 'other' END AS reason, CASE WHEN lower(trim(decision)) IN ('merge', 'distinct') THEN scored_at END AS resolved_at, CASE WHEN lower(trim(decision)) IN ('merge', 'distinct') THEN decision END AS resolution, CASE WHEN total IS NOT NULL AND lower(trim(decision)) IN ('merge', 'distinct') THEN 'rules' END AS resolver FROM pair_scores)"


@query(with_sql(_QUEUE_SQL) + "SELECT 'resolution_is_complete' AS rule, id FROM qu WHERE NOT ((resolved_at IS NULL) = (resolution IS NULL) AND (resolution IS NULL) = (resolver IS NULL)) UNION ALL SELECT 'pair_has_counterpart', id FROM qu WHERE reason = 'dedupe_ambiguous' AND related_move_id IS NULL UNION ALL SELECT 'not_self_paired', id FROM qu WHERE related_move_id = move_id")
def i17_queue_items(spark, root):
    """Scored pairs as review items: decided ones are resolved, by the rules where they have a total."""
    decided = F.lower(F.trim("decision")).isin("merge", "distinct")
    queue = table(spark, root, "pair_scores").select(
        F.concat_ws("-", F.col("left_move_id").cast("string"), F.col("right_move_id").cast("string"), F.coalesce(F.unix_micros("scored_at").cast("string"), F.lit(""))).alias("id"), F.col("left_move_id").alias("move_id"), F.col("right_move_id").alias("related_move_id"),
        F.when(F.lower(F.trim("decision")) == "ambiguous", "dedupe_ambiguous").otherwise("other").alias("reason"), F.when(decided, F.col("scored_at")).alias("resolved_at"), F.when(decided, F.col("decision")).alias("resolution"), F.when(decided & F.col("total").isNotNull(), "rules").alias("resolver"),
    )
    return integrity.queue_items(queue)


# A practice that is stated classifies a move; each of its role clauses assigns one group, the first of them the primary.
_STATE_SQL = (
    "st AS (SELECT move_id, CASE WHEN practice_text IS NOT NULL THEN 'classified' ELSE 'pending' END AS state, extractor_version AS version, coalesce(group_ref IS NOT NULL AND extracted_at < max(extracted_at) OVER (PARTITION BY group_ref), false) AS superseded, coalesce(confidence < 0.35, false) AS rejected FROM mv), "
    "ag AS (SELECT r.move_id, row_number() OVER (PARTITION BY r.move_id ORDER BY role_id) = 1 AS is_primary, CASE WHEN title IS NULL THEN 'none' ELSE mv.extractor_version END AS version FROM role_parts r JOIN mv ON mv.move_id = r.move_id WHERE trim(practice) <> ''), "
    "lk AS (SELECT move_id, true AS is_primary FROM mv WHERE source_slug IS NOT NULL UNION ALL SELECT mv.move_id, i.source_slug <> mv.source_slug FROM mv JOIN raw_items i ON i.item_id = mv.item_id WHERE mv.source_slug IS NOT NULL AND i.source_slug IS NOT NULL), "
    "tm AS (SELECT group_ref AS team_id, min_by(to_firm_id, move_id) AS to_firm, min_by(from_firm, move_id) AS from_firm, min(announced_date) AS window_start, min(announced_date) + 60 AS window_end, count(DISTINCT person_name) AS partner_count FROM mv WHERE group_ref IS NOT NULL GROUP BY group_ref)"
)


def states(spark, root):
    """(moves, assignments, links, teams): the tables of the rules, from the domain tables as in ``_STATE_SQL``."""
    rows = bindings.moves(spark, root)
    last = rows.groupBy("group_ref").agg(F.max("extracted_at").alias("last"))
    moves = rows.join(last, "group_ref", "left").select("move_id", F.when(F.col("practice_text").isNotNull(), "classified").otherwise("pending").alias("state"), F.col("extractor_version").alias("version"), F.coalesce(F.col("extracted_at") < F.col("last"), F.lit(False)).alias("superseded"), F.coalesce(F.col("confidence") < 0.35, F.lit(False)).alias("rejected"), "group_ref", "to_firm_id", "from_firm", "announced_date")
    first = F.row_number().over(Window.partitionBy("move_id").orderBy("role_id")) == 1
    roles = table(spark, root, "role_parts").filter(F.trim("practice") != "").select("move_id", "role_id", "title").join(rows.select("move_id", "extractor_version"), "move_id")
    assignments = roles.select("move_id", first.alias("is_primary"), F.when(F.col("title").isNull(), "none").otherwise(F.col("extractor_version")).alias("version"))
    own = rows.filter("source_slug is not null").select("move_id", "item_id", "source_slug")
    items = table(spark, root, "raw_items").filter("source_slug is not null").select("item_id", F.col("source_slug").alias("other"))
    links = own.select("move_id", F.lit(True).alias("is_primary")).unionByName(own.join(items, "item_id").select("move_id", (F.col("other") != F.col("source_slug")).alias("is_primary")))
    teams = rows.filter("group_ref is not null").groupBy(F.col("group_ref").alias("team_id")).agg(
        F.min_by("to_firm_id", F.when(F.col("to_firm_id").isNotNull(), F.col("move_id"))).alias("to_firm"), F.min_by("from_firm", F.when(F.col("from_firm").isNotNull(), F.col("move_id"))).alias("from_firm"), F.min("announced_date").alias("window_start"), F.date_add(F.min("announced_date"), 60).alias("window_end"), F.count_distinct("person_name").alias("partner_count"),
    )
    return moves, assignments, links, teams


@query(
    with_sql(MOVES_SQL, _STATE_SQL)
    + ", ct AS (SELECT st.move_id, count(*) FILTER (WHERE ag.is_primary) AS p, count(*) FILTER (WHERE NOT ag.is_primary) AS s, count(*) FILTER (WHERE ag.version IS DISTINCT FROM st.version AND ag.move_id IS NOT NULL) AS w FROM st LEFT JOIN ag ON ag.move_id = st.move_id WHERE st.state = 'classified' GROUP BY st.move_id) "
    "SELECT 'exactly_one_primary' AS rule, CAST(move_id AS VARCHAR) AS id FROM ct WHERE p <> 1 UNION ALL SELECT 'few_secondary', CAST(move_id AS VARCHAR) FROM ct WHERE s > 2 UNION ALL SELECT 'one_version', CAST(move_id AS VARCHAR) FROM ct WHERE w > 0"
)
def i07_classification(spark, root):
    moves, assignments, *_ = states(spark, root)
    return integrity.classification(moves, assignments)


@query(
    with_sql(MOVES_SQL, _STATE_SQL)
    + "SELECT 'same_destination' AS rule, CAST(mv.move_id AS VARCHAR) AS id FROM mv JOIN tm ON tm.team_id = mv.group_ref WHERE mv.to_firm_id IS DISTINCT FROM tm.to_firm UNION ALL SELECT 'same_origin', CAST(mv.move_id AS VARCHAR) FROM mv JOIN tm ON tm.team_id = mv.group_ref WHERE tm.from_firm IS NOT NULL AND mv.from_firm IS DISTINCT FROM tm.from_firm "
    "UNION ALL SELECT 'inside_window', CAST(mv.move_id AS VARCHAR) FROM mv JOIN tm ON tm.team_id = mv.group_ref WHERE NOT mv.announced_date BETWEEN tm.window_start AND tm.window_end "
    "UNION ALL SELECT 'count_is_kept', CAST(tm.team_id AS VARCHAR) FROM tm LEFT JOIN (SELECT mv.group_ref, count(*) AS n FROM mv JOIN st ON st.move_id = mv.move_id WHERE NOT st.superseded GROUP BY 1) c ON c.group_ref = tm.team_id WHERE tm.partner_count <> coalesce(c.n, 0)"
)
def i09_team_membership(spark, root):
    """Groups of moves as teams, their first move as what the others have to fit."""
    moves, _, _, teams = states(spark, root)
    return integrity.team_membership(moves.withColumnRenamed("group_ref", "team_id").withColumnRenamed("to_firm_id", "to_firm"), teams)


@query(
    with_sql(MOVES_SQL, _STATE_SQL)
    + "SELECT 'classified_without_primary' AS rule, CAST(move_id AS VARCHAR) AS id FROM st WHERE state = 'classified' AND move_id NOT IN (SELECT move_id FROM ag WHERE is_primary) UNION ALL SELECT 'several_primary_sources', CAST(move_id AS VARCHAR) FROM lk GROUP BY move_id HAVING count(*) FILTER (WHERE is_primary) > 1 "
    "UNION ALL SELECT 'canonical_without_source', CAST(move_id AS VARCHAR) FROM st WHERE NOT superseded AND NOT rejected AND move_id NOT IN (SELECT move_id FROM lk) UNION ALL SELECT 'team_of_fewer_than_two', CAST(team_id AS VARCHAR) FROM tm WHERE partner_count < 2"
)
def v05_monitored(spark, root):
    return integrity.monitored(*states(spark, root))


@query(with_sql(MOVES_SQL) + "SELECT 'exit_leads_in_house' AS rule, CAST(mv.move_id AS VARCHAR) AS id FROM mv LEFT JOIN firms f ON f.firm_id = mv.to_firm_id WHERE mv.move_type = 'in_house_exit' AND f.firm_type IS DISTINCT FROM 'other'")
def i08_firm_kinds(spark, root):
    """'other' is the kind that in-house teams have in the firms table."""
    moves = bindings.moves(spark, root).select("move_id", "move_type", "to_firm_id", F.lit(None).cast("long").alias("from_firm_id"))
    return integrity.firm_kinds(moves, table(spark, root, "firms"), "other")


_GONE = "gone AS (SELECT DISTINCT person_name FROM extracted_moves WHERE person_name LIKE 'Alexander%')"


@query(with_sql(_GONE) + "SELECT 'moves' AS table, count(*) AS erased FROM extracted_moves WHERE person_name IN (SELECT person_name FROM gone) UNION ALL SELECT 'spellings', count(*) FROM gone")
def m01_erase_person(spark, root):
    moves = table(spark, root, "extracted_moves").select("move_id", "person_name")
    gone = moves.filter(F.col("person_name").startswith("Alexander")).select("person_name").distinct()
    return upkeep.erase({"moves": moves, "spellings": moves.select("person_name").distinct()}, gone, "person_name", {"moves": "person_name", "spellings": "person_name"})[1]


@query("SELECT firm_id FROM firms WHERE firm_id NOT IN (SELECT to_firm_id FROM extracted_moves WHERE to_firm_id IS NOT NULL AND extractor_version NOT LIKE 'rules%')")
def m02_orphans_after_reextract(spark, root):
    kept = table(spark, root, "extracted_moves").filter("to_firm_id is not null and extractor_version not like 'rules%'").select(F.col("to_firm_id").alias("firm_id"))
    return upkeep.orphans(table(spark, root, "firms").select("firm_id"), kept, "firm_id")


@query("SELECT kind, count(*) AS entries, md5(string_agg(ref_code || name, '|' ORDER BY ref_code)) AS checksum FROM ref_values GROUP BY kind")
def m03_version_checksum(spark, root):
    rows = table(spark, root, "ref_values").groupBy("kind").agg(F.count("*").alias("entries"), F.array_sort(F.collect_list(F.struct("ref_code", "name"))).alias("all"))
    return rows.select("kind", "entries", F.md5(F.array_join(F.transform("all", lambda x: F.concat(x["ref_code"], x["name"])), "|")).alias("checksum"))


@query(with_sql(RUNS_SQL) + "SELECT campaign_id, count(*) FILTER (WHERE items_fetched <= 0 AND (ly IS NULL OR started_at > ly)) AS streak FROM (SELECT *, max(CASE WHEN items_fetched > 0 THEN started_at END) OVER (PARTITION BY campaign_id) AS ly FROM run WHERE status <> 'running') GROUP BY campaign_id")
def m04_empty_streaks(spark, root):
    return upkeep.empty_streaks(bindings.runs(spark, root))


@query(with_sql(RUNS_SQL) + f"SELECT coalesce(max(started_at) - INTERVAL 14 DAY, {NOW} - INTERVAL 90 DAY) AS since FROM run WHERE status = 'succeeded'")
def m05_catch_up_window(spark, root):
    return upkeep.catch_up_start(bindings.runs(spark, root), now())


QUERIES, SQL = query.queries, query.sql
