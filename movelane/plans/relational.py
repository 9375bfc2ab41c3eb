"""Joins, aggregates, windows, sorts, set operations and views over the domain tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from movelane.functions import taxonomy
from movelane.operators import bindings, upkeep
from movelane.operators.bindings import MOVES_SQL, RUNS_SQL, SOURCES_SQL, with_sql
from movelane.plans.registry import Registry
from movelane.session import table

query = Registry()

NORMAL_SQL = r"trim(regexp_replace(regexp_replace(' ' || regexp_replace(lower(strip_accents(replace(replace(coalesce({x}, ''), 'ø', 'o'), 'Ø', 'O'))), '[^a-z0-9]+', ' ', 'g') || ' ', ' (?:and )+', ' ', 'g'), ' +', ' ', 'g'))"
NODES_SQL = "nodes AS (SELECT 'g' || CAST((CAST(regexp_extract(ref_code, '([0-9]+)$', 1) AS INTEGER) - 1) // 7 AS VARCHAR) AS top, lower(ref_code) AS leaf, name FROM ref_values WHERE kind = 'practice')"
#: Practice of a move: the node whose whole name its practice text is.
CLASSIFIED_SQL = ", ".join([MOVES_SQL, SOURCES_SQL, NODES_SQL]) + ", cm AS (SELECT mv.*, nodes.top || '.' || nodes.leaf AS code, coalesce(nodes.top, 'unclassified') AS top FROM mv LEFT JOIN nodes ON lower(nodes.name) = lower(mv.practice_text))"


def classified(spark, root):
    nodes = taxonomy.taxonomy_from_list(table(spark, root, "ref_values")).select("code", F.lower("name").alias("n"))
    rows = bindings.moves(spark, root).join(nodes, F.lower("practice_text") == F.col("n"), "left").drop("n")
    return rows.withColumn("top", F.coalesce(taxonomy.top_level(F.col("code")), F.lit(taxonomy.UNCLASSIFIED)))


def quarter(column: str):
    return F.trunc(F.col(column), "quarter").cast("date")


# --- joins -----------------------------------------------------------------------------------------------------------


@query(with_sql(MOVES_SQL, SOURCES_SQL) + "SELECT mv.move_id, f.canonical_name AS firm, i.url, src.tier FROM mv JOIN firms f ON f.firm_id = mv.to_firm_id JOIN raw_items i ON i.item_id = mv.item_id JOIN src ON src.slug = i.source_slug WHERE mv.announced_date IS NOT NULL")
def j01_inner_chain(spark, root):
    rows = bindings.moves(spark, root).filter("announced_date is not null").select("move_id", "item_id", "to_firm_id")
    firms = table(spark, root, "firms").select(F.col("firm_id").alias("to_firm_id"), F.col("canonical_name").alias("firm"))
    items = table(spark, root, "raw_items").select("item_id", "url", F.col("source_slug").alias("slug"))
    return rows.join(firms, "to_firm_id").join(items, "item_id").join(bindings.sources(spark, root).select("slug", "tier"), "slug").select("move_id", "firm", "url", "tier")


@query(with_sql(CLASSIFIED_SQL) + "SELECT cm.move_id, cm.code, i.url, src.slug AS source FROM cm LEFT JOIN raw_items i ON i.item_id = cm.item_id AND i.access_level = 'full_public' LEFT JOIN src ON src.slug = i.source_slug")
def j02_left_outer_chain(spark, root):
    items = table(spark, root, "raw_items").filter("access_level = 'full_public'").select("item_id", "url", F.col("source_slug").alias("slug"))
    sources = bindings.sources(spark, root).select("slug", F.col("slug").alias("source"))
    return classified(spark, root).select("move_id", "item_id", "code").join(items, "item_id", "left").join(sources, "slug", "left").select("move_id", "code", "url", "source")


@query(with_sql(SOURCES_SQL) + "SELECT i.item_id, src.adapter, src.tier FROM raw_items i JOIN src ON src.slug = i.source_slug")
def j03_item_source(spark, root):
    return table(spark, root, "raw_items").select("item_id", F.col("source_slug").alias("slug")).join(bindings.sources(spark, root).select("slug", "adapter", "tier"), "slug").select("item_id", "adapter", "tier")


@query(with_sql(MOVES_SQL) + "SELECT i.source_slug, count(DISTINCT i.item_id) AS items, count(DISTINCT mv.move_id) AS moves FROM raw_items i LEFT JOIN mv ON mv.item_id = i.item_id GROUP BY i.source_slug")
def j04_left_distinct_counts(spark, root):
    # Each side is counted per item first, so nothing is expanded by the join.
    per_item = table(spark, root, "extracted_moves").select("item_id", "move_id").distinct().groupBy("item_id").agg(F.count("*").alias("n"))
    items = table(spark, root, "raw_items").select("item_id", "source_slug").distinct()
    return items.join(per_item, "item_id", "left").groupBy("source_slug").agg(F.count("*").alias("items"), F.coalesce(F.sum("n"), F.lit(0)).alias("moves"))


@query("SELECT move_id FROM extracted_moves WHERE EXISTS (SELECT 1 FROM firms WHERE firm_id = to_firm_id AND firm_type = 'boutique')")
def j06_left_semi(spark, root):
    firms = table(spark, root, "firms").filter("firm_type = 'boutique'").select(F.col("firm_id").alias("to_firm_id"))
    return table(spark, root, "extracted_moves").select("move_id", "to_firm_id").join(firms, "to_firm_id", "left_semi").select("move_id")


@query("SELECT item_id FROM raw_items i WHERE NOT EXISTS (SELECT 1 FROM extracted_moves m WHERE m.item_id = i.item_id)")
def j07_left_anti(spark, root):
    return table(spark, root, "raw_items").select("item_id").join(table(spark, root, "extracted_moves").select("item_id"), "item_id", "left_anti")


@query("SELECT DISTINCT m.move_id, f.firm_id FROM (SELECT move_id, lower(trim(fields['to_firm'].value)) AS k FROM extracted_moves) m JOIN (SELECT firm_id, lower(trim(unnest(list_append(aliases, canonical_name)))) AS k FROM firms) f ON f.k = m.k")
def j08_array_membership(spark, root):
    names = table(spark, root, "firms").select("firm_id", F.explode(F.concat("aliases", F.array("canonical_name"))).alias("k")).select("firm_id", F.lower(F.trim("k")).alias("k")).distinct()
    return table(spark, root, "extracted_moves").select("move_id", F.lower(F.trim(F.col("fields")["to_firm"]["value"])).alias("k")).join(names, "k").select("move_id", "firm_id").distinct()


@query("SELECT r.role_id, v.ref_code FROM role_parts r JOIN ref_values v ON v.kind = 'title' AND lower(trim(v.name)) = lower(trim(r.title))")
def j09_case_insensitive(spark, root):
    ref = table(spark, root, "ref_values").filter("kind = 'title'").select(F.lower(F.trim("name")).alias("k"), "ref_code")
    return table(spark, root, "role_parts").select("role_id", F.lower(F.trim("title")).alias("k")).join(ref, "k").select("role_id", "ref_code")


@query("SELECT a.config.slug AS slug, a.register_version AS version, b.config.reliability_tier AS tier_before FROM sources a LEFT JOIN sources b ON b.config.slug = a.config.slug AND b.register_version = a.register_version - 1")
def j10_register_lookup(spark, root):
    rows = table(spark, root, "sources").select(F.col("config.slug").alias("slug"), F.col("register_version").alias("version"), F.col("config.reliability_tier").alias("tier"))
    before = rows.select("slug", (F.col("version") + 1).alias("version"), F.col("tier").alias("tier_before"))
    return rows.join(before, ["slug", "version"], "left").select("slug", "version", "tier_before")


@query(with_sql(NODES_SQL) + "SELECT top AS parent, count(*) AS children FROM nodes GROUP BY top")
def j11_hierarchy(spark, root):
    nodes = taxonomy.taxonomy_from_list(table(spark, root, "ref_values"))
    parents = nodes.select(F.col("top").alias("parent")).distinct()
    return parents.join(nodes, F.col("parent") == taxonomy.top_level(F.col("code"))).groupBy("parent").agg(F.count("*").alias("children"))


@query("SELECT m.move_id, count(DISTINCT o.person_name) AS mates FROM extracted_moves m JOIN extracted_moves o ON o.group_ref = m.group_ref WHERE m.group_ref IS NOT NULL GROUP BY m.move_id")
def j13_scalar_recount(spark, root):
    rows = table(spark, root, "extracted_moves").filter("group_ref is not null").select("move_id", "group_ref", "person_name")
    return rows.select("move_id", "group_ref").join(rows.groupBy("group_ref").agg(F.count_distinct("person_name").alias("mates")), "group_ref").select("move_id", "mates")


@query("SELECT move_id, unnest(dropped) AS field_name FROM extracted_moves")
def j14_unnest_array(spark, root):
    return table(spark, root, "extracted_moves").select("move_id", F.explode("dropped").alias("field_name"))


@query("SELECT move_id, e.key AS field_name, e.value.value AS value, e.value.quality AS quality FROM (SELECT move_id, unnest(map_entries(fields)) AS e FROM extracted_moves)")
def j14_unnest_map(spark, root):
    return table(spark, root, "extracted_moves").select("move_id", F.explode("fields").alias("field_name", "f")).select("move_id", "field_name", "f.value", "f.quality")


# --- aggregates ------------------------------------------------------------------------------------------------------


@query(with_sql(MOVES_SQL) + "SELECT source_slug, CAST(date_trunc('month', announced_date) AS DATE) AS month, move_type, count(*) AS moves FROM mv GROUP BY ALL")
def a01_count_by_expressions(spark, root):
    return bindings.moves(spark, root).groupBy("source_slug", F.trunc("announced_date", "month").alias("month"), "move_type").agg(F.count("*").alias("moves"))


@query(with_sql(MOVES_SQL) + "SELECT to_firm_id, count(*) FILTER (WHERE move_type = 'promotion') AS promotions, count(*) FILTER (WHERE confidence >= 0.6) AS sure, count(*) FILTER (WHERE from_firm IS NULL) AS no_origin FROM mv GROUP BY to_firm_id")
def a02_filtered_counts(spark, root):
    return bindings.moves(spark, root).groupBy("to_firm_id").agg(F.count_if(F.col("move_type") == "promotion").alias("promotions"), F.count_if(F.col("confidence") >= 0.6).alias("sure"), F.count_if(F.col("from_firm").isNull()).alias("no_origin"))


@query("SELECT to_firm_id, count(DISTINCT person_name) AS people, count(DISTINCT source_slug) AS sources FROM extracted_moves GROUP BY to_firm_id")
def a03_count_distinct(spark, root):
    return table(spark, root, "extracted_moves").groupBy("to_firm_id").agg(F.count_distinct("person_name").alias("people"), F.count_distinct("source_slug").alias("sources"))


@query("SELECT group_ref, list_sort(list(DISTINCT person_name)) AS names, list_sort(list(move_id)) AS moves FROM extracted_moves WHERE group_ref IS NOT NULL GROUP BY group_ref")
def a04_array_agg(spark, root):
    rows = table(spark, root, "extracted_moves").filter("group_ref is not null")
    return rows.groupBy("group_ref").agg(F.array_sort(F.collect_set("person_name")).alias("names"), F.array_sort(F.collect_list("move_id")).alias("moves"))


@query("SELECT lower(trim(a)) AS alias, count(DISTINCT firm_id) AS firms FROM (SELECT firm_id, unnest(aliases) AS a FROM firms) GROUP BY 1 HAVING count(DISTINCT firm_id) > 1")
def a05_having(spark, root):
    return table(spark, root, "firms").select("firm_id", F.explode("aliases").alias("a")).groupBy(F.lower(F.trim("a")).alias("alias")).agg(F.count_distinct("firm_id").alias("firms")).filter("firms > 1")


@query("SELECT min(arrived_at) AS first_at, max(arrived_at) AS last_at, count(*) AS items FROM raw_items")
def a06_min_max(spark, root):
    return table(spark, root, "raw_items").agg(F.min("arrived_at").alias("first_at"), F.max("arrived_at").alias("last_at"), F.count("*").alias("items"))


@query(with_sql(MOVES_SQL, SOURCES_SQL) + "SELECT mv.to_firm_id, min_by(mv.move_id, {'t': coalesce(src.tier, 99), 'c': -coalesce(mv.confidence, -1), 'i': mv.move_id}) AS best FROM mv LEFT JOIN src ON src.slug = mv.source_slug GROUP BY mv.to_firm_id")
def a07_argmax_by_authority(spark, root):
    rows = bindings.moves(spark, root).join(bindings.sources(spark, root).select(F.col("slug").alias("source_slug"), "tier"), "source_slug", "left")
    rank = F.struct(F.coalesce("tier", F.lit(99)), -F.coalesce("confidence", F.lit(-1.0)), F.col("move_id"))
    return rows.groupBy("to_firm_id").agg(F.min_by("move_id", rank).alias("best"))


@query("SELECT source_slug, max(n) AS mode_items, CAST(sum(n) AS BIGINT) AS items, max(n) * 1.0 / sum(n) > 0.5 AS bulk FROM (SELECT source_slug, CAST(arrived_at AS DATE) AS d, count(*) AS n FROM raw_items GROUP BY ALL) GROUP BY source_slug")
def a08_mode_share(spark, root):
    days = table(spark, root, "raw_items").groupBy("source_slug", F.to_date("arrived_at").alias("d")).agg(F.count("*").alias("n"))
    return days.groupBy("source_slug").agg(F.max("n").alias("mode_items"), F.sum("n").alias("items"), (F.max("n") / F.sum("n") > 0.5).alias("bulk"))


@query("SELECT node, round(avg(duration_ms), 6) AS mean_ms, count(*) AS fetches FROM fetches GROUP BY node")
def a09_mean(spark, root):
    return table(spark, root, "fetches").groupBy("node").agg(F.round(F.avg("duration_ms"), 6).alias("mean_ms"), F.count("*").alias("fetches"))


@query(with_sql(MOVES_SQL) + "SELECT move_id, CAST((CASE WHEN from_firm IS NULL THEN 0 ELSE 30 END + CASE WHEN title_to IS NULL THEN 0 ELSE 15 END + CASE WHEN office IS NULL THEN 0 ELSE 25 END + CASE WHEN practice_text IS NULL THEN 0 ELSE 25 END + CASE WHEN partner_tier IS NULL THEN 0 ELSE 5 END) AS INTEGER) AS points FROM mv")
def a10_weighted_sum(spark, root):
    weights = {"from_firm": 30, "title_to": 15, "office": 25, "practice_text": 25, "partner_tier": 5}
    return bindings.moves(spark, root).select("move_id", sum((F.when(F.col(c).isNotNull(), w).otherwise(0) for c, w in weights.items()), F.lit(0)).alias("points"))


@query("SELECT to_firm_id, count(*) AS moves FROM extracted_moves WHERE to_firm_id IS NOT NULL GROUP BY to_firm_id ORDER BY moves DESC, to_firm_id LIMIT 6")
def a11_top_counts(spark, root):
    return table(spark, root, "extracted_moves").filter("to_firm_id is not null").groupBy("to_firm_id").agg(F.count("*").alias("moves")).orderBy(F.desc("moves"), "to_firm_id").limit(6)


@query(with_sql(MOVES_SQL) + "SELECT to_firm_id, list_sort(list(DISTINCT office)) AS offices, count(DISTINCT office) AS n FROM mv WHERE office IS NOT NULL GROUP BY to_firm_id")
def a12_set_aggregate(spark, root):
    return bindings.moves(spark, root).filter("office is not null").groupBy("to_firm_id").agg(F.array_sort(F.collect_set("office")).alias("offices"), F.count_distinct("office").alias("n"))


@query("SELECT stage, status, count(*) AS runs, CAST(sum(errors) AS BIGINT) AS errors, CAST(sum(items_fetched) AS BIGINT) AS items FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY logged_at DESC) AS n FROM pipeline_runs) WHERE n = 1 GROUP BY stage, status")
def a14_state_rollup(spark, root):
    return bindings.runs(spark, root).groupBy("stage", "status").agg(F.count("*").alias("runs"), F.sum("errors").alias("errors"), F.sum("items_fetched").alias("items"))


# --- windows, sorts, sets --------------------------------------------------------------------------------------------


@query("SELECT *, CAST(sum(moves) OVER (PARTITION BY source_slug, quarter) AS BIGINT) AS in_period FROM (SELECT source_slug, CAST(date_trunc('quarter', announced_date) AS DATE) AS quarter, fields['move_type'].value AS move_type, count(*) AS moves FROM extracted_moves GROUP BY ALL)")
def w01_window_over_aggregate(spark, root):
    rows = table(spark, root, "extracted_moves").groupBy("source_slug", quarter("announced_date").alias("quarter"), F.col("fields")["move_type"]["value"].alias("move_type")).agg(F.count("*").alias("moves"))
    return rows.withColumn("in_period", F.sum("moves").over(Window.partitionBy("source_slug", "quarter")))


@query(with_sql(CLASSIFIED_SQL) + "SELECT source_slug, top, count(*) AS moves, CAST(sum(count(*)) FILTER (WHERE top <> 'unclassified') OVER (PARTITION BY source_slug) AS BIGINT) AS classified FROM cm GROUP BY source_slug, top")
def w02_filtered_window(spark, root):
    rows = classified(spark, root).groupBy("source_slug", "top").agg(F.count("*").alias("moves"))
    return rows.withColumn("classified", F.sum(F.when(F.col("top") != "unclassified", F.col("moves"))).over(Window.partitionBy("source_slug")))


@query("SELECT to_firm_id, announced_date, move_id FROM (SELECT *, row_number() OVER (PARTITION BY to_firm_id ORDER BY announced_date DESC NULLS LAST, move_id) AS n FROM extracted_moves) WHERE n = 1")
def w04_rank_one(spark, root):
    # One row per group is an argmax, which combines before the shuffle; a window would sort every group.
    best = F.min_by(F.struct("announced_date", "move_id"), F.struct(F.col("announced_date").isNull(), -F.coalesce(F.unix_date("announced_date"), F.lit(0)), F.col("move_id")))
    return table(spark, root, "extracted_moves").groupBy("to_firm_id").agg(best.alias("b")).select("to_firm_id", "b.announced_date", "b.move_id")


@query("SELECT item_id, arrived_at FROM raw_items WHERE access_level = 'summary' ORDER BY arrived_at DESC, item_id LIMIT 25")
def o01_sort_limit(spark, root):
    return table(spark, root, "raw_items").filter("access_level = 'summary'").select("item_id", "arrived_at").orderBy(F.desc("arrived_at"), "item_id").limit(25)


@query("SELECT move_id, source_slug FROM extracted_moves ORDER BY source_slug NULLS FIRST, move_id LIMIT 40")
def o02_nulls_first(spark, root):
    return table(spark, root, "extracted_moves").select("move_id", "source_slug").orderBy(F.asc_nulls_first("source_slug"), "move_id").limit(40)


@query("SELECT move_id, source_slug FROM extracted_moves ORDER BY source_slug NULLS FIRST, move_id")
def o02_nulls_first_all(spark, root):
    return table(spark, root, "extracted_moves").select("move_id", "source_slug").orderBy(F.asc_nulls_first("source_slug"), "move_id")


@query("SELECT to_firm_id, announced_date, move_id FROM extracted_moves ORDER BY 1, 2, 3")
def o03_multi_key_sort(spark, root):
    return table(spark, root, "extracted_moves").select("to_firm_id", "announced_date", "move_id").orderBy("to_firm_id", "announced_date", "move_id")


@query("SELECT 'item' AS kind, source_slug, count(*) AS n FROM raw_items GROUP BY 2 UNION ALL SELECT 'fetch', source_slug, count(*) FROM fetches GROUP BY 2 UNION ALL SELECT 'move', source_slug, count(*) FROM extracted_moves GROUP BY 2")
def u01_union_all(spark, root):
    parts = [table(spark, root, t).groupBy("source_slug").agg(F.count("*").alias("n")).select(F.lit(k).alias("kind"), "source_slug", "n") for k, t in (("item", "raw_items"), ("fetch", "fetches"), ("move", "extracted_moves"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""SELECT item_id, list_sort(list_intersect(a, b)) AS both, list_sort(list_filter(a, lambda x: NOT list_contains(b, x))) AS only_headline FROM (
    SELECT item_id, list_distinct(list_filter(string_split(lower(headline), ' '), lambda x: x <> '')) AS a, list_distinct(list_filter(string_split(lower(url), '-'), lambda x: x <> '')) AS b FROM raw_items)""")
def u02_word_sets(spark, root):
    words = lambda c, sep: F.array_distinct(F.filter(F.split(F.lower(c), sep), lambda x: x != ""))
    rows = table(spark, root, "raw_items").select("item_id", words(F.col("headline"), " ").alias("a"), words(F.col("url"), "-").alias("b"))
    return rows.select("item_id", F.array_sort(F.array_intersect("a", "b")).alias("both"), F.array_sort(F.array_except("a", "b")).alias("only_headline"))


@query("SELECT url, min(item_id) AS item_id FROM raw_items GROUP BY url")
def u03_first_by_key(spark, root):
    return table(spark, root, "raw_items").groupBy("url").agg(F.min("item_id").alias("item_id"))


# --- views -----------------------------------------------------------------------------------------------------------

_SUPERSEDED = "superseded AS (SELECT move_id FROM (SELECT move_id, row_number() OVER (PARTITION BY group_ref ORDER BY extracted_at DESC, move_id) AS n FROM extracted_moves WHERE group_ref IS NOT NULL) WHERE n > 1)"
_CANONICAL = CLASSIFIED_SQL + ", " + _SUPERSEDED + ", canon AS (SELECT * FROM cm WHERE move_id NOT IN (SELECT move_id FROM superseded) AND coalesce(confidence, 1) >= 0.35)"


def canonical(spark, root):
    """Moves that no later member of their group supersedes and that are not refused."""
    rows = classified(spark, root)
    last = rows.filter("group_ref is not null").groupBy("group_ref").agg(F.min_by("move_id", F.struct(-F.unix_micros("extracted_at"), F.col("move_id"))).alias("kept"))
    return rows.join(last, "group_ref", "left").filter("kept is null or kept = move_id").drop("kept").filter("coalesce(confidence, 1) >= 0.35")


@query(with_sql(_CANONICAL) + "SELECT move_id, to_firm_id, top FROM canon")
def v01_canonical_moves(spark, root):
    return canonical(spark, root).select("move_id", "to_firm_id", "top")


@query(
    with_sql(_CANONICAL)
    + """SELECT c.move_id, c.to_firm_id, c.from_firm, c.move_type, c.title_to, c.office, c.announced_date, CAST(date_trunc('month', c.announced_date) AS DATE) AS period_month,
    CAST(date_trunc('quarter', c.announced_date) AS DATE) AS period_quarter, c.confidence, c.extractor_version, c.code AS practice_code, c.top AS practice_top, c.code IS NULL AS practice_unclassified,
    i.source_slug, src.tier, i.url, i.published_at_is_estimated AS date_is_estimated, i.headline_is_derived
    FROM canon c LEFT JOIN raw_items i ON i.item_id = c.item_id LEFT JOIN src ON src.slug = i.source_slug"""
)
def v02_analysis_moves(spark, root):
    items = table(spark, root, "raw_items").select("item_id", F.col("source_slug").alias("slug"), "url", F.col("published_at_is_estimated").alias("date_is_estimated"), "headline_is_derived")
    rows = canonical(spark, root).drop("source_slug").join(items, "item_id", "left").join(bindings.sources(spark, root).select("slug", "tier"), "slug", "left")
    return rows.select(
        "move_id", "to_firm_id", "from_firm", "move_type", "title_to", "office", "announced_date", F.trunc("announced_date", "month").alias("period_month"), quarter("announced_date").alias("period_quarter"),
        "confidence", "extractor_version", F.col("code").alias("practice_code"), F.col("top").alias("practice_top"), F.col("code").isNull().alias("practice_unclassified"),
        F.col("slug").alias("source_slug"), "tier", "url", "date_is_estimated", "headline_is_derived",
    )


@query(
    with_sql(SOURCES_SQL)
    + """SELECT i.source_slug, src.tier, CAST(date_trunc('month', i.arrived_at) AS DATE) AS period_month, CAST(date_trunc('quarter', i.arrived_at) AS DATE) AS period_quarter, count(*) AS items,
    count(*) FILTER (WHERE i.body_text IS NOT NULL) AS with_body, count(*) FILTER (WHERE m.item_id IS NOT NULL) AS items_with_moves, count(*) FILTER (WHERE i.published_at_is_estimated) AS items_date_estimated
    FROM raw_items i JOIN src ON src.slug = i.source_slug LEFT JOIN (SELECT DISTINCT item_id FROM extracted_moves) m ON m.item_id = i.item_id GROUP BY ALL"""
)
def v03_source_period_coverage(spark, root):
    moved = table(spark, root, "extracted_moves").select("item_id").distinct().withColumn("moved", F.lit(True))
    items = table(spark, root, "raw_items").select("item_id", F.col("source_slug").alias("slug"), "arrived_at", F.col("body_text").isNotNull().alias("has_body"), "published_at_is_estimated")
    rows = items.join(bindings.sources(spark, root).select("slug", "tier"), "slug").join(moved, "item_id", "left")
    return rows.groupBy(F.col("slug").alias("source_slug"), "tier", F.trunc("arrived_at", "month").alias("period_month"), F.trunc("arrived_at", "quarter").alias("period_quarter")).agg(
        F.count("*").alias("items"), F.count_if("has_body").alias("with_body"), F.count_if("moved").alias("items_with_moves"), F.count_if("published_at_is_estimated").alias("items_date_estimated"),
    )


_TREND = """SELECT source_slug, period_quarter, practice_top, moves, CAST(sum(moves) OVER w AS BIGINT) AS moves_in_period, CAST(sum(CASE WHEN practice_top <> 'unclassified' THEN moves END) OVER w AS BIGINT) AS classified_in_period,
    CASE WHEN practice_top <> 'unclassified' THEN round(moves * 1.0 / sum(CASE WHEN practice_top <> 'unclassified' THEN moves END) OVER w, 4) END AS share_of_classified
    FROM (SELECT source_slug, CAST(date_trunc('quarter', announced_date) AS DATE) AS period_quarter, top AS practice_top, count(*) AS moves FROM canon WHERE announced_date IS NOT NULL GROUP BY ALL)
    WINDOW w AS (PARTITION BY source_slug, period_quarter)"""


@query(with_sql(_CANONICAL) + _TREND)
def v04_practice_group_trend(spark, root):
    rows = canonical(spark, root).filter("announced_date is not null").groupBy("source_slug", quarter("announced_date").alias("period_quarter"), F.col("top").alias("practice_top")).agg(F.count("*").alias("moves"))
    period = Window.partitionBy("source_slug", "period_quarter")
    stated = F.when(F.col("practice_top") != "unclassified", F.col("moves"))
    rows = rows.withColumn("moves_in_period", F.sum("moves").over(period)).withColumn("classified_in_period", F.sum(stated).over(period))
    return rows.withColumn("share_of_classified", F.round(stated / F.col("classified_in_period"), 4))


@query(with_sql(RUNS_SQL) + "SELECT campaign_id, streak FROM (SELECT campaign_id, count(*) FILTER (WHERE items_fetched <= 0 AND (ly IS NULL OR started_at > ly)) AS streak FROM (SELECT *, max(CASE WHEN items_fetched > 0 THEN started_at END) OVER (PARTITION BY campaign_id) AS ly FROM run WHERE status <> 'running') GROUP BY campaign_id) WHERE streak >= 3")
def v06_yield_alerts(spark, root):
    """Campaigns whose last three runs or more brought nothing."""
    return upkeep.empty_streaks(bindings.runs(spark, root)).filter("streak >= 3")


@query("SELECT lower(trim(a)) AS alias, count(DISTINCT firm_id) AS firms FROM (SELECT firm_id, unnest(aliases) AS a FROM firms) GROUP BY 1 HAVING count(DISTINCT firm_id) > 1")
def a05_having(spark, root):
    return table(spark, root, "firms").select("firm_id", F.explode("aliases").alias("a")).groupBy(F.lower(F.trim("a")).alias("alias")).agg(F.count_distinct("firm_id").alias("firms")).filter("firms > 1")


@query("SELECT min(arrived_at) AS first_at, max(arrived_at) AS last_at, count(*) AS items FROM raw_items")
def a06_min_max(spark, root):
    return table(spark, root, "raw_items").agg(F.min("arrived_at").alias("first_at"), F.max("arrived_at").alias("last_at"), F.count("*").alias("items"))


@query(with_sql(MOVES_SQL, SOURCES_SQL) + "SELECT mv.to_firm_id, min_by(mv.move_id, {'t': coalesce(src.tier, 99), 'c': -coalesce(mv.confidence, -1), 'i': mv.move_id}) AS best FROM mv LEFT JOIN src ON src.slug = mv.source_slug GROUP BY mv.to_firm_id")
def a07_argmax_by_authority(spark, root):
    rows = bindings.moves(spark, root).join(bindings.sources(spark, root).select(F.col("slug").alias("source_slug"), "tier"), "source_slug", "left")
    rank = F.struct(F.coalesce("tier", F.lit(99)), -F.coalesce("confidence", F.lit(-1.0)), F.col("move_id"))
    return rows.groupBy("to_firm_id").agg(F.min_by("move_id", rank).alias("best"))


@query("SELECT source_slug, max(n) AS mode_items, CAST(sum(n) AS BIGINT) AS items, max(n) * 1.0 / sum(n) > 0.5 AS bulk FROM (SELECT source_slug, CAST(arrived_at AS DATE) AS d, count(*) AS n FROM raw_items GROUP BY ALL) GROUP BY source_slug")
def a08_mode_share(spark, root):
    days = table(spark, root, "raw_items").groupBy("source_slug", F.to_date("arrived_at").alias("d")).agg(F.count("*").alias("n"))
    return days.groupBy("source_slug").agg(F.max("n").alias("mode_items"), F.sum("n").alias("items"), (F.max("n") / F.sum("n") > 0.5).alias("bulk"))


@query("SELECT node, round(avg(duration_ms), 6) AS mean_ms, count(*) AS fetches FROM fetches GROUP BY node")
def a09_mean(spark, root):
    return table(spark, root, "fetches").groupBy("node").agg(F.round(F.avg("duration_ms"), 6).alias("mean_ms"), F.count("*").alias("fetches"))


@query(with_sql(MOVES_SQL) + "SELECT move_id, CAST((CASE WHEN from_firm IS NULL THEN 0 ELSE 30 END + CASE WHEN title_to IS NULL THEN 0 ELSE 15 END + CASE WHEN office IS NULL THEN 0 ELSE 25 END + CASE WHEN practice_text IS NULL THEN 0 ELSE 25 END + CASE WHEN partner_tier IS NULL THEN 0 ELSE 5 END) AS INTEGER) AS points FROM mv")
def a10_weighted_sum(spark, root):
    weights = {"from_firm": 30, "title_to": 15, "office": 25, "practice_text": 25, "partner_tier": 5}
    return bindings.moves(spark, root).select("move_id", sum((F.when(F.col(c).isNotNull(), w).otherwise(0) for c, w in weights.items()), F.lit(0)).alias("points"))


@query("SELECT to_firm_id, count(*) AS moves FROM extracted_moves WHERE to_firm_id IS NOT NULL GROUP BY to_firm_id ORDER BY moves DESC, to_firm_id LIMIT 6")
def a11_top_counts(spark, root):
    return table(spark, root, "extracted_moves").filter("to_firm_id is not null").groupBy("to_firm_id").agg(F.count("*").alias("moves")).orderBy(F.desc("moves"), "to_firm_id").limit(6)


@query(with_sql(MOVES_SQL) + "SELECT to_firm_id, list_sort(list(DISTINCT office)) AS offices, count(DISTINCT office) AS n FROM mv WHERE office IS NOT NULL GROUP BY to_firm_id")
def a12_set_aggregate(spark, root):
    return bindings.moves(spark, root).filter("office is not null").groupBy("to_firm_id").agg(F.array_sort(F.collect_set("office")).alias("offices"), F.count_distinct("office").alias("n"))


@query("SELECT stage, status, count(*) AS runs, CAST(sum(errors) AS BIGINT) AS errors, CAST(sum(items_fetched) AS BIGINT) AS items FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY logged_at DESC) AS n FROM pipeline_runs) WHERE n = 1 GROUP BY stage, status")
def a14_state_rollup(spark, root):
    return bindings.runs(spark, root).groupBy("stage", "status").agg(F.count("*").alias("runs"), F.sum("errors").alias("errors"), F.sum("items_fetched").alias("items"))


# --- windows, sorts, sets --------------------------------------------------------------------------------------------


@query("SELECT *, CAST(sum(moves) OVER (PARTITION BY source_slug, quarter) AS BIGINT) AS in_period FROM (SELECT source_slug, CAST(date_trunc('quarter', announced_date) AS DATE) AS quarter, fields['move_type'].value AS move_type, count(*) AS moves FROM extracted_moves GROUP BY ALL)")
def w01_window_over_aggregate(spark, root):
    rows = table(spark, root, "extracted_moves").groupBy("source_slug", quarter("announced_date").alias("quarter"), F.col("fields")["move_type"]["value"].alias("move_type")).agg(F.count("*").alias("moves"))
    return rows.withColumn("in_period", F.sum("moves").over(Window.partitionBy("source_slug", "quarter")))


@query(with_sql(CLASSIFIED_SQL) + "SELECT source_slug, top, count(*) AS moves, CAST(sum(count(*)) FILTER (WHERE top <> 'unclassified') OVER (PARTITION BY source_slug) AS BIGINT) AS classified FROM cm GROUP BY source_slug, top")
def w02_filtered_window(spark, root):
    rows = classified(spark, root).groupBy("source_slug", "top").agg(F.count("*").alias("moves"))
    return rows.withColumn("classified", F.sum(F.when(F.col("top") != "unclassified", F.col("moves"))).over(Window.partitionBy("source_slug")))


@query("SELECT to_firm_id, announced_date, move_id FROM (SELECT *, row_number() OVER (PARTITION BY to_firm_id ORDER BY announced_date DESC NULLS LAST, move_id) AS n FROM extracted_moves) WHERE n = 1")
def w04_rank_one(spark, root):
    # One row per group is an argmax, which combines before the shuffle; a window would sort every group.
    best = F.min_by(F.struct("announced_date", "move_id"), F.struct(F.col("announced_date").isNull(), -F.coalesce(F.unix_date("announced_date"), F.lit(0)), F.col("move_id")))
    return table(spark, root, "extracted_moves").groupBy("to_firm_id").agg(best.alias("b")).select("to_firm_id", "b.announced_date", "b.move_id")


@query("SELECT item_id, arrived_at FROM raw_items WHERE access_level = 'summary' ORDER BY arrived_at DESC, item_id LIMIT 25")
def o01_sort_limit(spark, root):
    return table(spark, root, "raw_items").filter("access_level = 'summary'").select("item_id", "arrived_at").orderBy(F.desc("arrived_at"), "item_id").limit(25)


@query("SELECT move_id, source_slug FROM extracted_moves ORDER BY source_slug NULLS FIRST, move_id LIMIT 40")
def o02_nulls_first(spark, root):
    return table(spark, root, "extracted_moves").select("move_id", "source_slug").orderBy(F.asc_nulls_first("source_slug"), "move_id").limit(40)


@query("SELECT move_id, source_slug FROM extracted_moves ORDER BY source_slug NULLS FIRST, move_id")
def o02_nulls_first_all(spark, root):
    return table(spark, root, "extracted_moves").select("move_id", "source_slug").orderBy(F.asc_nulls_first("source_slug"), "move_id")


@query("SELECT to_firm_id, announced_date, move_id FROM extracted_moves ORDER BY 1, 2, 3")
def o03_multi_key_sort(spark, root):
    return table(spark, root, "extracted_moves").select("to_firm_id", "announced_date", "move_id").orderBy("to_firm_id", "announced_date", "move_id")


@query("SELECT 'item' AS kind, source_slug, count(*) AS n FROM raw_items GROUP BY 2 UNION ALL SELECT 'fetch', source_slug, count(*) FROM fetches GROUP BY 2 UNION ALL SELECT 'move', source_slug, count(*) FROM extracted_moves GROUP BY 2")
def u01_union_all(spark, root):
    parts = [table(spark, root, t).groupBy("source_slug").agg(F.count("*").alias("n")).select(F.lit(k).alias("kind"), "source_slug", "n") for k, t in (("item", "raw_items"), ("fetch", "fetches"), ("move", "extracted_moves"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""SELECT item_id, list_sort(list_intersect(a, b)) AS both, list_sort(list_filter(a, lambda x: NOT list_contains(b, x))) AS only_headline FROM (
    SELECT item_id, list_distinct(list_filter(string_split(lower(headline), ' '), lambda x: x <> '')) AS a, list_distinct(list_filter(string_split(lower(url), '-'), lambda x: x <> '')) AS b FROM raw_items)""")
def u02_word_sets(spark, root):
    words = lambda c, sep: F.array_distinct(F.filter(F.split(F.lower(c), sep), lambda x: x != ""))
    rows = table(spark, root, "raw_items").select("item_id", words(F.col("headline"), " ").alias("a"), words(F.col("url"), "-").alias("b"))
    return rows.select("item_id", F.array_sort(F.array_intersect("a", "b")).alias("both"), F.array_sort(F.array_except("a", "b")).alias("only_headline"))


@query("SELECT url, min(item_id) AS item_id FROM raw_items GROUP BY url")
def u03_first_by_key(spark, root):
    return table(spark, root, "raw_items").groupBy("url").agg(F.min("item_id").alias("item_id"))


# --- views -----------------------------------------------------------------------------------------------------------

_SUPERSEDED = "superseded AS (SELECT move_id FROM (SELECT move_id, row_number() OVER (PARTITION BY group_ref ORDER BY extracted_at DESC, move_id) AS n FROM extracted_moves WHERE group_ref IS NOT NULL) WHERE n > 1)"
_CANONICAL = CLASSIFIED_SQL + ", " + _SUPERSEDED + ", canon AS (SELECT * FROM cm WHERE move_id NOT IN (SELECT move_id FROM superseded) AND coalesce(confidence, 1) >= 0.35)"


def canonical(spark, root):
    """Moves that no later member of their group supersedes and that are not refused."""
    rows = classified(spark, root)
    last = rows.filter("group_ref is not null").groupBy("group_ref").agg(F.min_by("move_id", F.struct(-F.unix_micros("extracted_at"), F.col("move_id"))).alias("kept"))
    return rows.join(last, "group_ref", "left").filter("kept is null or kept = move_id").drop("kept").filter("coalesce(confidence, 1) >= 0.35")


@query(with_sql(_CANONICAL) + "SELECT move_id, to_firm_id, top FROM canon")
def v01_canonical_moves(spark, root):
    return canonical(spark, root).select("move_id", "to_firm_id", "top")


@query(
    with_sql(_CANONICAL)
    + """SELECT c.move_id, c.to_firm_id, c.from_firm, c.move_type, c.title_to, c.office, c.announced_date, CAST(date_trunc('month', c.announced_date) AS DATE) AS period_month,
    CAST(date_trunc('quarter', c.announced_date) AS DATE) AS period_quarter, c.confidence, c.extractor_version, c.code AS practice_code, c.top AS practice_top, c.code IS NULL AS practice_unclassified,
    i.source_slug, src.tier, i.url, i.published_at_is_estimated AS date_is_estimated, i.headline_is_derived
    FROM canon c LEFT JOIN raw_items i ON i.item_id = c.item_id LEFT JOIN src ON src.slug = i.source_slug"""
)
def v02_analysis_moves(spark, root):
    items = table(spark, root, "raw_items").select("item_id", F.col("source_slug").alias("slug"), "url", F.col("published_at_is_estimated").alias("date_is_estimated"), "headline_is_derived")
    rows = canonical(spark, root).drop("source_slug").join(items, "item_id", "left").join(bindings.sources(spark, root).select("slug", "tier"), "slug", "left")
    return rows.select(
        "move_id", "to_firm_id", "from_firm", "move_type", "title_to", "office", "announced_date", F.trunc("announced_date", "month").alias("period_month"), quarter("announced_date").alias("period_quarter"),
        "confidence", "extractor_version", F.col("code").alias("practice_code"), F.col("top").alias("practice_top"), F.col("code").isNull().alias("practice_unclassified"),
        F.col("slug").alias("source_slug"), "tier", "url", "date_is_estimated", "headline_is_derived",
    )


@query(
    with_sql(SOURCES_SQL)
    + """SELECT i.source_slug, src.tier, CAST(date_trunc('month', i.arrived_at) AS DATE) AS period_month, CAST(date_trunc('quarter', i.arrived_at) AS DATE) AS period_quarter, count(*) AS items,
    count(*) FILTER (WHERE i.body_text IS NOT NULL) AS with_body, count(*) FILTER (WHERE m.item_id IS NOT NULL) AS items_with_moves, count(*) FILTER (WHERE i.published_at_is_estimated) AS items_date_estimated
    FROM raw_items i JOIN src ON src.slug = i.source_slug LEFT JOIN (SELECT DISTINCT item_id FROM extracted_moves) m ON m.item_id = i.item_id GROUP BY ALL"""
)
def v03_source_period_coverage(spark, root):
    moved = table(spark, root, "extracted_moves").select("item_id").distinct().withColumn("moved", F.lit(True))
    items = table(spark, root, "raw_items").select("item_id", F.col("source_slug").alias("slug"), "arrived_at", F.col("body_text").isNotNull().alias("has_body"), "published_at_is_estimated")
    rows = items.join(bindings.sources(spark, root).select("slug", "tier"), "slug").join(moved, "item_id", "left")
    return rows.groupBy(F.col("slug").alias("source_slug"), "tier", F.trunc("arrived_at", "month").alias("period_month"), F.trunc("arrived_at", "quarter").alias("period_quarter")).agg(
        F.count("*").alias("items"), F.count_if("has_body").alias("with_body"), F.count_if("moved").alias("items_with_moves"), F.count_if("published_at_is_estimated").alias("items_date_estimated"),
    )


_TREND = """SELECT source_slug, period_quarter, practice_top, moves, CAST(sum(moves) OVER w AS BIGINT) AS moves_in_period, CAST(sum(CASE WHEN practice_top <> 'unclassified' THEN moves END) OVER w AS BIGINT) AS classified_in_period,
    CASE WHEN practice_top <> 'unclassified' THEN round(moves * 1.0 / sum(CASE WHEN practice_top <> 'unclassified' THEN moves END) OVER w, 4) END AS share_of_classified
    FROM (SELECT source_slug, CAST(date_trunc('quarter', announced_date) AS DATE) AS period_quarter, top AS practice_top, count(*) AS moves FROM canon WHERE announced_date IS NOT NULL GROUP BY ALL)
    WINDOW w AS (PARTITION BY source_slug, period_quarter)"""


@query(with_sql(_CANONICAL) + _TREND)
def v04_practice_group_trend(spark, root):
    rows = canonical(spark, root).filter("announced_date is not null").groupBy("source_slug", quarter("announced_date").alias("period_quarter"), F.col("top").alias("practice_top")).agg(F.count("*").alias("moves"))
    period = Window.partitionBy("source_slug", "period_quarter")
    stated = F.when(F.col("practice_top") != "unclassified", F.col("moves"))
    rows = rows.withColumn("moves_in_period", F.sum("moves").over(period)).withColumn("classified_in_period", F.sum(stated).over(period))
    return rows.withColumn("share_of_classified", F.round(stated / F.col("classified_in_period"), 4))


_YIELD = RUNS_SQL + ", y AS (SELECT campaign_id, started_at, run_id, CAST(items_fetched = 0 OR status <> 'succeeded' AS INTEGER) AS empty FROM run WHERE stage = 'ingest')"


@query(with_sql(_YIELD) + "SELECT campaign_id, CAST(sum(empty) AS BIGINT) AS empty_runs, count(*) AS runs FROM y GROUP BY campaign_id HAVING sum(empty) >= 3")
def v06_yield_alerts(spark, root):
    rows = bindings.runs(spark, root).filter("stage = 'ingest'").withColumn("empty", ((F.col("items_fetched") == 0) | (F.col("status") != "succeeded")).cast("int"))
    return rows.groupBy("campaign_id").agg(F.sum("empty").alias("empty_runs"), F.count("*").alias("runs")).filter("empty_runs >= 3")


@query("SELECT lower(trim(a)) AS alias, count(DISTINCT firm_id) AS firms, list_sort(list(DISTINCT canonical_name)) AS names FROM (SELECT firm_id, canonical_name, unnest(aliases) AS a FROM firms) GROUP BY 1 HAVING count(DISTINCT firm_id) > 1")
def v07_ambiguous_aliases(spark, root):
    rows = table(spark, root, "firms").select("firm_id", "canonical_name", F.explode("aliases").alias("a"))
    return rows.groupBy(F.lower(F.trim("a")).alias("alias")).agg(F.count_distinct("firm_id").alias("firms"), F.array_sort(F.collect_set("canonical_name")).alias("names")).filter("firms > 1")


@query(
    with_sql(_CANONICAL)
    + """SELECT period_quarter, practice_top, moves, round(moves * 1.0 / sum(moves) OVER (PARTITION BY period_quarter), 3) AS share FROM (
    SELECT CAST(date_trunc('quarter', announced_date) AS DATE) AS period_quarter, top AS practice_top, count(*) AS moves FROM canon WHERE announced_date IS NOT NULL AND top <> 'unclassified' AND confidence >= 0.5 GROUP BY ALL)"""
)
def v08_worked_trend(spark, root):
    rows = canonical(spark, root).filter("announced_date is not null and top <> 'unclassified' and confidence >= 0.5").groupBy(quarter("announced_date").alias("period_quarter"), F.col("top").alias("practice_top")).agg(F.count("*").alias("moves"))
    return rows.withColumn("share", F.round(F.col("moves") / F.sum("moves").over(Window.partitionBy("period_quarter")), 3))


QUERIES, SQL = query.queries, query.sql
