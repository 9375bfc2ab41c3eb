"""Further operators of the inventory that are parts of others, each by itself with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from movelane.functions import confidence, gazetteer, html, names, spans, taxonomy
from movelane.operators import bindings, integrity, slots
from movelane.operators.bindings import MOVES_SQL, with_sql
from movelane.plans.events import _SCORED_SQL, _SCORES_SQL, PLACE_CODES, pair_scores, practice_words, scored
from movelane.plans.registry import Registry
from movelane.plans.relational import _CANONICAL, CLASSIFIED_SQL, canonical, classified
from movelane.plans.texts import _COMPACT, _PLACES_SQL, _PRACTICE_SQL, INDEX_SQL, NAMES_SQL, NORMAL_SQL, _classify_sql, _gate_sql, f02_language_gate, firm_index, people, place_index, practice_index
from movelane.session import table
from movelane.sources import feed, register, sitemap

query = Registry()

# --- sources ---------------------------------------------------------------------------------------------------------


def _escaped(column: str):
    return F.replace(F.replace(F.replace(column, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


@query("SELECT url, headline AS title FROM raw_items")
def s01_feed_scan(spark, root):
    """Items written as feed documents and read back."""
    item = F.concat(F.lit("<rss><channel><item><title>"), _escaped("headline"), F.lit("</title><link>"), _escaped("url"), F.lit("</link></item></channel></rss>"))
    files = table(spark, root, "raw_items").select(F.col("item_id").cast("string").alias("file"), item.alias("value"))
    return feed.parse_files(files).select("url", "title")


@query("SELECT url, CAST(arrived_at AS DATE) AS lastmod FROM raw_items")
def s03_sitemap_scan(spark, root):
    entry = F.concat(F.lit("<urlset><url><loc>"), _escaped("url"), F.lit("</loc><lastmod>"), F.date_format("arrived_at", "yyyy-MM-dd"), F.lit("</lastmod></url></urlset>"))
    files = table(spark, root, "raw_items").select(F.col("item_id").cast("string").alias("file"), entry.alias("value"))
    return sitemap.parse_sitemaps(files).select("url", "lastmod")


@query("SELECT item_id, CASE WHEN item_id % 3 = 0 THEN CAST(arrived_at AS DATE) ELSE make_date(year(arrived_at), 7, 1) END AS published_on, item_id % 3 <> 0 AS estimated FROM raw_items")
def s05_publication_date(spark, root):
    rows = table(spark, root, "raw_items").select("item_id", F.when(F.col("item_id") % 3 == 0, F.to_date("arrived_at")).alias("lastmod"), F.concat(F.lit("https://x/"), F.year("arrived_at"), F.lit("/a")).alias("u"))
    date, estimated = sitemap.publication_date(F.col("lastmod"), F.col("u"))
    return rows.select("item_id", date.alias("published_on"), estimated.alias("estimated"))


@query("SELECT 'known_adapter' AS rule, config.slug AS id FROM sources WHERE config.adapter NOT IN ('feed', 'paginated_feed', 'sitemap', 'imap') UNION ALL SELECT 'tier_in_range', config.slug FROM sources WHERE NOT config.reliability_tier BETWEEN 1 AND 3 UNION ALL SELECT 'feed_has_url', config.slug FROM sources WHERE config.adapter IN ('feed', 'paginated_feed') AND config.feed_url IS NULL UNION ALL SELECT 'tier_one_has_firm', config.slug FROM sources WHERE config.reliability_tier = 1 AND config.firm_name IS NULL UNION ALL SELECT 'one_entry_per_version', config.slug || '|' || register_version FROM sources GROUP BY 2 HAVING count(*) > 1")
def s09_register_problems(spark, root):
    return register.register_problems(table(spark, root, "sources"))


# --- filters, windows, aggregates ------------------------------------------------------------------------------------


@query(with_sql(_CANONICAL) + "SELECT move_id FROM canon WHERE top <> 'unclassified'")
def f01_canonical_filter(spark, root):
    return canonical(spark, root).filter("top <> 'unclassified'").select("move_id")


@query("SELECT reason, count(*) AS items FROM (" + _gate_sql() + ") GROUP BY reason")
def f03_gate_reasons(spark, root):
    return f02_language_gate(spark, root).groupBy("reason").agg(F.count("*").alias("items"))


@query("SELECT item_id FROM raw_items WHERE campaign_id = 1")
def f07_optional_parameter(spark, root):
    def items(campaign=None, source=None):
        rows = table(spark, root, "raw_items")
        rows = rows if campaign is None else rows.filter(F.col("campaign_id") == campaign)
        return rows if source is None else rows.filter(F.col("source_slug") == source)

    return items(campaign=1).select("item_id")


@query("SELECT count(*) FILTER (WHERE g.passed AND m.item_id IS NOT NULL) AS tp, count(*) FILTER (WHERE g.passed AND m.item_id IS NULL) AS fp, count(*) FILTER (WHERE NOT g.passed AND m.item_id IS NOT NULL) AS fn FROM (" + _gate_sql() + ") g LEFT JOIN (SELECT DISTINCT item_id FROM extracted_moves) m ON m.item_id = g.item_id")
def a13_confusion_counts(spark, root):
    moved = table(spark, root, "extracted_moves").select("item_id").distinct().withColumn("moved", F.lit(True))
    rows = f02_language_gate(spark, root).join(moved, "item_id", "left").withColumn("moved", F.col("moved").isNotNull())
    return rows.agg(F.count_if(F.col("passed") & F.col("moved")).alias("tp"), F.count_if(F.col("passed") & ~F.col("moved")).alias("fp"), F.count_if(~F.col("passed") & F.col("moved")).alias("fn"))


@query(with_sql(CLASSIFIED_SQL) + "SELECT to_firm_id, top, n, round(n * 1.0 / sum(n) OVER (PARTITION BY to_firm_id), 3) AS share FROM (SELECT to_firm_id, top, count(*) AS n FROM cm GROUP BY ALL)")
def w03_share_of_total(spark, root):
    rows = classified(spark, root).groupBy("to_firm_id", "top").agg(F.count("*").alias("n"))
    return rows.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("to_firm_id")), 3))


@query("SELECT s.surface FROM (SELECT DISTINCT " + NORMAL_SQL.format(x="canonical_name") + " AS surface FROM firms) s ORDER BY length(s.surface) DESC, s.surface LIMIT 20")
def o04_longest_first(spark, root):
    rows = table(spark, root, "firms").select(gazetteer.normal(F.col("canonical_name")).alias("surface")).distinct()
    return rows.orderBy(F.desc(F.length("surface")), "surface").limit(20)


@query("SELECT s.surface FROM (SELECT DISTINCT " + NORMAL_SQL.format(x="canonical_name") + " AS surface FROM firms) s ORDER BY length(s.surface) DESC, s.surface")
def o04_longest_first_all(spark, root):
    rows = table(spark, root, "firms").select(gazetteer.normal(F.col("canonical_name")).alias("surface")).distinct()
    return rows.orderBy(F.desc(F.length("surface")), "surface")


@query("SELECT person_name, min(move_id) AS move_id FROM extracted_moves GROUP BY person_name")
def o05_first_match(spark, root):
    return table(spark, root, "extracted_moves").groupBy("person_name").agg(F.min("move_id").alias("move_id"))


# --- texts -----------------------------------------------------------------------------------------------------------


@query(with_sql(NAMES_SQL) + f"SELECT {_COMPACT.format(x='sur')} AS surname_key, count(*) AS spellings FROM nm GROUP BY 1")
def t06_surname_keys(spark, root):
    return names.with_name_keys(people(spark, root), "person_name").groupBy("surname_key").agg(F.count("*").alias("spellings"))


@query(
    "SELECT item_id, regexp_replace(CASE WHEN cut IS NOT NULL THEN substr(body_text, 1, cut - 1) ELSE body_text END, '^\\s+|\\s+$', '', 'g') AS trimmed FROM (SELECT item_id, body_text, least("
    + ", ".join("CASE WHEN instr(substr(lower(body_text), 122), '{m}') > 0 THEN instr(substr(lower(body_text), 122), '{m}') + 121 END".format(m=m.replace("'", "''")) for m in html.TAIL_MARKERS)
    + ") AS cut FROM raw_items WHERE body_text IS NOT NULL)"
)
def t11_trim_tail(spark, root):
    return table(spark, root, "raw_items").filter("body_text is not null").select("item_id", html.trim_tail(F.col("body_text")).alias("trimmed"))


@query(with_sql(_PRACTICE_SQL, _classify_sql("c1", "role_parts", "role_id", "practice")) + "SELECT rule_key AS phrase, count(*) AS texts FROM c1 WHERE code <> 'unclassified' GROUP BY rule_key")
def t23_matched_phrases(spark, root):
    rows = taxonomy.classify_phrases(table(spark, root, "role_parts"), practice_index(spark, root), "role_id", "practice")
    return rows.filter("code <> 'unclassified'").groupBy(F.col("rule_key").alias("phrase")).agg(F.count("*").alias("texts"))


_FILLER_SQL, _STRUCTURAL_SQL = "|".join(spans.FILLERS), "|".join(spans.STRUCTURAL)


@query(
    rf"""WITH a AS (SELECT role_id, trim(regexp_replace(regexp_replace(regexp_replace(practice, '(?i)\s+and\s+(?:a|an|the|its)\s.*$', ''), '[,;]', ' ', 'g'), '(^|\s)[-–—](?=\s|$)', ' ', 'g')) AS p FROM role_parts WHERE practice IS NOT NULL),
    b AS (SELECT role_id, trim(regexp_replace(p, '\s+', ' ', 'g')) AS p FROM a), c AS (SELECT role_id, regexp_replace(p, '(?i)^(?:(?:{_FILLER_SQL})(?:\s|$))+', '') AS p FROM b),
    d AS (SELECT role_id, trim(regexp_replace(p, '(?i)(?:(?:^|\s)(?:{_STRUCTURAL_SQL}))+$', '')) AS p FROM c)
    SELECT role_id, CASE WHEN length(p) >= 3 AND NOT regexp_matches(p, '(?i)^(?:(?:{_STRUCTURAL_SQL}|{"|".join(spans.JOINTS)})(?:\s|$))*$') THEN p END AS cleaned FROM d""".replace("(?=\\s|$)", "(\\s|$)")
)
def t25_clean_practice(spark, root):
    return table(spark, root, "role_parts").filter("practice is not null").select("role_id", spans.clean_practice(F.col("practice")).alias("cleaned"))


_NEVER_SQL = ", ".join(f"'{w}'" for w in slots.NOT_A_NAME)


@query(
    with_sql(
        INDEX_SQL, _PLACES_SQL,
        "pw AS (SELECT DISTINCT unnest(string_split(" + NORMAL_SQL.format(x="name") + ", ' ')) AS word FROM ref_values WHERE kind = 'practice')",
        "pn AS (SELECT DISTINCT person_name FROM extracted_moves WHERE person_name IS NOT NULL)",
        "nw AS (SELECT person_name, list_transform(list_filter(regexp_split_to_array(lower(trim(person_name)), '\\s+'), lambda x: x <> ''), lambda x: regexp_replace(x, '^[.,''’-]+|[.,''’-]+$', '', 'g')) AS w, list_filter(string_split(" + NORMAL_SQL.format(x="person_name") + ", ' '), lambda x: x <> '') AS n FROM pn)",
        "wd AS (SELECT person_name, unnest(w) AS word FROM nw)",
        "rn AS (SELECT person_name, n, place, unnest(range(1, len(n) - place + 2)) AS words FROM (SELECT person_name, n, unnest(range(1, len(n) + 1)) AS place FROM nw))",
        "sf AS (SELECT person_name, len(n) AS total, place, words, array_to_string(n[place:place + words - 1], ' ') AS surface FROM rn)",
    )
    + f"""SELECT nw.person_name, len(w) BETWEEN 2 AND 4 AND NOT regexp_matches(nw.person_name, '[0-9]') AND len(list_intersect(w, [{_NEVER_SQL}])) = 0
    AND nw.person_name NOT IN (SELECT person_name FROM wd JOIN pw ON pw.word = wd.word WHERE pw.word NOT IN ('law', 'of', 'in', 'the'))
    AND nw.person_name NOT IN (SELECT person_name FROM sf JOIN ix ON ix.surface = sf.surface WHERE place = 1 AND (words >= 2 OR words = total))
    AND nw.person_name NOT IN (SELECT person_name FROM sf JOIN pc ON pc.surface = sf.surface) AS fits FROM nw"""
)
def t31_person_slot(spark, root):
    fit = slots.fitting(people(spark, root), "person_name", firm_index(spark, root), PLACE_CODES, practice_words(spark, root)).withColumn("fits", F.lit(True))
    return people(spark, root).join(fit, "person_name", "left").select("person_name", F.coalesce("fits", F.lit(False)).alias("fits"))


_NOISE_SQL = "|".join(sorted({*slots.NAVIGATION, *(p for p in PLACE_CODES if " " not in p)}))


@query(
    rf"""WITH a AS (SELECT DISTINCT person_name, trim(regexp_replace(person_name, '\s+', ' ', 'g')) AS p FROM extracted_moves WHERE person_name IS NOT NULL),
    b AS (SELECT person_name, CASE WHEN regexp_matches(lower(p), '^(?:[.,''’-]*(?:{"|".join(names.TITLES_OF_ADDRESS)})[.,''’-]*( |$))+$') THEN p ELSE regexp_replace(p, '(?i)^(?:[.,''’-]*(?:{"|".join(names.TITLES_OF_ADDRESS)})[.,''’-]* )+', '') END AS p FROM a),
    c AS (SELECT person_name, string_split(p, ' ') AS w FROM b),
    d AS (SELECT person_name, w[least(greatest(len(w) - 1, 1), coalesce(list_position(list_transform(w, lambda x: NOT regexp_matches(lower(regexp_replace(x, '^[.,''’-]+|[.,''’-]+$', '', 'g')), '^(?:{_NOISE_SQL})$')), true), len(w))):] AS w FROM c)
    SELECT person_name, array_to_string(CASE WHEN len(w) >= 2 AND len(w) % 2 = 0 AND lower(array_to_string(w[:len(w) // 2], ' ')) = lower(array_to_string(w[len(w) // 2 + 1:], ' ')) THEN w[:len(w) // 2] ELSE w END, ' ') AS cleaned FROM d"""
)
def t32_clean_name(spark, root):
    return people(spark, root).withColumn("cleaned", slots.cleaned(F.col("person_name"), PLACE_CODES))


@query(
    with_sql(
        _PLACES_SQL,
        "u AS (SELECT item_id, string_split(" + NORMAL_SQL.format(x="replace(url, '/', ' ')") + ", ' ') AS w FROM raw_items)",
        "p AS (SELECT item_id, w, unnest(range(1, len(w) + 1)) AS place FROM u)",
        "r AS (SELECT item_id, w, place, unnest(range(1, len(w) - place + 2)) AS words FROM p)",
        "h AS (SELECT r.item_id, pc.code, row_number() OVER (PARTITION BY r.item_id ORDER BY place, words DESC) AS n FROM r JOIN pc ON pc.surface = array_to_string(w[place:place + words - 1], ' '))",
        MOVES_SQL,
    )
    + "SELECT mv.move_id, coalesce(mv.office, h.code) AS jurisdiction FROM mv LEFT JOIN (SELECT * FROM h WHERE n = 1) h ON h.item_id = mv.item_id"
)
def x13_slug_jurisdiction(spark, root):
    urls = table(spark, root, "raw_items").select("item_id", "url")
    found = gazetteer.first_hit(urls, place_index(spark), "item_id", "url").select("item_id", "code")
    return bindings.moves(spark, root).join(found, "item_id", "left").select("move_id", F.coalesce("office", "code").alias("jurisdiction"))


# --- scores, queues, rules -------------------------------------------------------------------------------------------


@query(with_sql(MOVES_SQL) + "SELECT move_id, CAST(CASE WHEN from_firm IS NULL THEN 0 ELSE 0.30 END + CASE WHEN title_to IS NULL THEN 0 ELSE 0.15 END + CASE WHEN office IS NULL THEN 0 ELSE 0.25 END + CASE WHEN practice_text IS NULL THEN 0 ELSE 0.25 END + CASE WHEN partner_tier IS NULL THEN 0 ELSE 0.05 END AS DECIMAL(4,2)) AS completeness FROM mv")
def c02_completeness(spark, root):
    present = {name: F.col(name).isNotNull() for name in confidence.COMPLETENESS}
    return bindings.moves(spark, root).select("move_id", confidence.completeness(present).cast("decimal(4,2)").alias("completeness"))


@query("SELECT needs_review, count(*) AS moves FROM (" + _SCORED_SQL + ") GROUP BY needs_review")
def c04_needs_review(spark, root):
    rows = scored(spark, root).select(confidence.needs_review(F.col("total"), F.col("n_dropped"), F.col("confidence")).alias("needs_review"))
    return rows.groupBy("needs_review").agg(F.count("*").alias("moves"))


@query("WITH " + _SCORES_SQL + " SELECT move_id_a AS move_id, move_id_b AS counterpart, 'ambiguous_pair' AS reason FROM dc WHERE decision = 'ambiguous'")
def d08_queue(spark, root):
    return pair_scores(spark, root).filter("decision = 'ambiguous'").select(F.col("move_id_a").alias("move_id"), F.col("move_id_b").alias("counterpart"), F.lit("ambiguous_pair").alias("reason"))


@query("WITH " + _SCORES_SQL + " SELECT decision, count(*) AS pairs FROM dc GROUP BY decision")
def d09_dry_run(spark, root):
    return pair_scores(spark, root).groupBy("decision").agg(F.count("*").alias("pairs"))


@query("SELECT 'superseded_has_successor' AS rule, CAST(a.move_id AS VARCHAR) AS id FROM extracted_moves a WHERE a.group_ref IS NOT NULL AND a.extracted_at < (SELECT max(extracted_at) FROM extracted_moves b WHERE b.group_ref = a.group_ref) AND a.extractor_version LIKE 'rules%'")
def i05_superseded(spark, root):
    rows = table(spark, root, "extracted_moves").filter("group_ref is not null")
    last = rows.groupBy("group_ref").agg(F.max("extracted_at").alias("last"))
    return integrity.violations(rows.join(last, "group_ref"), "move_id", {"superseded_has_successor": ~((F.col("extracted_at") < F.col("last")) & F.col("extractor_version").like("rules%"))})


@query(with_sql(CLASSIFIED_SQL) + "SELECT 'classified_has_version' AS rule, CAST(move_id AS VARCHAR) AS id FROM cm WHERE code IS NOT NULL AND NOT extractor_version LIKE '%.%'")
def i06_classified_has_version(spark, root):
    return integrity.violations(classified(spark, root).filter("code is not null"), "move_id", {"classified_has_version": F.col("extractor_version").like("%.%")})


@query("SELECT 'window_within_60_days' AS rule, CAST(o_orderkey AS VARCHAR) AS id FROM (SELECT o.o_orderkey, date_diff('day', CAST(o.o_orderdate AS DATE), max(CAST(l.l_shipdate AS DATE))) AS days FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey, o.o_orderdate) WHERE NOT days BETWEEN 0 AND 60")
def i10_window_rules(spark, root):
    last = table(spark, root, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max(F.to_date("l_shipdate")).alias("last_day"))
    rows = table(spark, root, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("first_day")).join(last, "o_orderkey")
    return integrity.violations(rows, "o_orderkey", {"window_within_60_days": F.datediff("last_day", "first_day").between(0, 60)})


@query(with_sql(_PRACTICE_SQL, _classify_sql("c1", "role_parts", "role_id", "practice")) + "SELECT 'assignment_has_a_rule' AS rule, CAST(role_id AS VARCHAR) AS id FROM c1 WHERE code = 'unclassified' AND rule_key = 'no_mapping_matched'")
def i12_assignment_rules(spark, root):
    rows = taxonomy.classify_phrases(table(spark, root, "role_parts"), practice_index(spark, root), "role_id", "practice")
    return integrity.violations(rows, "role_id", {"assignment_has_a_rule": F.col("rule_key") != "no_mapping_matched"})


@query("SELECT 'refused_has_reason' AS rule, CAST(item_id AS VARCHAR) AS id FROM (" + _gate_sql() + ") WHERE NOT passed AND reason IS NULL")
def i14_refused_has_reason(spark, root):
    return integrity.violations(f02_language_gate(spark, root), "item_id", {"refused_has_reason": F.col("passed") | F.col("reason").isNotNull()})


@query("SELECT 'child_under_parent' AS rule, lower(ref_code) AS id FROM ref_values WHERE kind = 'practice' AND NOT regexp_matches(ref_code, '^PR[0-9]{2}$')")
def i16_taxonomy_tree(spark, root):
    nodes = taxonomy.taxonomy_from_list(table(spark, root, "ref_values"))
    rule = (taxonomy.top_level(F.col("code")) == F.col("top")) & F.col("code").rlike(r"^g\d+\.pr\d{2}$")
    return integrity.violations(nodes.withColumn("leaf", F.split_part("code", F.lit("."), F.lit(2))), "leaf", {"child_under_parent": rule})


@query("SELECT 'erased_stays_erased' AS rule, CAST(move_id AS VARCHAR) AS id FROM extracted_moves WHERE lower(person_name) IN (SELECT lower(person_name) FROM extracted_moves WHERE move_id % 50 = 0)")
def i19_erased_stays_erased(spark, root):
    """Moves of people whose salted hash is on the list of the erased."""
    rows = table(spark, root, "extracted_moves").select("move_id", F.sha2(F.concat(F.lit("salt"), F.lower("person_name")), 256).alias("h"))
    erased = rows.filter("move_id % 50 = 0").select("h").distinct()
    return rows.join(erased, "h", "left_semi").select(F.lit("erased_stays_erased").alias("rule"), F.col("move_id").cast("string").alias("id"))


QUERIES, SQL = query.queries, query.sql
