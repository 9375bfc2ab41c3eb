"""Confidence, duplicates, merges, group moves, resolution, extraction and evaluation over the domain tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from movelane.functions import confidence, gazetteer, names, spans
from movelane.operators import bindings, dedupe, extraction, gate
from movelane.operators.bindings import MOVES_SQL, SOURCES_SQL, with_sql
from movelane.plans.registry import Registry
from movelane.plans.texts import _COMPACT, INDEX_SQL, NAMES_SQL, NORMAL_SQL, RUNS_OF_WORDS_SQL, _about_sql, PLACES, firm_index
from movelane.session import cut_lineage, table

query = Registry()

_SCORED_SQL = (
    with_sql(
        MOVES_SQL,
        SOURCES_SQL,
        "q AS (SELECT move_id, list_transform(list_filter(map_values(fields), lambda f: f.quality <> 'dropped'), lambda f: CASE f.quality WHEN 'exact' THEN 1.0::DOUBLE WHEN 'recovered' THEN 0.9::DOUBLE ELSE 0.0::DOUBLE END) AS s FROM extracted_moves)",
        "parts AS (SELECT mv.move_id, mv.confidence AS self_reported, mv.n_dropped, CASE src.tier WHEN 1 THEN 0.95::DOUBLE WHEN 2 THEN 0.88::DOUBLE WHEN 3 THEN 0.70::DOUBLE ELSE 0.60::DOUBLE END AS tb, "
        "CASE i.access_level WHEN 'full_public' THEN 1.0::DOUBLE WHEN 'summary' THEN 0.98::DOUBLE WHEN 'headline_only' THEN 0.88::DOUBLE ELSE 0.90::DOUBLE END AS af, "
        "(CASE WHEN from_firm IS NULL THEN 0 ELSE 0.30::DOUBLE END + CASE WHEN title_to IS NULL THEN 0 ELSE 0.15::DOUBLE END + CASE WHEN office IS NULL THEN 0 ELSE 0.25::DOUBLE END + CASE WHEN practice_text IS NULL THEN 0 ELSE 0.25::DOUBLE END + CASE WHEN partner_tier IS NULL THEN 0 ELSE 0.05::DOUBLE END) AS comp, "
        "CASE WHEN len(q.s) > 0 THEN list_sum(q.s) / len(q.s) ELSE 0 END AS spans FROM mv LEFT JOIN src ON src.slug = mv.source_slug LEFT JOIN raw_items i ON i.item_id = mv.item_id JOIN q ON q.move_id = mv.move_id)",
        "scored AS (SELECT move_id, self_reported, n_dropped, round(greatest(0, least(1, tb * af * (0.9 + 0.1 * round(spans + 1e-10, 6)) + 0.05 * comp - 0.06 * n_dropped)) + 1e-9, 3) AS total FROM parts)",
    )
    + "SELECT move_id, CAST(total AS DECIMAL(4,3)) AS total, (total < 0.85 OR n_dropped >= 2 OR coalesce(self_reported, 0) < 0.60) AS needs_review FROM scored"
)


def scored(spark, root):
    rows = bindings.moves(spark, root)
    spans = table(spark, root, "extracted_moves").select("move_id", F.transform(F.filter(F.map_values("fields"), lambda f: f["quality"] != "dropped"), lambda f: f["quality"]).alias("qualities"))
    rows = rows.join(bindings.sources(spark, root).select(F.col("slug").alias("source_slug"), "tier"), "source_slug", "left").join(table(spark, root, "raw_items").select("item_id", "access_level"), "item_id", "left").join(spans, "move_id")
    present = confidence.completeness({name: F.col(name).isNotNull() for name in confidence.COMPLETENESS})
    return rows.withColumn("total", confidence.total(confidence.tier_base(F.col("tier")), confidence.access_factor(F.col("access_level")), present, confidence.span_quality(F.col("qualities")), F.col("n_dropped"), F.lit(1)))


@query(_SCORED_SQL)
def c01_confidence(spark, root):
    return scored(spark, root).select("move_id", "total", confidence.needs_review(F.col("total"), F.col("n_dropped"), F.col("confidence")).alias("needs_review"))


@query("SELECT group_ref, CAST(least(10, 4 * greatest(0, count(DISTINCT source_slug) - 1)) AS INTEGER) AS bonus_hundredths FROM extracted_moves WHERE group_ref IS NOT NULL GROUP BY group_ref")
def c03_corroboration(spark, root):
    rows = table(spark, root, "extracted_moves").filter("group_ref is not null").groupBy("group_ref").agg(F.count_distinct("source_slug").alias("n"))
    return rows.select("group_ref", F.round(confidence.corroboration_bonus(F.col("n")) * 100).cast("int").alias("bonus_hundredths"))


_BLOCKS_SQL = (
    NAMES_SQL
    + ", "
    + MOVES_SQL
    + f", cd AS (SELECT mv.move_id, mv.to_firm_id, mv.announced_date, mv.from_firm, mv.office, mv.title_to, {_COMPACT.format(x='nm.sur')} AS skey, nullif({_COMPACT.format(x='nm.giv')}, '') AS gkey, "
    + "list_filter(string_split(replace(nm.giv, '-', ' '), ' '), lambda x: x <> '') AS gt, "
    + r"nullif(lower(regexp_replace(trim(regexp_extract(mv.person_name, '\(([^)]*)\)', 1)), '[\s-]+', '', 'g')), '') AS akey FROM mv JOIN nm ON nm.person_name = mv.person_name WHERE mv.to_firm_id IS NOT NULL AND mv.announced_date IS NOT NULL), "
    + "pr AS (SELECT a.move_id AS move_id_a, b.move_id AS move_id_b, a.to_firm_id, CAST(abs(date_diff('day', a.announced_date, b.announced_date)) AS INTEGER) AS days_apart, a.gkey AS ga, b.gkey AS gb, a.akey AS aa, b.akey AS ab, a.gt[1] AS fa, b.gt[1] AS fb, "
    + "a.from_firm AS oa, b.from_firm AS ob, a.office AS ja, b.office AS jb, a.title_to AS ta, b.title_to AS tb FROM cd a JOIN cd b ON a.skey = b.skey AND a.to_firm_id = b.to_firm_id AND a.move_id < b.move_id WHERE a.skey <> '' AND abs(date_diff('day', a.announced_date, b.announced_date)) <= 60)"
)
_SCORES_SQL = (
    _BLOCKS_SQL
    + """, lb AS (SELECT *, CASE WHEN len(list_intersect(list_filter([ga, aa], lambda x: x IS NOT NULL), list_filter([gb, ab], lambda x: x IS NOT NULL))) > 0 THEN 'shared' WHEN ga IS NULL OR gb IS NULL THEN 'unknown' WHEN fa = fb THEN 'first'
    WHEN (length(fa) = 1 AND starts_with(fb, fa)) OR (length(fb) = 1 AND starts_with(fa, fb)) THEN 'initial' ELSE 'disagree' END AS given_label FROM pr),
    pt AS (SELECT *, CASE given_label WHEN 'shared' THEN 8500 WHEN 'first' THEN 7650 WHEN 'initial' THEN 6375 ELSE 0 END + CASE WHEN oa IS NULL OR ob IS NULL THEN 0 WHEN lower(oa) = lower(ob) THEN 1000 ELSE -1500 END
    + CASE WHEN ja IS NULL OR jb IS NULL THEN 0 WHEN lower(ja) = lower(jb) THEN 500 ELSE -1000 END + CASE WHEN ta IS NOT NULL AND tb IS NOT NULL AND lower(ta) = lower(tb) THEN 500 ELSE 0 END + CAST(round(500 * (1 - days_apart / 60.0)) AS INTEGER) AS raw FROM lb),
    sc AS (SELECT *, CASE WHEN given_label = 'disagree' THEN 0 WHEN given_label = 'unknown' THEN 4250 ELSE greatest(0, least(10000, raw)) END AS points FROM pt),
    dc AS (SELECT move_id_a, move_id_b, to_firm_id, days_apart, given_label, CAST(points / 10000.0 AS DECIMAL(5,4)) AS total, CASE WHEN given_label = 'disagree' THEN 'distinct' WHEN given_label = 'unknown' THEN 'ambiguous' WHEN points >= 8500 THEN 'merge' WHEN points >= 6000 THEN 'ambiguous' ELSE 'distinct' END AS decision FROM sc)"""
)
_COMPONENTS_SQL = "WITH RECURSIVE " + _SCORES_SQL + ", ed AS (SELECT move_id_a AS x, move_id_b AS y FROM dc WHERE decision = 'merge' UNION SELECT move_id_b, move_id_a FROM dc WHERE decision = 'merge'), rc AS (SELECT x, x AS y FROM ed UNION SELECT rc.x, ed.y FROM rc JOIN ed ON ed.x = rc.y), cp AS (SELECT x AS move_id, min(y) AS component FROM rc GROUP BY x) "


def pair_scores(spark, root):
    return dedupe.score_pairs(dedupe.candidate_pairs(dedupe.candidates(bindings.moves(spark, root))))


@query("WITH " + _BLOCKS_SQL + " SELECT to_firm_id, skey AS surname_key, count(*) AS moves FROM cd WHERE skey <> '' GROUP BY to_firm_id, skey HAVING count(*) > 1")
def d01_blocks(spark, root):
    return dedupe.candidates(bindings.moves(spark, root)).groupBy("to_firm_id", "surname_key").agg(F.count("*").alias("moves")).filter("moves > 1")


@query("WITH " + _BLOCKS_SQL + " SELECT move_id_a, move_id_b, days_apart FROM pr")
def j05_blocked_range_join(spark, root):
    return dedupe.candidate_pairs(dedupe.candidates(bindings.moves(spark, root))).select("move_id_a", "move_id_b", "days_apart")


@query("WITH " + _SCORES_SQL + " SELECT given_label, count(*) AS pairs FROM dc GROUP BY given_label")
def d02_given_compare(spark, root):
    return pair_scores(spark, root).groupBy("given_label").agg(F.count("*").alias("pairs"))


@query("WITH " + _SCORES_SQL + " SELECT * FROM dc")
def d03_pair_scores(spark, root):
    return pair_scores(spark, root)


def components(spark, root):
    return dedupe.block_components(pair_scores(spark, root).filter("decision = 'merge'"))


@query(_COMPONENTS_SQL + "SELECT move_id, component FROM cp")
def d04_components(spark, root):
    return components(spark, root)


@query(_COMPONENTS_SQL + "SELECT move_id_a, move_id_b FROM dc WHERE decision = 'ambiguous' AND move_id_a NOT IN (SELECT move_id FROM cp) AND move_id_b NOT IN (SELECT move_id FROM cp)")
def d05_ambiguous_left(spark, root):
    scores = cut_lineage(pair_scores(spark, root))
    merged = dedupe.block_components(scores.filter("decision = 'merge'")).select("move_id")
    rows = scores.filter("decision = 'ambiguous'").select("move_id_a", "move_id_b")
    return rows.join(merged, F.col("move_id_a") == F.col("move_id"), "left_anti").join(merged, F.col("move_id_b") == F.col("move_id"), "left_anti")


_MERGED_FIELDS = ["from_firm", "title_to", "office", "practice_text"]
_MERGED_SQL = (
    _COMPONENTS_SQL.rstrip()
    + ", "
    + SOURCES_SQL
    + ", ms AS (SELECT cp.component, mv.*, {'t': coalesce(src.tier, 99), 'c': -coalesce(mv.confidence, -1), 'i': mv.move_id} AS rank FROM cp JOIN mv ON mv.move_id = cp.move_id LEFT JOIN src ON src.slug = mv.source_slug) "
)


def merged(spark, root):
    return dedupe.merged_records(bindings.moves(spark, root), components(spark, root), bindings.sources(spark, root).select("slug", "tier"), _MERGED_FIELDS)


@query(
    _MERGED_SQL
    + "SELECT component, min_by(move_id, rank) AS winner, count(*) AS members, min(announced_date) AS announced_date, count(DISTINCT source_slug) AS sources, "
    + ", ".join(f"min_by({f}, rank) FILTER (WHERE {f} IS NOT NULL) AS {f}" for f in _MERGED_FIELDS)
    + ", greatest("
    + ", ".join(f"count(DISTINCT {f})" for f in _MERGED_FIELDS)
    + ") > 1 AS pending FROM ms GROUP BY component"
)
def d06_merged(spark, root):
    return merged(spark, root).drop("conflicts")


@query(_MERGED_SQL + ", bs AS (SELECT component, min_by(title_to, rank) FILTER (WHERE title_to IS NOT NULL) AS best FROM ms GROUP BY component) SELECT DISTINCT ms.component, ms.title_to AS lost FROM ms JOIN bs ON bs.component = ms.component WHERE ms.title_to IS NOT NULL AND ms.title_to <> bs.best")
def d06_lost_titles(spark, root):
    return merged(spark, root).select("component", F.explode(F.col("conflicts")["title_to"]).alias("lost"))


_TEAM_SQL = """WITH RECURSIVE tm AS (SELECT l.l_suppkey % 20 AS to_firm, p.l_suppkey % 20 AS from_firm, CAST(o.o_orderdate AS DATE) AS d, o.o_custkey AS person, CAST(l.l_suppkey % 5 AS VARCHAR) AS office
    FROM orders o JOIN (SELECT l_orderkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1) l ON l.l_orderkey = o.o_orderkey JOIN (SELECT l_orderkey, max(l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1) p ON p.l_orderkey = o.o_orderkey),
    ok AS (SELECT * FROM tm WHERE to_firm <> from_firm), an AS (SELECT to_firm, from_firm, min(d) AS first_day FROM ok GROUP BY 1, 2
    UNION SELECT an.to_firm, an.from_firm, (SELECT min(ok.d) FROM ok WHERE ok.to_firm = an.to_firm AND ok.from_firm = an.from_firm AND ok.d > an.first_day + 60) AS first_day FROM an WHERE an.first_day IS NOT NULL),
    sp AS (SELECT *, lead(first_day) OVER (PARTITION BY to_firm, from_firm ORDER BY first_day) AS nxt FROM an WHERE first_day IS NOT NULL)
    SELECT sp.to_firm, sp.from_firm, sp.first_day, max(ok.d) AS last_day, count(DISTINCT ok.person) AS people, CASE WHEN min(ok.office) = max(ok.office) THEN min(ok.office) END AS office
    FROM sp JOIN ok ON ok.to_firm = sp.to_firm AND ok.from_firm = sp.from_firm AND ok.d >= sp.first_day AND (sp.nxt IS NULL OR ok.d < sp.nxt) GROUP BY 1, 2, 3 HAVING count(DISTINCT ok.person) >= 2"""


@query(_TEAM_SQL)
def d07_group_moves(spark, root):
    """Orders as moves between the suppliers of their lines, so that windows of every length occur."""
    lines = table(spark, root, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_suppkey").alias("lo"), F.max("l_suppkey").alias("hi"))
    rows = table(spark, root, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("announced_date"), F.col("o_custkey").alias("person")).join(lines, "o_orderkey")
    return dedupe.group_moves(rows.select((F.col("lo") % 20).alias("to_firm"), (F.col("hi") % 20).alias("from_firm"), "announced_date", "person", (F.col("lo") % 5).cast("string").alias("office")))


@query(
    with_sql(INDEX_SQL, "tf AS (SELECT move_id, fields['to_firm'].value AS raw FROM extracted_moves)")
    + "SELECT move_id, coalesce(e.firm_id, a.firm_id) AS firm_id, CASE WHEN e.firm_id IS NOT NULL THEN 'name' WHEN a.firm_id IS NOT NULL THEN 'alias' ELSE 'new' END AS how FROM tf LEFT JOIN (SELECT lower(trim(canonical_name)) AS k, min(firm_id) AS firm_id FROM firms GROUP BY 1) e ON e.k = lower(trim(tf.raw)) "
    "LEFT JOIN (SELECT k, min(firm_id) AS firm_id FROM (SELECT firm_id, lower(trim(unnest(aliases))) AS k FROM firms) GROUP BY k HAVING count(DISTINCT firm_id) = 1) a ON a.k = lower(trim(tf.raw))"
)
def x14_firm_resolution(spark, root):
    firms = table(spark, root, "firms")
    exact = firms.groupBy(F.lower(F.trim("canonical_name")).alias("k")).agg(F.min("firm_id").alias("by_name"))
    alias = firms.select("firm_id", F.explode("aliases").alias("a")).groupBy(F.lower(F.trim("a")).alias("k")).agg(F.min("firm_id").alias("by_alias"), F.count_distinct("firm_id").alias("n")).filter("n = 1").drop("n")
    rows = table(spark, root, "extracted_moves").select("move_id", F.lower(F.trim(F.col("fields")["to_firm"]["value"])).alias("k"))
    how = F.when(F.col("by_name").isNotNull(), "name").when(F.col("by_alias").isNotNull(), "alias").otherwise("new")
    return rows.join(exact, "k", "left").join(alias, "k", "left").select("move_id", F.coalesce("by_name", "by_alias").alias("firm_id"), how.alias("how"))


@query(with_sql(NAMES_SQL) + f", pk AS (SELECT {_COMPACT.format(x='sur')} || '|' || {_COMPACT.format(x='giv')} AS k, person_name FROM nm), rep AS (SELECT k, min(m.move_id) AS person_id FROM pk JOIN extracted_moves m ON m.person_name = pk.person_name GROUP BY k) SELECT m.move_id, rep.person_id FROM extracted_moves m JOIN pk ON pk.person_name = m.person_name JOIN rep ON rep.k = pk.k".replace(" , pk", ", pk"))
def x15_person_resolution(spark, root):
    rows = names.with_name_keys(table(spark, root, "extracted_moves").select("move_id", "person_name").filter("person_name is not null"), "person_name")
    keyed = rows.select("move_id", F.concat_ws("|", "surname_key", F.coalesce("given_key", F.lit(""))).alias("k"))
    return keyed.join(keyed.groupBy("k").agg(F.min("move_id").alias("person_id")), "k").select("move_id", "person_id")


@query(_SCORED_SQL.replace("SELECT move_id, CAST(total AS DECIMAL(4,3)) AS total, (total < 0.85 OR n_dropped >= 2 OR coalesce(self_reported, 0) < 0.60) AS needs_review FROM scored", "SELECT s.move_id, CASE WHEN s.total < 0.85 OR n_dropped >= 2 OR coalesce(self_reported, 0) < 0.60 THEN 'low_confidence' ELSE 'unclassified_practice' END AS reason FROM scored s JOIN (SELECT move_id AS m, practice_text FROM mv) p ON p.m = s.move_id WHERE s.total < 0.85 OR n_dropped >= 2 OR coalesce(self_reported, 0) < 0.60 OR p.practice_text IS NULL"))
def x16_review_routing(spark, root):
    rows = scored(spark, root)
    review = confidence.needs_review(F.col("total"), F.col("n_dropped"), F.col("confidence"))
    return rows.withColumn("reason", F.when(review, "low_confidence").when(F.col("practice_text").isNull(), "unclassified_practice")).filter("reason is not null").select("move_id", "reason")


@query(with_sql(NAMES_SQL) + f"SELECT m.move_id, sha256(CAST(m.item_id AS VARCHAR) || '|' || {_COMPACT.format(x='nm.sur')} || '|' || CAST(row_number() OVER (PARTITION BY m.item_id ORDER BY m.move_id) - 1 AS VARCHAR)) AS fingerprint FROM extracted_moves m JOIN nm ON nm.person_name = m.person_name")
def x12_fingerprint(spark, root):
    """The slot of a move is its place among the moves of its item that name a person."""
    rows = names.with_name_keys(table(spark, root, "extracted_moves").select("move_id", "item_id", "person_name").filter("person_name is not null"), "person_name")
    slot = F.row_number().over(Window.partitionBy("item_id").orderBy("move_id")) - 1
    return rows.select("move_id", extraction.fingerprint(F.col("item_id"), F.col("surname_key"), slot).alias("fingerprint"))


_PAIR_SQL = (
    "WITH RECURSIVE "
    + ", ".join([INDEX_SQL, RUNS_OF_WORDS_SQL])
    + ", al AS (SELECT sf.item_id, sf.place, sf.words, ix.code FROM sf JOIN ix ON ix.surface = sf.surface), "
    "be AS (SELECT item_id, place, max(words) AS words, max_by(code, words) AS code FROM al GROUP BY item_id, place), "
    "nx AS (SELECT b.item_id, b.place, b.words, b.code, min(c.place) AS then FROM be b LEFT JOIN be c ON c.item_id = b.item_id AND c.place >= b.place + b.words GROUP BY ALL), "
    "wk AS (SELECT nx.* FROM nx JOIN (SELECT item_id, min(place) AS p FROM be GROUP BY item_id) f ON f.item_id = nx.item_id AND f.p = nx.place UNION ALL SELECT nx.* FROM wk JOIN nx ON nx.item_id = wk.item_id AND nx.place = wk.then) "
)


@query(_PAIR_SQL + "SELECT wk.item_id, CAST(wk.place AS INTEGER) AS place, CAST(wk.words AS INTEGER) AS words, array_to_string(tx.w[wk.place:wk.place + wk.words - 1], ' ') AS surface, wk.code FROM wk JOIN tx ON tx.item_id = wk.item_id")
def t18_firm_find_all(spark, root):
    return gazetteer.hits(table(spark, root, "raw_items"), firm_index(spark, root), "item_id", "headline")


@query(
    _PAIR_SQL
    + f""", cu AS (SELECT wk.item_id, wk.place, wk.code, CASE WHEN regexp_matches(array_to_string(tx.w[1:wk.place - 1], ' ') || ' ', '{extraction.LOSES_BEFORE}') OR regexp_matches(' ' || array_to_string(tx.w[wk.place + wk.words:], ' '), '{extraction.LOSES_BEHIND}') THEN 'loses'
    WHEN regexp_matches(array_to_string(tx.w[1:wk.place - 1], ' ') || ' ', '{extraction.GAINS_BEFORE}') THEN 'gains' END AS cue FROM wk JOIN tx ON tx.item_id = wk.item_id),
    ls AS (SELECT item_id, min_by(code, place) FILTER (WHERE cue = 'loses') AS loser, min_by(code, place) FILTER (WHERE cue = 'gains') AS winner FROM cu GROUP BY item_id),
    ds AS (SELECT ls.item_id, loser, coalesce(winner, min_by(cu.code, cu.place) FILTER (WHERE loser IS NULL OR cu.code <> loser)) AS destination FROM ls JOIN cu ON cu.item_id = ls.item_id GROUP BY ls.item_id, loser, winner)
    SELECT ds.item_id, destination, coalesce(loser, min_by(cu.code, cu.place) FILTER (WHERE destination IS NULL OR cu.code <> destination)) AS origin FROM ds JOIN cu ON cu.item_id = ds.item_id GROUP BY ds.item_id, loser, destination"""
)
def x05_firm_direction(spark, root):
    return extraction.firm_direction(table(spark, root, "raw_items").select("item_id", "headline"), firm_index(spark, root), "item_id", "headline")


@query(r"SELECT item_id, regexp_extract(headline, '^(.+?) hires (.+?) from (.+)$', 1) AS firm, regexp_extract(headline, '^(.+?) hires (.+?) from (.+)$', 2) AS person, regexp_extract(headline, '^(.+?) hires (.+?) from (.+)$', 3) AS origin FROM raw_items WHERE regexp_matches(headline, '^(.+?) hires (.+?) from (.+)$')")
def x05_hire_slots(spark, root):
    """The three slots of the plainest headline, which the evaluation takes for expected."""
    shape = r"^(.+?) hires (.+?) from (.+)$"
    rows = table(spark, root, "raw_items").filter(F.col("headline").rlike(shape))
    return rows.select("item_id", *[F.regexp_extract("headline", shape, i).alias(n) for i, n in ((1, "firm"), (2, "person"), (3, "origin"))])


@query(
    r"SELECT item_id, CASE WHEN regexp_matches(headline, '(?i)\b(?:absorb(?:s|ed|ing)?|merg(?:er|es?|ing) with|combin(?:ation|es?) with|tie-?up with)\b') THEN 'merger_absorbed' WHEN regexp_matches(headline, '(?i)\b(?:promot(?:es?|ed|ing|ion) .{0,60}?to .{0,20}?partner|elevat(?:es?|ed|ing) .{0,60}?to .{0,20}?partner|promotions? round|partnership promotions?)') THEN 'promotion' ELSE 'lateral' END AS move_type FROM raw_items"
)
def x08_move_type(spark, root):
    return table(spark, root, "raw_items").select("item_id", extraction.move_type(F.col("headline"), F.lit(None)).alias("move_type"))


def practice_words(spark, root):
    """The words of practice names, a fixed list; 'law' is a surname too."""
    rows = table(spark, root, "ref_values").filter("kind = 'practice'").select(F.explode(F.split(gazetteer.normal(F.col("name")), " ")).alias("word"))
    return sorted(r.word for r in rows.filter("word not in ('law', 'of', 'in', 'the')").distinct().limit(gazetteer.FIXED_ENTRIES).collect())


PLACE_CODES = {place.lower(): code for code, place in PLACES.items()}


def gated(spark, root):
    """Items that pass the language gate at the tier of their source, with what extraction reads."""
    src = bindings.sources(spark, root).select(F.col("slug").alias("source_slug"), "tier", (F.col("adapter") == "sitemap").alias("entity_slug"))
    items = table(spark, root, "raw_items").select("item_id", "headline", F.col("body_text").alias("body"), "url", "access_level", "source_slug").join(src, "source_slug", "left")
    passed = items.filter(gate.language_gate(F.col("headline"), F.col("body"), F.col("tier"))["passed"])
    return passed.drop("source_slug").withColumn("entity_slug", F.coalesce("entity_slug", F.lit(False)))


def extracted(spark, root):
    return extraction.extract_moves(gated(spark, root), firm_index(spark, root), PLACE_CODES, practice_words(spark, root))


@query()
def x01_extract_moves(spark, root):
    return extracted(spark, root)


@query()
def x02_headline_moves(spark, root):
    """Headlines alone: role parse, partner test and both firms, none of the body."""
    firms = firm_index(spark, root)
    return extraction.headline_moves(cut_lineage(extraction.read_headlines(gated(spark, root), firms, PLACE_CODES)), firms, PLACE_CODES, practice_words(spark, root))


@query()
def x03_body_proposals(spark, root):
    """What the sentences of bodies propose before any guard."""
    return extraction.body_proposals(gated(spark, root).select("item_id", "body"), firm_index(spark, root)).drop("clause", "sentence")


@query()
def x04_body_moves(spark, root):
    """Bodies read under all guards, whether or not the headline has a move."""
    firms = cut_lineage(firm_index(spark, root))
    read = cut_lineage(extraction.read_headlines(gated(spark, root), firms, PLACE_CODES))
    proposals = cut_lineage(extraction.body_proposals(read.select("item_id", "body"), firms))
    return extraction.body_moves(extraction.with_origins(read, proposals), proposals, firms, PLACE_CODES, practice_words(spark, root))


@query()
def x04_slug_contradicts(spark, root):
    """Moves whose item's url names someone else who stands in the body, over all sources."""
    items = table(spark, root, "raw_items").select("item_id", "url", F.col("body_text").alias("body"))
    rows = table(spark, root, "extracted_moves").select("item_id", F.col("person_name").alias("person")).join(items, "item_id")
    return extraction.slug_contradicts(rows, firm_index(spark, root), PLACE_CODES, practice_words(spark, root))


@query(
    with_sql(MOVES_SQL, NAMES_SQL, "ab AS (SELECT mv.move_id, " + _about_sql("i.body_text") + " AS about FROM mv JOIN raw_items i ON i.item_id = mv.item_id JOIN nm ON nm.person_name = mv.person_name)")
    + "SELECT move_id, about FROM ab WHERE about IS NOT NULL AND about <> ''"
)
def x06_sentences_about(spark, root):
    """The sentences of an item's body about the person of a move."""
    people = names.with_name_keys(bindings.moves(spark, root).select("move_id", "item_id", "person_name"), "person_name")
    rows = people.join(table(spark, root, "raw_items").select("item_id", "body_text"), "item_id")
    return rows.select("move_id", extraction.sentences_about(F.array_join("surname_tokens", " "), F.col("body_text")).alias("about")).filter("about is not null and about <> ''")


@query()
def x06_practice_near(spark, root):
    """The practice that an item's body states near the person of a move."""
    rows = bindings.moves(spark, root).select("move_id", "item_id", "person_name").join(table(spark, root, "raw_items").filter("body_text is not null").select("item_id", "body_text"), "item_id")
    return rows.select("move_id", extraction.practice_near(F.col("person_name"), spans.sentences(F.col("body_text"))).alias("practice")).filter("practice is not null")


@query(
    with_sql(INDEX_SQL, "rw AS (SELECT move_id, list_filter(string_split(" + NORMAL_SQL.format(x="fields['to_firm'].value || chr(39) || 's newest office'") + ", ' '), lambda x: x <> '') AS w FROM extracted_moves)", "pf AS (SELECT move_id, w, unnest(range(1, len(w) + 1)) AS n FROM rw)")
    + "SELECT pf.move_id, max_by(ix.code, pf.n) AS code FROM pf JOIN ix ON ix.surface = array_to_string(pf.w[1:pf.n], ' ') GROUP BY pf.move_id"
)
def x07_leading_firm(spark, root):
    """Firms resolved at the start of a text that goes on: the longest surface, a possessive and further words behind it."""
    rows = table(spark, root, "extracted_moves").select("move_id", F.concat(F.col("fields")["to_firm"]["value"], F.lit("'s newest office")).alias("text"))
    found = gazetteer.all_hits(rows, firm_index(spark, root), "move_id", "text").filter("place = 1")
    return found.groupBy("move_id").agg(F.max_by("code", "words").alias("code"))


@query()
def x09_enriched(spark, root):
    """Headline moves with the practice and origin that only the body states."""
    firms = cut_lineage(firm_index(spark, root))
    read = cut_lineage(extraction.read_headlines(gated(spark, root), firms, PLACE_CODES))
    told = cut_lineage(extraction.headline_moves(read, firms, PLACE_CODES, practice_words(spark, root)))
    return extraction.enriched(told, extraction.with_origins(read, extraction.body_proposals(read.select("item_id", "body"), firms)))


@query()
def e01_evaluation(spark, root):
    """Extraction against the slots of the headlines that name a hire, the firms of both through the gazetteer."""
    hires, firms = x05_hire_slots(spark, root), firm_index(spark, root)
    code = lambda c: hires.select("item_id", gazetteer.normal(F.col(c)).alias("surface")).join(firms, "surface").select("item_id", F.col("code").alias(c))
    expected = hires.select("item_id", F.lower("person").alias("person")).join(code("firm"), "item_id", "left").join(code("origin"), "item_id", "left")
    predicted = extracted(spark, root).filter("part = 'headline'").join(hires.select("item_id"), "item_id", "left_semi").select("item_id", F.lower("person").alias("person"), F.col("to_firm").alias("firm"), F.col("from_firm").alias("origin"))
    return extraction.evaluate(predicted, expected, ["item_id", "person"], ["firm", "origin"])


QUERIES, SQL = query.queries, query.sql
