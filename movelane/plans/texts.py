"""Text, name, gazetteer, gate and taxonomy functions over the domain tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from movelane.functions import gazetteer, html, names, spans, taxonomy
from movelane.functions.text import fold_accents
from movelane.operators import bindings, extraction, gate
from movelane.operators.bindings import MOVES_SQL, SOURCES_SQL, with_sql
from movelane.plans.registry import Registry
from movelane.plans.relational import NORMAL_SQL
from movelane.session import table

query = Registry()

_FOLD = "lower(strip_accents(replace(replace({x}, 'ø', 'o'), 'Ø', 'O')))"
_HON, _POST, _PART = "|".join(names.HONORIFICS), "|".join(names.POST_NOMINALS), "|".join(names.PARTICLES)
_FAM = ", ".join(f"'{x}'" for x in names.FAMILY_FIRST)
NAMES_SQL = (
    r"nm0 AS (SELECT DISTINCT person_name, trim(regexp_replace(regexp_replace(regexp_replace("
    + _FOLD.format(x=r"regexp_replace(person_name, '\([^)]*\)', ' ', 'g')")
    + r", '[’''`]', '', 'g'), '[^\p{L}\p{N}_\s-]', ' ', 'g'), '\s+', ' ', 'g')) AS t FROM extracted_moves WHERE person_name IS NOT NULL), "
    + rf"nm1 AS (SELECT person_name, regexp_replace(regexp_replace(t, '^(?:(?:{_HON}) )+', ''), '^(\S+ \S+(?: \S+)*?)(?: (?:{_POST}))+$', '\1') AS t FROM nm0), "
    + "nm2 AS (SELECT person_name, t, list_filter(string_split(t, ' '), lambda x: x <> '') AS w FROM nm1), "
    + f"nm3 AS (SELECT *, len(w) > 1 AND w[1] IN ({_FAM}) AND w[len(w)] NOT IN ({_FAM}) AS turned FROM nm2), "
    + rf"nm AS (SELECT person_name, w, CASE WHEN len(w) <= 1 THEN t WHEN turned THEN w[1] ELSE regexp_extract(t, '^(\S+(?: \S+)*?) ((?:(?:{_PART}) )*\S+)$', 2) END AS sur, "
    + rf"CASE WHEN len(w) <= 1 THEN '' WHEN turned THEN array_to_string(w[2:], ' ') ELSE regexp_extract(t, '^(\S+(?: \S+)*?) ((?:(?:{_PART}) )*\S+)$', 1) END AS giv FROM nm3)"
)
_COMPACT = r"regexp_replace({x}, '[\s-]+', '', 'g')"


def people(spark, root):
    return table(spark, root, "extracted_moves").select("person_name").filter("person_name is not null").distinct()


@query(r"SELECT DISTINCT person_name, trim(regexp_replace(regexp_replace(regexp_replace(" + _FOLD.format(x="person_name") + rf", '\b(?:{_HON}|{_POST})\b', ' ', 'g'), '[^a-z0-9 ]', ' ', 'g'), '\s+', ' ', 'g')) AS hashed_form FROM extracted_moves WHERE person_name IS NOT NULL")
def t01_hash_normalise(spark, root):
    return people(spark, root).withColumn("hashed_form", names.hash_normalised(F.col("person_name")))


@query(r"SELECT DISTINCT person_name, sha256('salt' || trim(regexp_replace(regexp_replace(regexp_replace(" + _FOLD.format(x="person_name") + rf", '\b(?:{_HON}|{_POST})\b', ' ', 'g'), '[^a-z0-9 ]', ' ', 'g'), '\s+', ' ', 'g'))) AS h FROM extracted_moves WHERE person_name IS NOT NULL")
def t02_name_hash(spark, root):
    return people(spark, root).withColumn("h", names.name_hash(F.col("person_name"), "salt"))


@query("SELECT firm_id, " + _FOLD.format(x="canonical_name") + " AS folded FROM firms")
def t03_accent_fold(spark, root):
    return table(spark, root, "firms").select("firm_id", F.lower(fold_accents(F.col("canonical_name"))).alias("folded"))


@query(with_sql(NAMES_SQL) + "SELECT person_name, w AS tokens FROM nm")
def t04_name_tokens(spark, root):
    return people(spark, root).withColumn("tokens", names.name_tokens(F.col("person_name")))


@query(with_sql(NAMES_SQL) + f"SELECT person_name, {_COMPACT.format(x='sur')} AS surname_key, nullif({_COMPACT.format(x='giv')}, '') AS given_key FROM nm")
def t05_name_keys(spark, root):
    return names.with_name_keys(people(spark, root), "person_name").select("person_name", "surname_key", "given_key")


@query(with_sql(NAMES_SQL) + "SELECT person_name, list_filter(string_split(replace(giv, '-', ' '), ' '), lambda x: x <> '') AS given FROM nm")
def t07_given_tokens(spark, root):
    return names.with_name_keys(people(spark, root), "person_name").select("person_name", F.col("given_tokens").alias("given"))


@query()
def t07_name_variants(spark, root):
    return names.with_name_variants(people(spark, root), "person_name").select("person_name", "variants")


@query(r"SELECT DISTINCT person_name, nullif(trim(regexp_extract(person_name, '\(([^)]*)\)', 1)), '') AS alias FROM extracted_moves WHERE person_name IS NOT NULL")
def t08_bracketed_alias(spark, root):
    return people(spark, root).withColumn("alias", names.bracketed_alias(F.col("person_name")))


def pages(spark, root):
    """Items as pages of markup, so that the page functions have something to undo."""
    rows = table(spark, root, "raw_items").filter("body_text is not null")
    body = F.concat(F.lit("<p>"), F.replace(F.replace("body_text", F.lit("&"), F.lit("&amp;")), F.lit("\n"), F.lit("</p><p>")), F.lit("</p>"))
    head = F.replace("headline", F.lit("&"), F.lit("&amp;"))
    return rows.select("item_id", "headline", F.concat(F.lit("<html><head><title>"), head, F.lit(" | Site</title><style>p {}</style></head><body><!-- top --><h1>"), head, F.lit("</h1>"), body, F.lit("<script>x()</script></body></html>")).alias("page"))


@query()
def t09_html_to_text(spark, root):
    return pages(spark, root).select("item_id", html.html_to_text(F.col("page")).alias("text"))


_BYLINE_SQL = html.BYLINE.replace("'", "''")


@query(
    f"""WITH a AS (SELECT item_id, CASE WHEN length(headline) > 0 AND strpos(reverse(body_text), reverse(headline)) > 0 THEN substr(body_text, length(body_text) - strpos(reverse(body_text), reverse(headline)) + 2) ELSE body_text END AS t FROM raw_items WHERE body_text IS NOT NULL),
    b AS (SELECT item_id, t, regexp_extract(t, '{_BYLINE_SQL}') AS line FROM a), c AS (SELECT item_id, CASE WHEN line <> '' THEN substr(t, strpos(t, line) + length(line)) ELSE t END AS t FROM b),
    d AS (SELECT item_id, t, least("""
    + ", ".join("CASE WHEN instr(substr(lower(t), 122), '{m}') > 0 THEN instr(substr(lower(t), 122), '{m}') + 121 END".format(m=m.replace("'", "''")) for m in html.TAIL_MARKERS)
    + r""") AS cut FROM c), e AS (SELECT item_id, regexp_replace(CASE WHEN cut IS NOT NULL THEN substr(t, 1, cut - 1) ELSE t END, '^\s+|\s+$', '', 'g') AS b FROM d)
    SELECT item_id, CASE WHEN length(b) >= 120 THEN substr(b, 1, 4000) END AS body FROM e"""
)
def t10_body_trimmed(spark, root):
    rows = table(spark, root, "raw_items").filter("body_text is not null")
    return rows.select("item_id", html.body_of(F.col("body_text"), F.col("headline")).alias("body"))


@query("SELECT item_id, CASE WHEN len(string_split(h, ' ')) BETWEEN 3 AND 30 THEN h END AS title FROM (SELECT item_id, trim(regexp_replace(headline, '\\s+', ' ', 'g')) AS h FROM raw_items WHERE body_text IS NOT NULL)")
def t12_title_of(spark, root):
    return pages(spark, root).select("item_id", html.title_of(F.col("page")).alias("title"))


@query(r"SELECT item_id, upper(substr(s, 1, 1)) || substr(s, 2) AS headline_from_url FROM (SELECT item_id, nullif(trim(regexp_replace(regexp_replace(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*(?:/[^/?#]*)*?/([^/?#]*[^/?#0-9][^/?#]*)(?:/[0-9]*)*(?:[?#].*)?$', 1), '-[0-9]{4,}$', ''), '[-_]+', ' ', 'g')), '') AS s FROM raw_items)")
def t13_headline_from_slug(spark, root):
    return table(spark, root, "raw_items").select("item_id", html.headline_from_slug(F.col("url")).alias("headline_from_url"))


@query("SELECT item_id, url || '?id=' || item_id AS clean FROM raw_items")
def t14_strip_tracking(spark, root):
    tagged = F.concat("url", F.lit("?utm_source=x&id="), F.col("item_id").cast("string"), F.lit("&mc_cid=1&trk=z"))
    return table(spark, root, "raw_items").select("item_id", html.strip_tracking(tagged).alias("clean"))


@query(r"SELECT item_id, trim(regexp_replace(headline, '\s+', ' ', 'g')) AS text FROM raw_items")
def t15_strip_tags(spark, root):
    return table(spark, root, "raw_items").select("item_id", html.strip_tags(F.concat(F.lit("<b>"), "headline", F.lit("</b><br/>"))).alias("text"))


@query("SELECT firm_id, " + NORMAL_SQL.format(x="canonical_name") + " AS spaced, replace(" + NORMAL_SQL.format(x="canonical_name") + ", ' ', '') AS tight FROM firms")
def t16_firm_normalise(spark, root):
    return table(spark, root, "firms").select("firm_id", gazetteer.normal(F.col("canonical_name")).alias("spaced"), gazetteer.tight(F.col("canonical_name")).alias("tight"))


INDEX_SQL = (
    "ix AS (SELECT surface, min_by(firm_id, {'l': -length(canonical_name), 'i': firm_id}) AS code FROM (SELECT firm_id, canonical_name, "
    + NORMAL_SQL.format(x="raw")
    + " AS surface FROM (SELECT firm_id, canonical_name, unnest(list_prepend(canonical_name, aliases)) AS raw FROM firms)) WHERE surface <> '' GROUP BY surface)"
)
RUNS_OF_WORDS_SQL = (
    "tx AS (SELECT item_id, list_filter(string_split(" + NORMAL_SQL.format(x="headline") + ", ' '), lambda x: x <> '') AS w FROM raw_items), "
    "pl AS (SELECT item_id, w, unnest(range(1, len(w) + 1)) AS place FROM tx), "
    "rn AS (SELECT item_id, w, place, unnest(range(1, len(w) - place + 2)) AS words FROM pl), "
    "sf AS (SELECT item_id, place, words, array_to_string(w[place:place + words - 1], ' ') AS surface FROM rn)"
)


def firm_index(spark, root):
    return gazetteer.surface_index(table(spark, root, "firms"), "canonical_name", "aliases", "firm_id")


@query(with_sql(INDEX_SQL) + "SELECT surface, code FROM ix")
def t17_firm_index(spark, root):
    return firm_index(spark, root)


@query(with_sql(INDEX_SQL, RUNS_OF_WORDS_SQL) + "SELECT sf.item_id, CAST(sf.place AS INTEGER) AS place, CAST(sf.words AS INTEGER) AS words, sf.surface, ix.code FROM sf JOIN ix ON ix.surface = sf.surface")
def j15_gazetteer_join(spark, root):
    return gazetteer.all_hits(table(spark, root, "raw_items"), firm_index(spark, root), "item_id", "headline")


@query(with_sql(INDEX_SQL, RUNS_OF_WORDS_SQL) + "SELECT item_id, surface, code FROM (SELECT sf.item_id, sf.surface, ix.code, row_number() OVER (PARTITION BY sf.item_id ORDER BY sf.place, sf.words DESC) AS n FROM sf JOIN ix ON ix.surface = sf.surface) WHERE n = 1")
def t18_firm_find_first(spark, root):
    return gazetteer.first_hit(table(spark, root, "raw_items"), firm_index(spark, root), "item_id", "headline").select("item_id", "surface", "code")


@query(with_sql(INDEX_SQL) + "SELECT m.move_id, ix.code AS firm_id FROM (SELECT move_id, " + NORMAL_SQL.format(x="fields['to_firm'].value") + " AS s FROM extracted_moves) m JOIN ix ON ix.surface = m.s")
def t18_firm_resolve(spark, root):
    rows = table(spark, root, "extracted_moves").select("move_id", gazetteer.normal(F.col("fields")["to_firm"]["value"]).alias("surface"))
    return rows.join(firm_index(spark, root), "surface").select("move_id", F.col("code").alias("firm_id"))


# Places of the feeds, by code.
PLACES = {
    "AE": "Dubai", "AU-NSW": "Sydney", "DE": "Frankfurt", "FR": "Paris", "GB": "London", "HK": "Hong Kong", "ID": "Jakarta", "IN": "Mumbai", "JP": "Tokyo",
    "MY": "Kuala Lumpur", "NZ": "Auckland", "SG": "Singapore", "TH": "Bangkok", "US-NY": "New York",
}
_PLACES_SQL = "pc AS (SELECT * FROM (VALUES " + ", ".join(f"('{p.lower()}', '{c}')" for c, p in PLACES.items()) + ") v(surface, code))"


def place_index(spark):
    return spark.createDataFrame([(p.lower(), c) for c, p in PLACES.items()], "surface string, code string")


@query(with_sql(_PLACES_SQL, RUNS_OF_WORDS_SQL) + "SELECT item_id, code FROM (SELECT sf.item_id, pc.code, row_number() OVER (PARTITION BY sf.item_id ORDER BY sf.place, sf.words DESC) AS n FROM sf JOIN pc ON pc.surface = sf.surface) WHERE n = 1")
def t19_place_find(spark, root):
    return gazetteer.first_hit(table(spark, root, "raw_items"), place_index(spark), "item_id", "headline").select("item_id", "code")


@query("SELECT role_id, nullif(trim(regexp_replace(regexp_replace(lower(coalesce(practice, '')), '[^a-z0-9&]+', ' ', 'g'), ' +', ' ', 'g')), '') AS phrase FROM role_parts")
def t20_taxonomy_normalise(spark, root):
    return table(spark, root, "role_parts").select("role_id", taxonomy.normalise(F.col("practice")).alias("phrase"))


_PRACTICE_SQL = "px AS (SELECT " + NORMAL_SQL.format(x="name") + " AS surface, 'g' || CAST((CAST(regexp_extract(ref_code, '([0-9]+)$', 1) AS INTEGER) - 1) // 7 AS VARCHAR) || '.' || lower(ref_code) AS code FROM ref_values WHERE kind = 'practice')"


def _classify_sql(name: str, source: str, key: str, text: str) -> str:
    """Named queries that classify ``text`` of ``source`` into ``name``."""
    return (
        f"{name}w AS (SELECT {key}, " + NORMAL_SQL.format(x=text) + f" AS n FROM {source}), "
        f"{name}p AS (SELECT {key}, n, string_split(n, ' ') AS w, unnest(range(1, len(string_split(n, ' ')) + 1)) AS place FROM {name}w WHERE n <> ''), "
        f"{name}r AS (SELECT {key}, n, w, place, unnest(range(1, len(w) - place + 2)) AS words FROM {name}p), "
        f"{name}h AS (SELECT {key}, px.surface, px.code, row_number() OVER (PARTITION BY {key} ORDER BY place, words DESC) AS k FROM {name}r JOIN px ON px.surface = array_to_string(w[place:place + words - 1], ' ')), "
        f"{name} AS (SELECT {name}w.{key}, coalesce(h.code, 'unclassified') AS code, CASE WHEN h.code IS NOT NULL THEN h.surface WHEN n = '' THEN 'no_practice_text' ELSE 'no_mapping_matched' END AS rule_key, "
        f"CASE WHEN h.code IS NULL THEN 0.0 WHEN h.surface = n THEN 0.95 ELSE 0.8 END AS confidence FROM {name}w LEFT JOIN (SELECT * FROM {name}h WHERE k = 1) h ON h.{key} = {name}w.{key})"
    )


def practice_index(spark, root):
    return taxonomy.phrase_index(taxonomy.taxonomy_from_list(table(spark, root, "ref_values")))


@query(with_sql(_PRACTICE_SQL, _classify_sql("c1", "role_parts", "role_id", "practice")) + "SELECT * FROM c1")
def t21_classify_phrase(spark, root):
    return taxonomy.classify_phrases(table(spark, root, "role_parts"), practice_index(spark, root), "role_id", "practice")


@query(
    with_sql(_PRACTICE_SQL, MOVES_SQL, "tv AS (SELECT mv.move_id, mv.practice_text, i.headline FROM mv LEFT JOIN raw_items i ON i.item_id = mv.item_id)", _classify_sql("c1", "tv", "move_id", "practice_text"), _classify_sql("c2", "tv", "move_id", "headline"))
    + "SELECT c1.move_id, CASE WHEN c1.code <> 'unclassified' THEN c1.code ELSE c2.code END AS code, CASE WHEN c1.code <> 'unclassified' THEN 'stated:' || c1.rule_key WHEN c2.code <> 'unclassified' THEN 'headline:' || c2.rule_key ELSE 'no_mapping_matched' END AS rule_key, "
    "CASE WHEN c1.code <> 'unclassified' THEN c1.confidence ELSE CAST(round(c2.confidence * 0.75 + 0.0000001, 3) AS DECIMAL(4,3)) END AS confidence FROM c1 JOIN c2 ON c2.move_id = c1.move_id"
)
def t22_classify_by_evidence(spark, root):
    rows = bindings.moves(spark, root).select("move_id", "item_id", "practice_text").join(table(spark, root, "raw_items").select("item_id", "headline"), "item_id", "left")
    return taxonomy.classify_by_evidence(rows, practice_index(spark, root), "move_id", {"stated": "practice_text", "headline": "headline"})


def _about_sql(body: str) -> str:
    has = lambda x: "contains(' ' || " + NORMAL_SQL.format(x=x) + " || ' ', ' ' || " + NORMAL_SQL.format(x="nm.sur") + " || ' ')"
    cut = rf"regexp_split_to_array(regexp_replace({body}, '([.!?])\s+(\p{{Lu}})', '\1' || chr(10) || '\2', 'g'), '\n+')"
    bare = r"regexp_replace(regexp_replace({x}, '[''’]s([^\p{{L}}\p{{N}}]|$)', '\1', 'g'), '[''’`]', '', 'g')"
    return "CASE WHEN " + NORMAL_SQL.format(x="nm.sur") + f" <> '' THEN array_to_string(list_filter({cut}, lambda s: {has('s')} OR {has(bare.format(x='s'))}), ' ') END"


@query(
    with_sql(
        _PRACTICE_SQL, MOVES_SQL, NAMES_SQL,
        "tv AS (SELECT mv.move_id, mv.practice_text, i.headline, " + _about_sql("i.body_text") + " AS about FROM mv LEFT JOIN raw_items i ON i.item_id = mv.item_id LEFT JOIN nm ON nm.person_name = mv.person_name)",
        _classify_sql("c1", "tv", "move_id", "practice_text"), _classify_sql("c2", "tv", "move_id", "headline"), _classify_sql("c3", "tv", "move_id", "about"),
    )
    + "SELECT c1.move_id, CASE WHEN c1.code <> 'unclassified' THEN c1.code WHEN c2.code <> 'unclassified' THEN c2.code ELSE c3.code END AS code, "
    "CASE WHEN c1.code <> 'unclassified' THEN 'stated:' || c1.rule_key WHEN c2.code <> 'unclassified' THEN 'headline:' || c2.rule_key WHEN c3.code <> 'unclassified' THEN 'body:' || c3.rule_key ELSE 'no_mapping_matched' END AS rule_key, "
    "CASE WHEN c1.code <> 'unclassified' THEN c1.confidence WHEN c2.code <> 'unclassified' THEN CAST(round(c2.confidence * 0.75 + 0.0000001, 3) AS DECIMAL(4,3)) ELSE CAST(round(c3.confidence * 0.60 + 0.0000001, 3) AS DECIMAL(4,3)) END AS confidence "
    "FROM c1 JOIN c2 ON c2.move_id = c1.move_id JOIN c3 ON c3.move_id = c1.move_id"
)
def t22_classify_with_body(spark, root):
    """The whole chain: stated, headline, then the sentences of the body about the person."""
    people = names.with_name_keys(bindings.moves(spark, root).select("move_id", "item_id", "person_name", "practice_text"), "person_name")
    rows = people.join(table(spark, root, "raw_items").select("item_id", "headline", "body_text"), "item_id", "left")
    rows = rows.withColumn("about", extraction.sentences_about(F.array_join("surname_tokens", " "), F.col("body_text"))).select("move_id", "practice_text", "headline", "about")
    return taxonomy.classify_by_evidence(rows, practice_index(spark, root), "move_id", {"stated": "practice_text", "headline": "headline", "body": "about"})


@query()
def t24_role_parse(spark, root):
    return spans.parse_roles(table(spark, root, "role_parts"), "role_id", F.concat_ws(" in ", "title", "practice"), {place.lower(): code for code, place in PLACES.items()})


@query(
    r"""WITH t AS (SELECT move_id, lower(coalesce(fields['title_to'].value, '')) AS t FROM extracted_moves), g AS (SELECT move_id, t, replace(t, 'general counsel', 'general_c') AS u FROM t)
    SELECT move_id, regexp_matches(t, '\b(?:partner|counsel|head|chair|managing|principal|director|(?:gc|clo|silk|kc|qc|sc)\b)') AND NOT (NOT regexp_matches(t, '\b(?:partners?(?:hip)?|principal)\b')
    AND (regexp_matches(u, '\bcounsel\b') OR regexp_matches(replace(t, 'associate partner', ''), '\bassociate\b') OR regexp_matches(t, '\b(?:paralegal|trainee|secondee|graduate|intern|director of \w+|executive director|chief \w+ officer)\b'))) AS senior FROM g"""
)
def t26_senior_title(spark, root):
    return table(spark, root, "extracted_moves").select("move_id", spans.is_senior(F.col("fields")["title_to"]["value"]).alias("senior"))


_SPANS_SQL = "sp AS (SELECT m.move_id, e.key AS field_name, e.value.value AS v, e.value.span_start AS a, e.value.span_end AS b, coalesce(i.headline, '') || chr(10) || chr(10) || coalesce(i.body_text, '') AS t FROM (SELECT move_id, item_id, unnest(map_entries(fields)) AS e FROM extracted_moves) m JOIN raw_items i ON i.item_id = m.item_id)"


def spanned(spark, root):
    """Each field of a move with the whole text of its item."""
    text = F.concat(F.coalesce("headline", F.lit("")), F.lit("\n\n"), F.coalesce("body_text", F.lit("")))
    rows = table(spark, root, "extracted_moves").select("move_id", "item_id", F.explode("fields").alias("field_name", "f"))
    return rows.join(table(spark, root, "raw_items").select("item_id", text.alias("t")), "item_id").select("move_id", "field_name", "f.*", "t")


@query(
    "WITH " + _SPANS_SQL + r""", q AS (SELECT *, trim(v) AS w, '(?i)' || array_to_string(list_transform(regexp_split_to_array(trim(v), '\s+'), lambda x: regexp_escape(x)), '\s+') AS pattern FROM sp)
    SELECT move_id, field_name, CASE WHEN v IS NULL OR w = '' THEN 'dropped' WHEN a >= 0 AND a < b AND b <= length(t) AND contains(lower(strip_accents(substr(t, a + 1, b - a))), lower(strip_accents(w))) THEN 'exact' WHEN contains(lower(t), lower(w)) OR regexp_matches(t, pattern) THEN 'recovered' ELSE 'dropped' END AS quality FROM q"""
)
def t27_span_verify(spark, root):
    """Every field of every move against the whole text of its item."""
    return spanned(spark, root).select("move_id", "field_name", spans.verify(F.col("value"), F.col("span_start"), F.col("span_end"), F.col("t"))["quality"].alias("quality"))


@query("WITH " + _SPANS_SQL + " SELECT move_id, field_name, CASE WHEN coalesce(trim(v) <> '' AND a >= 0 AND a < b AND b <= length(t), false) THEN 'exact' ELSE 'dropped' END AS quality FROM sp")
def t27_span_verify_coded(spark, root):
    return spanned(spark, root).select("move_id", "field_name", spans.verify_coded(F.col("value"), F.col("span_start"), F.col("span_end"), F.col("t"))["quality"].alias("quality"))


@query("WITH " + _SPANS_SQL + r" SELECT move_id, field_name, array_to_string(string_split(trim(regexp_replace(substr(t, greatest(0, a - 60) + 1, b + 60 - greatest(0, a - 60)), '\s+', ' ', 'g')), ' ')[1:25], ' ') AS excerpt FROM sp")
def t28_excerpt(spark, root):
    return spanned(spark, root).select("move_id", "field_name", spans.excerpt(F.col("t"), F.col("span_start"), F.col("span_end")).alias("excerpt"))


@query()
def t29_sentences(spark, root):
    rows = table(spark, root, "documents").filter("text is not null")
    return rows.select("doc_id", F.posexplode(spans.sentences(F.col("text"))).alias("place", "sentence"))


@query("SELECT firm_id, alias, CASE WHEN (length(alias) <= 5 AND upper(alias) = alias AND lower(alias) <> alias) OR contains(canonical_name, list_filter(regexp_split_to_array(trim(alias), '\\s+'), lambda x: x <> '')[1]) THEN 'abbreviation' ELSE 'legacy_name' END AS alias_type FROM (SELECT firm_id, canonical_name, unnest(aliases) AS alias FROM firms)")
def t30_alias_type(spark, root):
    rows = table(spark, root, "firms").select("firm_id", "canonical_name", F.explode("aliases").alias("alias"))
    return rows.select("firm_id", "alias", spans.alias_kind(F.col("canonical_name"), F.col("alias")).alias("alias_type"))


def _gate_sql() -> str:
    hit = lambda text, patterns: f"regexp_matches({text}, '{gate.family(patterns)}')".replace("(?i)", "(?i)")
    both = "headline || chr(10) || body"
    return (
        with_sql(
            SOURCES_SQL,
            "it AS (SELECT i.item_id, coalesce(i.headline, '') AS headline, coalesce(i.body_text, '') AS body, src.tier FROM raw_items i LEFT JOIN src ON src.slug = i.source_slug)",
            f"g AS (SELECT item_id, tier, {hit(both, gate.STRONG)} AS strong, {hit('headline', gate.MOVEMENT)} AS mh, {hit('body', gate.MOVEMENT)} AS mb, {hit(both, gate.SENIORITY)} AS senior, {hit(both, gate.DISQUALIFIERS)} AS dis, {hit(both, gate.JUDICIAL)} AS jud FROM it)",
            "d AS (SELECT *, CASE WHEN strong AND NOT jud THEN true WHEN jud THEN false WHEN NOT (mh OR mb) THEN false WHEN NOT senior AND (coalesce(tier, 0) <> 1 OR dis) THEN false WHEN dis AND NOT mh THEN false ELSE true END AS passed, "
            "greatest(0, least(100, CASE WHEN strong THEN 60 ELSE 0 END + CASE WHEN mh THEN 30 WHEN mb THEN 15 ELSE 0 END + CASE WHEN senior THEN 25 ELSE 0 END - CASE WHEN dis THEN 30 ELSE 0 END - CASE WHEN jud THEN 60 ELSE 0 END)) AS points FROM g)",
        )
        + "SELECT item_id, passed, CAST(points / 100.0 AS DECIMAL(3,2)) AS score, CASE WHEN passed THEN 'relevant' WHEN jud THEN 'judicial' WHEN dis THEN 'disqualifier' WHEN NOT (mh OR mb) THEN 'no movement' ELSE 'no seniority' END AS reason FROM d"
    )


@query(_gate_sql())
def f02_language_gate(spark, root):
    rows = table(spark, root, "raw_items").select("item_id", "headline", "body_text", F.col("source_slug").alias("slug")).join(bindings.sources(spark, root).select("slug", "tier"), "slug", "left")
    return rows.select("item_id", gate.language_gate(F.col("headline"), F.col("body_text"), F.col("tier")).alias("g")).select("item_id", "g.passed", "g.score", "g.reason")


@query()
def f04_slug_gate(spark, root):
    items = table(spark, root, "raw_items").select("item_id", html.headline_from_slug(F.col("url")).alias("slug_text"))
    firms = gazetteer.hits(items, firm_index(spark, root), "item_id", "slug_text").groupBy("item_id").agg(F.sum("words").alias("firm_words"))
    places = gazetteer.first_hit(items, place_index(spark), "item_id", "slug_text").select("item_id", F.col("code").alias("place"))
    rows = items.join(firms, "item_id", "left").join(places, "item_id", "left")
    return rows.select("item_id", gate.slug_gate(F.col("slug_text"), F.col("firm_words"), F.col("place")).alias("g")).select("item_id", "g.*")


@query("SELECT item_id FROM raw_items WHERE regexp_matches(url, '^https?://') AND NOT (url IS NULL)")
def f05_regex_filter(spark, root):
    return table(spark, root, "raw_items").filter(F.col("url").rlike("^https?://")).select("item_id")


@query("SELECT firm_id FROM firms WHERE hq_jurisdiction IS DISTINCT FROM 'SG'")
def f06_null_safe(spark, root):
    return table(spark, root, "firms").filter(~F.col("hq_jurisdiction").eqNullSafe("SG")).select("firm_id")


@query("SELECT move_id FROM extracted_moves WHERE announced_date BETWEEN DATE '2025-04-10' AND DATE '2026-02-01' AND list_contains(dropped, 'to_firm')")
def f08_range_and_array(spark, root):
    return table(spark, root, "extracted_moves").filter(F.col("announced_date").between("2025-04-10", "2026-02-01") & F.array_contains("dropped", "to_firm")).select("move_id")


@query(with_sql(SOURCES_SQL) + "SELECT slug FROM src WHERE active AND blocked_reason IS NULL")
def f09_collectable(spark, root):
    return bindings.sources(spark, root).filter("active and blocked_reason is null").select("slug")


QUERIES, SQL = query.queries, query.sql
