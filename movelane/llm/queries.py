"""Queries of the llm operators: name -> (spark, folder) -> DataFrame, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from movelane.llm import boilerplate, canonical, components, encode, mixture, names, residue, survivor
from movelane.session import table


def p2_found(spark, root):
    return components.move_groups(table(spark, root, "pair_scores"))


def p3_found(spark, root):
    return names.links(table(spark, root, "firms"), table(spark, root, "extracted_moves"))


def p3_membership(spark, root):
    return names.person_membership(table(spark, root, "extracted_moves")).select("move_id", "person")


def p4_found(spark, root):
    return boilerplate.body_lines(table(spark, root, "raw_items")).selectExpr("item_id", "line_no")


def p6_found(spark, root):
    return survivor.surviving_values(table(spark, root, "extracted_moves"), table(spark, root, "sources")).select("group_ref", "field_name", "move_id")


def p6_currency(spark, root):
    """The moves with the timestamps of one extractor's rows withheld, so that currency has to be reasoned out for them."""
    moves = table(spark, root, "extracted_moves")
    withheld = moves.withColumn("extracted_at", F.when(~F.col("extractor_version").startswith("model"), F.col("extracted_at")))
    return survivor.surviving_values(withheld, table(spark, root, "sources")).select("group_ref", "field_name", "move_id")


def p7_found(spark, root):
    return canonical.map_values(table(spark, root, "role_parts"), table(spark, root, "ref_values"))


def p8_ids(spark, root):
    return encode.encode_documents(table(spark, root, "documents"))


def p9_positions(spark, root):
    return mixture.training_order(table(spark, root, "documents"), table(spark, root, "mix_targets"))


def p9_shares(spark, root):
    return mixture.mixture_report(table(spark, root, "documents"), table(spark, root, "mix_targets"))


def p10_found(spark, root):
    return residue.residue(table(spark, root, "documents"))


QUERIES = {f.__name__: f for f in (p2_found, p3_found, p3_membership, p4_found, p6_found, p6_currency, p7_found, p8_ids, p9_positions, p9_shares, p10_found)}
_MISSING = ", ".join("'" + m + "'" for m in survivor.MISSING)
SQL: dict[str, str] = {
    "p2_found": """
        WITH RECURSIVE d AS (SELECT least(left_move_id, right_move_id) AS a, greatest(left_move_id, right_move_id) AS b, decision, total,
            row_number() OVER (PARTITION BY least(left_move_id, right_move_id), greatest(left_move_id, right_move_id) ORDER BY scored_at DESC NULLS LAST, total DESC NULLS LAST, decision DESC NULLS LAST) AS n
            FROM pair_scores WHERE left_move_id <> right_move_id),
        e AS (SELECT a, b FROM d WHERE n = 1 AND CASE WHEN decision IS NOT NULL THEN lower(trim(decision)) = 'merge' ELSE total >= 0.85 END),
        ed AS (SELECT a AS x, b AS y FROM e UNION SELECT b, a FROM e),
        rc AS (SELECT x, x AS y FROM ed UNION SELECT rc.x, ed.y FROM rc JOIN ed ON ed.x = rc.y)
        SELECT x AS move_id, min(y) AS group_id FROM rc GROUP BY x""",
    "p6_found": f"""
        WITH s AS (SELECT slug, tier FROM (SELECT config.slug AS slug, config.reliability_tier AS tier, row_number() OVER (PARTITION BY config.slug ORDER BY register_version DESC) AS n FROM sources) WHERE n = 1),
        f AS (SELECT group_ref, move_id, source_slug, extracted_at, CASE WHEN self_confidence > 1 THEN self_confidence / 100 ELSE self_confidence END AS c, unnest(map_entries(fields)) AS e FROM extracted_moves WHERE group_ref IS NOT NULL),
        v AS (SELECT f.*, s.tier FROM f LEFT JOIN s ON s.slug = f.source_slug WHERE regexp_matches(f.e.value.value, '[\\p{{L}}\\p{{N}}]') AND lower(trim(f.e.value.value)) NOT IN ({_MISSING}) AND coalesce(f.e.value.quality, '') <> 'dropped')
        SELECT group_ref, field_name, move_id FROM (SELECT group_ref, e.key AS field_name, move_id, row_number() OVER (PARTITION BY group_ref, e.key ORDER BY tier NULLS LAST, c DESC NULLS LAST, extracted_at DESC, move_id) AS n FROM v) WHERE n = 1""",
    "p6_currency": f"""
        WITH RECURSIVE s AS (SELECT slug, tier FROM (SELECT config.slug AS slug, config.reliability_tier AS tier, row_number() OVER (PARTITION BY config.slug ORDER BY register_version DESC) AS n FROM sources) WHERE n = 1),
        f AS (SELECT group_ref, move_id, source_slug, CASE WHEN extractor_version LIKE 'model%' THEN NULL ELSE extracted_at END AS ts, CASE WHEN self_confidence > 1 THEN self_confidence / 100 ELSE self_confidence END AS c, unnest(map_entries(fields)) AS e FROM extracted_moves WHERE group_ref IS NOT NULL),
        v AS (SELECT f.group_ref AS g, f.e.key AS k, f.e.value.value AS x, f.move_id, f.ts, f.c, s.tier FROM f LEFT JOIN s ON s.slug = f.source_slug WHERE regexp_matches(f.e.value.value, '[\\p{{L}}\\p{{N}}]') AND lower(trim(f.e.value.value)) NOT IN ({_MISSING}) AND coalesce(f.e.value.quality, '') <> 'dropped'),
        dt AS (SELECT g, k, x, min(ts) AS first_at FROM v WHERE ts IS NOT NULL GROUP BY ALL),
        st AS (SELECT k, lag(x) OVER (PARTITION BY g, k ORDER BY first_at, x) AS older, x AS newer FROM dt),
        nt AS (SELECT k, least(older, newer) AS a, greatest(older, newer) AS b, sum(CASE WHEN older < newer THEN 1 ELSE -1 END) AS n FROM st WHERE older IS NOT NULL GROUP BY ALL),
        pr AS (SELECT k, CASE WHEN n > 0 THEN a ELSE b END AS older, CASE WHEN n > 0 THEN b ELSE a END AS newer FROM nt WHERE n <> 0),
        mt AS (SELECT DISTINCT v.g, v.k, v.x FROM v JOIN (SELECT DISTINCT g, k FROM v WHERE ts IS NULL) u ON u.g = v.g AND u.k = v.k),
        ed AS (SELECT a.g, a.k, a.x AS older, b.x AS newer FROM pr JOIN mt a ON a.k = pr.k AND a.x = pr.older JOIN mt b ON b.k = pr.k AND b.x = pr.newer AND b.g = a.g),
        rc AS (SELECT * FROM ed UNION SELECT rc.g, rc.k, rc.older, ed.newer FROM rc JOIN ed ON ed.g = rc.g AND ed.k = rc.k AND ed.older = rc.newer),
        cm AS (SELECT mt.g, mt.k, mt.x, least(mt.x, coalesce(min(a.newer), mt.x)) AS c FROM mt LEFT JOIN (SELECT p.* FROM rc p JOIN rc q ON q.g = p.g AND q.k = p.k AND q.older = p.newer AND q.newer = p.older) a ON a.g = mt.g AND a.k = mt.k AND a.older = mt.x GROUP BY mt.g, mt.k, mt.x),
        ce AS (SELECT DISTINCT ed.g, ed.k, o.c AS older, n.c AS newer FROM ed JOIN cm o ON o.g = ed.g AND o.k = ed.k AND o.x = ed.older JOIN cm n ON n.g = ed.g AND n.k = ed.k AND n.x = ed.newer WHERE o.c <> n.c),
        dp AS (SELECT DISTINCT g, k, c, 0 AS d FROM cm UNION SELECT ce.g, ce.k, ce.newer, dp.d + 1 FROM dp JOIN ce ON ce.g = dp.g AND ce.k = dp.k AND ce.older = dp.c),
        dv AS (SELECT cm.g, cm.k, cm.x, max(dp.d) AS depth FROM cm JOIN dp ON dp.g = cm.g AND dp.k = cm.k AND dp.c = cm.c GROUP BY ALL)
        SELECT g AS group_ref, k AS field_name, move_id FROM (SELECT v.g, v.k, v.move_id, row_number() OVER (PARTITION BY v.g, v.k ORDER BY tier NULLS LAST, c DESC NULLS LAST, ts DESC NULLS LAST, CASE WHEN ts IS NULL THEN coalesce(depth, 0) ELSE 0 END DESC, move_id) AS n FROM v LEFT JOIN dv ON dv.g = v.g AND dv.k = v.k AND dv.x = v.x) WHERE n = 1""",
}
