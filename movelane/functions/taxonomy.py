"""Classification of free text into a versioned taxonomy, with the evidence that decided."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from movelane.functions import gazetteer

# Weight of the text in which a phrase was found, and the classifier's confidences.
EVIDENCE = {"stated": 1.0, "headline": 0.75, "body": 0.60}
WHOLE, PART, NOT_A_PRACTICE = 0.95, 0.80, 0.90
UNCLASSIFIED = "unclassified"
MAX_SECONDARY = 2


def taxonomy_from_list(ref_values: DataFrame, kind: str = "practice", width: int = 7) -> DataFrame:
    """(code, top, name): a two-level tree over a canonical list; level one groups ``width`` neighbours."""
    number = F.regexp_extract("ref_code", r"(\d+)$", 1).cast("int")
    rows = ref_values.filter(F.col("kind") == kind)
    top = F.concat(F.lit("g"), F.floor((number - 1) / width).cast("string"))
    return rows.select(F.concat_ws(".", top, F.lower("ref_code")).alias("code"), top.alias("top"), "name")


def normalise(text: Column) -> Column:
    """The written form of a practice phrase: lower case, '&' kept, other signs to single blanks; null if nothing is left."""
    flat = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9&]+", " "))
    return F.when(flat != "", flat)


def phrase_index(nodes: DataFrame, phrases: DataFrame | None = None) -> DataFrame:
    """(surface, code): node names and further phrases; a phrase of several nodes goes to the smallest code."""
    rows = nodes.select(gazetteer.normal(F.col("name")).alias("surface"), "code")
    if phrases is not None:
        rows = rows.unionByName(phrases.select(gazetteer.normal(F.col("phrase")).alias("surface"), "code"))
    return rows.filter("surface <> ''").groupBy("surface").agg(F.min("code").alias("code"))


def classify_phrases(texts: DataFrame, index: DataFrame, key: str, text: str) -> DataFrame:
    """(key, code, rule_key, confidence): the leftmost, longest phrase of each text decides.

    A text that is the phrase and nothing else is surer. No phrase: no_mapping_matched; null or blank text:
    no_practice_text; both are unclassified with confidence 0. Codes that are null in the index say 'not a practice'.
    """
    found = gazetteer.first_hit(texts, index, key, text).select(key, "surface", "code")
    rows = texts.select(key, gazetteer.normal(F.col(text)).alias("n")).join(found, key, "left")
    hit = F.col("surface").isNotNull()
    sure = F.when(hit & F.col("code").isNull(), NOT_A_PRACTICE).when(hit & (F.col("n") == F.col("surface")), WHOLE).when(hit, PART).otherwise(0.0)
    rule = F.when(hit, F.col("surface")).when(F.col("n") == "", "no_practice_text").otherwise("no_mapping_matched")
    return rows.select(key, F.coalesce("code", F.lit(UNCLASSIFIED)).alias("code"), rule.alias("rule_key"), sure.cast("decimal(4,3)").alias("confidence"))


def classify_by_evidence(texts: DataFrame, index: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """(key, code, rule_key, confidence): the first of stated, headline and body texts that has a phrase decides.

    ``columns`` names the text column of each kind of evidence; confidence is weighted by kind, rule_key says which.
    """
    out, first = texts.select(key), []
    for kind, weight in EVIDENCE.items():
        if kind not in columns:
            continue
        part = classify_phrases(texts, index, key, columns[kind]).filter(~F.col("rule_key").isin("no_practice_text", "no_mapping_matched"))
        name = f"_{kind}"
        out = out.join(part.select(key, F.struct("code", F.concat(F.lit(kind + ":"), "rule_key").alias("rule_key"), F.round(F.col("confidence") * F.lit(weight).cast("decimal(4,3)"), 3).cast("decimal(4,3)").alias("confidence")).alias(name)), key, "left")
        first.append(F.col(name))
    none = F.struct(F.lit(UNCLASSIFIED).alias("code"), F.lit("no_mapping_matched").alias("rule_key"), F.lit(0).cast("decimal(4,3)").alias("confidence"))
    return out.select(key, F.coalesce(*first, none).alias("c")).select(key, "c.*")


def top_level(code: Column) -> Column:
    return F.split_part(code, F.lit("."), F.lit(1))
