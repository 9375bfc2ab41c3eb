"""Dictionary-in-text lookup by equi-join of word runs, leftmost first and longest at each place.

Texts and surfaces are normalised alike; every run of a text that has as many words as some surface of the dictionary
is a row that meets it in a hash join, so surfaces may be of any length and the dictionary may have millions of them:
it is never compiled into one pattern.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from movelane.functions.text import fold_accents


def normal(text: Column) -> Column:
    """Folded lower-case words with single blanks; signs for 'and' and the word itself are dropped."""
    flat = F.regexp_replace(F.lower(fold_accents(F.coalesce(text, F.lit("")))), r"[^a-z0-9]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(F.concat(F.lit(" "), flat, F.lit(" ")), r" (?:and )+", " "), r" +", " "))


def tight(text: Column) -> Column:
    """The normal form with no blanks."""
    return F.replace(normal(text), F.lit(" "), F.lit(""))


def surface_index(names: DataFrame, canonical: str, aliases: str, code: str) -> DataFrame:
    """(surface, code): each normalised name and alias; one that several entries use goes to the longest canonical name.

    Null and empty surfaces are left out; ties go to the smaller code.
    """
    spelled = names.select(F.col(code).alias("code"), F.col(canonical).alias("canonical"), F.explode(F.concat(F.array(canonical), F.coalesce(F.col(aliases), F.array().cast("array<string>")))).alias("raw"))
    keyed = spelled.select("code", "canonical", normal(F.col("raw")).alias("surface")).filter("surface <> ''")
    return keyed.groupBy("surface").agg(F.min_by("code", F.struct(-F.length("canonical"), F.col("code"))).alias("code"))


def openings(index: DataFrame) -> DataFrame:
    """(opening, lengths): the first words of the surfaces of ``index``, each with the numbers of words they have."""
    words = F.split("surface", " ")
    return index.groupBy(F.get(words, F.lit(0)).alias("opening")).agg(F.collect_set(F.size(words)).alias("lengths"))


def word_runs(texts: DataFrame, index: DataFrame, key: str, text: str) -> DataFrame:
    """(key, place, words, surface): every run of a text that begins like some surface of ``index`` and is as long as one.

    A word that opens no surface is dropped before any run is built from it.
    """
    longest = index.agg(F.max(F.size(F.split("surface", " "))).alias("longest"))
    words = texts.select(F.col(key), F.filter(F.split(normal(F.col(text)), " "), lambda w: w != "").alias("w")).filter(F.size("w") > 0)
    # One row, whatever the dictionary holds; no place has to carry more words than the longest surface has.
    sized = words.join(F.broadcast(longest), F.lit(True))
    at = sized.select(key, "w", "longest", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("place"))
    at = at.select(key, "place", F.get("w", F.col("place") - 1).alias("opening"), F.slice("w", F.col("place"), F.col("longest")).alias("ahead"))
    runs = at.join(openings(index), "opening").select(key, "place", "ahead", F.explode("lengths").alias("words")).filter(F.col("words") <= F.size("ahead"))
    return runs.select(key, "place", "words", F.array_join(F.slice("ahead", F.lit(1), F.col("words")), " ").alias("surface"))


#: A list that is fixed (places, regions) may be this long to be looked up by one pattern instead of a join.
FIXED_ENTRIES = 10_000


def fixed_lookup(surfaces: dict[str, str | None]):
    """A function of a text column: the codes of the surfaces in it, leftmost first and longest at each place.

    For fixed reference lists of at most FIXED_ENTRIES entries only. A surface whose code is None takes up its words
    and gives no code.
    """
    if len(surfaces) > FIXED_ENTRIES:
        raise ValueError(f"more than {FIXED_ENTRIES} surfaces are no fixed list; use the joins")
    ordered = sorted(surfaces, key=lambda s: (-len(s), s))
    codes = F.create_map(*[F.lit(x) for s in ordered if surfaces[s] is not None for x in (s, surfaces[s])]) if any(surfaces.values()) else None

    def look(text: Column) -> Column:
        if codes is None:
            return F.array().cast("array<string>")
        # Blanks are doubled, so that neighbours don't share one.
        padded = F.concat(F.lit(" "), F.replace(normal(text), F.lit(" "), F.lit("  ")), F.lit(" "))
        pattern = " (" + "|".join(s.replace(" ", "  ") for s in ordered) + ") "
        found = F.transform(F.regexp_extract_all(padded, F.lit(pattern), F.lit(1)), lambda m: F.element_at(codes, F.replace(m, F.lit("  "), F.lit(" "))))
        return F.filter(found, lambda c: c.isNotNull())

    return look


def all_hits(texts: DataFrame, index: DataFrame, key: str, text: str) -> DataFrame:
    """(key, place, words, surface, code): every surface that occurs in a text at word borders, overlaps included."""
    return word_runs(texts, index, key, text).join(index, "surface").select(key, "place", "words", "surface", "code")


def hits(texts: DataFrame, index: DataFrame, key: str, text: str) -> DataFrame:
    """(key, place, words, surface, code) without overlaps: leftmost, then longest, then onward from its end."""
    best = all_hits(texts, index, key, text).groupBy(key, "place").agg(F.max_by(F.struct("words", "surface", "code"), "words").alias("_hit"))
    line = best.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("place", F.col("_hit").alias("h")))).alias("_all"))
    kind = line.schema["_all"].dataType
    kept = F.aggregate(
        "_all", F.struct(F.lit(0).alias("end"), F.array().cast(kind).alias("kept")),
        lambda acc, x: F.when(x["place"] > acc["end"], F.struct((x["place"] + x["h"]["words"] - 1).alias("end"), F.array_append(acc["kept"], x).alias("kept"))).otherwise(acc),
    )["kept"]
    return line.select(key, F.explode(kept).alias("_x")).select(key, "_x.place", "_x.h.words", "_x.h.surface", "_x.h.code")


def first_hit(texts: DataFrame, index: DataFrame, key: str, text: str) -> DataFrame:
    """(key, place, words, surface, code): the leftmost hit, the longest at that place."""
    found = all_hits(texts, index, key, text)
    return found.groupBy(key).agg(F.min_by(F.struct("place", "words", "surface", "code"), F.struct("place", -F.col("words"))).alias("_hit")).select(key, "_hit.*")
