"""Name keys that hold across orders, hyphens, accents and affixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from movelane.functions.text import fold_accents

# Affixes and particles that decide the keys.
HONORIFICS = "mr mrs ms miss dr prof sir dame hon".split()
POST_NOMINALS = "sc kc qc llb llm jd ba ma phd faciarb ficarb".split()
TITLES_OF_ADDRESS = "dr mr mrs ms miss prof professor sir dame".split()
PARTICLES = "van von der den de del della di da das dos du la le lo ten ter bin binte binti ibn al".split()
#: Family names that may be written first; the caller may pass a longer list.
FAMILY_FIRST = "chan chen cheung chua goh ho huang kim koh kwok lam lau lee leong lim lin liu ng ong park tan tang teo wang wong wu yang yeo zhang zhao zhou nguyen tran pham sato suzuki tanaka singh kumar".split()
_CJK = r"[㐀-䶿一-鿿가-힯]"


def compact(words: Column) -> Column:
    return F.regexp_replace(F.array_join(words, ""), r"[\s-]+", "")


def name_tokens(name: Column) -> Column:
    """Lower-case tokens without bracketed alias, accents, leading honorifics and trailing post-nominals.

    A first and a last name always survive, so that a surname which is also an affix is kept.
    """
    text = F.regexp_replace(F.coalesce(name, F.lit("")), r"\([^)]*\)", " ")
    text = F.lower(F.regexp_replace(F.regexp_replace(fold_accents(text), r"[’'`]", ""), r"[^\p{L}\p{N}_\s-]", " "))
    text = F.trim(F.regexp_replace(text, r"\s+", " "))
    text = F.regexp_replace(text, rf"^(?:(?:{'|'.join(HONORIFICS)}) )+", "")
    text = F.regexp_replace(text, rf"^(\S+ \S+(?: \S+)*?)(?: (?:{'|'.join(POST_NOMINALS)}))+$", "$1")
    return F.filter(F.split(text, " "), lambda w: w != "")


def with_name_parts(frame: DataFrame, name: str, family_first: list[str] | None = None) -> DataFrame:
    """``frame`` with surname_tokens and given_tokens of the column ``name``.

    One token is a surname; a listed family name in front, with none at the end, comes first; else the surname is the
    last token with the particles before it, and at least one token stays given. Han and Hangul names split after the
    first sign. Null and empty names have no tokens.
    """
    families = family_first or FAMILY_FIRST
    rows = frame.withColumn("_w", name_tokens(F.col(name))).withColumn("_signs", F.array_join(F.regexp_extract_all(F.coalesce(F.col(name), F.lit("")), F.lit(_CJK), F.lit(0)), ""))
    w, n = F.col("_w"), F.size("_w")
    turned = (n > 1) & F.get(w, F.lit(0)).isin(families) & ~F.element_at(w, -1).isin(families)
    middle = F.reverse(F.slice(w, F.lit(2), F.greatest(n - 2, F.lit(0))))
    step = lambda acc, x: F.struct((acc["k"] + F.when(acc["open"] & x.isin(PARTICLES), 1).otherwise(0)).alias("k"), (acc["open"] & x.isin(PARTICLES)).alias("open"))
    run = F.aggregate(middle, F.struct(F.lit(0).alias("k"), F.lit(True).alias("open")), step)["k"]
    rows = rows.withColumn("_cut", F.when(F.length("_signs") > 0, F.lit(-1)).when(turned, F.lit(1)).when(n <= 1, F.lit(0)).otherwise(n - 1 - run))
    signs = F.filter(F.array(F.substring("_signs", 1, 1)), lambda x: x != "")
    rest = F.filter(F.array(F.substr(F.col("_signs"), F.lit(2))), lambda x: x != "")
    left, right = F.slice(w, F.lit(1), F.greatest(F.col("_cut"), F.lit(0))), F.slice(w, F.greatest(F.col("_cut"), F.lit(0)) + 1, F.greatest(n, F.lit(1)))
    rows = rows.withColumn("surname_tokens", F.when(F.col("_cut") < 0, signs).when(turned, left).otherwise(right))
    rows = rows.withColumn("given_tokens", F.when(F.col("_cut") < 0, rest).when(turned, right).otherwise(left))
    return rows.drop("_w", "_signs", "_cut")


def with_name_keys(frame: DataFrame, name: str, family_first: list[str] | None = None) -> DataFrame:
    """``frame`` with surname_tokens, given_tokens (split at hyphens too), surname_key and given_key (null if none)."""
    rows = with_name_parts(frame, name, family_first).withColumn("surname_key", compact(F.col("surname_tokens"))).withColumn("given_key", compact(F.col("given_tokens")))
    rows = rows.withColumn("given_tokens", F.filter(F.flatten(F.transform("given_tokens", lambda w: F.split(w, "-"))), lambda w: w != ""))
    return rows.withColumn("given_key", F.when(F.col("given_key") != "", F.col("given_key")))


def bracketed_alias(name: Column) -> Column:
    alias = F.trim(F.regexp_extract(name, r"\(([^)]*)\)", 1))
    return F.when(alias != "", alias)


def title_case(text: Column) -> Column:
    """First letter of each run of letters in capitals, also after hyphens."""
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0)), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))), "")


def with_name_variants(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` with variants: sorted spellings as written, in both orders, with given names joined, and by the alias."""
    rows = with_name_parts(frame, name)
    rows = rows.withColumn("_s", title_case(F.array_join("surname_tokens", " "))).withColumn("_g", title_case(F.array_join("given_tokens", " "))).withColumn("_f", title_case(compact(F.col("given_tokens"))))
    has = F.size("given_tokens") > 0
    joined = F.when(has & (F.lower("_f") != F.lower(F.replace("_g", F.lit(" "), F.lit("")))), F.concat_ws(" ", "_f", "_s")).when(has & F.col("_g").contains("-"), F.concat_ws(" ", F.replace("_g", F.lit("-"), F.lit("")), "_s"))
    alias = bracketed_alias(F.col(name))
    spellings = F.array(F.trim(name), F.when(has, F.concat_ws(" ", "_g", "_s")), F.when(has, F.concat_ws(" ", "_s", "_g")), joined, F.when(alias.isNotNull() & (F.col("_s") != ""), F.concat_ws(" ", alias, "_s")))
    return rows.withColumn("variants", F.array_sort(F.array_distinct(F.filter(spellings, lambda x: x.isNotNull() & (x != ""))))).drop("_s", "_g", "_f", "surname_tokens", "given_tokens")


def clean_person(name: Column, noise: list[str]) -> Column:
    """A person as captured from text, without what stood around: honorifics, words of ``noise`` in front, a second copy.

    Leading words go only while more than two are left; a name printed twice in a row counts once. ``noise`` has lower-case
    words (navigation, datelines).
    """
    words = F.filter(F.split(F.trim(name), r"\s+"), lambda w: w != "")
    bare = lambda w: F.lower(F.regexp_replace(w, r"^[.,'’-]+|[.,'’-]+$", ""))
    lead = F.array_position(F.transform(words, lambda w: ~bare(w).isin(TITLES_OF_ADDRESS)), F.lit(True)).cast("int")
    words = F.when(lead > 0, F.slice(words, lead, F.size(words))).otherwise(words)
    front = F.array_position(F.transform(words, lambda w: ~bare(w).isin(noise)), F.lit(True)).cast("int")
    start = F.greatest(F.lit(1), F.least(F.when(front > 0, front).otherwise(F.size(words)), F.size(words) - 1))
    words = F.slice(words, start, F.size(words))
    half = (F.size(words) / 2).cast("int")
    first, second = F.slice(words, F.lit(1), half), F.slice(words, half + 1, F.size(words))
    twice = (half > 0) & (F.lower(F.array_join(first, " ")) == F.lower(F.array_join(second, " ")))
    return F.array_join(F.when(twice, first).otherwise(words), " ")


def hash_normalised(name: Column) -> Column:
    """The form of a name that is hashed: folded, without affixes as whole words, punctuation or double blanks."""
    text = F.lower(fold_accents(F.coalesce(name, F.lit(""))))
    text = F.regexp_replace(text, rf"\b(?:{'|'.join(HONORIFICS + POST_NOMINALS)})\b", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"[^a-z0-9 ]", " "), r"\s+", " "))


def name_hash(name: Column, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(salt), hash_normalised(name)), 256)
