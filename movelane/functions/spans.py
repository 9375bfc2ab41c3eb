"""Spans, excerpts, sentences and role clauses.

A role clause ("co-head of its disputes practice in Hong Kong") is read as an array of words: the title is a head noun
with the qualifiers that lead up to it, the practice is what stands between a preposition and a unit (team, practice,
group) or the end. Everything is array functions on words, so a clause of any length is read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from movelane.functions import gazetteer
from movelane.functions.text import fold_accents

PADDING, MAX_WORDS = 60, 25
# The words that decide what is a title, a practice, or neither.
HEADS = "partner partners principal principals counsel head heads chair chairs chairman chairmen chairwoman chairwomen director directors silk silks".split()
QUALIFIERS = "managing senior junior equity salaried fixed-share consulting regional global national local deputy acting interim executive co vice assistant associate general special of".split()
PREFIXES = "co vice deputy".split()
PREPOSITIONS = "in on of to within for".split()
UNITS = "practice team group department division bench".split()
FILLERS = "of in on for to at the its a an their new newest".split()
OPENERS = "a an the its their his her new newest first second next firm firms company companys".split()
STRUCTURAL = "office offices partnership partner partners firm team group practice role position market region business leadership succession round promotion promotions company bench seat charge board".split()
JOINTS = "and & the of its".split()
#: A clause ends where a reason, a time or a relative clause begins.
ENDS = ["as part of", "in planned", "to boost", "to expand", "to lead", "amid", "after", "following", "ahead of", "while", "which", "who", "that"]
SENIOR_STEMS = "partner counsel head chair managing principal director".split()
SENIOR_LETTERS = "gc clo silk kc qc sc".split()
PARTNER_WORDS = "partner partners partnership partnerships principal".split()
JUNIORS = "paralegal trainee secondee graduate intern".split()
#: Regions that are no place of their own; a practice named by one is none.
REGIONS = ["asia", "asia pacific", "apac", "europe", "emea", "middle east", "africa", "americas", "latin america", "north america", "south asia", "southeast asia", "greater china"]


def _one_of(words: list[str]):
    return lambda w: w.isin(words)


def role_words(text: Column) -> Column:
    """The words of a clause in lower case; hyphens and '&' stay inside, apostrophes fall out, commas are words."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), r"['’`]", ""), ",", " , ")
    plain = F.regexp_replace(F.regexp_replace(plain, r"[^\p{L}\p{N}&,\s-]+", " "), r"\s*[-–—]\s*(?=\S)", "-")
    return F.filter(F.split(plain, r"\s+"), lambda w: (w != "") & (w != "-"))


def is_senior(title: Column) -> Column:
    """True for a partner-level title. A form below partner decides, unless the title also says partner.

    Below partner: counsel that is not general counsel, an associate who is no associate partner, a director of
    something or an executive director, a chief officer, and juniors. Null and empty titles are not senior.
    """
    w = role_words(F.coalesce(title, F.lit("")))
    pairs = F.transform(w, lambda x, i: F.struct(x.alias("x"), F.when(i > 0, F.get(w, i - 1)).alias("before"), F.get(w, i + 1).alias("after"), F.get(w, i + 2).alias("beyond")))
    below = F.exists(
        pairs,
        lambda p: ((p["x"] == "counsel") & ~p["before"].eqNullSafe("general"))
        | ((p["x"] == "associate") & ~p["after"].eqNullSafe("partner"))
        | ((p["x"] == "director") & (p["after"].eqNullSafe("of") & p["beyond"].isNotNull() | p["before"].eqNullSafe("executive")))
        | ((p["x"] == "chief") & p["beyond"].eqNullSafe("officer"))
        | p["x"].isin(JUNIORS),
    )
    parts = F.flatten(F.transform(w, lambda x: F.split(x, "-")))
    high = F.exists(parts, lambda x: x.isin(SENIOR_LETTERS) | F.exists(F.array(*map(F.lit, SENIOR_STEMS)), lambda s: x.startswith(s)))
    return high & ~(below & ~F.exists(parts, _one_of(PARTNER_WORDS)))


def clean_practice(text: Column) -> Column:
    """A practice phrase without what leads up to it and the structural nouns behind it; null if nothing else is in it.

    'its newest corporate practice' -> 'corporate'. A second clause ('and a ...') is cut, phrases under three letters
    and phrases of structural words only are none.
    """
    first = F.regexp_replace(text, r"(?i)\s+and\s+(?:a|an|the|its)\s.*$", "")
    words = F.filter(F.split(F.regexp_replace(first, r"[,;]", " "), r"\s+"), lambda w: ~w.isin("", "-", "–", "—"))
    plain = lambda w: F.lower(F.regexp_replace(w, r"['’]", ""))
    # The first word that is no filler begins the phrase, the last that is no structural noun ends it.
    lead = F.array_position(F.transform(words, lambda w: ~plain(w).isin(FILLERS)), F.lit(True))
    body = F.when(lead > 0, F.slice(words, lead.cast("int"), F.size(words))).otherwise(F.array().cast("array<string>"))
    back = F.array_position(F.transform(F.reverse(body), lambda w: ~plain(w).isin(STRUCTURAL)), F.lit(True))
    kept = F.when(back > 0, F.slice(body, F.lit(1), F.size(body) - back.cast("int") + 1)).otherwise(F.array().cast("array<string>"))
    says = F.exists(kept, lambda w: ~plain(w).isin(STRUCTURAL + JOINTS))
    out = F.array_join(kept, " ")
    return F.when(says & (F.length(out) >= 3), out)


def with_role(rows: DataFrame, phrase: Column, places: dict[str, str] | None = None) -> DataFrame:
    """``rows`` with title, practice and place of a role clause; nulls where the clause names none.

    The practice that a unit bounds comes before one that runs to the end; one that the title repeats, and a phrase of
    up to three words that is a place or region, are none. ``places`` is the fixed list of places, surface to code.
    """
    text = F.coalesce(phrase, F.lit(""))
    for end in ENDS:
        text = F.regexp_replace(text, rf"(?i)\s{end}\b.*$", "")
    staged = rows.withColumn("t", text).withColumn("w", role_words(F.col("t")))
    lead = F.array_position(F.transform("w", lambda x: ~x.isin(OPENERS)), F.lit(True))
    staged = staged.withColumn("w", F.when(lead > 0, F.slice("w", lead.cast("int"), F.size("w"))).otherwise(F.array().cast("array<string>")))
    w = F.col("w")
    stem = lambda x: F.regexp_replace(x, rf"^(?:{'|'.join(PREFIXES)})-", "")
    staged = staged.withColumn("head", F.array_position(F.transform(w, lambda x: stem(x).isin(HEADS)), F.lit(True)).cast("int"))
    at = lambda i: F.get(w, i - 1)
    qualified = lambda i: F.coalesce(at(i).isin(QUALIFIERS), F.lit(False))
    h = F.col("head")
    run = F.when(~qualified(h - 1), 0).when(~qualified(h - 2), 1).when(~qualified(h - 3), 2).otherwise(3)
    charge = at(h + 1).eqNullSafe("in") & at(h + 2).eqNullSafe("charge")
    staged = staged.withColumn("from", F.when(h > 0, h - run)).withColumn("to", F.when(h > 0, h + F.when(charge, 2).otherwise(0)))
    staged = staged.withColumn("title", F.when(h > 0, F.array_join(F.slice(w, F.col("from"), F.col("to") - F.col("from") + 1), " ")))
    # From each preposition: the words up to the next unit, and those up to the end.
    n = F.size(w)
    starts = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.coalesce(at(i).isin(PREPOSITIONS) & ~i.between(F.col("from"), F.col("to")), at(i).isin(PREPOSITIONS), F.lit(False)))
    rest = lambda i: F.slice(w, i + 1, n)
    unit = lambda i: F.array_position(F.transform(rest(i), _one_of(UNITS)), F.lit(True)).cast("int")
    joined = lambda words: F.regexp_replace(F.replace(F.array_join(words, " "), F.lit(" ,"), F.lit(",")), r"^(?:(?:the|its|their|an?) )?firms ", "")
    bounded = F.transform(F.filter(starts, lambda i: unit(i) > 1), lambda i: joined(F.slice(rest(i), F.lit(1), unit(i) - 1)))
    trailing = F.transform(starts, lambda i: joined(rest(i)))
    staged = staged.withColumn("found", F.transform(F.concat(bounded, trailing), clean_practice))
    new = lambda p: p.isNotNull() & ~F.coalesce(F.contains(F.col("title"), p), F.lit(False))
    staged = staged.withColumn("practice", F.get(F.filter("found", new), F.lit(0)))
    places = places or {}
    local = gazetteer.fixed_lookup({**dict.fromkeys(REGIONS), **places})
    named = gazetteer.fixed_lookup({**{r: r for r in REGIONS}, **places})
    geographic = (F.size(F.split("practice", r"\s+")) <= 3) & (F.size(named(F.col("practice"))) > 0)
    return staged.select(*rows.columns, "title", F.when(~geographic, F.col("practice")).alias("practice"), F.get(local(F.col("t")), F.lit(0)).alias("place"))


def parse_roles(rows: DataFrame, key: str, phrase: Column, places: dict[str, str] | None = None) -> DataFrame:
    """(key, title, practice, place) of role clauses, as ``with_role``."""
    return with_role(rows.select(key, phrase.alias("_phrase")), F.col("_phrase"), places).drop("_phrase")


def verify(value: Column, start: Column, end: Column, text: Column, fold: bool = True) -> Column:
    """struct(quality, span_start, span_end): exact if the span holds the value, recovered if the text does elsewhere.

    The text holds a value if it has its words in any case with any white space between them. Offsets count from 0, the
    end is exclusive. Null or blank values and texts without the value are dropped.
    """
    same = (lambda c: F.lower(fold_accents(F.trim(c)))) if fold else F.trim
    sane = (start >= 0) & (start < end) & (end <= F.length(text))
    inside = sane & same(F.substr(text, start + 1, end - start)).contains(same(value))
    # Each word is quoted, so that no sign of it is read as a pattern.
    words = F.transform(F.split(F.trim(value), r"\s+"), lambda w: F.concat(F.lit("\\Q"), F.replace(w, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E")))
    pattern = F.concat(F.lit("(?i)"), F.array_join(words, r"\s+"))
    stated = F.coalesce(F.trim(value) != "", F.lit(False))
    plain = F.instr(F.lower(text), F.lower(F.trim(value)))
    at = F.when(plain > 0, plain).otherwise(F.regexp_instr(text, pattern))
    size = F.when(plain > 0, F.length(F.trim(value))).otherwise(F.length(F.regexp_substr(text, pattern)))
    quality = F.when(stated & inside, "exact").when(stated & (at > 0), "recovered").otherwise("dropped")
    first = F.when(quality == "exact", start).when(quality == "recovered", at - 1).otherwise(0)
    last = F.when(quality == "exact", end).when(quality == "recovered", at - 1 + size).otherwise(0)
    return F.struct(quality.alias("quality"), first.cast("int").alias("span_start"), last.cast("int").alias("span_end"))


def verify_coded(value: Column, start: Column, end: Column, text: Column) -> Column:
    """struct like ``verify`` for values that are codes: the span only has to be a real part of the text."""
    sane = F.coalesce((F.trim(value) != "") & (start >= 0) & (start < end) & (end <= F.length(text)), F.lit(False))
    pick = lambda c: F.when(sane, c).otherwise(0).cast("int")
    return F.struct(F.when(sane, "exact").otherwise("dropped").alias("quality"), pick(start).alias("span_start"), pick(end).alias("span_end"))


def excerpt(text: Column, start: Column, end: Column) -> Column:
    """The text around a span, white space collapsed, at most MAX_WORDS words."""
    low = F.greatest(F.lit(0), start - PADDING)
    piece = F.substr(text, low + 1, end + PADDING - low)
    return F.array_join(F.slice(F.split(F.trim(F.regexp_replace(piece, r"\s+", " ")), " "), 1, MAX_WORDS), " ")


def sentences(text: Column) -> Column:
    """Sentences: cut after . ! or ? and white space before a capital."""
    return F.split(text, r"(?<=[.!?])\s+(?=\p{Lu})")


def alias_kind(canonical: Column, alias: Column) -> Column:
    """abbreviation if the alias is up to five capitals or its first word stands in the canonical name, else legacy_name."""
    short = (F.length(alias) <= 5) & (F.upper(alias) == alias) & (F.lower(alias) != alias)
    first = F.get(F.filter(F.split(F.trim(alias), r"\s+"), lambda w: w != ""), F.lit(0))
    return F.when(short | F.coalesce(F.contains(canonical, first), F.lit(False)), "abbreviation").otherwise("legacy_name")
