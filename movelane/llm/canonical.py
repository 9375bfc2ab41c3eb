"""Mapping free-entered values to a canonical list by token-level repair and soft TF-IDF.

Only distinct values are worked on. Each distinct token meets the reference vocabulary through equi-joins: as it is, by
a shared deletion (symmetric deletes, verified by edit distance with a swap counted once), or as a dotted abbreviation
by prefix. The repaired tokens then rank complete entries by the cosine of TF-IDF weights, each product scaled by the
similarity of its tokens. The reference list and its other names are fixed, so a token meets a bounded number of entries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from movelane.functions.text import edits
from movelane.session import cut_lineage

# Other names of the entries in professional use, by entry name: a default that may be replaced or left out ({}).
OTHER_NAMES = {
    "Mergers and Acquisitions": "M&A; mergers and acqs; public takeovers; takeovers; corporate acquisitions",
    "Private Equity": "PE; PE buyouts; buyouts; leveraged buyouts; LBO",
    "Venture Capital": "VC; venture; start-up financing; startups",
    "Equity Capital Markets": "ECM; IPOs; equity cap markets; initial public offerings; listings",
    "Debt Capital Markets": "DCM; bond issues; bonds; debt cap mkts",
    "Banking and Lending": "bank lending; loans; syndicated loans; lending; leveraged finance",
    "Project Finance": "PF; project financings; financing of projects; infrastructure finance",
    "Asset Finance": "aircraft leasing; ship finance; aircraft finance",
    "Restructuring and Insolvency": "R&I; bankruptcy; insolvencies; restructurings; insolvency",
    "Commercial Litigation": "comm lit; commercial disputes; court litigation; litigation; dispute resolution",
    "International Arbitration": "arbitration; arbitral disputes; int'l arb",
    "White Collar Crime": "WCC; corporate crime; white-collar defence; fraud",
    "Competition and Antitrust": "anti-trust; antitrust; cartels; merger control; competition law",
    "Data Protection and Privacy": "data privacy; GDPR; privacy law; privacy; data protection",
    "Cybersecurity": "cyber; cyber incident response; cyber security",
    "Employment and Labour": "HR law; labor law; labour law; workplace law; employment law",
    "Pensions and Benefits": "employee benefits; pension schemes; pensions",
    "Corporate Tax": "corp tax; tax; tax structuring; taxation",
    "Customs and Trade": "int'l trade; sanctions and customs; customs; international trade; export controls",
    "Commercial Real Estate": "CRE; property; real estate; property law",
    "Construction and Engineering": "building contracts; construction disputes; construction",
    "Planning and Zoning": "land use; zoning law; zoning; planning law",
    "Energy and Renewables": "power; renewable energy; wind and solar; renewables; energy",
    "Oil and Gas": "O&G; upstream petroleum; petroleum",
    "Mining and Metals": "mining law; mines and minerals; mining",
    "Shipping and Maritime": "maritime law; admiralty; shipping law; shipping",
    "Aviation": "airlines; aviation law",
    "Insurance and Reinsurance": "re/insurance; coverage disputes; insurers; insurance law; insurance",
    "Patents": "patent lit; patent prosecution; patent litigation; patent law",
    "Trade Marks": "TMs; trademarks; brand protection; trademark law",
    "Copyright and Media": "media law; publishing law; copyright law",
    "Technology and Outsourcing": "tech; IT contracts; outsourcings; technology law",
    "Telecommunications": "telco; telecoms; telecom",
    "Life Sciences": "pharma; biotech; pharmaceuticals",
    "Healthcare": "health care law; hospitals; health law",
    "Private Wealth": "private client; trusts and estates; wills and probate",
    "Family Law": "divorce; matrimonial; family",
    "Immigration": "visas; business immigration; immigration law",
    "Financial Services Regulation": "fin reg; FS regulatory; financial regulation",
    "Investment Funds": "fund formation; hedge funds; funds; asset management",
    "Sports and Entertainment": "sports law; entertainment law",
    "Public Law": "administrative law; judicial review; constitutional law",
    "Partner": "ptr; law firm partner; partner newly made up",
    "Equity Partner": "equity; full equity ptr; equity ptr",
    "Salaried Partner": "fixed-share partner; non-equity partner",
    "Managing Partner": "MP; managing ptr",
    "Senior Partner": "snr ptr; sr partner; sr ptr; snr partner",
    "Office Managing Partner": "OMP; partner in charge of office; office head",
    "Practice Head": "head of practice; heads the practice; practice group leader; head of department",
    "Practice Co-Head": "joint head of practice; co-leads practice; joint practice head; co-head of practice",
    "Of Counsel": "OC; of-counsel",
    "Special Counsel": "spec counsel; counsel special",
    "Senior Associate": "sr assoc; snr associate; sr associate",
    "General Counsel": "GC; chief legal officer; head of legal; CLO",
    "Deputy General Counsel": "DGC; dep gen counsel; no 2 in-house lawyer; no 2 inhouse lawyer; deputy GC",
    "Legal Director": "director legal; dir legal",
    "Consultant": "consultant solicitor; consulting lawyer",
    "Chairperson": "chair; chairman; chairwoman",
    "Vice Chair": "deputy chair; vice-chairman; vice chairperson",
    "Barrister": "advocate barrister; barr; member of the bar; advocate",
    "Registered Foreign Lawyer": "foreign lawyer; RFL",
    "Trainee Solicitor": "trainee; articled clerk",
}
# Words around a value that are no part of it.
AROUND = r"\b(?:its|the firm's|their newest|their|newest|now|new|as|team|group|work|lead|acting|incoming|designate|former|and|the|an?|in|practice group)\b"
AROUND_PRACTICE = r"\b(?:practice|practices|department|desk|matters|specialist)\b"
#: An entry is taken from this soft cosine on.
ACCEPT = 0.74
#: A match by another name counts this much of one by the entry's own.
OTHER_NAME = 0.96


def surfaces(ref_values: DataFrame, other_names: dict[str, str] | None = None) -> DataFrame:
    """(kind, ref_code, surface, trust): the entries under all their names; entries without a code, kind or name are left out."""
    spark = ref_values.sparkSession
    names = [(name, other.strip()) for name, others in (OTHER_NAMES if other_names is None else other_names).items() for other in others.split(";")]
    known = ref_values.filter("ref_code is not null and kind is not null and name is not null").select("kind", "ref_code", "name").distinct()
    others = known.join(spark.createDataFrame(names or [], "name string, surface string"), "name").select("kind", "ref_code", "surface", F.lit(OTHER_NAME).alias("trust"))
    return known.select("kind", "ref_code", F.col("name").alias("surface"), F.lit(1.0).alias("trust")).unionByName(others)


def normal(value: Column) -> Column:
    """Lower case, white space collapsed, signs for 'and' spelled out."""
    text = F.lower(F.trim(F.regexp_replace(value, r"(?U)\s+", " ")))
    return F.regexp_replace(F.regexp_replace(text, r"[’`]", "'"), r"\s*[&+]\s*", " and ")


def tokens(value: Column, kind: Column) -> Column:
    """Words of a normalised value, dots of abbreviations kept, words around the value dropped unless nothing is left."""
    flat = F.regexp_replace(value, r"[()\[\],;:/|_–—-]+", " ")
    bare = F.regexp_replace(flat, AROUND, " ")
    bare = F.when(kind == "practice", F.regexp_replace(bare, AROUND_PRACTICE, " ")).otherwise(bare)
    words = lambda text: F.array_distinct(F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+(?:'[\p{L}]+)?\.?"), F.lit(0)))
    return F.when(F.size(words(bare)) > 0, words(bare)).otherwise(words(flat))


def deletions(word: Column, least: int = 4) -> Column:
    """The word and, from ``least`` letters on, its forms with one or two letters left out (two only from six letters on)."""
    one = lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substr(w, F.lit(1), i - 1), F.substr(w, i + 1)))
    first = one(word)
    both = F.when(F.length(word) >= 6, F.concat(F.array(word), first, F.flatten(F.transform(first, one)))).otherwise(F.concat(F.array(word), first))
    return F.array_distinct(F.when(F.length(word) >= least, both).otherwise(F.array(word)))


def repairs(words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(kind, token, term, sim, weak): the terms of the reference vocabulary that a distinct token may stand for.

    One edit repairs words from four letters on, two edits words from nine on. An edit of a word of two or three letters
    is weak: it counts only beside other words of the value that meet the same entry (``rank_entries``).
    """
    word = F.regexp_replace("token", r"\.$", "")
    words = words.select("kind", "token", word.alias("word")).distinct()
    # A token longer than every term by more than the edits allowed stands for none.
    longest = vocabulary.groupBy("kind").agg((F.max(F.length("term")) + 2).alias("longest"))
    near = (
        words.join(longest, "kind").filter(F.length("word") <= F.col("longest"))
        .select("kind", "token", "word", F.explode(deletions(F.col("word"), 2)).alias("key"))
        .join(vocabulary.select("kind", "term", F.explode(deletions(F.col("term"), 2)).alias("key")), ["kind", "key"])
        .select("kind", "token", "word", "term").distinct()
        .withColumn("d", edits(F.col("word"), F.col("term")))
    )
    size = F.greatest(F.length("word"), F.length("term"))
    least = F.least(F.length("word"), F.length("term"))
    sound = (F.col("d") == 0) | ((F.col("d") == 1) & (size >= 4) & (least >= 3)) | ((F.col("d") == 2) & (size >= 9))
    near = near.withColumn("weak", ~sound).filter(sound | ((F.col("d") == 1) & (least >= 2)))
    short = words.filter(F.col("token").endswith(".") & (F.length("word") >= 1))
    starts = vocabulary.select("kind", "term", F.explode(F.transform(F.sequence(F.lit(1), F.length("term")), lambda i: F.substr("term", F.lit(1), i))).alias("word"))
    abbreviated = short.join(starts, ["kind", "word"]).filter(F.length("term") > F.length("word")).select("kind", "token", "term", (0.9 + 0.1 * F.length("word") / F.length("term")).alias("sim"), F.lit(False).alias("weak"))
    both = near.select("kind", "token", "term", (1 - 0.8 * F.col("d") / size).alias("sim"), "weak").unionByName(abbreviated)
    return both.groupBy("kind", "token", "term").agg(F.max("sim").alias("sim"), F.min("weak").alias("weak"))


def closed_up(values: DataFrame, named: DataFrame) -> DataFrame:
    """(kind, value, ref_code, score) of values that, closed up, are within one edit of an entry closed up.

    Catches blanks and hyphens that are missing or have moved, which leaves no token to repair.
    """
    one = lambda w: F.array_distinct(F.concat(F.array(w), F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substr(w, F.lit(1), i - 1), F.substr(w, i + 1)))))
    left = values.select("kind", "value", F.regexp_replace(F.array_join(tokens(F.col("value"), F.col("kind")), ""), r"[.']", "").alias("word")).filter(F.length("word") >= 6)
    right = named.select("kind", "ref_code", "trust", F.regexp_replace(F.array_join("terms", ""), "'", "").alias("term")).filter(F.length("term") >= 6)
    longest = right.groupBy("kind").agg((F.max(F.length("term")) + 1).alias("longest"))
    near = left.join(longest, "kind").filter(F.length("word") <= F.col("longest")).select("kind", "value", "word", F.explode(one(F.col("word"))).alias("key")).join(right.select("kind", "ref_code", "trust", "term", F.explode(one(F.col("term"))).alias("key")), ["kind", "key"])
    d = edits(F.col("word"), F.col("term"))
    return near.filter(d <= 1).select("kind", "value", "ref_code", (F.col("trust") * (1 - 0.8 * d / F.length("term"))).alias("score")).distinct()


def rank_entries(values: DataFrame, ref_values: DataFrame, other_names: dict[str, str] | None = None) -> DataFrame:
    """(kind, value, ref_code, score): the best entry of each distinct (kind, value); ties go to the smaller code."""
    named = surfaces(ref_values, other_names).select("kind", "ref_code", "surface", "trust", F.transform(tokens(normal(F.col("surface")), F.col("kind")), lambda t: F.regexp_replace(t, r"\.$", "")).alias("terms"))
    named = cut_lineage(named)
    terms = named.select("kind", "ref_code", "surface", "trust", F.explode("terms").alias("term"))
    entries = named.groupBy("kind").agg(F.count_distinct("ref_code").alias("entries"))
    idf = terms.groupBy("kind", "term").agg(F.count_distinct("ref_code").alias("df")).join(entries, "kind").select("kind", "term", F.log1p(F.col("entries") / F.col("df")).alias("w"))
    weighed = terms.join(idf, ["kind", "term"])
    norms = weighed.groupBy("kind", "ref_code", "surface").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("surface_norm"))
    weighed, idf = cut_lineage(weighed.join(norms, ["kind", "ref_code", "surface"])), cut_lineage(idf)

    words = cut_lineage(values.select("kind", "value", F.explode(tokens(F.col("value"), F.col("kind"))).alias("token")))
    fixed = cut_lineage(repairs(words, idf.select("kind", "term")))
    # A part in brackets or after a dash of which the vocabulary knows nothing (a place, a remark) is no part of the value.
    aside = F.regexp_extract("value", r"(?:\(([^()]*)\)|\s[-–—]\s(.+))$", 0)
    asides = values.select("kind", "value", F.explode(tokens(aside, F.col("kind"))).alias("token"))
    known_asides = asides.join(fixed.filter("not weak").select("kind", "token").distinct(), ["kind", "token"], "left_semi").select("kind", "value").distinct()
    strange = asides.join(known_asides, ["kind", "value"], "left_anti")
    words = cut_lineage(words.join(strange, ["kind", "value", "token"], "left_anti"))

    weights = fixed.join(idf, ["kind", "term"])
    # Terms as near as each other settle by weight, so that the order of rows plays no part; a weak repair settles nothing.
    own = weights.filter("not weak").groupBy("kind", "token").agg(F.max_by("w", F.struct("sim", "w")).alias("own"))
    rarest = idf.groupBy("kind").agg(F.max("w").alias("most"))
    owned = words.join(own, ["kind", "token"], "left").join(rarest, "kind").select("kind", "value", "token", F.pow(F.coalesce("own", "most"), F.lit(2)).alias("own2"))
    sized = owned.groupBy("kind", "value").agg(F.sum("own2").alias("value2"))
    met = owned.join(fixed, ["kind", "token"]).join(weighed, ["kind", "term"])
    entry = ["kind", "value", "ref_code", "surface", "trust", "surface_norm"]
    pairs = met.groupBy(*entry, "token").agg(F.max(F.struct((F.col("sim") * F.col("w") * F.col("w")).alias("part"), (F.col("w") * F.col("w")).alias("w2"), "own2")).alias("m"), F.min("weak").alias("weak"))
    # Only entries that a sound token meets: a weak one is read in their light.
    scores = pairs.groupBy(*entry).agg(F.count_if(~F.col("weak")).alias("sound"), F.sum("m.part").alias("dot"), F.sum("m.w2").alias("met2"), F.sum("m.own2").alias("own2")).filter("sound > 0").join(sized, ["kind", "value"])
    # A token that meets an entry weighs as the term it meets; the others weigh as their best term, or as the rarest.
    norm = F.sqrt(F.col("value2") - F.col("own2") + F.col("met2")) * F.col("surface_norm")
    scored = scores.select("kind", "value", "ref_code", (F.col("trust") * F.least(F.lit(1.0), F.col("dot") / norm)).alias("score")).unionByName(closed_up(values, named))
    return scored.groupBy("kind", "value").agg(F.min_by(F.struct("ref_code", "score"), F.struct(F.round(-F.col("score"), 6), "ref_code")).alias("b")).select("kind", "value", "b.ref_code", "b.score")


def map_values(roles: DataFrame, ref_values: DataFrame, accept: float = ACCEPT, other_names: dict[str, str] | None = None) -> DataFrame:
    """(role_id, part, ref_code) of each value that is neither null nor blank; 'unmatched' where no entry is near enough.

    Values are compared in lower case with white space collapsed. Repeated rows come out repeated.
    """
    parts = roles.select("role_id", F.explode(F.map_from_arrays(F.array(F.lit("title"), F.lit("practice")), F.array("title", "practice"))).alias("kind", "raw"))
    parts = parts.filter(F.col("raw").rlike(r"(?U)\S")).select("role_id", "kind", normal(F.col("raw")).alias("value"))
    best = rank_entries(cut_lineage(parts.select("kind", "value").distinct()), ref_values, other_names).filter(F.col("score") >= accept)
    return parts.join(best, ["kind", "value"], "left").select("role_id", F.col("kind").alias("part"), F.coalesce("ref_code", F.lit("unmatched")).alias("ref_code"))
