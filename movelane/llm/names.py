"""Variant spellings of names typed by people: organisations and persons.

Distinct normalised forms are compared, never rows. Candidates come from symmetric-delete neighbourhoods: forms that
share the parts of a name up to one left-out letter meet in an equi-join. A pair is decided by the best assignment of
its tokens, in which tokens may be equal, one edit apart, short forms, initials, or extra middle names. Sure pairs make
clusters; forms that fit several people (initials, short names) join a cluster only if it is the only one they fit.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from movelane.functions.text import deletions, edits, fold_accents, squeeze
from movelane.llm.components import connected_components, refine
from movelane.session import cut_lineage

# Legal forms and other words around an organisation's own name, longest first.
FIRM_WORDS = r"llp|l\.l\.p\.|law firm|law offices?|law|partners|associates|chambers|legal|lawyers|solicitors|advocates|attorneys|& co|and co|pte\. ltd\.|pte ltd|ltd|limited|plc|inc|gmbh|group|\([a-z ]+\)"
# Offices that appear after a name.
OFFICES = "auckland|bangkok|beijing|dubai|frankfurt|hong kong|jakarta|kuala lumpur|london|manila|melbourne|mumbai|new york|paris|perth|seoul|shanghai|singapore|sydney|tokyo"
# Words before and after a person's name.
HONORIFICS = "mr mrs ms miss mx mme mlle dr prof professor dato datuk datin sir dame hon herr frau sr sra justice rev"
POST_NOMINALS = "kc qc sc jp llm llb phd mba esq jd msc ba ma obe cbe mbe ao ac sj"
# Short forms of given names, by given name.
SHORT_FORMS = {
    "alexander": "alex sandy xander alec sasha", "andrew": "drew andy", "anthony": "tony ant", "benjamin": "ben benny benji",
    "charles": "charlie chuck chas", "christopher": "chris kit topher", "deborah": "deb debs debbie", "edward": "ed eddie ted ned",
    "elizabeth": "liz beth eliza betty libby lizzie", "francesca": "fran frankie chessie", "gerald": "gerry jerry", "henrietta": "etta hettie hen",
    "isabella": "bella izzy isa", "jonathan": "jon jonty jonny", "josephine": "jo josie", "katherine": "kate kathy kat katie kath", "leonard": "len leo lenny",
    "margaret": "maggie meg peggy marge", "michael": "mike mick micky", "nicholas": "nick nicky nico", "patricia": "pat trish tricia patty", "rebecca": "becky becca bec",
    "richard": "rick dick rich ricky", "robert": "bob rob bobby robbie bert", "samantha": "sam sammy", "susannah": "sue susie suzy", "theodore": "theo ted teddy",
    "timothy": "tim timmy", "victoria": "vicky tori vic", "william": "bill will billy liam", "james": "jim jimmy jamie", "john": "jack johnny", "joseph": "joe", "thomas": "tom tommy",
    "daniel": "dan danny", "david": "dave", "matthew": "matt", "stephen": "steve", "philip": "phil", "peter": "pete", "catherine": "cathy cat", "jennifer": "jen jenny", "caroline": "caz carrie",
}

# --- organisations ---------------------------------------------------------------------------------------------------


def firm_core(name: Column) -> Column:
    """The own words of an organisation's name: folded, lower case, without legal forms, offices or article."""
    text = F.lower(fold_accents(squeeze(name)))
    text = F.regexp_replace(text, r"^chambers of |^the (?=.+ group$)", "")
    text = F.regexp_replace(text, rf"^(\S.+?)(?:[ ,]+(?:{FIRM_WORDS}|{OFFICES}))+$", "$1")
    words = F.split(F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}']+|\band\b", " ")), r"\s+")
    return F.filter(words, lambda w: w != "")


def _without(words: Column, i: Column) -> Column:
    return F.concat(F.slice(words, F.lit(1), i), F.slice(words, i + 2, F.size(words)))


def core_keys(core: Column) -> Column:
    """Keys that two cores share if they have as many words and differ by at most one edit in one word, in any order."""
    return F.array_distinct(
        F.flatten(F.transform(F.sequence(F.lit(0), F.size(core) - 1), lambda i: F.transform(deletions(F.get(core, i)), lambda d: F.concat_ws("|", F.size(core).cast("string"), F.array_join(F.array_sort(_without(core, i)), " "), d))))
    )


def core_edits(left: Column, right: Column) -> Column:
    """Edits between cores of as many words under the best assignment: the words both have cancel out."""
    a, b = F.array_sort(F.array_except(left, right)), F.array_sort(F.array_except(right, left))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 0).when((F.size(a) == 1) & (F.size(b) == 1), edits(F.get(a, F.lit(0)), F.get(b, F.lit(0)))).otherwise(99)


def short_keys(core: Column) -> Column:
    """Short forms of a core: first word with the initials of the rest, and all initials."""
    initials = lambda words: F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), "")
    first = F.concat_ws(" ", F.get(core, F.lit(0)), initials(F.slice(core, F.lit(2), F.greatest(F.size(core), F.lit(1)))))
    return F.when(F.size(core) >= 2, F.array(first, initials(core))).otherwise(F.array().cast("array<string>"))


def _compatible(a: str, b: str) -> Column:
    """No two stated head offices, and no two stated kinds, that contradict each other ('other' states none)."""
    hq = F.col(f"{a}.hq").isNull() | F.col(f"{b}.hq").isNull() | (F.col(f"{a}.hq") == F.col(f"{b}.hq"))
    kind = F.col(f"{a}.kind").isNull() | F.col(f"{b}.kind").isNull() | (F.col(f"{a}.kind") == F.col(f"{b}.kind"))
    return hq & kind


def firm_clusters(firms: DataFrame) -> DataFrame:
    """(firm_id, cluster) of the entries that share their organisation with another; cluster is its smallest firm_id.

    Entries without an id or name are left out. An alias counts only where it is a spelling of the whole name: as many
    words as the canonical name, or any full form if that is initials. One-word short names and initials shared by
    strangers never link by themselves.
    """
    kind = F.when(F.lower("firm_type") != "other", F.lower("firm_type"))
    base = firms.filter("firm_id is not null and canonical_name is not null").select("firm_id", F.upper(F.trim("hq_jurisdiction")).alias("hq"), kind.alias("kind"), firm_core(F.col("canonical_name")).alias("core"), "aliases")
    base = cut_lineage(base.filter(F.size("core") > 0))
    is_short = lambda core: (F.size(core) == 1) & (F.length(F.get(core, F.lit(0))) <= 4) | (F.size(core) == 2) & (F.length(F.get(core, F.lit(1))) <= 2)
    aliases = base.select("firm_id", "hq", "kind", F.col("core").alias("own"), F.explode("aliases").alias("alias")).filter("alias is not null")
    aliases = aliases.select("firm_id", "hq", "kind", "own", firm_core(F.col("alias")).alias("core")).filter(F.size("core") > 0)
    spelled = aliases.filter(~is_short(F.col("core")) & (is_short(F.col("own")) & (F.size("core") >= 2) & F.array_contains(short_keys(F.col("core")), F.array_join("own", " ")) | (F.size("core") == F.size("own")) & ~is_short(F.col("own"))))
    forms = base.select("firm_id", "hq", "kind", "core").filter(~is_short(F.col("core"))).unionByName(spelled.select("firm_id", "hq", "kind", "core")).distinct()
    forms = cut_lineage(forms)

    # Entries of one spelling, office and kind are one node of the comparison, so that one name in many entries is few.
    entry = cut_lineage(forms.select(F.array_sort("core").alias("core"), "firm_id", "hq", "kind").distinct())
    nodes = cut_lineage(entry.groupBy("core", "hq", "kind").agg(F.min("firm_id").alias("node")))
    keyed = nodes.select("core").distinct().select("core", F.explode(core_keys(F.col("core"))).alias("key"))
    other = keyed.select(F.col("core").alias("core2"), "key")
    near = keyed.join(other, "key").filter(F.array_join("core", " ") < F.array_join("core2", " ")).select("core", "core2").distinct().filter(core_edits(F.col("core"), F.col("core2")) <= 1)
    own = entry.alias("a").join(nodes.alias("b"), (F.col("a.core") == F.col("b.core")) & F.col("a.hq").eqNullSafe(F.col("b.hq")) & F.col("a.kind").eqNullSafe(F.col("b.kind"))).select(F.col("a.firm_id").alias("a"), F.col("b.node").alias("b"))
    # A node that states less joins one node that states more, the smallest it fits, so that it is no bridge between two
    # that contradict each other; nodes that state as much as each other meet only if neither fits a third.
    level = lambda side: F.col(f"{side}.hq").isNotNull().cast("int") + F.col(f"{side}.kind").isNotNull().cast("int")
    fit = nodes.alias("a").join(nodes.alias("b"), "core").filter(_compatible("a", "b") & (F.col("a.node") != F.col("b.node"))).select(F.col("a.node").alias("a"), F.col("b.node").alias("b"), level("a").alias("la"), level("b").alias("lb"))
    best = fit.groupBy("a", "la").agg(F.min(F.struct(-F.col("lb"), F.col("b"))).alias("m"), F.count("*").alias("n"))
    best = best.select("a", "la", F.col("m.b").alias("b"), (-F.col("m.col1")).alias("lb"), "n")
    alone = best.filter("n = 1").select(F.col("a").alias("b"), F.lit(True).alias("alone"))
    alike = best.join(alone, "b", "left").filter((F.col("lb") > F.col("la")) | ((F.col("lb") == F.col("la")) & (F.col("n") == 1) & F.coalesce("alone", F.lit(False)))).select("a", "b")
    same = own.unionByName(alike)
    typed = near.join(nodes.alias("a"), "core").join(nodes.withColumnRenamed("core", "core2").alias("b"), "core2").filter(_compatible("a", "b")).select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))
    edges = cut_lineage(same.unionByName(typed).filter("a <> b"))

    # Initials: an entry known by them only joins the one organisation that they fit and that nothing contradicts.
    sure = cut_lineage(connected_components(edges))
    member = forms.join(sure.withColumnRenamed("node", "firm_id"), "firm_id", "left").select("firm_id", "hq", "kind", "core", F.coalesce("label", "firm_id").alias("cluster"))
    lone = base.filter(is_short(F.col("core"))).join(forms.select("firm_id").distinct(), "firm_id", "left_anti").select("firm_id", "hq", "kind", F.array_join("core", " ").alias("key"))
    full = member.select("cluster", "hq", "kind", F.explode(short_keys(F.col("core"))).alias("key")).distinct()
    fits = lone.alias("a").join(full.alias("b"), "key").filter(_compatible("a", "b")).select(F.col("a.firm_id").alias("a"), F.col("b.cluster").alias("b")).distinct()
    only = fits.groupBy("a").agg(F.min("b").alias("b"), F.count("*").alias("n")).filter("n = 1").select("a", "b")
    least = lone.groupBy("key", "hq", "kind").agg(F.min("firm_id").alias("b"))
    repeated = lone.alias("l").join(least.alias("m"), (F.col("l.key") == F.col("m.key")) & F.col("l.hq").eqNullSafe(F.col("m.hq")) & F.col("l.kind").eqNullSafe(F.col("m.kind"))).select(F.col("l.firm_id").alias("a"), "b")
    found = refine(sure, only.unionByName(repeated).filter("a <> b"))
    return found.select(F.col("node").alias("firm_id"), F.col("label").alias("cluster"))


# --- persons ---------------------------------------------------------------------------------------------------------

_HON, _POST = HONORIFICS.split(), POST_NOMINALS.split()
_SHORT = sorted({(short, full) for full, shorts in SHORT_FORMS.items() for short in shorts.split()})
_KNOWN_GIVEN = sorted({name for pair in _SHORT for name in pair})


def person_parts(spellings: DataFrame, name: str = "name") -> DataFrame:
    """``spellings`` with p = struct(words, caps, cut, alias): folded words, which are capitals, where a comma cut."""
    rows = spellings.withColumn("_t", F.regexp_replace(fold_accents(squeeze(F.col(name))), r"[’'`´]", ""))
    rows = rows.withColumn("_b", F.regexp_replace(F.lower(F.trim(F.regexp_extract("_t", r"[(\[]([^()\[\]]*)[)\]]", 1))), r"[^\p{L}\p{N} ]", ""))
    bare = F.regexp_replace("_t", r"[(\[][^()\[\]]*[)\]]", " ")
    # Post-nominals go first, so that a comma before them is no cut.
    bare = F.regexp_replace(bare, rf"(?i)(?:[ ,]+(?:{'|'.join(_POST)})\b\.?)+\s*$", "")
    bare = F.regexp_replace(bare, rf"(?i)^\s*(?:(?:{'|'.join(_HON)})\b\.?\s+)+", "")
    rows = rows.withColumn("_s", F.split(bare, ",", 2))
    split = lambda i: F.regexp_extract_all(F.coalesce(F.get("_s", F.lit(i)), F.lit("")), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    rows = rows.withColumn("_l", split(0)).withColumn("_r", split(1)).withColumn("_w", F.concat("_l", "_r"))
    loud = lambda w: (F.length(w) >= 3) & (F.upper(w) == w) & w.rlike(r"\p{L}")
    parts = F.struct(
        F.transform("_w", lambda w: F.lower(w)).alias("words"),
        F.transform("_w", loud).alias("caps"),
        F.when(F.size("_r") > 0, F.size("_l")).otherwise(F.lit(0)).alias("cut"),
        F.when((F.col("_b") != "") & ~F.col("_b").isin(_HON + _POST), F.col("_b")).alias("alias"),
    )
    return rows.select(*spellings.columns, parts.alias("p"))


def given_words(spellings: DataFrame, share: float = 0.012, least: int = 4) -> DataFrame:
    """(word, n): the words that many firms' names have, which surnames don't: given names, with the known short forms."""
    words = spellings.select("firm", F.explode("p.words").alias("word"))
    spread = words.groupBy("word").agg(F.count_distinct("firm").alias("firms"), F.count("*").alias("n"))
    firms = spellings.agg(F.count_distinct("firm").alias("all_firms"))
    known = spellings.sparkSession.createDataFrame([(w,) for w in _KNOWN_GIVEN], "word string").withColumn("known", F.lit(True))
    rated = spread.join(F.broadcast(firms), F.lit(True)).join(known, "word", "left")
    return rated.filter((F.length("word") >= 2) & (F.col("known") | (F.col("firms") >= F.greatest(F.lit(least), F.lit(share) * F.col("all_firms"))))).select("word", "n")


def repaired_words(spellings: DataFrame, given: DataFrame) -> DataFrame:
    """(word, fixed): rare words one edit from exactly one given name that is far more frequent."""
    words = spellings.select(F.explode("p.words").alias("word")).groupBy("word").agg(F.count("*").alias("k")).filter(F.length("word") >= 4)
    keyed = words.select("word", "k", F.explode(deletions(F.col("word"))).alias("key"))
    against = given.filter(F.length("word") >= 3).select(F.col("word").alias("fixed"), "n", F.explode(deletions(F.col("word"), 3)).alias("key"))
    near = keyed.join(against, "key").select("word", "fixed", "k", "n").distinct().filter((F.col("word") != F.col("fixed")) & (F.col("n") >= 8 * F.col("k")) & (edits(F.col("word"), F.col("fixed")) == 1))
    return near.groupBy("word").agg(F.min("fixed").alias("fixed"), F.count("*").alias("fits")).filter("fits = 1").select("word", "fixed")


def person_forms(moves: DataFrame, given: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """((firm, name, form), (form, firm, surname, givens, known, alias, half)): spellings to forms; a form's id is its smallest move_id.

    ``given`` (word, n) are given names and how often they occur, learned elsewhere; by default the moves teach them.
    """
    rows = moves.filter("person_name is not null and to_firm_id is not null and move_id is not null").select("move_id", F.col("to_firm_id").alias("firm"), F.col("person_name").alias("name"))
    spellings = person_parts(rows.groupBy("firm", "name").agg(F.min("move_id").alias("first")))
    spellings = cut_lineage(spellings.filter(F.size("p.words") > 0))
    given = cut_lineage(given_words(spellings) if given is None else given.select("word", "n"))
    fixes = repaired_words(spellings, given)
    vocabulary = spellings.select(F.explode("p.words").alias("word")).groupBy("word").agg(F.count("*").alias("k"))
    marks = given.select(F.col("word").alias("of"), F.lit(True).alias("is_given"))
    vocabulary = vocabulary.join(fixes, "word", "left").join(marks, F.coalesce("fixed", "word") == F.col("of"), "left").select("word", "k", "fixed", F.coalesce("is_given", F.lit(False)).alias("is_given"))
    vocabulary = cut_lineage(vocabulary)
    placed = spellings.select("firm", "name", F.posexplode("p.words").alias("i", "word")).join(vocabulary, "word")
    marked = placed.groupBy("firm", "name").agg(F.array_sort(F.collect_list(F.struct("i", "word", "k", "fixed", "is_given"))).alias("w")).join(spellings, ["firm", "name"])
    n = F.size("w")
    loud = F.size(F.filter("p.caps", lambda c: c))
    at = lambda i: F.get(F.col("w"), i)
    # Where the surname ends: at a comma, as the one word in capitals in front, or in front of a given name at the end.
    first_loud = F.get("p.caps", F.lit(0)) & (loud == 1) & (n > 1)
    turned = (n > 1) & at(n - 1)["is_given"] & ~at(F.lit(0))["is_given"] & (F.length(at(F.lit(0))["word"]) > 2)
    front = F.when(F.col("p.cut") > 0, F.col("p.cut")).when(first_loud | turned, F.lit(1)).otherwise(F.lit(0))
    certain = F.when(F.col("p.cut") > 0, 3).when(first_loud, 2).when(turned, 1).otherwise(0)
    parsed = marked.withColumn("front", front).withColumn("certain", certain)
    parsed = parsed.select(
        "firm", "name", "first", "p.alias", "certain",
        F.when(F.col("front") > 0, F.slice("w", F.lit(1), F.col("front"))).otherwise(F.slice("w", n, F.lit(1))).alias("s"),
        F.when(F.col("front") > 0, F.slice("w", F.col("front") + 1, n)).otherwise(F.slice("w", F.lit(1), n - 1)).alias("g"),
    )
    fixed = lambda x: F.coalesce(x["fixed"], x["word"])
    parse = F.struct(F.array_join(F.transform("s", lambda x: x["word"]), "").alias("surname"), F.transform("g", fixed).alias("givens"), F.transform("g", lambda x: x["is_given"]).alias("known"))
    # Spellings of the same words in any order are one form; the parse with the surest surname, then the rarest, holds.
    keyed = parsed.select("firm", "name", "first", "alias", F.array_join(F.array_sort(F.concat(F.transform("s", lambda x: x["word"]), F.transform("g", fixed))), " ").alias("words"), parse.alias("parse"), F.struct("certain", -F.array_max(F.transform("s", lambda x: x["k"])).alias("rare")).alias("sure"))
    keyed = cut_lineage(keyed)
    key = ["firm", "words", "alias"]
    ids = keyed.groupBy(*key).agg(F.min("first").alias("form"), F.max_by("parse", F.struct("sure", "first")).alias("parse"))
    links = keyed.alias("a").join(ids.alias("b"), (F.col("a.firm") == F.col("b.firm")) & (F.col("a.words") == F.col("b.words")) & F.col("a.alias").eqNullSafe(F.col("b.alias"))).select("a.firm", "a.name", "b.form")
    forms = cut_lineage(ids.select("form", "firm", "alias", "parse.*"))
    # First given words that hardly ever stand alone (Siew Jun, Siew Ling) are half a name.
    lone = forms.filter(F.size("givens") > 0).groupBy(F.get("givens", F.lit(0)).alias("head")).agg((F.sum(F.when(F.size("givens") == 1, 1).otherwise(0)) < 0.3 * F.count("*")).alias("half"))
    return links, forms.join(lone, F.get("givens", F.lit(0)) == F.col("head"), "left").select("form", "firm", "surname", "givens", "known", "alias", F.coalesce("half", F.lit(False)).alias("half"))


def chosen_names(forms: DataFrame, share: float = 0.1, least: int = 2) -> DataFrame:
    """(word): names seen in brackets behind given names of two words or more, and not much oftener by themselves."""
    inside = forms.filter((F.size("givens") >= 2) & F.col("alias").isNotNull()).groupBy(F.col("alias").alias("word")).agg(F.count("*").alias("inside"))
    alone = forms.filter(F.size("givens") == 1).groupBy(F.get("givens", F.lit(0)).alias("word")).agg(F.count("*").alias("alone"))
    return inside.join(alone, "word", "left").filter((F.col("inside") >= least) & (F.col("inside") >= share * (F.col("inside") + F.coalesce("alone", F.lit(0))))).select("word")


_SHORT_OF: dict[str, set[str]] = {}
for _s, _f in _SHORT:
    _SHORT_OF.setdefault(_s, set()).add(_f)


def _one_edit(a: str, b: str) -> bool:
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])
    longer, shorter = (a, b) if len(a) > len(b) else (b, a)
    return longer[i + 1 :] == shorter[i:]


SURE, SHORT, INITIAL, LOOSE = 4, 3, 2, 1
#: Which side of a match says less: the one that could stand for several people.
LEFT, RIGHT = 1, 2
NO_MATCH = (0, 0)


def word_match(a: str, b: str, known_a: bool = False, known_b: bool = False) -> tuple[int, int]:
    """(grade, weak sides) of two given words: SURE, SHORT (short form, or slip in a short word), INITIAL, or 0.

    Two different words that are both known as given names are no slip of each other.
    """
    if a == b:
        return SURE, 0
    if len(a) == 1 or len(b) == 1:
        return (INITIAL, LEFT if len(a) == 1 else RIGHT) if a[:1] == b[:1] else NO_MATCH
    short_a, short_b = _SHORT_OF.get(a, set()), _SHORT_OF.get(b, set())
    if b in short_a or a in short_b or short_a & short_b:
        return SHORT, (LEFT if short_a else 0) | (RIGHT if short_b else 0)
    if not (known_a and known_b) and _one_edit(a, b):
        if min(len(a), len(b)) >= 6:
            return SURE, 0
        return SHORT, LEFT | RIGHT if known_a == known_b else RIGHT if known_a else LEFT
    return NO_MATCH


def given_match(a: list[str], b: list[str], known_a: list[bool], known_b: list[bool], half_a: bool, half_b: bool) -> tuple[int, int]:
    """(grade, weak sides) of two lists of given words under their best assignment; the longer may have middle names.

    Words in order, first to first, make the grade of the worst of them. Any other assignment of all words of the shorter
    list, of which one at least is more than an initial, is LOOSE: names in another order, or one known by a middle name.
    """
    match = _in_order(a, b, known_a, known_b, half_a, half_b)
    if match[0] or not a or not b:
        return match
    if (len(a) == 1 and len(b) > 1 and half_b) or (len(b) == 1 and len(a) > 1 and half_a):
        return NO_MATCH
    return (LOOSE, LEFT | RIGHT if len(a) == len(b) else LEFT if len(a) < len(b) else RIGHT) if _assignable(a, b, known_a, known_b) else NO_MATCH


def _assignable(a: list[str], b: list[str], known_a: list[bool], known_b: list[bool]) -> bool:
    """True if every word of the shorter list has its own match in the longer one, one of them more than an initial."""
    if len(a) > len(b):
        a, b, known_a, known_b = b, a, known_b, known_a
    grades = [[word_match(x, y, p, q)[0] for y, q in zip(b, known_b)] for x, p in zip(a, known_a)]
    if max(map(max, grades)) < SHORT:
        return False
    taken: dict[int, int] = {}

    def place(i: int, seen: set[int]) -> bool:
        # Augmenting paths; the best partners are tried first, so that full words are not given away to initials.
        for j in sorted((j for j in range(len(b)) if grades[i][j] and j not in seen), key=lambda j: -grades[i][j]):
            seen.add(j)
            if j not in taken or place(taken[j], seen):
                taken[j] = i
                return True
        return False

    return all(place(i, set()) for i in sorted(range(len(a)), key=lambda i: -max(grades[i]))) and any(grades[i][j] >= SHORT for j, i in taken.items())


def _in_order(a: list[str], b: list[str], known_a: list[bool], known_b: list[bool], half_a: bool, half_b: bool) -> tuple[int, int]:
    if not a or not b:
        return NO_MATCH
    joined, apart = "".join(a), "".join(b)
    if joined == apart:
        return SURE, 0
    if (len(a) == 1) != (len(b) == 1) and min(len(joined), len(apart)) >= 6 and _one_edit(joined, apart):
        return SHORT, LEFT if len(a) == 1 else RIGHT
    if len(a) > len(b):
        grade, weak = _in_order(b, a, known_b, known_a, half_b, half_a)
        return grade, (weak & LEFT and RIGHT) | (weak & RIGHT and LEFT)
    if len(a) == 1 and len(a[0]) > 1 and len(b) > 1 and half_b:
        return NO_MATCH
    # Words keep their order and the first meets the first; row i holds the best match of a[: i + 1] within b[: j + 1].
    row = [word_match(a[0], b[0], known_a[0], known_b[0])] * len(b)
    for i in range(1, len(a)):
        above, row = row, [NO_MATCH] * len(b)
        for j in range(i, len(b)):
            one, before = word_match(a[i], b[j], known_a[i], known_b[j]), above[j - 1]
            both = (min(one[0], before[0]), one[1] | before[1]) if one[0] and before[0] else NO_MATCH
            row[j] = max(both, row[j - 1], key=lambda m: m[0])
    return row[-1]


def _same_short_surname(a: str, b: str) -> bool:
    """True if a short surname is a slip of another whatever the corpus: neighbours swapped, or a letter typed twice.

    Another letter makes another surname (Lim and Lin, Chan and Chen), and under four letters a doubled one does (Le, Lee).
    """
    if len(a) == len(b):
        return len(a) >= 3 and a != b and _one_edit(a, b) and sorted(a) == sorted(b)
    longer, shorter = (a, b) if len(a) > len(b) else (b, a)
    return len(shorter) >= 4 and any(longer[i] == longer[i - 1] and longer[:i] + longer[i + 1 :] == shorter for i in range(1, len(longer)))


def person_match(a: dict, b: dict) -> tuple[int, int]:
    """(grade, weak sides) of two forms: 0 unless the surnames are within one edit, else by given and chosen names.

    Surnames under five letters have to be slips by themselves and the given names have to be surely the same.
    """
    sa, ga, xa, sb, gb, xb = a["surname"], a["givens"], a["alias"], b["surname"], b["givens"], b["alias"]
    if sa != sb and min(len(sa), len(sb)) < 5:
        sure = _same_short_surname(sa, sb) and len("".join(ga)) >= 3 and given_match(ga, gb, a["known"], b["known"], a["half"], b["half"])[0] == SURE
        return (SURE, 0) if sure else NO_MATCH
    if sa != sb and not _one_edit(sa, sb):
        return NO_MATCH
    match = given_match(ga, gb, a["known"], b["known"], a["half"], b["half"])
    if not match[0]:
        for alias, givens, side in ((xa, gb, RIGHT), (xb, ga, LEFT)):
            if alias and len(givens) == 1 and match[0] < SURE:
                if givens[0] == alias:
                    match = SURE, 0
                elif word_match(alias, givens[0])[0] == INITIAL:
                    match = INITIAL, side
        if not match[0] and xa and xa == xb and ga[:1] == gb[:1]:
            match = SURE, 0
        for one, other, side in ((a, b, LEFT), (b, a, RIGHT)):
            if not match[0] and one["chosen"] and len(other["givens"]) >= 2 and not other["alias"]:
                match = (INITIAL, LEFT | RIGHT) if max(map(len, other["givens"])) == 1 else (SHORT, side) if other["half"] else NO_MATCH
    if sa != sb and match[0] == SURE and max(map(len, ga), default=0) < 3:
        match = INITIAL, LEFT | RIGHT
    return match


def form_pairs(forms: DataFrame) -> DataFrame:
    """(a, b, grade, weak) of the forms of one firm whose surnames are within one edit and whose given names agree."""
    rated = forms.join(chosen_names(forms).withColumn("chosen", F.lit(True)), (F.size("givens") == 1) & (F.get("givens", F.lit(0)) == F.col("word")), "left").select("form", "firm", F.struct("surname", "givens", "known", "alias", "half", F.coalesce("chosen", F.lit(False)).alias("chosen")).alias("f"))
    keyed = rated.select("form", "firm", "f", F.explode(deletions(F.col("f.surname"), 3)).alias("key"))
    other = keyed.select(F.col("form").alias("form2"), "firm", F.col("f").alias("f2"), "key")
    pairs = keyed.join(other, ["firm", "key"]).filter("form < form2").select("form", "form2", "f", "f2").dropDuplicates(["form", "form2"])

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, left, right = (batch.column(i).to_pylist() for i in range(4))
            grades = list(map(person_match, left, right))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array([g[0] for g in grades], pa.int32()), pa.array([g[1] for g in grades], pa.int32())], ["a", "b", "grade", "weak"])

    return pairs.mapInArrow(grade, "a long, b long, grade int, weak int").filter("grade > 0")


def _only_fits(pairs: DataFrame, clusters: DataFrame, grade: int) -> DataFrame:
    """Edges of the pairs of ``grade`` whose weak side fits one cluster only; a weak form that fits more gets none."""
    left, right = clusters.select(F.col("node").alias("a"), F.col("label").alias("x")), clusters.select(F.col("node").alias("b"), F.col("label").alias("y"))
    placed = pairs.filter(F.col("grade") == grade).join(left, "a", "left").join(right, "b", "left").select(F.coalesce("x", "a").alias("x"), F.coalesce("y", "b").alias("y"), "weak").filter("x <> y")
    from_left, from_right = F.col("weak").isin(LEFT, LEFT | RIGHT), F.col("weak").isin(RIGHT, LEFT | RIGHT)
    fits = placed.filter(from_left).select(F.col("x").alias("s"), F.col("y").alias("t")).unionByName(placed.filter(from_right).select(F.col("y").alias("s"), F.col("x").alias("t")))
    settled = fits.groupBy("s").agg(F.count_distinct("t").alias("n")).filter("n = 1")
    one, two = settled.select(F.col("s").alias("x"), F.lit(True).alias("x_ok")), settled.select(F.col("s").alias("y"), F.lit(True).alias("y_ok"))
    return placed.join(one, "x", "left").join(two, "y", "left").filter((~from_left | F.col("x_ok").isNotNull()) & (~from_right | F.col("y_ok").isNotNull())).select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()


def person_clusters(forms: DataFrame) -> DataFrame:
    """(form, cluster) of the forms that share their person with another form."""
    pairs = cut_lineage(form_pairs(forms))
    clusters = cut_lineage(connected_components(pairs.filter(F.col("grade") == SURE).select("a", "b")))
    for grade in (SHORT, INITIAL, LOOSE):
        clusters = refine(clusters, _only_fits(pairs, clusters, grade))
    return clusters.select(F.col("node").alias("form"), F.col("label").alias("cluster"))


def linked_firms(firms: DataFrame) -> DataFrame:
    """(left_id, right_id) of entries of one organisation, the smaller id first."""
    found = firm_clusters(firms)
    return found.alias("a").join(found.alias("b"), "cluster").filter("a.firm_id < b.firm_id").select(F.col("a.firm_id").alias("left_id"), F.col("b.firm_id").alias("right_id"))


def person_membership(moves: DataFrame, given: DataFrame | None = None) -> DataFrame:
    """(move_id, name, person): each move with a name and firm, and its person: one row a move, whatever the groups hold."""
    spellings, forms = person_forms(moves, given)
    clusters = person_clusters(forms)
    whole = spellings.join(clusters, "form", "left").select("firm", "name", F.coalesce("cluster", "form").alias("person"))
    return moves.select("move_id", F.col("to_firm_id").alias("firm"), F.col("person_name").alias("name")).join(whole, ["firm", "name"]).select("move_id", "name", "person")


def linked_moves(moves: DataFrame, given: DataFrame | None = None) -> DataFrame:
    """(left_id, right_id) of moves of one person whose person_name texts differ, the smaller id first.

    Moves without a name or firm have no links. A name at another firm is another person. ``person_membership`` says the
    same in one row a move.
    """
    rows = person_membership(moves, given)
    other = rows.select(F.col("move_id").alias("right_id"), F.col("name").alias("name2"), "person")
    return rows.join(other, "person").filter("move_id < right_id and name <> name2").select(F.col("move_id").alias("left_id"), "right_id")


def links(firms: DataFrame, moves: DataFrame, given: DataFrame | None = None) -> DataFrame:
    """(kind, left_id, right_id): ``linked_firms`` and ``linked_moves`` together."""
    return linked_firms(firms).select(F.lit("firm").alias("kind"), "left_id", "right_id").unionByName(linked_moves(moves, given).select(F.lit("person").alias("kind"), "left_id", "right_id"))
