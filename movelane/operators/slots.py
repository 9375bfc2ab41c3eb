"""Person slots: whether the words captured for a person can be one.

Firms are a table of any size that the words meet in a join; places and practice words are fixed lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from movelane.functions import gazetteer
from movelane.functions.names import clean_person

# Words that no name has, by what they are. Common surnames (law, young, long, king, white) are left out.
FUNCTION_WORDS = "a an the in at on of to for from with and or as by into after before amid over its his her their this that new".split()
ROLE_WORDS = "partner partners counsel lawyer lawyers solicitor barrister silk head chief director associate associates practice group office leader managing global regional deputy acting senior junior former executive gc clo ceo cfo kc qc llp team litigator veteran specialist expert trainee intern consultant".split()
NAVIGATION = "most popular latest trending featured sponsored deal deals highlights related recommended newsletter subscribe login register menu search share print comments advertisement rankings awards briefing bulletin weekly daily monthly archive copyright privacy terms contact about home news insights analysis opinion premium exclusive".split()
PUBLIC_BODIES = "ex prosecutor regulator commissioner ombudsman inspector adviser judge magistrate registrar tribunal commission authority agency ministry treasury government federal state".split()
QUANTITIES = "one two three four five six seven eight nine ten eleven twelve dozen several many round double triple trio duo pair quartet".split()
EPITHETS = "star ace guru heavyweight rainmaker boss hire hires recruit talent rising seasoned prominent leading top eminent noted respected".split()
ORGANISATIONS = "legal offices journal business founder chambers solicitors attorneys advocates consultancy corporation partnership bureau holdings industries systems solutions ventures ltd limited pty inc corp plc".split()
NOT_A_NAME = sorted({*FUNCTION_WORDS, *ROLE_WORDS, *NAVIGATION, *PUBLIC_BODIES, *QUANTITIES, *EPITHETS, *ORGANISATIONS})


def cleaned(name: Column, places: dict[str, str]) -> Column:
    """``names.clean_person`` with navigation words and one-word places (datelines) as noise in front."""
    return clean_person(name, sorted({*NAVIGATION, *(p for p in places if " " not in p)}))


def fitting(frame: DataFrame, name: str, firms: DataFrame, places: dict[str, str], practices: list[str]) -> DataFrame:
    """(name): the distinct values of column ``name`` that can be a person.

    Two to four words, no digit, no word of NOT_A_NAME or of a practice; without a place; not a firm and not led by a
    firm of two words or more (``firms`` is (surface, code)). ``places`` and ``practices`` are fixed lists. Null names
    don't fit.
    """
    people = frame.select(name).filter(F.col(name).isNotNull()).distinct()
    words = F.filter(F.split(F.lower(F.trim(name)), r"\s+"), lambda w: w != "")
    bare = people.withColumn("_w", F.transform(words, lambda w: F.regexp_replace(w, r"^[.,'’-]+|[.,'’-]+$", "")))
    never = F.array(*map(F.lit, sorted({*NOT_A_NAME, *practices})))
    likely = bare.filter(F.size("_w").between(2, 4) & ~F.col(name).rlike(r"\d") & ~F.arrays_overlap("_w", never) & (F.size(gazetteer.fixed_lookup(places)(F.col(name))) == 0)).select(name)
    n = F.size(F.split(gazetteer.normal(F.col(name)), " "))
    led = gazetteer.all_hits(likely, firms, name, name).filter((F.col("place") == 1) & ((F.col("words") >= 2) | (F.col("words") == n))).select(name).distinct()
    return likely.join(led, name, "left_anti")
