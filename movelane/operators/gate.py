"""Relevance gates: by language and by the shape of a slug. Recall before precision; a refusal keeps its reason.

Everything is a boolean column of a regular expression, so the gate sits below any Python in a plan and is pushed there.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from movelane.functions.text import reused

# The patterns of each family, case-insensitive. They decide what passes, so they equal the published ones.
MOVEMENT = r"""\bre-?join(s|ed|ing)?\b|\bjoin(s|ed|ing)?\b
\bre-?hire(s|d|ing)?\b|\bhire(s|d|ing)?\b
\bre-?appoint(s|ed|ment|ments|ing)?\b
\bappoint(s|ed|ment|ments|ing)?\b
\bname[sd]?\b[^.]{0,70}?\bas\b
\bname[sd]?\s+(?:its|new|the)\b
\bwelcome(s|d)?\b
\brecruit(s|ed|ing|ment)?\b
\bpoach(es|ed|ing)?\b
\blure[sd]?\b
\bsnap(s|ped)\s+up\b
\bmove[sd]?\s+to\b
\bdepart(s|ed|ure|ures|ing)?\b
\bexit(s|ed|ing)?\b
\bquit(s|ting)?\b
\bleave[sd]?\b|\bleaving\b|\bleft\b
\bpromote[sd]?\b|\bpromotion[s]?\b|\belevate[sd]?\b
\bstep(s|ped|ping)\s+(?:down|up)\b
\bretire(s|d|ment)?\b
\blift[- ]?out\b|\bteam\s+move\b
\bswitch(es|ed)?\b
\bbolster(s|ed)?\b|\bstrengthen(s|ed|ing)?\b|\bbeef(s|ed)\s+up\b
\bgrow(s|ing)?\s+its\b|\badd(s|ed)\b
\blaunch(es|ed)\s+(?:a\s+)?(?:new\s+)?(?:office|practice|firm)\b
\bset(s|ting)?\s+up\s+(?:a\s+)?(?:new\s+)?(?:office|practice|firm)\b
\bopen(s|ed|ing)\s+(?:a\s+)?(?:new\s+)?office\b"""
SENIORITY = r"""\bpartner(s|ship)?\b
\bof\s+counsel\b
\bcounsel\b
\bhead\s+of\b
\bhead(s|ed)?\s+up\b
\bto\s+head\b
\bco[- ]?head\b
\bpractice\s+(?:group\s+)?(?:head|leader)\b
\bmanaging\s+(?:partner|director)\b
\bsenior\s+(?:\w+\s+){0,3}?(?:counsel|lawyer|associate|litigator)\b
\bseasoned\s+(?:\w+\s+){0,2}?(?:counsel|lawyer|litigator|practitioner)\b
\bgeneral\s+counsel\b|\bGC\b
\bchief\s+legal\s+officer\b|\bCLO\b
\bdirector\b
\bprincipal\b
\bsilk\b|\bSC\b|\bKC\b|\bQC\b"""
STRONG = r"""\bwelcomes?\b[^.]{0,60}\bas\s+(?:a\s+|its\s+)?(?:new\s+)?partner\b
\b(?:joins?|joined)\b[^.]{0,40}\bas\s+(?:a\s+|its\s+)?(?:new\s+)?partner\b
\bhires?\b[^.]{0,40}\bpartner\b
\bpartner\b[^.]{0,30}\bjoins?\b
\bnew\s+partner\b
\bpartner\s+(?:hire|appointment|promotion)s?\b
\blateral\s+(?:hire|move)s?\b
\bteam\s+(?:of\s+)?\w+\s+partners?\b
\b\w+[- ]partner\s+team\b"""
DISQUALIFIERS = r"""\bwebinar\b|\bpodcast\b|\bseminar\b|\bconference\b|\bmasterclass\b
\bsponsors?(hip)?\b|\bcharity\b|\bfundrais\w+\b|\bdonation[s]?\b
\bpro\s*bono\s+(?:week|day|award)\b
\baward(s|ed)?\b|\branking[s]?\b|\bshortlist\w*\b|\bfinalist[s]?\b
\bbest\s+law\s+firms?\b|\bemployers?\s+of\s+choice\b
\bcourt\s+(?:rules|orders|finds|rejects|holds|dismisses)\b
\bfederal\s+court\b|\bsupreme\s+court\b|\bhigh\s+court\b|\bcourt\s+of\s+appeal\b
\bjudgment\b|\bappeal\b|\blawsuit\b|\bsues?\b|\bsued\b
\badvis(?:es|ed|ing)\s+on\b|\bacted\s+for\b|\bdeal\s+of\s+the\b
\bsurvey\b|\breport\s+finds\b|\bresearch\s+shows\b
\bgraduate[s]?\b|\btrainee[s]?\b|\bintern(ship)?s?\b
\bjoins?\s+the\b[^.]{0,70}?\b(?:association|society|network|alliance|council|chamber|initiative|pledge|coalition)\b
\bas\s+a\s+(?:\w+\s+){0,2}?(?:corporate|platinum|gold|silver|founding)\s+(?:member|sponsor|partner)\b"""
JUDICIAL = r"""\b(?:named|appointed|announced)\b[^.]{0,50}\b(?:justice|judge|magistrate)\b
\bjudicial\s+appointment\b
\bchief\s+justice\b
\b(?:justice|judge)\s+of\s+the\b
\bsupreme\s+court\s+president\b"""
NOT_A_MOVE_SLUG = r"""\b(?:advises?|advised|acts?\s+for|acted|counsel\s+to)\b
\b(?:financing|refinancing|acquisition|merger|ipo|listing|bond|issuance|offering|investment|fundraising|deal|transaction|joint\s+venture)\b
\b(?:seminar|webinar|conference|forum|summit|awards?|survey|report|guide|rankings?|roundtable|briefing)\b
\b(?:billing|rates|reform|regulation|guidelines|ruling|judgment)\b
\b(?:opens?|launches?|office)\b"""
VERSION = {"language": "language/1", "slug": "slug/1"}


def family(patterns: str) -> str:
    """One case-insensitive alternation."""
    return "(?i)" + "|".join(f"(?:{p})" for p in patterns.splitlines())


def _alternatives(pattern: str) -> list[str]:
    """The alternatives of a pattern that stand outside brackets."""
    out, depth, at = [""], 0, 0
    while at < len(pattern):
        step = pattern[at : at + 2] if pattern[at] == "\\" else pattern[at]
        depth += (step in "([") - (step in ")]") if len(step) == 1 else 0
        if step == "|" and depth == 0:
            out.append("")
        else:
            out[-1] += step
        at += len(step)
    return out


def scan(patterns: str) -> str:
    """``family`` for a scanner that tries alternatives one by one: the common word border is tested first, once."""
    every = [a for line in patterns.splitlines() for a in _alternatives(line)]
    words = [a[2:] for a in every if a.startswith(r"\b")]
    rest = [a for a in every if not a.startswith(r"\b")]
    return "(?i)" + "|".join([rf"\b(?=\w)(?:{'|'.join(words)})", *rest])


#: The tests of the language gate: family, and whether it reads headline, body or both.
TESTS = {"strong": (STRONG, "both"), "judicial": (JUDICIAL, "both"), "disqualified": (DISQUALIFIERS, "both"), "senior": (SENIORITY, "both"), "in_head": (MOVEMENT, "head"), "in_body": (MOVEMENT, "body")}


def language_tests(headline: Column, body: Column) -> Column:
    """struct of the booleans of TESTS; null texts count as empty. Each family is scanned once."""
    head, text = F.coalesce(headline, F.lit("")), F.coalesce(body, F.lit(""))
    read = {"head": head, "body": text, "both": F.concat(head, F.lit("\n"), text)}
    return F.struct(*[read[where].rlike(scan(patterns)).alias(name) for name, (patterns, where) in TESTS.items()])


def decide(tests: Column, tier: Column) -> Column:
    """struct(passed, score, matched, reason) of the booleans of ``language_tests``.

    Evidence adds up to a score between 0 and 1; the decision is an ordered list of rules, the reason names the first
    that refused.
    """
    strong, judicial, disqualified, senior, in_head, in_body = (tests[name] for name in TESTS)
    moved = in_head | in_body
    part = lambda test, points: F.when(test, F.lit(points)).otherwise(F.lit(0))
    # Hundredths, so that the sum is exact.
    points = part(strong, 60) + F.when(in_head, 30).when(in_body, 15).otherwise(0) + part(senior, 25) - part(disqualified, 30) - part(judicial, 60)
    passed = (
        F.when(strong & ~judicial, True).when(judicial, False).when(~moved, False)
        .when(~senior & (~F.coalesce(tier == 1, F.lit(False)) | disqualified), False).when(disqualified & ~in_head, False).otherwise(True)
    )
    named = F.filter(F.array(*[F.when(test, F.lit(name)) for test, name in ((strong, "strong"), (moved, "movement"), (senior, "seniority"), (disqualified, "disqualifier"), (judicial, "judicial"))]), lambda x: x.isNotNull())
    reason = (
        F.when(passed, "relevant").when(judicial, "judicial").when(disqualified, "disqualifier")
        .when(~moved, "no movement").otherwise("no seniority")
    )
    score = F.greatest(F.lit(0), F.least(F.lit(100), points)).cast("decimal(5,2)") / F.lit(100)
    return F.struct(passed.alias("passed"), score.cast("decimal(3,2)").alias("score"), named.alias("matched"), reason.alias("reason"))


def language_gate(headline: Column, body: Column, tier: Column) -> Column:
    """struct(passed, score, matched, reason) of an item; null texts count as empty, a null tier as none.

    The tests are made once: a lambda's variable holds them for the decision, which uses each several times.
    """
    return reused(language_tests(headline, body), lambda tests: decide(tests, tier))


def slug_gate(slug_text: Column, firm_words: Column, place_code: Column) -> Column:
    """struct(passed, score, reason) of a slug that names a firm and a place instead of telling a story.

    ``firm_words`` is the number of words taken by firms (null or 0: none), ``place_code`` the place found. Words of a
    place count as the parts of its code; two words must be left for a name.
    """
    text = F.coalesce(slug_text, F.lit(""))
    words = F.when(F.trim(text) == "", 0).otherwise(F.size(F.split(F.trim(text), r"\s+")))
    firm, place = F.coalesce(firm_words, F.lit(0)) > 0, place_code.isNotNull()
    spare = words - firm_words - F.size(F.split(place_code, "-"))
    reason = (
        F.when(text.rlike(scan(NOT_A_MOVE_SLUG)), "deal_or_event").when(~firm & ~place, "no entity")
        .when(~firm | ~place, "one entity").when(spare < 2, "no_room_for_a_name").otherwise("name_space")
    )
    score = F.when(reason == "name_space", 60).when(reason == "no_room_for_a_name", 30).when(reason == "one entity", 20).otherwise(0)
    return F.struct((reason == "name_space").alias("passed"), (score.cast("decimal(5,2)") / 100).cast("decimal(3,2)").alias("score"), reason.alias("reason"))
