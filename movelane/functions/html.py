"""Pages and urls to text: regular expressions on columns, one alternation branch per element."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from movelane.functions.text import reused

# Elements dropped with their content, block ends, and the entities that occur.
DROPPED = "script style nav header footer aside form noscript svg iframe".split()
BLOCKS = "p div li br tr h1 h2 h3 h4 h5 h6 section article blockquote ul ol table".split()
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&rsquo;": "’", "&lsquo;": "‘", "&ldquo;": "“", "&rdquo;": "”", "&ndash;": "–", "&mdash;": "—", "&amp;": "&"}
TRACKING = r"^(?:utm_|mc_|_hs|ck_|elq|mkt_tok|trk)"
MIN_BODY, MAX_BODY = 120, 4000
# What begins the furniture below an article.
TAIL_MARKERS = [
    "related stories", "related articles", "most read", "most popular", "subscribe", "newsletter", "share this article",
    "copyright", "terms of use", "privacy policy", "follow us", "read next", "recommended", "deal highlights",
    "you might also like", "more from", "latest news", "latest articles", "editor's picks", "sign up",
    "all rights reserved", "leave a reply", "comments",
]
#: A byline: By, one to three names, a date.
BYLINE = r"By\s+\p{Lu}[\w'’-]+(?:\s+\p{Lu}[\w'’-]+){0,2}\s+\d{1,2}\s+\w{3,9}\s+\d{4}"


def unescape(text: Column) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), ENTITIES.items(), text)


def html_to_text(html: Column) -> Column:
    """Text of a page: comments and dropped elements out, block ends to newlines, other tags to blanks, blanks collapsed."""
    text = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    dropped = "|".join(f"<{e}\\b[^>]*>.*?</{e}>" for e in DROPPED)
    text = F.regexp_replace(text, f"(?is){dropped}", " ")
    text = F.regexp_replace(text, rf"(?i)</(?:{'|'.join(BLOCKS)})>|<br\s*/?>", "\n")
    text = unescape(F.regexp_replace(text, r"<[^>]+>", " "))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"[ \t\r ]+", " "), r" ?\n[ \n]*", "\n"), r"^\s+|\s+$", "")


def strip_tags(text: Column) -> Column:
    """Tags to blanks, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"<[^>]+>", " "), r"\s+", " "))


def title_of(html: Column) -> Column:
    """The first h1, else the title without its site; null unless it has 3 to 30 words."""
    heading = strip_tags(F.regexp_extract(html, r"(?is)<h1\b[^>]*>(.*?)</h1>", 1))
    title = F.regexp_replace(strip_tags(F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title>", 1)), r"\s+[|–—-]\s+[^|–—-]+$", "")
    text = unescape(F.when(heading != "", heading).otherwise(title))
    return F.when(F.size(F.split(text, " ")).between(3, 30), text)


def trim_tail(body: Column, markers: list[str] | None = None) -> Column:
    """The body up to the earliest marker behind its first MIN_BODY characters, white space at its ends dropped.

    Trimming twice changes nothing.
    """
    def cut(text: Column) -> Column:
        at = reused(F.lower(text), lambda low: F.array_min(F.filter(F.transform(F.array(*map(F.lit, markers or TAIL_MARKERS)), lambda m: F.position(m, low, F.lit(MIN_BODY + 2))), lambda i: i > 0)))
        return F.regexp_replace(F.substr(text, F.lit(1), F.coalesce(at - 1, F.length(text))), r"^\s+|\s+$", "")

    return reused(body, cut)


def body_of(text: Column, headline: Column) -> Column:
    """What follows the last occurrence of the headline and then the byline, tail trimmed.

    Null below MIN_BODY characters; cut at MAX_BODY, which is the published limit of an article.
    """
    at = F.instr(F.reverse(text), F.reverse(headline))
    rest = F.when((F.length(headline) > 0) & (at > 0), F.substr(text, F.length(text) - at + 2)).otherwise(text)
    signed = lambda r: reused(F.regexp_instr(r, F.lit(BYLINE)), lambda i: F.when(i > 0, F.substr(r, i + F.length(F.regexp_substr(r, F.lit(BYLINE))))).otherwise(r))
    return reused(trim_tail(reused(rest, signed)), lambda body: F.when(F.length(body) >= MIN_BODY, F.substring(body, 1, MAX_BODY)))


def headline_from_slug(url: Column) -> Column:
    """Words of the last path segment that is no number, without a trailing id of four digits or more."""
    path = F.coalesce(F.regexp_extract(url, r"^[a-zA-Z]+://[^/?#]*([^?#]*)", 1), F.lit(""))
    segments = F.filter(F.split(path, "/"), lambda s: (s != "") & ~s.rlike(r"^\d+$"))
    slug = F.regexp_replace(F.regexp_replace(F.element_at(segments, -1), r"\.[a-z]{2,5}$", ""), r"-\d{4,}$", "")
    text = F.trim(F.regexp_replace(slug, r"[-_]+", " "))
    return F.when(text != "", F.concat(F.upper(F.substring(text, 1, 1)), F.substr(text, F.lit(2))))


def strip_tracking(url: Column) -> Column:
    """The url without tracking parameters; the order of the others is kept."""
    base, query = F.substring_index(url, "?", 1), F.when(F.instr(url, "?") > 0, F.regexp_extract(url, r"\?([^#]*)", 1))
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: ~p.rlike(TRACKING) & (p != "")), "&")
    return F.when(query.isNull(), url).when(kept == "", base).otherwise(F.concat(base, F.lit("?"), kept))
