"""Template residue and error-page text.

Placeholders are found by grammars, one per delimiter, each read up to its closing delimiter however far that is, so
that brackets of ordinary prose (quotations, sets, citations, strings special to a tokenizer) are none. What surrounds a
placeholder discounts it: code, quotation marks around it, a sentence that names the machinery of templates, or, in a
text that does so repeatedly, a sentence that shows one. One common word never does. Filler is found by the phrases
that writers leave behind and by runs of filler words, unless a sentence quotes them as such. Error pages and script
notices count only where little else is left: each sentence of a text is cue, furniture or content, and the share of
content decides; texts no phrase fits are scored by how densely they speak of failing.

All of it is JVM expressions over one row: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from movelane.functions.text import reused

_FIELD = r"[A-Za-z_][\w.\- ]*"
# One grammar per delimiter.
GRAMMARS = {
    "double braces": r"\{\{\{?\s*[#/^>!&]?\s*[A-Za-z_][^{}\n]*\}\}",
    "block tag": r"\{%-?\s*\w[^%\n]*(?:%(?!\})[^%\n]*)*%\}",
    "scriptlet": r"<%[=#\-]?\s*\w[^\n>]*%>",
    "dollar braces": r"\$\{\s*[A-Za-z_][\w.\-]*\s*\}",
    "hash braces": r"#\{\s*[A-Za-z_][\w.\-]*\s*\}",
    "single braces": r"\{(?:\d{1,2}|[a-z]+(?:[A-Z][a-z]+)+|[a-z]+(?:_[a-z]+)+|[A-Z]{2,}(?:_[A-Z]+)*|(?:first|last|full)? ?(?:name|firm|title|date|city|office|email|company|partner|client|headline|author))\}",
    "double brackets": r"\[\[\s*" + _FIELD + r"\]\]",
    "double angles": r"<<\s*" + _FIELD + r">>",
    "escaped angles": r"&lt;\s*[A-Za-z_][\w \-]*&gt;",
    "percent signs": r"%[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)+%|%%[A-Za-z_]{2,}%%|%\([a-z_]{2,}\)s",
    "underscores": r"__[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)*__",
    "at signs": r"@@[A-Z][A-Z0-9_]*@@",
    "list marks": r"\*\|[A-Z][A-Z0-9_:]*\|\*",
    "named brackets": r"\[(?:(?:[A-Z][a-z]+ ){0,3}(?:Name|Title|Date|City|Office|Email|Address|Company|Quote|Surname|Number|Firm|Practice)(?: Here)?|[A-Z]{3,}(?:[ _-][A-Z]+)+|(?:(?:INSERT|ADD|ENTER|YOUR|PLACEHOLDER|REPLACE|TO COME|Insert|Add|Enter|Your)\b|T[BK][ACD]?\b:?)[^\[\]\n]*|(?:(?:the|your|client|customer|recipient|first|last|full|company|firm|partner|event|author|contact|sender|job)[ _-])+(?:name|title|date|city|office|email|address|phone|company|quote|surname|number|firm|practice|amount|department|position|country))\]",
    "object": r"\[object [A-Z]\w*\]|\[object [^\[\]\n]+ Object\]",
    "format letter": r"%[sd](?<![\w%]%[sd]|\d %[sd])(?![\w%])",
    "unset value": r"undefined(?<![\w\"'“‘]undefined)(?<!\b(?:is|was|were|are|be|been|being|left|remain|remains|remained|an|legally|deliberately|otherwise|simply|currently|and|or|as|itself) undefined)(?<!\b[a-z]{2,20}ly undefined)(?![\"'”’A-Za-z]| (?:terms?|variables?|behaviou?rs?|values?|in the|by the|by any))",
}
PLACEHOLDER = r"(?=[{\[<$#%_@*&u])(?:" + "|".join(f"(?:{g})" for g in GRAMMARS.values()) + ")"
# Words that name the machinery of templates: a sentence with one speaks of placeholders instead of holding one.
_MACHINERY = r"(?i)\b(?:syntax|template language|templating|templates? engine|placeholders?|merge (?:fields?|tags?)|mail merge|curly brac\w+|delimiters?|variables? (?:such as|like|named|called)|interpolat\w+|escap(?:e|ed|ing) sequences?|documentation|tutorial)\b"
# Words by which a sentence may show one; they count only in a text that names the machinery, or with each other.
_SHOWS = r"(?i)\b(?:write|writes|written as|typed?|types|renders?|prints?|outputs?|looks? like|for example|for instance|e\.g\.|such as)\b"
#: A text that names the machinery this often is about it.
ABOUT = 2
_QUOTED = r"[\"“«‘`]\s*(?:%s)\s*[\"”»’`]"
_CODE = r"(?s)```.*?```|`[^`\n]+`|(?m)(?:^(?: {4,}|\t+)(?:[^\s]+[ \t]*){1,6}$)"

# Phrases left where text was to come. A line that is nothing else is filler. Lower case; blanks only as "\ ".
FILLER = r"""(?m)^[^\w\n]*(?:
 (?:text|copy|story|article|body|more\ text|content|caption|details?)\ to\ (?:come|follow) | (?:your\ |the\ )?(?:\w+\ )?(?:headline|copy|text|caption|title|story|body|quote|content|standfirst)s?\ goes?\ here
 | (?:insert|write|type|put|add|enter|paste)\ (?:your\ |the\ |a\ )?(?:\w+\ ){0,2}(?:here|quote|text|copy|body|headline|article|story)(?:\ here)? | replace\ this\ text\b.*
 | (?:this\ is\ )?(?:a\ |some\ )?(?:dummy|filler|sample|placeholder|holding|blind|test)[\ -]?(?:text|paragraph|copy|content|sentence|article|story)\b.{0,90}
 | blindtext(?:,?\ blindtext)* | hier\ steht\ (?:später\ )?(?:der|ihr|dein)\b.{0,30} | ici\ votre\ texte | votre\ texte\ ici | (?:à|a)\ compléter\b.{0,40} | texte\ à\ venir | texto\ de\ (?:relleno|ejemplo) | aquí\ va\ .{0,30} | su\ texto\ aquí
 | 此处(?:填写|输入|插入).{0,20} | 占位(?:文本|符).{0,10} | (?:正文|内容)待(?:补充|定)
 | (?:test|blah|bla|asdf\w*|foo|qwerty\w*|x{3,}|jkl|lorem)(?:[\ ,]+(?:test|blah|bla|asdf\w*|foo|bar|qwerty\w*|x+|jkl|ipsum))+ | story\ text | body\ text | tk(?:\ ?tk)+ | [\dx]+\ words\ on\ .{1,40} | .{0,40}\bdo\ not\ publish\b.*
)[^\w\n]*$"""  # fmt: skip
# The words of the usual nonsense Latin; ordinary prose has no run of them.
_LATIN = "lorem|ipsum|dolor|sit|amet|consectetur|adipiscing|elit|sed|do|eiusmod|tempor|incididunt|ut|labore|et|dolore|magna|aliqua|enim|ad|minim|veniam|quis|nostrud|exercitation|ullamco|laboris|nisi|aliquip|ex|ea|commodo|consequat|duis|aute|irure|in|reprehenderit|voluptate|velit|esse|cillum|eu|fugiat|nulla|pariatur|excepteur|sint|occaecat|cupidatat|non|proident|sunt|culpa|qui|officia|deserunt|mollit|anim|id|est|laborum"
LATIN_RUN = rf"(?i)\b(?:{_LATIN})(?:[\s,.;]+(?:{_LATIN})){{5,}}\b"

# Sentences that speak of filler: its words quoted in one of them are none.
_SPEAKS = r"(?i)\b(?:placeholder|dummy|filler|specimen|typeset\w*|printers?|nonsense|phrase|words|example|known as|begins?|reads?)\b"

# What servers and gates say, each in one line. Lower case; blanks only as "\ ".
ERROR = r"""
 ^\W*(?:error|http|fehler|erreur|status)?\W*[45]\d\d\b(?!\ (?:lawyers|partners|million|per|page\ on))(?=\W*$|\W{1,4}\w+(?:\ \w+){0,4}\W*$|\W+(?:no|the|page|your|our|you|we|this|something|an?|please|too|access|checking|reading|it|that)\b)
 | \b(?:page|story|url|item|resource|content|link|address|file|article)\b.{0,40}\b(?:not\ found|could\ not\ be|cannot\ be|can't\ be|no\ longer\ at|has\ moved|never\ existed|been\ withdrawn|is\ broken|may\ be\ old|does\ not\ exist|doesn't\ exist|is\ gone|is\ unavailable|is\ not\ available)\b
 | ^\W*(?:page\ )?not\ found\W*$ | page\ introuvable | l'adresse\ demandée | no\ se\ ha\ encontrado | página\ no\ (?:encontrada|existe) | 页面不存在 | 无法找到 | 已被删除 | seite\ nicht\ gefunden | n'a\ pas\ été\ trouvée
 | we\ (?:can't|cannot|couldn't|could\ not|were\ unable\ to)\ (?:find|load|open|display)\b | \bhave\ lost\ that\ page | that\ link\ is\ broken | no\ such\ item\b | cannot\ open\ article | may\ have\ been\ taken\ down
 | bad\ gateway | ^\W*bad\ request | gateway\ time-?out | internal\ server\ error\W*$ | erreur\ interne\ du\ serveur | interner\ serverfehler | error\ interno\ del | service\ (?:temporarily\ )?unavailable | ^\W*temporarily\ (?:offline|unavailable) | ^\W*service\ interruption | upstream\ timed\ out | origin\ refused\ the | did\ not\ answer\ in\ time | could\ not\ complete\ your\ request | could\ not\ be\ rendered | unexpected\ condition\ was
 | ^\W*something\ (?:went\ wrong|broke)\b | \ban\ error\ (?:has\ )?occurred | ^\W*(?:o+ps|whoops|hmm)\b | carrying\ out\ planned\ maintenance | making\ some\ changes\ and\ will\ be\ back | ^\W*we(?:'ll|\ will)\ be\ (?:right\ )?back
 | ^\W*access\ denied\W*$ | ^\W*(?:access\ )?forbidden\W*$ | don't\ have\ permission\ to | needs\ a\ permission\ your | ^\W*unauthori[sz]ed\b.{0,12}$ | ^\W*(?:you\ (?:are|have\ been)\ )?blocked\W*$ | ^\W*request\ rejected | blocked\ by\ the\ firewall | detected\ unusual\ traffic | too\ many\ requests | slow\ down\ and\ try | not\ available\ in\ your\ (?:region|country)
 | \b(?:session|sign-?in|login)\ (?:has\ )?expired | have\ been\ signed\ out | please\ log\ in\ again | not\ a\ robot | checking\ that\ you\ are\ human | checking\ your\ browser | ^\W*nothing\ here\b
 | traceback\ \(most\ recent | ^\W*[\w.]*(?:error|exception):\ | nullpointerexception | ^\W*fatal\ error | uncaught\ exception | ^\ *at\ [\w.]+\([\w.]+:\d+\) | ^\W*file\ ".+",\ line\ \d+ | \bin\ /\S+\.php\ on\ line | could\ not\ connect\ to\ database"""  # fmt: skip
SCRIPT = r"""
 \b(?:enable|activate|allow|turn(?:ed)?\ on|switch(?:ed)?\ on|need|requires?|needs|activez?r?|active|aktivieren\ sie|activer|habilite)\b.{0,40}\b(?:javascript|js|scripts?|scripting)\b
 | \b(?:javascript|js|scripts?|scripting)\b.{0,60}\b(?:required|disabled|blocked|switched\ (?:off|on)|turn(?:ed)?\ (?:it\ )?on|enabled?|is\ allowed|erforderlich|nécessaire|necesario|aktivieren|activer)\b
 | \bblocks\ scripts\b | \bnoscript\b | only\ works\ with\ (?:javascript|js|active\ scripting|scripting)\b | 启用\ ?javascript"""  # fmt: skip
FURNITURE = r"""
 ^.*\ [|›·]\ | ^\S.{0,60}\ {2,}\S.{0,200}$ | ^\W*© | all\ rights\ reserved\W*$ | terms\ of\ use | registered\ office\ and | is\ published\ from | printed\ and\ published | independent\ press\ panel | images\ supplied\ by | ^\W*design: | ^\W*build\ \d | popular\ searches | contact\ the\ newsdesk
 | ^\W*(?:return\ to|go\ back|back\ to)\b.{0,40}$ | ^\W*(?:try|please\ try)\b.{0,60}\b(?:again|later|search)\b | enable\ it\ under | ^\W*(?:incident|reference|ray|request\ id|proxy|error\ code|node|code)\b.{0,40}$ | keeps\ happening | ^\W*quote\ (?:reference\ )?\S+ | ^\W*[\w-]*\d[\w-]*\W*$ | ^\W*loading\W*$ | report\ a\ problem
 | experience\ turn\ it\ on | page\ needs\ it\ to | this\ takes\ a\ moment | réessayer | prüfen\ sie\ die\ adresse | ^\W*.{0,60}\ come\ back\W*$ | change\ your\ browser\ settings | if\ nothing\ happens | will\ be\ back | and\ reload\W*$ | write\ to\ the\ help\ desk | is\ legal\ advice | take\ advice\ on\ their\ own | accepts?\ no\ liability | ^.{0,3}$ | newsroom\W*$ | ^\W*(?:ltd|l\.l\.p|llp|co|pte)\W*$ | turn\ it\ on\ to\ continue"""  # fmt: skip


def _pattern(text: str) -> str:
    """A pattern written over several lines; a backslash before a blank keeps it."""
    return "".join(text.replace("\\ ", "\x00").split()).replace("\x00", " ")


def _scan(pattern: str) -> str:
    """The alternatives of a pattern regrouped so that what many begin with, a line or a word, is tested once."""
    parts, depth, at = [""], 0, 0
    while at < len(pattern):
        step = pattern[at : at + 2] if pattern[at] == "\\" else pattern[at]
        depth += (step in ("(", "[")) - (step in (")", "]"))
        if step == "|" and depth == 0:
            parts.append("")
        else:
            parts[-1] += step
        at += len(step)
    line, word = r"^\W*", r"\b"
    lines = [p[len(line) :] for p in parts if p.startswith(line)]
    words = [p.removeprefix(word) for p in parts if p.startswith(word) or (p[0].isascii() and p[0].isalpha())]
    rest = [p for p in parts if not p.startswith((line, word)) and not (p[0].isascii() and p[0].isalpha())]
    return "|".join([f"{line}(?:{'|'.join(lines)})", rf"\b(?=[a-z])(?:{'|'.join(words)})", *rest])


_FILLER, _ERROR, _SCRIPT, _FURNITURE = map(_pattern, (FILLER, ERROR, SCRIPT, FURNITURE))
_CUE = f"(?m)(?:{_scan(_ERROR + '|' + _SCRIPT)})"
_NO_CONTENT = f"(?m)^(?=.*?(?:{_ERROR}|{_SCRIPT}|{_FURNITURE})).*$"
_HEADINGS = r"^\s*(?:[^\n]+[^\n.!?。！？\"”»]\n+){1,2}(?=\S)"
#: A notice stands in place of content if content is at most this share of the text's characters.
CONTENT_SHARE = 0.3
# What pages that fail speak of, whatever their phrases: the failure, what failed, and what to do about it.
FAILURES = r"\b(?:errors?|fail(?:ed|s|ure)|problems?|went wrong|not (?:found|available|exist|load(?:ed|ing)?|respond(?:ing)?|supported|permitted|allowed|authori[sz]ed)|isn't available|aren't available|cannot|can't|couldn't|could not|unable to|un(?:available|reachable|expected|supported)|denied|forbidden|expired|timed? ?-?out|too long|moved|missing|broken|blocked|disabled|offline|down for|maintenance|overloaded|busy|unusual|suspicious)\b"
MACHINES = r"\b(?:server|page|url|link|address|site|website|request|response|connection|network|gateway|browser|javascript|scripts?|cookies?|session|captcha|robots?|firewall|host|domain|resource|content|access|permission|login|sign-?in|account)\b"
REMEDIES = r"\b(?:try again|refresh|reload|go back|return to|come back|check (?:the|your)|clear your|contact (?:the|us|your|support)|log ?in|sign in|enable|turn on|switch on|wait|later|shortly|moment|retry|home ?page|search)\b"
#: A text without a known phrase is a notice if it has all three kinds and at least this many of them a word.
DENSITY = 1 / 3
#: No notice is longer: one that says it in so many words is an article.
LONGEST_NOTICE = 600


def one_per_line(text: Column) -> Column:
    """The text in lower case with each sentence on a line of its own."""
    ended = F.regexp_replace(F.lower(text), r"([.!?])[  ]+(?=\S)", "$1\n")
    for stop in "。！？":
        ended = F.replace(ended, F.lit(stop), F.lit(stop + "\n"))
    return F.regexp_replace(ended, r"\n\s+", "\n")


def without_code(text: Column) -> Column:
    return F.regexp_replace(text, _CODE, " ")


def has_placeholder(text: Column) -> Column:
    """True if a placeholder stands outside code and quotation marks, in a sentence that does not speak of placeholders.

    A sentence speaks of them if it names the machinery of templates; one that only shows (writes, for example) does so
    in a text that names the machinery ABOUT times or more.
    """

    def unfilled(bare: Column) -> Column:
        sentences = F.split(bare, r"\n+|(?<=[.!?])\s+")
        about = F.size(F.regexp_extract_all(bare, F.lit(_MACHINERY), F.lit(0))) >= ABOUT
        return F.exists(sentences, lambda s: s.rlike(PLACEHOLDER) & ~s.rlike(_MACHINERY) & ~(about & s.rlike(_SHOWS)))

    # Few texts have any; only those are taken apart.
    return text.rlike(PLACEHOLDER) & reused(F.regexp_replace(without_code(text), _QUOTED % PLACEHOLDER, " "), unfilled)


def _latin(text: Column) -> Column:
    """True if a run of filler words stands in a sentence that does not quote it as such."""
    return text.rlike(LATIN_RUN) & F.exists(F.split(text, r"\n+"), lambda s: F.regexp_replace(s, r"[\"“«‘][^\"“”«»]*[\"”»’]", " ").rlike(LATIN_RUN) | (s.rlike(LATIN_RUN) & ~s.rlike(_SPEAKS)))


def _filler(text: Column, lines: Column) -> Column:
    return _latin(text) | F.when(F.contains(lines, F.lit(" / ")), F.regexp_replace(lines, r" +/ +", "\n")).otherwise(lines).rlike(_FILLER)


def _dense(lines: Column) -> Column:
    """True if a short text is dense in words of failing, of what fails and of remedies."""
    kinds = [F.array_distinct(F.regexp_extract_all(lines, F.lit(k), F.lit(0))) for k in (FAILURES, MACHINES, REMEDIES)]
    hits = sum((F.size(k) for k in kinds), F.lit(0))
    return F.length(lines).between(20, LONGEST_NOTICE) & (F.array_min(F.array(*map(F.size, kinds))) > 0) & (hits >= DENSITY * F.size(F.split(F.trim(lines), r"\s+")))


def _notice(lines: Column) -> Column:
    def little(under: Column) -> Column:
        return F.length(F.regexp_replace(F.regexp_replace(under, _NO_CONTENT, ""), r"\s+", " ")) <= CONTENT_SHARE * F.length(lines)

    # Headings (up to two leading lines that end no sentence) are not what a page is for.
    return (lines.rlike(_CUE) & little(F.regexp_replace(lines, _HEADINGS, ""))) | _dense(lines)


def has_filler(text: Column) -> Column:
    return reused(one_per_line(text), lambda lines: _filler(text, lines))


def is_notice(text: Column) -> Column:
    """True if an error page or script notice stands in place of content."""
    return reused(one_per_line(text), _notice)


def residue_kinds(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, placeholder, filler, notice) of each document; null and blank texts have none of them."""
    t = F.coalesce(F.col(text), F.lit(""))
    both = reused(one_per_line(t), lambda lines: F.struct(_filler(t, lines).alias("filler"), _notice(lines).alias("notice")))
    return documents.select(F.col(key), has_placeholder(t).alias("placeholder"), both.alias("_b")).select(key, "placeholder", "_b.filler", "_b.notice")


def residue(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key) of the documents with template residue, or with an error page or script notice in place of content.

    Null, empty and blank texts are no case. Every row is judged by itself, repeated rows come out repeated.
    """
    return residue_kinds(documents, key, text).filter("placeholder or filler or notice").select(key)
