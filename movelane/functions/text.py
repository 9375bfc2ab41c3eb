"""Text helpers as column expressions."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters that no decomposition folds.
_WHOLE = {"ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "ħ": "h", "Ħ": "H", "ı": "i", "ŧ": "t", "Ŧ": "T"}
_WIDE = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "TH"}


@functools.lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """(accented letters, their base letters): every Latin letter whose decomposition begins with an ASCII letter."""
    pairs = dict(_WHOLE)
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFD", chr(code))
        if len(base) > 1 and base[0].isascii() and base[0].isalpha():
            pairs[chr(code)] = base[0]
    return "".join(pairs), "".join(pairs.values())


def fold_accents(text: Column) -> Column:
    """Latin letters without their accents; combining marks dropped; other characters as they are."""
    source, target = accent_table()
    out = F.translate(F.regexp_replace(text, r"[̀-ͯ]", ""), source, target)
    for letter, letters in _WIDE.items():
        out = F.replace(out, F.lit(letter), F.lit(letters))
    return out


def reused(value: Column, build) -> Column:
    """``build(value)`` with ``value`` computed once, however often ``build`` uses it."""
    return F.get(F.transform(F.array(value), build), F.lit(0))


def squeeze(text: Column) -> Column:
    """White space of any kind collapsed to single blanks, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)[\s​﻿]+", " "))


#: From this length on, halves of a word serve as keys instead of its forms with one letter left out.
LONG = 64


def deletions(word: Column, least: int = 4) -> Column:
    """Keys that words one edit apart share: the word and, from ``least`` letters on, its forms with one left out.

    Very long words have their first and last 32 letters as keys: one edit cannot change both. Words at the border have
    both kinds, so that no pair is missed.
    """
    size = F.length(word)
    one = F.transform(F.sequence(F.lit(1), F.least(size, F.lit(LONG + 1))), lambda i: F.concat(F.substr(word, F.lit(1), i - 1), F.substr(word, i + 1)))
    ends = F.array(F.concat(F.lit("^"), F.substring(word, 1, LONG // 2)), F.concat(F.lit("$"), F.substr(word, size - LONG // 2 + 1)))
    return F.when(size < least, F.array(word)).when(size < LONG, F.array_distinct(F.concat(F.array(word), one))).when(size <= LONG + 1, F.array_distinct(F.concat(F.array(word), one, ends))).otherwise(ends)


def edits(left: Column, right: Column) -> Column:
    """Edit distance up to 2 (99 beyond), with words that differ by one swap of neighbours at distance 1."""
    plain = F.levenshtein(left, right, 2)
    letters = lambda w: F.array_sort(F.split(w, ""))
    swapped = (plain == 2) & (F.length(left) == F.length(right)) & (letters(left) == letters(right))
    return F.when(swapped, 1).when(plain < 0, 99).otherwise(plain)
