"""Text measures, case folding for literal search, quote location and evidence windows."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every whitespace code point, and the letters that equal an ASCII letter when
# case is ignored (dotted and dotless i, long s, Kelvin sign).
WHITESPACE = "".join(
    map(
        chr,
        (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B))
        + (0x2028, 0x2029, 0x202F, 0x205F, 0x3000),
    )
)
CASE_VARIANTS = (chr(0x130) + chr(0x131) + chr(0x17F) + chr(0x212A), "iisk")
REPLACEMENT_CHARACTER = chr(0xFFFD)
EVIDENCE_RADIUS = 120

# Ignore case for all scripts, Unicode classes, and only \n as a line end.
REGEX_FLAGS = "(?iuUd)"
_WORD = r"[\p{L}\p{N}_]"
# A letter outside the basic plane takes two units, so looking back must reach two units.
_BEFORE = _WORD + "{1,2}"
WORD_BOUNDARY = f"(?:(?<!{_BEFORE})(?={_WORD})|(?<={_BEFORE})(?!{_WORD}))"


def remove_whitespace(text: Column) -> Column:
    return F.regexp_replace(text, f"[{WHITESPACE}]+", "")


def is_blank(text: Column) -> Column:
    """True for null, empty and whitespace-only text."""
    return ~F.coalesce(text.rlike(f"[^{WHITESPACE}]"), F.lit(False))


def collapse_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "(?U)[\\s\\x1c-\\x1f]+", " "))


def fold_case(text: Column) -> Column:
    """Lower-case text on which an ASCII literal is found exactly when a case-blind search hits."""
    held = reduce(or_, [text.contains(variant) for variant in CASE_VARIANTS[0]])
    return F.lower(F.when(held, F.translate(text, *CASE_VARIANTS)).otherwise(text))


def portable(pattern: str) -> str:
    """Spell word boundaries out: letters, numbers and underscore, but no combining marks."""
    return re.sub(r"(?<!\\)\\b", lambda _: WORD_BOUNDARY, pattern)


def word_text(folded: Column) -> Column:
    """Folded text reduced to its words, one blank apart and at both ends."""
    words = F.regexp_replace(folded, r"[^\p{L}\p{N}_]+", " ")
    return F.concat(F.lit(" "), words, F.lit(" "))


def pattern_hit(
    text: Column, folded: Column, words: Column, pattern: str, guard: str | None = None
) -> Column:
    """Does the pattern occur, ignoring case?

    Plain text and whole words need no regex. For other patterns ``guard`` may name a text that
    every match holds; the regex then only runs where that text occurs.
    """
    if re.fullmatch(r"[A-Za-z0-9 ]+", pattern):
        return folded.contains(pattern.lower())
    word = re.fullmatch(r"\\b([A-Za-z0-9]+)\\b", pattern)
    if word:
        return words.contains(f" {word.group(1).lower()} ")
    hit = text.rlike(REGEX_FLAGS + portable(pattern))
    return hit if guard is None else folded.contains(guard) & hit


def locate_quote(text: Column, quote: Column) -> Column:
    """Zero-based start when the quote occurs exactly once (overlaps count), else NULL."""
    first = F.instr(text, quote)
    again = F.call_function("locate", quote, text, first + 1)
    return F.when((first > 0) & (again == 0), first - 1)


def quote_occurrence(text: Column, quote: Column) -> Column:
    """``absent``, ``unique`` or ``ambiguous``."""
    first = F.instr(text, quote)
    again = F.call_function("locate", quote, text, first + 1)
    return (
        F.when(F.coalesce(first, F.lit(0)) == 0, "absent")
        .when(again > 0, "ambiguous")
        .otherwise("unique")
    )


def window_start(match_start: Column) -> Column:
    return F.greatest(F.lit(0), match_start - EVIDENCE_RADIUS)


def window_end(match_end: Column, text_length: Column) -> Column:
    return F.least(text_length, match_end + EVIDENCE_RADIUS)


def cut(text: Column, start: Column, end: Column) -> Column:
    """Half-open, zero-based slice."""
    return text.substr(start + 1, end - start)
