"""Column functions over text: normalisers, words, number parsing, predicates. All stay in the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import profiles as P

#: White space as Python's str.strip sees it; Java's Unicode class lacks U+001C to U+001F.
_EDGE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, _EDGE, "")


def let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x), with x computed once, however often f uses it."""
    return F.transform(F.array(x), f)[0]


def ascii_digits(text: Column) -> Column:
    return F.translate(text, P.ARABIC_DIGITS, P.ASCII_DIGITS)


def _spelled(ranges: str) -> str:
    """All characters of a class like [\\u0610-\\u061A\\u0640]."""
    out = []
    for low, high in re.findall(r"\\u([0-9A-F]{4})(?:-\\u([0-9A-F]{4}))?", ranges):
        out += map(chr, range(int(low, 16), int(high or low, 16) + 1))
    return "".join(out)


#: One table for digits, letter variants and what is deleted, so that a text is gone through once.
_KEPT = len(P.LETTERS_TO)
_SEARCH_FROM = P.ARABIC_DIGITS + P.LETTERS_FROM[:_KEPT] + P.LETTERS_FROM[_KEPT:] + _spelled(P.MARKS_SEARCH)
_SEARCH_TO = P.ASCII_DIGITS + P.LETTERS_TO


def search_form(text: Column) -> Column:
    """For matching: ASCII digits, no marks, letter variants as one, all else than Arabic, digits and Latin letters a space."""
    # spaces aren't searchable either, so a run of both becomes one space
    return F.trim(F.regexp_replace(F.translate(text, _SEARCH_FROM, _SEARCH_TO), P.NOT_SEARCHABLE.replace(" ]", "]+"), " "))


def written_as(letter: str) -> str:
    """All characters that are this letter in search form."""
    return letter + "".join(a for a, b in zip(P.LETTERS_FROM, P.LETTERS_TO, strict=False) if b == letter)


def gate_form(text: Column) -> Column:
    """For the gate: no marks, fewer letter variants as one, single spaces; punctuation, digits and the ends stay."""
    bare = F.translate(text, P.GATE_LETTERS_FROM + _spelled(P.MARKS_GATE), P.GATE_LETTERS_TO)
    return F.regexp_replace(bare, r"(?U)[\s\x1c-\x1f]+", " ")


def search_form_of(literal: str) -> str:
    """search_form of a constant, on the driver."""
    bare = re.sub(P.MARKS_SEARCH, "", literal.translate(str.maketrans(P.ARABIC_DIGITS, P.ASCII_DIGITS)))
    gone = str.maketrans(P.LETTERS_FROM[: len(P.LETTERS_TO)], P.LETTERS_TO, P.LETTERS_FROM[len(P.LETTERS_TO) :])
    return " ".join(re.sub(P.NOT_SEARCHABLE, " ", bare.translate(gone)).split(" ")).strip()


STOP = sorted({search_form_of(w) for w in P.STOP_WORDS})


def words(text: Column) -> Column:
    """Words of the search form in order, none for an empty text."""
    return F.filter(F.split(search_form(text), " "), lambda w: w != "")


def content_words(text: Column, least: int = 4, stop: Sequence[str] = STOP) -> Column:
    """Distinct words of at least `least` characters that aren't stop words; null for a null text."""
    long = F.filter(F.split(search_form(text), " "), lambda w: F.length(w) >= least)
    return F.array_except(long, F.array(*[F.lit(w) for w in stop])) if stop else F.array_distinct(long)


def _number(text: Column, pattern: str, group: int = 1) -> Column:
    found = F.regexp_extract(text, "(?d)" + pattern, group)
    return F.when(found != "", ascii_digits(found).cast("int"))


def number_prefix(search: Column) -> tuple[Column, Column]:
    """(number, rest) of a paragraph in search form that begins with a number; null without one."""
    n = _number(search, P.NUMBER_PREFIX)
    return n, F.when(n.isNotNull(), F.regexp_extract(search, "(?d)" + P.NUMBER_PREFIX, 2))


def unit_marker(search: Column) -> Column:
    return _number(search, P.UNIT_MARKER)


def bracket_number(text: Column) -> Column:
    """The number of a run that is nothing but a bracketed number."""
    return _number(F.regexp_replace(strip(text), P.MARKS_BRACKET, ""), P.BRACKET_NUMBER)


def header_number(search: Column) -> Column:
    """The number of a header line whose rest opens like a narration."""
    return F.when(F.regexp_extract(search, "(?d)" + P.HEADER_NUMBER, 2).rlike(P.HEADER_REST), _number(search, P.HEADER_NUMBER))


def opens_by_formula(search: Column, least: int = 60) -> Column:
    return (F.length(search) > least) & search.rlike("(?d)" + P.OPENING_FORMULA)


def starts_with_any(text: Column, starts: Sequence[str]) -> Column:
    # one pattern, as an or of many would compute the text for each
    return text.rlike("^(?:" + "|".join(map(re.escape, starts)) + ")")


def is_narration(search: Column) -> Column:
    return starts_with_any(search, P.NARRATION_STARTS)


def is_chapter(search: Column) -> Column:
    """Whether it begins with a chapter word, alone or after the conjunction; prefixes, not whole words."""
    return starts_with_any(search, [*P.CHAPTER_STARTS, *(P.AND + w for w in P.CHAPTER_STARTS)])


def is_chapter_title(search: Column) -> Column:
    return search.rlike(P.CHAPTER_TITLE) & (F.length(search) > 3) & (F.length(search) < 90)


def trim_set(text: Column, characters: str = "()[]،,. ") -> Column:
    return F.btrim(text, F.lit(characters))


def commentary_text(parts: Column) -> Column:
    """Parts that aren't blank, joined by blank lines, without the lead marker and with rule lines as blank lines."""
    joined = F.array_join(F.filter(parts, lambda p: strip(p) != ""), "\n\n")
    return strip(F.regexp_replace(F.regexp_replace(joined, P.LEAD_MARKER, ""), P.RULE_LINE, "\n\n"))


def clean_parts(parts: Column, drop: Sequence[str] = ()) -> Column:
    """Stripped parts without empty ones and without those in `drop`."""
    return F.filter(F.transform(parts, strip), lambda p: (p != "") & ~p.isin("", *drop))


def second_half(items: Column, least: int = 30) -> Column:
    """The second half of a list of more than `least` items, else all of it."""
    n = F.size(items)
    return F.when(n > least, F.slice(items, F.floor(n / 2).cast("int") + 1, n)).otherwise(items)


def listed_places(header: Column, parts: Column, most_parts: int = 2) -> Column:
    """Numbers listed as other places of a unit, in order, as digits without leading zeros: a list may hold ones of any length."""
    text = F.array_join(F.concat(F.array(header), F.slice(parts, 1, most_parts)), "\n")
    listed = F.regexp_extract(text, P.CROSS_REFERENCE, 1)
    return F.transform(F.filter(F.split(listed, r"[،,\s]+"), lambda x: x != ""), lambda x: F.regexp_replace(ascii_digits(x), r"^0+(?=\d)", ""))


def cross_references(header: Column, parts: Column, most_parts: int = 2) -> Column:
    """The same as integers; null for one that no unit can have, as it is beyond them."""
    return F.transform(listed_places(header, parts, most_parts), lambda x: x.try_cast("int"))


def fragments(text: Column, pattern: str = P.FRAGMENT, start: str | None = P.COMMENT_START, head: int = 1_200, body: int = 3_000, least: int = 18, most: int = 4) -> Column:
    """Up to `most` quoted fragments in gate form, from the first comment start in the head of the text on."""
    begin = F.regexp_instr(F.substring(text, 1, head), F.lit(start)) if start else F.lit(0)
    part = F.substr(text, F.when(begin > 0, begin).otherwise(F.lit(1)), F.lit(body))
    found = F.transform(F.regexp_extract_all(part, F.lit(pattern), 1), gate_form)
    return F.slice(F.filter(found, lambda f: F.length(f) >= least), 1, most)


def has_glued_tail(text: Column, least: int = 80) -> Column:
    right = F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+$", "")
    return F.regexp_like(right, F.lit("(?d)" + P.GLUED_TAIL)) & (F.length(gate_form(text)) > least)


def has_stray_prefix(text: Column) -> Column:
    return text.rlike(P.STRAY_PREFIX)


def without_glued_tail(text: Column) -> Column:
    return F.when(has_glued_tail(text), strip(F.regexp_replace(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+$", ""), "(?d)" + P.GLUED_TAIL, ""))).otherwise(text)


def accepted(best: Column, second: Column, total: Column, rules: Sequence[P.Rule]) -> Column:
    """Whether a score passes any of the rules; `total` is the number of words looked for."""
    ratio = best / F.greatest(total, F.lit(1))
    return reduce(lambda a, b: a | b, [(best >= b) & (ratio >= r) & (best - second >= m) for b, r, m in rules])
