"""From pages to paragraphs and styled runs."""

from __future__ import annotations

import json
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..profiles import GLYPH_SPACE, INVISIBLE, PageProfile

_OPEN, _CLASS = "\u0001", "\u0002"


#: A reference's name or number as it follows the ampersand; names that count without a semicolon, also before more letters.
NAME = r"^[^\t\n\x0C <&#;]{1,32};?"
NUMBER = r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?"
#: The commonest names stand first, as a map is searched from its beginning.
COMMON = ("amp;", "quot;", "lt;", "gt;", "nbsp;")


@lru_cache(maxsize=1)
def entity_names() -> dict[str, str]:
    """HTML's named characters by their names, with the semicolon where it is needed."""
    return {n: html5[n] for n in COMMON} | html5


@lru_cache(maxsize=1)
def open_names() -> str:
    """A pattern of the names that need no semicolon, longer ones first."""
    return "^(?:" + "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))) + ")"


@lru_cache(maxsize=1)
def odd_numbers() -> dict[str, str]:
    """Numbers that stand for other characters than their own: those of Windows' Latin letters, zero and the carriage return."""
    latin = {n: bytes([n]).decode("cp1252", "replace") for n in range(0x80, 0xA0)}
    return {"0": "\ufffd", "13": "\r"} | {str(n): chr(n) if c == "\ufffd" else c for n, c in latin.items()}


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.from_json(F.lit(json.dumps(table)), "map<string,string>"), key)


def _numbered_character(digits: Column, base: int, most: int) -> Column:
    """The character of a number; none for control and non-characters, the replacement character for what is no code point."""
    bare = F.regexp_replace(digits, "^0+", "")
    n = F.when(F.length(bare) <= most, F.coalesce(F.conv(F.when(bare == "", "0").otherwise(bare), base, 10).cast("bigint"), F.lit(0))).otherwise(0x110000)
    none = n.between(1, 8) | (n == 11) | n.between(14, 31) | n.between(0x7F, 0x9F) | n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(0xFFFE) == 0xFFFE)
    valid = F.when(n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), 0xFFFD).otherwise(n)
    character = F.decode(F.unhex(F.lpad(F.hex(valid), 8, "0")), "UTF-32")
    return F.coalesce(_lookup(odd_numbers(), n.cast("string")), F.when(n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "\ufffd").when(none, "").otherwise(character))


def unescape(text: Column) -> Column:
    """Character references as characters, named and numbered ones, by HTML's rules; all in the JVM."""

    def resolved(piece: Column) -> Column:
        name, number = F.regexp_extract(piece, NAME, 0), F.regexp_extract(piece, NUMBER, 0)
        known, prefix = _lookup(entity_names(), name), F.regexp_extract(name, open_names(), 0)
        behind = lambda token: F.substr(piece, F.length(token) + 1)
        hexadecimal = number.rlike("^#[xX]")
        character = F.when(hexadecimal, _numbered_character(F.regexp_extract(number, "[0-9a-fA-F]+", 0), 16, 6)).otherwise(_numbered_character(F.regexp_extract(number, "[0-9]+", 0), 10, 7))
        named = F.when(known.isNotNull(), F.concat(known, behind(name))).when(prefix != "", F.concat(_lookup(entity_names(), prefix), behind(prefix)))
        return F.coalesce(F.when(number != "", F.concat(character, behind(number))), named, F.concat(F.lit("&"), piece))

    pieces = F.split(text, "&")
    rest = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), resolved)
    return F.when(F.contains(text, F.lit("&")), F.concat(pieces[0], F.array_join(rest, ""))).otherwise(text)


def clean(text: Column, entities: dict[str, str] | None = None) -> Column:
    """Without tags, invisible characters and outer white space, and with entities resolved.

    A given entity vocabulary is replaced in its order; without one, all of HTML's character references are resolved.
    """
    bare = F.regexp_replace(text, "<[^>]+>", "")
    if entities is None:
        bare = unescape(bare)
    else:
        for name, character in entities.items():
            bare = F.replace(bare, F.lit(name), F.lit(character))
    return strip(F.translate(bare, INVISIBLE, ""))


def container(page: Column, profile: PageProfile) -> Column:
    """The part of a page with its text; null if there is none."""
    whole = F.when(page.rlike(profile.container), F.regexp_extract(page, profile.container, 1))
    if profile.open_container is None:
        return whole
    rest = F.when(page.rlike(profile.open_container), F.split(F.regexp_extract(page, profile.open_container, 1), profile.open_end)[0])
    return F.coalesce(whole, rest)


def raw_paragraphs(page: Column, profile: PageProfile) -> Column:
    """Paragraph bodies in order: null for no page or a challenge, empty without a container."""
    held = container(page, profile)
    bodies = F.when(held.isNull(), F.array().cast("array<string>")).otherwise(F.regexp_extract_all(held, F.lit(profile.paragraph), 1))
    blocked = F.substring(page, 1, profile.challenge_chars).contains(profile.challenge)
    return F.when(page.isNotNull() & ~blocked, bodies)


def raw_runs(body: Column, profile: PageProfile) -> Column:
    """(cls, text) pieces of a paragraph body in order, not cleaned; text outside of runs has class ''."""
    marked = F.regexp_replace(body, profile.run, f"{_OPEN}$1{_CLASS}$2{_OPEN}")

    def piece(x: Column) -> Column:
        styled = x.contains(_CLASS)
        cls = F.substring_index(x, _CLASS, 1)
        plain = cls.isin(*profile.plain_classes) if profile.plain_classes else F.lit(False)
        return F.struct(F.when(styled & ~plain, cls).otherwise("").alias("cls"), F.when(styled, F.substr(x, F.instr(x, _CLASS) + 1)).otherwise(x).alias("text"))

    return F.transform(F.split(marked, _OPEN), piece)


def page_runs(pages: DataFrame, profile: PageProfile, keys: list[str], html_col: str = "html") -> DataFrame:
    """(*keys, para_ix, run_ix, cls, text): cleaned runs that aren't empty."""
    bodies = pages.select(*keys, F.posexplode(raw_paragraphs(F.col(html_col), profile)).alias("para_ix", "body"))
    runs = bodies.select(*keys, "para_ix", F.posexplode(raw_runs(F.col("body"), profile)).alias("run_ix", "run"))
    return runs.select(*keys, "para_ix", "run_ix", "run.cls", clean(F.col("run.text"), profile.entities).alias("text")).where("text <> ''")


def page_paragraphs(pages: DataFrame, profile: PageProfile, keys: list[str], html_col: str = "html") -> DataFrame:
    """(*keys, para_ix, runs, text): each paragraph's runs are glued as the profile says; empty paragraphs go."""
    runs = page_runs(pages, profile, keys, html_col)
    ordered = F.sort_array(F.collect_list(F.struct("run_ix", "cls", "text")))
    paragraphs = runs.groupBy(*keys, "para_ix").agg(F.transform(ordered, lambda r: F.struct(r["cls"].alias("cls"), r["text"].alias("text"))).alias("runs"))
    text = strip(F.replace(F.array_join(F.transform("runs", lambda r: r["text"]), profile.glue), F.lit(GLYPH_SPACE), F.lit(" ")))
    return paragraphs.withColumn("text", text).where("text <> ''")


def page_documents(paragraphs: DataFrame, book: str, page: str, least: int = 50) -> DataFrame:
    """(book, page_ix, page, text): a page's paragraphs joined by line ends; short pages go, page_ix has no gaps."""
    from pyspark.sql import Window

    ordered = F.transform(F.sort_array(F.collect_list(F.struct("para_ix", "text"))), lambda p: p["text"])
    joined = paragraphs.groupBy(book, page).agg(F.array_join(ordered, "\n").alias("text")).where(F.length("text") >= least)
    return joined.select(book, (F.row_number().over(Window.partitionBy(book).orderBy(page)) - 1).alias("page_ix"), page, "text")
