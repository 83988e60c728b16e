"""Sources: cached pages as files, page tables, crawl bookkeeping, JSON books."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHAPTER = "struct<id:int,bookId:int,arabic:string,english:string>"
UNIT = "struct<id:int,idInBook:int,chapterId:int,bookId:int,arabic:string>"
BOOK = f"id int, metadata struct<id:int,length:int,arabic:string,english:string>, chapters array<{CHAPTER}>, hadiths array<{UNIT}>"


def lenient_utf8(raw: Column) -> Column:
    """Bytes as text with malformed sequences left out."""
    return F.replace(F.make_valid_utf8(raw.cast("string")), F.lit("\ufffd"), F.lit(""))


#: Digits of a page number at most.
MOST_DIGITS = 9


def number_globs(first: int, last: int | None = None) -> list[str]:
    """Glob patterns that together match the numbers from first to last (without one, all from first on), as they are written without leading zeros."""
    last = 10**MOST_DIGITS - 1 if last is None else last
    out = []
    while first <= last:
        # the widest block of numbers that begins here and differs in its last digits only
        free = 0
        while first and first % 10 ** (free + 1) == 0 and first + 10 ** (free + 1) - 1 <= last and len(str(first + 10 ** (free + 1) - 1)) == len(str(first)):
            free += 1
        head, digit = divmod(first // 10**free, 10)
        top = digit
        while top < 9 and (top + 1 - digit) * 10**free + first + 10**free - 1 <= last:
            top += 1
        span = str(digit) if top == digit else f"[{digit}-{top}]"
        out.append((str(head) if head else "") + span + "[0-9]" * free)
        first += (top - digit + 1) * 10**free
    return out


def read_cached_pages(spark: SparkSession, root: str, first: int = 1, last: int | None = None) -> DataFrame:
    """(book_id, page, html, bytes) of files <root>/<book_id>/<page>.html with page numbers from first to last; files out of range are never opened."""
    names = number_globs(max(0, first), last)
    names = names or ["none"]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "{" + ",".join(f"{n}.html" for n in names) + "}").load(root)
    at = F.regexp_extract("path", r"/(\d+)/(\d+)\.html$", 1), F.regexp_extract("path", r"/(\d+)/(\d+)\.html$", 2)
    pages = files.where(F.col("path").rlike(r"/\d+/\d+\.html$")).select(at[0].cast("int").alias("book_id"), at[1].cast("int").alias("page"), lenient_utf8(F.col("content")).alias("html"), F.col("length").alias("bytes"))
    return pages.where(F.col("page") >= first) if last is None else pages.where(F.col("page").between(first, last))


def is_challenge(html: Column) -> Column:
    """Whether a response is the crawler challenge in place of a page; looks at its first bytes."""
    head = lambda n: F.substring(html.cast("binary"), 1, n).cast("string")
    return head(2_000).contains("Just a moment") | head(3_000).contains("challenges.cloudflare.com")


def response_status(html: Column, least: int = 2_000) -> Column:
    """fail (none), challenge, small (up to `least` bytes, not kept) or ok."""
    return F.when(html.isNull(), "fail").when(is_challenge(html), "challenge").when(F.octet_length(html) > least, "ok").otherwise("small")


def crawl_work(spark: SparkSession, first: int, last: int, cached: DataFrame, least: int = 4_000) -> DataFrame:
    """Pages from first to last that aren't cached with more than `least` bytes; cached has (page, bytes)."""
    wanted = spark.range(first, last + 1).select(F.col("id").cast("int").alias("page"))
    return wanted.join(cached.where(F.col("bytes") > least), "page", "left_anti")


def read_book(spark: SparkSession, path: str) -> DataFrame:
    """One JSON base book a file; the text may span lines."""
    return spark.read.schema(BOOK).option("multiLine", "true").json(path)


def book_units(books: DataFrame) -> DataFrame:
    """(book_id, unit_ix, num, chapter_id, text), in file order; a missing chapter counts as 1."""
    listed = books.select(F.col("id").alias("book_id"), F.posexplode("hadiths").alias("unit_ix", "u"))
    return listed.select("book_id", "unit_ix", F.col("u.idInBook").alias("num"), F.coalesce("u.chapterId", F.lit(1)).alias("chapter_id"), F.col("u.arabic").alias("text"))


def book_chapters(books: DataFrame) -> DataFrame:
    listed = books.select(F.col("id").alias("book_id"), F.posexplode("chapters").alias("chapter_ix", "c"))
    return listed.select("book_id", "chapter_ix", F.col("c.id").alias("chapter_id"), F.col("c.arabic").alias("title"))
