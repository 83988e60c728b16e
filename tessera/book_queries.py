"""Queries of the operators that read a commentary's own text: the lines and pages of the tables, dressed in the patterns of a commentary."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import profiles as P
from . import samples as S
from .functions import text as T
from .operators import align, gate, lookup, pages, segment, spans
from .plans import books
from .sources import pages as sources
from .storage import cut

RUNS = "array<struct<cls:string,text:string>>"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pattern(rows: list, schema: str, turn: Column) -> Column:
    """The pattern whose turn it is, a struct; they take turns."""
    named = [dict(zip([f.split(" ")[0] for f in schema.split(", ")], r if isinstance(r, tuple) else (r,), strict=True)) for r in rows]
    return F.from_json(F.lit(json.dumps(named)), f"array<struct<{schema}>>")[(turn % len(rows)).cast("int")]


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, line_ix, line, turn): the documents' lines, and whose turn it is among patterns."""
    lines = _table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_ix", "line"))
    return lines.withColumn("turn", F.col("doc_id") + F.col("line_ix"))


def _dressed(turn: Column, n: int) -> Column:
    """Of n patterns, each stands before its line in one round and alone in the next."""
    return F.floor(turn / n) % 2 == 0


def _paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as pages of fifty books, their lines as paragraphs with runs."""
    runs = [[{"cls": c, "text": t} for c, t in r] for *_, r in S.PARAGRAPHS]
    lines = _lines(spark, sf_dir)
    pattern = _pattern([(r,) for r in runs], f"runs {RUNS}", F.col("turn"))["runs"]
    line = F.array(F.struct(F.lit("").alias("cls"), F.concat(F.lit(" "), "line").alias("text")))
    rows = lines.select((F.col("doc_id") % 50).cast("int").alias("book_id"), F.col("doc_id").alias("page"), F.col("line_ix").alias("para_ix"), F.when(_dressed(F.col("turn"), len(runs)), F.concat(pattern, line)).otherwise(pattern).alias("runs"))
    return rows.withColumn("text", F.array_join(F.transform("runs", lambda r: r["text"]), ""))


def _segments(segments: DataFrame) -> DataFrame:
    return segments.select("book_id", F.col("seg_ix").cast("int").alias("seg_ix"), F.col("hdr_num").cast("int").alias("hdr_num"), "header", F.array_join("parts", "|").alias("parts"), "page")


# ---- parsers -------------------------------------------------------------------------------------


def number_parsers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' lines behind, or in place of, a line that a parser reads or almost reads."""
    lines = _lines(spark, sf_dir)
    pattern = _pattern(S.NUMBER_LINES, "text string", F.col("turn"))["text"]
    lines = lines.select("doc_id", "line_ix", F.when(_dressed(F.col("turn"), len(S.NUMBER_LINES)), F.concat(pattern, F.lit(" "), "line")).otherwise(pattern).alias("text")).withColumn("search", T.search_form(F.col("text")))
    search, (number, rest) = F.col("search"), T.number_prefix(F.col("search"))
    return lines.select("doc_id", "line_ix", number.alias("number"), rest.alias("rest"), T.unit_marker(search).alias("marker"), T.bracket_number(F.col("text")).alias("bracket"), T.header_number(search).alias("header"), T.opens_by_formula(search).alias("formula"), T.is_narration(search).alias("narration"), T.is_chapter(search).alias("chapter"), T.is_chapter_title(search).alias("title"))


def commentary_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's lines behind the parts of a commentary."""
    parts = F.concat(_pattern([(c,) for c in S.COMMENTS], "parts array<string>", F.col("doc_id"))["parts"], F.split("text", "\n"))
    rows = _table(spark, sf_dir, "documents").select("doc_id", parts.alias("parts"))
    return rows.select("doc_id", T.commentary_text(F.col("parts")).alias("text"), F.array_join(T.clean_parts(F.col("parts"), [P.RULE_PART]), "|").alias("cleaned"))


def cross_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's lines behind a header and parts that list other places, near enough or too far down."""
    pattern = _pattern(S.REFERENCES, "header string, parts array<string>", F.col("doc_id"))
    rows = _table(spark, sf_dir, "documents").select("doc_id", pattern["header"].alias("header"), F.concat(pattern["parts"], F.split("text", "\n")).alias("parts"))
    return rows.select("doc_id", F.array_join(T.listed_places(F.col("header"), F.col("parts")), ",").alias("numbers"))


def second_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "benchmark").select("item_id", F.array_join(T.second_half(T.words(F.col("text"))), " ").alias("words"))


def _contained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with their article as a container that is closed, as one that is left open, without one, behind a challenge, and none; bold as runs."""
    html = F.col("html")
    for plain, styled in S.STYLES:
        html = F.replace(html, F.lit(plain), F.lit(styled))
    kind = F.col("page_id") % 5
    opened = F.replace(html, F.lit("<article>"), F.lit(S.CONTAINER))
    closed, left_open = F.replace(opened, F.lit("</article>"), F.lit(S.CLOSED)), F.replace(opened, F.lit("</article>"), F.lit(S.LEFT_OPEN))
    return _table(spark, sf_dir, "pages").select("page_id", F.when(kind == 0, closed).when(kind == 1, left_open).when(kind == 2, html).when(kind == 3, F.concat(F.lit(S.CHALLENGE), closed)).alias("html"))


def container_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _contained(spark, sf_dir)
    runs = pages.page_runs(rows, P.PageProfile(entities={"&amp;": "&"}), ["page_id"])
    bodies = rows.select("page_id", F.size(pages.raw_paragraphs(F.col("html"), P.PageProfile())).alias("n"))
    return bodies.join(runs.groupBy("page_id").agg(F.concat_ws("|", F.transform(F.sort_array(F.collect_list(F.struct("para_ix", "run_ix", "cls", "text"))), lambda r: F.concat_ws(":", r["para_ix"], r["cls"], r["text"]))).alias("runs")), "page_id", "left").select("page_id", F.when(F.col("n") >= 0, F.col("n")).alias("n_paragraphs"), "runs")


def entity_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' source and the documents, each before a few character references, with all references resolved."""
    page = _table(spark, sf_dir, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text"))
    rows = page.unionByName(_table(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text"))
    text = pages.unescape(F.concat("text", F.lit(" "), _pattern(S.REFERENCES_IN_TEXT, "text string", F.col("id"))["text"]))
    return rows.select("kind", "id", F.length(text).alias("n_chars"), F.sha2(text, 256).alias("text_sha256"))


def base_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as a base book in JSON, its lines as units of two chapters, some without one; units with the titles of their chapters."""
    ident = F.col("doc_id").cast("int")
    chapter = lambda n: F.struct(F.lit(n).alias("id"), ident.alias("bookId"), F.concat("source", F.lit(f" {n}")).alias("arabic"), F.lit("").alias("english"))
    unit = lambda line, i: F.struct((i + 1).alias("id"), (i + 1).alias("idInBook"), F.when(i % 3 > 0, i % 3).alias("chapterId"), ident.alias("bookId"), line.alias("arabic"))
    book = F.struct(ident.alias("id"), F.array(chapter(1), chapter(2)).alias("chapters"), F.transform(F.split("text", "\n"), unit).alias("hadiths"))
    held = _table(spark, sf_dir, "documents").select(F.to_json(book).alias("value")).select(F.from_json("value", sources.BOOK).alias("b")).select("b.*")
    units, chapters = sources.book_units(held), sources.book_chapters(held)
    return units.join(chapters.select("book_id", "chapter_id", "title"), ["book_id", "chapter_id"], "left").select("book_id", "unit_ix", "num", "chapter_id", "text", "title")


def lenient_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' bytes between two that no text has."""
    broken = F.concat(F.unhex(F.lit("FF")), F.col("text").cast("binary"), F.unhex(F.lit("C3")))
    return _table(spark, sf_dir, "documents").select("doc_id", F.sha2(sources.lenient_utf8(broken), 256).alias("text_sha256"))


# ---- cutting -------------------------------------------------------------------------------------


def numbered_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(segment.numbered_segments(_paragraphs(spark, sf_dir)))


def header_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(segment.header_segments(_paragraphs(spark, sf_dir)))


def formula_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(segment.formula_segments(_paragraphs(spark, sf_dir)))


def styled_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(segment.styled_segments(_paragraphs(spark, sf_dir)))


def marker_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(segment.marker_segments(_paragraphs(spark, sf_dir)))


def marker_after_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(segment.marker_segments(_paragraphs(spark, sf_dir), after=True))


def merged_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user as segments of a book; every fourth number is missing, every third header empty."""
    number = F.when(F.floor("value") % 4 != 3, F.floor("value") % 4).cast("int")
    rows = _table(spark, sf_dir, "events").select(F.col("user_id").alias("book_id"), F.col("event_id").alias("seg_ix"), number.alias("hdr_num"), F.when(F.col("event_id") % 3 == 0, "").otherwise(F.col("event_type")).alias("header"), F.array(F.concat("event_type", F.col("event_id").cast("string"))).alias("parts"), F.floor(F.col("event_id") / 100).alias("page"))
    merged = segment.merge_adjacent(rows)
    return merged.select("book_id", "seg_ix", "hdr_num", "header", F.array_join("parts", "|").alias("parts"), "page")


def _titled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as pages of fifty books, behind pieces that are titles, almost are, or repeat the one before."""
    book, page = (F.col("doc_id") % 50).cast("int"), F.floor(F.col("doc_id") / 50).cast("int")
    pattern = _pattern([t for *_, t in S.TITLE_PAGES], "text string", book + page)["text"]
    return _table(spark, sf_dir, "documents").select(book.alias("book_id"), page.alias("page_ix"), F.concat(pattern, F.lit("\n"), "text").alias("text"))


def chapter_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.chapter_headers(_titled_pages(spark, sf_dir))


def chapter_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole books of pages: chapters by their titles, each document as a unit of one of four chapters, its commentary the pages up to the next one's."""
    held = _titled_pages(spark, sf_dir)
    chapters = held.select("book_id").distinct().select("book_id", F.posexplode(F.array(*map(F.lit, S.CHAPTERS))).alias("at", "title")).select("book_id", (F.col("at") + 1).alias("chapter_id"), "title")
    at = F.floor(F.col("doc_id") / 50)
    units = _table(spark, sf_dir, "documents").select((F.col("doc_id") % 50).cast("int").alias("book_id"), (1 + F.floor(at / 5) % 4).alias("chapter_id"), at.alias("unit_ix"), (at + 1).cast("int").alias("num"), "text")
    entries = books.chapter_book(held.withColumn("page_ix", F.col("page_ix").cast("bigint")), units, chapters)
    return entries.select("book_id", "num", F.length("sharh").alias("n_chars"), F.sha2("sharh", 256).alias("sharh_sha256"))


# ---- alignment -----------------------------------------------------------------------------------


def _words(spark: SparkSession, sf_dir: str, name: str, key: str, named: str) -> DataFrame:
    return _table(spark, sf_dir, name).select(F.col(key).alias(named), T.content_words(F.col("text")).alias("words"))


def relaxed_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align.global_match(_words(spark, sf_dir, "benchmark", "item_id", "unit_ix"), _words(spark, sf_dir, "documents", "doc_id", "seg_ix"), P.RELAXED_FILL)
    return found.select(F.col("unit_ix").alias("item_id"), F.col("seg_ix").alias("doc_id"), "best", "n_words")


def suspects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that have little in common with the document of their number."""
    found = align.suspects(_words(spark, sf_dir, "benchmark", "item_id", "num"), _words(spark, sf_dir, "documents", "doc_id", "num"))
    return found.select(F.col("num").alias("item_id"), "shared")


def direct_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with the document of their number, or of the one before or after, that shares most words; eight at least."""
    docs = _words(spark, sf_dir, "documents", "doc_id", "key").withColumnRenamed("words", "body_words")
    shared = F.size(F.array_intersect("words", "body_words"))
    hits = lookup.near_key(_words(spark, sf_dir, "benchmark", "item_id", "num"), docs, "num", "key", F.when(shared >= 8, shared).otherwise(0))
    return hits.select(F.col("num").alias("item_id"), F.col("key").alias("doc_id"), "offset", "score")


def book_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well the benchmark's numbers agree with the places of each source's documents."""
    docs = _table(spark, sf_dir, "documents").select(F.col("source").alias("book_id"), (F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1).cast("bigint").alias("num"), T.content_words(F.col("text")).alias("words"))
    items = _words(spark, sf_dir, "benchmark", "item_id", "unit_ix").withColumn("num", F.col("unit_ix"))
    # every unit counts in every book: twenty books at any size
    return align.agreement(items.crossJoin(docs.select("book_id").distinct()), docs, by=["book_id"])


def number_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources whose numbers may be trusted: every document counts as the unit of its place, or in sources whose name has an even length of the next one's."""
    place = (F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1).cast("bigint")
    docs = _table(spark, sf_dir, "documents").select(F.col("source").alias("book_id"), place.alias("unit_ix"), T.content_words(F.col("text")).alias("words"))
    moved = F.when(F.length("book_id") % 2 == 0, 1).otherwise(0)
    counts = align.agreement(docs.withColumn("num", F.col("unit_ix") + moved), docs.withColumnRenamed("unit_ix", "num"), by=["book_id"])
    sure = align.trusted(counts).select("book_id", F.lit(True).alias("trusted"))
    return counts.join(sure, "book_id", "left").select("book_id", "agree", "disagree", "missing", F.coalesce("trusted", F.lit(False)).alias("trusted"))


def words_needed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers as books, their items as units and their parts as segments: how many words must agree in each."""
    books_ = _table(spark, sf_dir, "lineitem").groupBy(F.col("l_linenumber").alias("book_id")).agg(F.count("*").alias("n_units"), F.count_distinct("l_partkey").alias("n_segs"))
    return books_.select("book_id", "n_units", "n_segs", align.words_needed(F.col("n_units"), F.col("n_segs")).alias("need"))


def entry_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of the documents, some of them many times over, some cut short, are long enough for each book, and not too long."""
    text = F.when(F.col("doc_id") % 4 == 0, F.substring("text", 1, (F.col("doc_id") % 300).cast("int"))).otherwise(F.repeat("text", (1 + F.col("doc_id") % 9).cast("int")))
    docs = _table(spark, sf_dir, "documents").select(text.alias("sharh"))
    limits = lambda b: books.entry_texts(docs, b).agg(F.count("*").alias("n"), F.sum(F.length("sharh")).alias("n_chars")).select(F.lit(b.slug).alias("slug"), "n", "n_chars")
    return reduce(DataFrame.unionByName, map(limits, P.BOOKS.values()))


def _marker_book(spark: SparkSession, sf_dir: str, force_direct: bool) -> DataFrame:
    profile = P.BOOKS["nasai"]
    segments = books.cut_book(_paragraphs(spark, sf_dir), profile)
    at = F.floor(F.col("doc_id") / 50)
    units = _table(spark, sf_dir, "documents").select((F.col("doc_id") % 50).cast("int").alias("book_id"), at.alias("unit_ix"), (at + 1).cast("int").alias("num"), "text")
    entries = books.marker_book(segments, units, profile, global_match=True, force_direct=force_direct)
    return entries.select("book_id", "num", F.length("sharh").alias("n_chars"), F.sha2("sharh", 256).alias("sharh_sha256"))


def numbered_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole numbered book, fifty times: numbers whose sequence holds, then the moving window, cross-references, and a match by text."""
    at = F.floor(F.col("doc_id") / 50)
    units = _table(spark, sf_dir, "documents").select((F.col("doc_id") % 50).cast("int").alias("book_id"), at.alias("unit_ix"), (at + 1).cast("int").alias("num"), "text")
    entries = books.numbered_book(_paragraphs(spark, sf_dir), units)
    return entries.select("book_id", "num", F.length("sharh").alias("n_chars"), F.sha2("sharh", 256).alias("sharh_sha256"))


def marker_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole marker book, fifty times: cut at its markers, its documents as units, numbers where they may be trusted, else the best head of all."""
    return _marker_book(spark, sf_dir, False)


def forced_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with all numbers trusted."""
    return _marker_book(spark, sf_dir, True)


def fill_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders filled from five sources in turn: the part of their number, of the next one, listed parts, listing orders, any part."""
    numbers = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("num"))
    usable = _table(spark, sf_dir, "part").where("p_size >= 40").select(F.col("p_partkey").alias("num"))
    edges = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"), F.col("l_linenumber").alias("pos"), F.col("l_orderkey").alias("src_ix"))
    own = lookup.among(numbers, usable, ["num"]).withColumn("target", F.col("num"))
    following = numbers.withColumn("target", F.col("num") + 1).join(usable.withColumnRenamed("num", "target"), "target", "left_semi").select("num", "target")
    listed, listing = lookup.forward_reference(numbers, edges, usable), lookup.reverse_reference(numbers, edges, usable)
    rest = numbers.where("num % 3 = 0").withColumn("target", F.lit(0).cast("bigint"))
    return lookup.by_priority([own, following, listed, listing, rest], ["num"]).select("num", "target", "priority")


def anchor_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source is a book of pages, the benchmark items are its units, in chapters of twenty that may be anywhere."""
    docs = _table(spark, sf_dir, "documents").select(F.col("source").alias("book_id"), (F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1).cast("bigint").alias("page_ix"), T.content_words(F.col("text")).alias("words"))
    docs = cut(docs)  # written once, as many steps read them
    sized = docs.groupBy("book_id").agg((F.count("*") - 1).alias("end"))
    items = _table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("unit_ix"), F.col("item_id").alias("num"), F.floor(F.col("item_id") / 20).alias("chapter_id"), "text")
    # every unit is looked for in every book: twenty books at any size
    units = items.crossJoin(sized).withColumn("start", F.lit(0).cast("bigint"))
    return books.unit_anchors(docs, units).select("book_id", "num", "page_ix")


# ---- gate ----------------------------------------------------------------------------------------


def gate_identical_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the units of a book; neighbours are alike where their values are near."""
    allowed = spark.createDataFrame(P.IDENTICAL_ALLOWED, "a bigint, b bigint")
    text = F.repeat(F.concat(F.lit("value "), F.floor(F.col("value") / 200).cast("string"), F.lit(" ")), F.when(F.col("event_type") == "click", 5).otherwise(12))
    return gate.identical_neighbours(_table(spark, sf_dir, "events").select(F.lit("events").alias("slug"), F.col("event_id").alias("num"), text.alias("text")), allowed)


def gate_spot_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = _table(spark, sf_dir, "benchmark").select(F.lit("all").alias("slug"), F.col("item_id").alias("num"), "text")
    return gate.spot_case(units, "all", 3, ["the"], 4)


def gate_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as units; commentaries quote their own one, the next one, a narration's opening, or nothing."""
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("num"), "text")
    after = docs.select((F.col("num") - 1).alias("num"), F.substring("text", 21, 60).alias("next"))
    # what is quoted is cut out first, so that no whole text is moved for it
    held = docs.select("num", F.substring("text", 11, 60).alias("own"), F.substring("text", 1, 20).alias("head"))
    own, kind = F.col("own"), F.col("num") % 5
    quote = F.when(kind <= 1, F.concat(F.lit(S.QUOTE_OWN[0]), own, F.lit(S.QUOTE_OWN[1]))).when(kind == 2, F.concat(F.lit(S.QUOTE_NEXT[0]), F.coalesce("next", F.lit("")), F.lit(S.QUOTE_NEXT[1]))).when(kind == 3, F.lit(S.QUOTE_NARRATION)).otherwise("")
    return gate.pairing(held.join(after, "num", "left").select("num", F.concat(quote, F.lit(" "), "head").alias("sharh")), docs)


def gate_unit_maxima(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders dealt out over the base books, up to the greatest number that each has: complete or not."""
    rows = [(i, slug, n, P.UNIT_TOLERANCE.get(slug, 0), slug in P.UNORDERED_BOOKS) for i, (slug, n) in enumerate(P.UNIT_MAXIMA.items())]
    expected = spark.createDataFrame(rows, "at int, slug string, canon_max int, tolerance int, unordered boolean")
    dealt = _table(spark, sf_dir, "orders").select((F.col("o_orderkey") % len(rows)).cast("int").alias("at"), F.floor(F.col("o_orderkey") / len(rows)).cast("int").alias("num"), F.concat_ws(" ", "o_orderpriority", F.col("o_totalprice").cast("int")).alias("text"))
    units = dealt.join(expected.select("at", "slug", "canon_max"), "at").where(F.col("num").between(1, F.col("canon_max"))).select("slug", F.col("num").alias("unit_ix"), "num", "text")
    return gate.numbering(units, expected.drop("at")).select("slug", "n", "n_short", "max_num", "n_inversions", "ok")


_ALL = (number_trust, words_needed, entry_limits, marker_book, forced_book, chapter_book, numbered_book, entity_text, lenient_text, book_agreement, fill_order, number_parsers, commentary_texts, cross_references, second_half, container_text, base_book, numbered_segments, header_segments, formula_segments, styled_segments, marker_segments, marker_after_segments, merged_segments, chapter_titles, relaxed_fill, suspects, direct_verify, anchor_search, gate_identical_pairs, gate_spot_case, gate_pairing, gate_unit_maxima)
QUERIES = {f.__name__: f for f in _ALL}
