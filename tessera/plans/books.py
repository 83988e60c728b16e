"""Whole plans: from paragraphs and units to the entries of a package, one per way of aligning a book.

segments: (book_id, seg_ix, hdr_num, header, parts, page), units: (book_id, unit_ix, num, chapter_id, text). Many
books go through a plan at once; entries are (book_id, num, sharh).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import profiles as P
from ..functions import text as T
from ..operators import align, lookup, segment, spans
from ..storage import cut, free

BOOK = "book_id"
#: Pages of a stretch, by which units meet the pages that their windows may show.
STRETCH = 64
#: Books are dealt out over so many waves, one after the other, as all words of their units and pages are moved.
WAVES = 4


def global_entries(units: DataFrame, segments: DataFrame, rules: Sequence[P.Rule], least: int = 60) -> DataFrame:
    """Units (unit_ix, text) with the text of the best segment (seg_ix, text) of all, if it passes the rules and is long enough."""
    words = lambda rows, key: rows.select(key, T.content_words(F.col("text")).alias("words"))
    found = align.global_match(words(units, "unit_ix"), words(segments, "seg_ix"), rules)
    return found.join(segments, "seg_ix").where(F.length("text") >= least).select("unit_ix", "seg_ix", "best", "text")


def _texts(segments: DataFrame, numbered: bool) -> DataFrame:
    text = T.commentary_text(F.col("parts")) if numbered else F.array_join("parts", "\n\n")
    return segments.select(BOOK, "seg_ix", "hdr_num", text.alias("sharh"))


def entry_texts(texts: DataFrame, profile: P.BookProfile) -> DataFrame:
    """The texts (sharh) that are long enough to be an entry of the book, and not too long."""
    long = texts.where(F.length("sharh") >= profile.least_text)
    return long.where(F.length("sharh") <= profile.most_text) if profile.most_text else long


def _by_number(segments: DataFrame) -> DataFrame:
    return lookup.first_wins(segments.where("hdr_num is not null").select(BOOK, F.col("hdr_num").alias("num"), "seg_ix"), [BOOK, "num"], "seg_ix")


def _sized(segments: DataFrame, units: DataFrame) -> DataFrame:
    return segments.groupBy(BOOK).agg(F.count("*").alias("n_segs")).join(units.groupBy(BOOK).agg(F.count("*").alias("n_units")), BOOK)


def numbered_book(paragraphs: DataFrame, units: DataFrame, profile: P.BookProfile = P.BOOKS["bukhari"]) -> DataFrame:
    """Numbers first, then the window, then cross-references forward and back, then a relaxed match by text."""
    # written once, as many steps read them
    segments = cut(segment.validated_book(paragraphs))
    texts = _texts(segments, True)
    words = cut(units.select(BOOK, "unit_ix", "num", T.content_words(F.col("text")).alias("words")))
    heads = cut(segments.select(BOOK, "seg_ix", T.content_words(F.coalesce("header", F.lit(""))).alias("words")))
    direct = _by_number(segments)
    placed = words.join(direct.withColumnRenamed("seg_ix", "direct"), [BOOK, "num"], "left").select(BOOK, "unit_ix", "num", "words", "direct")
    window = align.numbered_search(placed, heads, [BOOK], profile.rules)
    own = lookup.by_priority([lookup.among(direct, units, [BOOK, "num"]), window.select(BOOK, F.col("num").cast("int").alias("num"), F.col("seg_ix").cast("int").alias("seg_ix"))], [BOOK, "num"])
    entries = cut(own.join(texts.select(BOOK, "seg_ix", "sharh"), [BOOK, "seg_ix"]).where(F.length("sharh") >= profile.least_text).select(BOOK, "num", "sharh"))
    missing = cut(lookup.without(words, entries, [BOOK, "num"]))
    usable = texts.where(F.length("sharh") >= profile.least_text)
    return entries.unionByName(fill_missing(missing, segments, usable, heads, profile))


def fill_missing(missing: DataFrame, segments: DataFrame, usable: DataFrame, heads: DataFrame, profile: P.BookProfile) -> DataFrame:
    """Entries for units without their own commentary, from the usable segment that cross-references or the text point to."""
    ids = [BOOK, "num"]
    edges = segments.where("hdr_num is not null").select(BOOK, "seg_ix", F.col("hdr_num").alias("src"), F.posexplode(T.cross_references(F.col("header"), F.col("parts"))).alias("p", "dst")).select(BOOK, "src", "dst", F.struct("seg_ix", "p").alias("pos"), F.col("seg_ix").alias("src_ix"))
    keyed = lookup.first_wins(usable.where("hdr_num is not null").select(BOOK, F.col("hdr_num").alias("target"), "seg_ix"), [BOOK, "target"], "seg_ix")
    listed = missing.select(BOOK, "num").join(edges.withColumnRenamed("src", "num"), ids).withColumnRenamed("dst", "target").join(keyed, [BOOK, "target"])
    forward = lookup.first_wins(listed.select(BOOK, "num", "pos", "seg_ix"), ids, "pos").select(BOOK, "num", "seg_ix")
    naming = missing.select(BOOK, "num").join(edges.withColumnRenamed("dst", "num"), ids).withColumnRenamed("src", "target").join(keyed, [BOOK, "target"])
    first_named = naming.join(edges.groupBy(BOOK, F.col("src").alias("target")).agg(F.min("src_ix").alias("listed_ix")), [BOOK, "target"])
    reverse = lookup.first_wins(first_named.select(BOOK, "num", "listed_ix", "seg_ix"), ids, "listed_ix").select(BOOK, "num", "seg_ix")
    best = align.block_match(missing.select(BOOK, "unit_ix", "words"), lookup.among(heads, usable, [BOOK, "seg_ix"]), P.RELAXED_FILL, [BOOK])
    relaxed = missing.join(best, [BOOK, "unit_ix"]).select(BOOK, "num", "seg_ix")
    chosen = lookup.by_priority([forward, reverse, relaxed], ids)
    return chosen.join(usable.select(BOOK, "seg_ix", "sharh"), [BOOK, "seg_ix"]).select(BOOK, "num", "sharh")


def marker_book(segments: DataFrame, units: DataFrame, profile: P.BookProfile, global_match: bool = False, force_direct: bool = False) -> DataFrame:
    """Numbers where they agree with the texts (a count over the first units decides), else windows or the best match of all."""
    # written once, as many steps read them; of words 64 bits of a hash, as words take more room than the texts
    signed = segment.signatures(segments, profile.signature_chars, profile.most_segment)
    signed = cut(signed.withColumn("head_words", align.hashed(F.col("head_words"))).withColumn("body_words", align.hashed(F.col("body_words"))))
    segments = signed.drop("head_words", "body_words")
    texts = entry_texts(_texts(segments, False), profile)
    words = cut(units.select(BOOK, "unit_ix", "num", align.hashed(T.content_words(F.col("text"))).alias("words")))
    first = _by_number(segments)
    heads = first.join(signed, [BOOK, "seg_ix"]).select(BOOK, "num", F.col("head_words").alias("words"))
    if force_direct:
        trusted = segments.select(BOOK).distinct()
    else:  # each book decides for itself
        counts = align.agreement(words, heads, by=[BOOK])
        trusted = align.trusted(counts).select(BOOK)
    # few rows, needed here and in the plan
    trusted = cut(trusted)
    direct = None
    if not trusted.isEmpty():
        sizes = _sized(segments, units)
        bodies = first.join(trusted, BOOK, "left_semi").join(signed, [BOOK, "seg_ix"]).join(sizes, BOOK).select(BOOK, F.col("num").alias("key"), "seg_ix", "body_words", align.words_needed(F.col("n_units"), F.col("n_segs")).alias("need"))
        shared = F.size(F.array_intersect("words", "body_words"))
        hits = lookup.near_key(words, bodies, "num", "key", F.when(shared >= F.col("need"), shared).otherwise(0), by=[BOOK])
        direct = cut(hits.join(first.withColumnRenamed("num", "key"), [BOOK, "key"]).select(BOOK, "num", "seg_ix"))
    if global_match:
        rest = words if direct is None else lookup.without(words, direct, [BOOK, "num"])
        numbers = align.block_match(rest, signed.select(BOOK, "seg_ix", F.col("head_words").alias("words")), P.MARKER_GLOBAL, [BOOK]).join(words, [BOOK, "unit_ix"]).select(BOOK, "num", "seg_ix")
    else:
        scores = align.overlap(words.select(BOOK, "unit_ix", "words"), signed.select(BOOK, "seg_ix", F.col("body_words").alias("words")), [BOOK], least=3)
        flags = texts.select(BOOK, "seg_ix", F.lit(True).alias("usable"))
        scores = scores.join(flags, [BOOK, "seg_ix"], "left").na.fill(False, ["usable"])
        placed = words.join(_sized(segments, units), BOOK)
        placed = placed.withColumn("direct", F.lit(None).cast("bigint")) if direct is None else placed.join(direct.withColumnRenamed("seg_ix", "direct"), [BOOK, "num"], "left")
        placed = placed.select(BOOK, "unit_ix", "num", F.size("words").alias("n_words"), "n_segs", "n_units", "direct")
        numbers = align.proportional_window(placed, scores, [BOOK], profile.rules, between=profile.segmentation not in ("styled", "formula"))
    numbers = numbers.select(BOOK, F.col("num").cast("int").alias("num"), F.col("seg_ix").cast("int").alias("seg_ix"))
    if direct is not None:
        numbers = numbers.unionByName(direct.select(BOOK, F.col("num").cast("int").alias("num"), F.col("seg_ix").cast("int").alias("seg_ix")))
    return numbers.join(texts, [BOOK, "seg_ix"]).select(BOOK, "num", T.strip(F.col("sharh")).alias("sharh"))


def cut_book(paragraphs: DataFrame, profile: P.BookProfile) -> DataFrame:
    """Segments by the profile's way of cutting."""
    cutters = {
        "marker": lambda p: segment.marker_segments(p, head_chars=profile.head_chars),
        "marker_after": lambda p: segment.marker_segments(p, after=True, head_chars=profile.head_chars),
        "header": lambda p: segment.header_segments(p, head_chars=profile.head_chars),
        "styled": lambda p: segment.styled_segments(p, head_chars=profile.head_chars),
        "formula": lambda p: segment.formula_segments(p, head_chars=profile.head_chars),
        "numbered": lambda p: segment.validated_segments(segment.numbered_segments(p)),
    }
    cut = cutters[profile.segmentation](paragraphs)
    return cut.withColumn("seg_ix", F.row_number().over(Window.partitionBy(BOOK).orderBy("seg_ix")) - 1)


def unit_anchors(pages: DataFrame, at: DataFrame) -> DataFrame:
    """(book_id, num, page_ix) of units (book_id, chapter_id, unit_ix, num, text, start, end) on pages (book_id, page_ix, words).

    Searched are the words among a unit's first 22, and the six rarest of its second half that at most 25 pages of the book have.
    """
    at = spans.anchor_windows(at)
    words = pages.select(BOOK, "page_ix", F.floor(F.col("page_ix") / STRETCH).alias("stretch"), F.explode("words").alias("word"))
    frequency = words.groupBy(BOOK, "word").agg(F.count("*").alias("df"))
    in_text = T.words(F.col("text"))
    usable = lambda ws: F.array_except(F.filter(F.array_distinct(ws), lambda w: F.length(w) >= 4), F.array(*[F.lit(w) for w in T.STOP]))
    listed = at.select(BOOK, "unit_ix", usable(F.slice(in_text, 1, 22)).alias("head"), usable(T.second_half(in_text)).alias("tail"))
    # only words that some page has count; of the tail, the rarest six
    head = listed.select(BOOK, "unit_ix", F.explode("head").alias("word")).join(frequency, [BOOK, "word"])
    tail = listed.select(BOOK, "unit_ix", F.explode("tail").alias("word")).join(frequency.where("df <= 25"), [BOOK, "word"])
    tail = cut(lookup.lowest(tail, [BOOK, "unit_ix"], ["df", "word"], 6))
    counts = lambda rows, name: rows.groupBy(BOOK, "unit_ix").agg(F.count("*").alias(name))
    n_rare = counts(tail, "n_rare")
    of_unit = Window.partitionBy(BOOK, "unit_ix")
    head = head.select("*", F.row_number().over(of_unit.orderBy("df", "word")).alias("rank"), F.count("*").over(of_unit).alias("n_head")).join(n_rare, [BOOK, "unit_ix"], "left").na.fill(0, ["n_rare"])
    head = cut(head.withColumn("least", spans.least_hits(F.col("n_head"), F.col("n_rare"))))
    # a page with `least` words of the head has one of all but its least - 1 most frequent, which are looked up only on pages that are met so
    first_words = head.where(F.col("rank") <= F.col("n_head") - F.col("least") + 1)
    postings = cut(words.join(first_words.select(BOOK, "word").unionByName(tail.select(BOOK, "word")).distinct(), [BOOK, "word"], "left_semi"))
    windows = at.select(BOOK, "unit_ix", "__from", "__to").where(F.col("__from") <= F.col("__to"))
    first, last = F.floor(F.col("__from") / STRETCH), F.floor(F.col("__to") / STRETCH)

    def hits(rows: DataFrame) -> DataFrame:
        """How many of a unit's words each page has that its window may show; a word that more pages have than the window has stretches meets by stretch."""
        asked = rows.select(BOOK, "unit_ix", "word", "df").join(windows, [BOOK, "unit_ix"]).withColumn("__often", F.col("df") > last - first + 1)
        rare = asked.where("not __often").join(postings.drop("stretch"), [BOOK, "word"])
        often = asked.where("__often").withColumn("stretch", F.explode(F.sequence(first, last))).join(postings, [BOOK, "word", "stretch"])
        met = rare.select(BOOK, "unit_ix", "page_ix", "__from", "__to").unionByName(often.select(BOOK, "unit_ix", "page_ix", "__from", "__to"))
        return met.where(F.col("page_ix").between(F.col("__from"), F.col("__to"))).groupBy(BOOK, "unit_ix", "page_ix").agg(F.count("*").alias("hits"))

    sought = head.groupBy(BOOK, "unit_ix").agg(F.collect_list("word").alias("head"), F.first("least").alias("least"))
    maybe = hits(first_words).drop("hits").join(sought, [BOOK, "unit_ix"])
    full = maybe.join(pages.select(BOOK, "page_ix", "words"), [BOOK, "page_ix"]).select(BOOK, "unit_ix", "page_ix", F.size(F.array_intersect("head", "words")).cast("bigint").alias("hits"), "least")
    sized = at.join(counts(head, "n_head"), [BOOK, "unit_ix"], "left").join(n_rare, [BOOK, "unit_ix"], "left").na.fill(0, ["n_head", "n_rare"])
    return spans.find_anchors(sized.select(BOOK, "chapter_id", "num", "unit_ix", "start", "end", "__place", "__high", "n_head", "n_rare"), full.where("hits >= least").drop("least"), hits(tail))


def chapter_anchors(pages: DataFrame, units: DataFrame, ranges: DataFrame) -> DataFrame:
    """unit_anchors for windows that move on through long chapters: pages are looked at as the windows show them, not joined before.

    units (book_id, chapter_id, unit_ix, num, text), ranges (book_id, chapter_id, start, end).
    """
    keys = [BOOK, "unit_ix"]
    usable = lambda ws: F.array_except(F.filter(F.array_distinct(ws), lambda w: F.length(w) >= 4), F.array(*[F.lit(w) for w in T.STOP]))
    named = lambda ws, opens: F.transform(usable(ws), lambda w: F.struct(w.alias("word"), F.lit(opens).alias("opens")))
    listed = T.let(T.words(F.col("text")), lambda ws: F.concat(named(F.slice(ws, 1, 22), True), named(T.second_half(ws), False)))
    asked = lookup.one_each(units, keys, listed, "w").select(*keys, "w.*")
    frequency = lookup.one_each(pages, [BOOK], "words", "word").groupBy(BOOK, "word").agg(F.count("*").alias("df"))
    # only words that some page has count; of the tail, the rarest six
    met = asked.join(frequency, [BOOK, "word"]).where(F.col("opens") | (F.col("df") <= 25))
    rarest = F.slice(F.sort_array(F.collect_list(F.when(~F.col("opens"), F.struct("df", "word")))), 1, 6)
    found = cut(met.groupBy(*keys).agg(F.collect_list(F.when(F.col("opens"), F.xxhash64("word"))).alias("head"), F.transform(rarest, lambda w: F.xxhash64(w["word"])).alias("rare")))
    free(pages.sparkSession)
    # a unit without words takes its place in the chapter all the same
    none = F.array().cast("array<bigint>")
    placed = units.select(*keys, "chapter_id", "num").join(ranges, [BOOK, "chapter_id"]).join(found, keys, "left")
    placed = cut(placed.withColumn("head", F.coalesce("head", none)).withColumn("rare", F.coalesce("rare", none)))
    found = cut(spans.search_anchors(placed, pages.select(BOOK, "page_ix", align.hashed(F.col("words")).alias("words"))))
    free(pages.sparkSession)
    return found


def chapter_book(pages: DataFrame, units: DataFrame, chapters: DataFrame, least: int = 250) -> DataFrame:
    """Chapters find their pages by title, units their page in the chapter; an entry is the pages up to the next unit's.

    pages (book_id, page_ix, text), chapters (book_id, chapter_id, title).
    """
    # written once, as many steps read them
    words = cut(pages.select(BOOK, "page_ix", T.content_words(F.col("text")).alias("words")))
    last = pages.groupBy(BOOK).agg(F.max("page_ix").alias("last_page"))
    headers = cut(segment.chapter_headers(pages))
    titled = lambda rows, key, title: rows.select(BOOK, F.col(key).cast("bigint").alias(("unit_ix" if key == "chapter_id" else "seg_ix")), T.content_words(F.col(title), 1, [P.TITLE_STOP]).alias("words"))
    matched = align.title_match(titled(chapters, "chapter_id", "title"), titled(headers, "header_ix", "title"), [BOOK]).select(BOOK, F.col("unit_ix").alias("chapter_id"), F.col("seg_ix").alias("header_ix"))
    found = spans.chapter_ranges(matched, headers)
    known = chapters.select(BOOK, F.col("chapter_id").cast("bigint").alias("chapter_id")).join(found, [BOOK, "chapter_id"], "left").join(last, BOOK)
    known = known.withColumn("end", F.when(F.col("start").isNotNull(), F.coalesce("end", "last_page")))
    ranges = cut(spans.interpolate(known).select(BOOK, "chapter_id", "start", "end"))
    wave = lambda rows, k: rows.where(F.pmod(F.xxhash64(BOOK), F.lit(WAVES)) == k)
    anchors = reduce(DataFrame.unionByName, [chapter_anchors(*(wave(rows, k) for rows in (words, units, ranges))) for k in range(WAVES)])
    placed = spans.anchor_spans(anchors.join(last, BOOK))
    return spans.span_text(placed, pages, least=least).select(BOOK, "num", F.col("text").alias("sharh"))
