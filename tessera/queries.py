"""The registered queries: the library's operators over the driver's tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import profiles as P
from .book_oracles import ORACLES as BOOK_ORACLES
from .book_queries import QUERIES as BOOK_QUERIES
from .functions import text as T
from .operators import align, gate, lookup, pages, segment, spans
from .oracles import ORACLES as TABLE_ORACLES
from .plans import books
from .sources import package as packages
from .sources import pages as sources
from .storage import Scratch, cut


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- pages ---------------------------------------------------------------------------------------


def page_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").groupBy(sources.response_status(F.col("html")).alias("status")).agg(F.count("*").alias("n"))


def crawl_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    cached = _table(spark, sf_dir, "pages").select(F.col("page_id").alias("page"), F.octet_length("html").alias("bytes"))
    last = cached.agg(F.max("page")).first()[0]
    return sources.crawl_work(spark, 0, last, cached)


def page_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = pages.raw_paragraphs(F.col("html"), P.ARTICLE_PAGES)
    return _table(spark, sf_dir, "pages").select("page_id", F.posexplode(bodies).alias("para_ix", "body"))


def paragraph_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = _table(spark, sf_dir, "pages").select("page_id", F.posexplode(pages.raw_paragraphs(F.col("html"), P.MENU_PAGES)).alias("para_ix", "body"))
    return bodies.select("page_id", "para_ix", F.posexplode(pages.raw_runs(F.col("body"), P.MENU_PAGES)).alias("run_ix", "r")).where("r.text <> ''").select("page_id", "para_ix", "run_ix", "r.cls", "r.text")


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_paragraphs(_table(spark, sf_dir, "pages"), P.ARTICLE_PAGES, ["page_id"]).select("page_id", "para_ix", "text")


def page_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = _table(spark, sf_dir, "pages").withColumn("book_id", F.col("page_id") % 16)
    paragraphs = pages.page_paragraphs(held, P.ARTICLE_PAGES, ["book_id", "page_id"])
    return pages.page_documents(paragraphs, "book_id", "page_id").select("book_id", "page_ix", "page_id", F.length("text").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


# ---- text ----------------------------------------------------------------------------------------


def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", T.search_form(F.col("text")).alias("form"))


def gate_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", T.gate_form(F.col("text")).alias("form"))


def _words(spark: SparkSession, sf_dir: str, name: str, key: str, stop=()) -> DataFrame:
    return _table(spark, sf_dir, name).select(F.col(key), T.content_words(F.col("text"), stop=stop or T.STOP).alias("words"))


def content_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _words(spark, sf_dir, "documents", "doc_id").select("doc_id", F.size("words").alias("n_words"), F.array_join(F.array_sort("words"), " ").alias("words"))


def doc_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.document_frequency(_words(spark, sf_dir, "documents", "doc_id"))


def rare_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _words(spark, sf_dir, "documents", "doc_id")
    return spans.rare_words(words, spans.document_frequency(words), "doc_id")


def text_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = T.fragments(F.col("text"), pattern=r",([^,.]{18,150})", start="The|And")
    return _table(spark, sf_dir, "documents").select("doc_id", F.posexplode(found).alias("ix", "fragment"))


# ---- segments ------------------------------------------------------------------------------------

#: A line of the documents begins a segment if it is this short.
SHORT_LINE = 120


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_ix", "line"))


def segment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = segment.islands(_lines(spark, sf_dir), ["doc_id"], ["line_ix"], F.length("line") < SHORT_LINE)
    parts = F.transform(F.sort_array(F.collect_list(F.struct("line_ix", "line"))), lambda p: p["line"])
    joined = rows.where("seg_ix > 0").groupBy("doc_id", "seg_ix").agg(F.count("*").alias("n_lines"), F.array_join(parts, "\n").alias("body"))
    return joined.select("doc_id", "seg_ix", "n_lines", F.sha2("body", 256).alias("body_sha256"))


def merge_adjacent(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    order = Window.partitionBy("user_id").orderBy("event_id")
    rows = segment.islands(events.withColumn("change", ~F.col("event_type").eqNullSafe(F.lag("event_type").over(order)) | (F.row_number().over(order) == 1)), ["user_id"], ["event_id"], F.col("change"), "run_ix")
    return rows.groupBy("user_id", "run_ix").agg(F.min("event_type").alias("event_type"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"), F.count("*").alias("n"))


def sequence_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("user_id", "event_id", F.floor(F.col("value")).cast("bigint").alias("n"), (F.col("event_id") % 17 == 0).alias("forced"))
    return segment.keep_sequence(events, ["user_id"], ["event_id"], "n", "forced", reach=20, back=5)


def mega_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.lit("").alias("header"), F.split("text", "\n").alias("parts"))
    signed = segment.signatures(docs)
    return signed.select("doc_id", F.size("head_words").alias("n_head"), F.size("body_words").alias("n_body"))


# ---- lookups -------------------------------------------------------------------------------------


def first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("source", "lang", "doc_id", "n_chars")
    return lookup.first_wins(docs, ["source", "lang"], "doc_id")


def direct_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("num"), "source")
    labels = lookup.first_wins(_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("num"), "quality", "toxic"), ["num"], "quality")
    return lookup.direct_map(docs, labels)


def missing_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.without(_table(spark, sf_dir, "documents").select("doc_id", "source"), _table(spark, sf_dir, "labels"), ["doc_id"])


def membership_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.among(_table(spark, sf_dir, "documents").select("doc_id", "source"), _table(spark, sf_dir, "labels"), ["doc_id"])


def near_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = _table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.count("*").alias("lines"))
    return lookup.near_key(_table(spark, sf_dir, "orders").select("o_orderkey"), held, "o_orderkey", "key", F.col("lines"), least=2)


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"), F.col("l_linenumber").alias("pos"), F.col("l_orderkey").alias("src_ix"))


def _usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").where("p_size >= 20").select(F.col("p_partkey").alias("num"))


def _numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("num"))


def xref_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.forward_reference(_numbers(spark, sf_dir), _edges(spark, sf_dir), _usable(spark, sf_dir))


def xref_reverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.reverse_reference(_numbers(spark, sf_dir), _edges(spark, sf_dir), _usable(spark, sf_dir))


def priority_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = lookup.among(_numbers(spark, sf_dir), _usable(spark, sf_dir), ["num"]).withColumn("target", F.col("num"))
    return lookup.by_priority([own, xref_forward(spark, sf_dir), xref_reverse(spark, sf_dir)], ["num"]).select("num", "target", "priority")


# ---- alignment -----------------------------------------------------------------------------------


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _words(spark, sf_dir, "benchmark", "item_id").withColumnRenamed("item_id", "unit_ix")


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _words(spark, sf_dir, "documents", "doc_id").withColumnRenamed("doc_id", "seg_ix")


def overlap_best_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align.top_two(_units(spark, sf_dir), _segments(spark, sf_dir))
    return found.select(F.col("unit_ix").alias("item_id"), F.col("seg_ix").alias("doc_id"), "best", "second", (F.col("best") - F.col("second")).alias("margin"))


def overlap_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align.global_match(_units(spark, sf_dir), _segments(spark, sf_dir), P.MARKER_GLOBAL)
    return found.select(F.col("unit_ix").alias("item_id"), F.col("seg_ix").alias("doc_id"), "best", "n_words")


def title_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as titles; a document's header is its first line."""
    heads = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seg_ix"), T.content_words(F.split("text", "\n")[0], 1, ["the"]).alias("words"))
    titles = _table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("unit_ix"), T.content_words(F.col("text"), 1, ["the"]).alias("words"))
    return align.title_match(titles, heads).select(F.col("unit_ix").alias("item_id"), F.col("seg_ix").alias("doc_id"), "best")


def number_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = _units(spark, sf_dir).select("unit_ix", F.col("unit_ix").alias("num"), "words")
    return align.agreement(units, _segments(spark, sf_dir).select(F.col("seg_ix").alias("num"), "words"))


def _window_units(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Each source is a book: its longer documents are segments in the order of their ids, the benchmark items the units."""
    docs = _table(spark, sf_dir, "documents").select("source", "doc_id", T.content_words(F.col("text")).alias("words"))
    segs = docs.select("source", (F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1).cast("bigint").alias("seg_ix"), "words")
    sized = segs.groupBy("source").agg(F.count("*").alias("n_segs"))
    items = _units(spark, sf_dir).select("unit_ix", (F.col("unit_ix") + 1).alias("num"), "words", F.size("words").alias("n_words"))
    units = items.join(F.broadcast(sized) if sized.count() <= 10_000 else sized).withColumn("direct", F.when(F.col("num") % 10 == 0, F.col("num")).cast("bigint")).withColumn("n_units", F.lit(items.count()))
    return units, align.overlap(units.select("source", "unit_ix", "words"), segs, ["source"], least=3)


def window_align_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    units, scores = _window_units(spark, sf_dir)
    return align.numbered_window(units.drop("words"), scores, ["source"])


def window_align_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    units, scores = _window_units(spark, sf_dir)
    return align.proportional_window(units.drop("words"), scores, ["source"])


def window_align_other(spark: SparkSession, sf_dir: str) -> DataFrame:
    units, scores = _window_units(spark, sf_dir)
    return align.proportional_window(units.drop("words").withColumn("direct", F.lit(None).cast("bigint")), scores, ["source"], between=False)


# ---- spans ---------------------------------------------------------------------------------------


def span_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("book_id"), F.col("turn").alias("page_ix")).agg(F.min("role").alias("role"), F.min("text").alias("text"))
    last = turns.groupBy("book_id").agg(F.max("page_ix").alias("last_page"))
    anchors = turns.where("role = 'user'").join(last, "book_id").select("book_id", F.col("page_ix").alias("num"), "page_ix", "last_page")
    joined = spans.span_text(spans.anchor_spans(anchors, most=4, tail=2), turns, separator="\n\n")
    return joined.select(F.col("book_id").alias("conv_id"), F.col("num").alias("turn"), "first", "last", F.length("text").alias("n_chars"))


def _chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    at = events.groupBy(F.col("user_id").alias("book_id"), F.floor(F.col("event_id") / 500).alias("chapter_id")).agg(F.min("event_id").alias("low"), F.max("event_id").alias("high"), F.count("*").alias("n"))
    last = F.max("high").over(Window.partitionBy("book_id"))
    matched = F.col("n") % 2 == 0
    return at.select("book_id", "chapter_id", F.when(matched, F.col("low")).alias("start"), F.when(matched, F.col("high")).alias("end"), last.alias("last_page"))


def chapter_interpolate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.interpolate(_chapters(spark, sf_dir)).select("book_id", "chapter_id", "filled", "start", "end")


def next_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").where("role = 'user'").select(F.col("conv_id").alias("book_id"), F.col("turn").alias("page_ix")).distinct()
    headers = turns.withColumn("header_ix", F.row_number().over(Window.partitionBy("book_id").orderBy("page_ix")) - 1).withColumn("last_page", F.lit(99))
    matched = headers.select("book_id", F.col("header_ix").alias("chapter_id"), "header_ix")
    return spans.chapter_ranges(matched, headers).select("book_id", "chapter_id", "start", "end")


# ---- gate ----------------------------------------------------------------------------------------


def _slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return docs.select(F.col("source").alias("slug"), F.col("doc_id").alias("unit_ix"), F.floor(F.col("doc_id") / 20).alias("num"), "text")


def gate_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = _slugs(spark, sf_dir)
    expected = units.groupBy("slug").agg(F.max("num").alias("canon_max")).select("slug", "canon_max", F.lit(5).alias("tolerance"), (F.col("slug") == "src1").alias("unordered"))
    return gate.numbering(units, expected).select("slug", "n", "n_short", "max_num", "n_inversions", "ok")


def gate_adjacent_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(F.lit("all").alias("slug"), F.floor(F.col("doc_id") / 2).alias("num"), (F.col("doc_id") % 2).alias("h"), "text")
    allowed = spark.createDataFrame(P.IDENTICAL_ALLOWED, "a bigint, b bigint")
    return gate.identical_neighbours(docs.select("slug", "num", "text"), allowed).groupBy("slug", "num", "next").agg(F.count("*").alias("n"))


def gate_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.stray_prefixes(_table(spark, sf_dir, "documents"))


def gate_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.glued_tails(_table(spark, sf_dir, "documents"))


def gate_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = _table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("slug"), F.col("l_partkey").alias("key"))
    units = _table(spark, sf_dir, "orders").select(F.when(F.col("o_orderstatus") == "F", "A").when(F.col("o_orderstatus") == "O", "N").otherwise("X").alias("slug"), (F.col("o_orderkey") / 100).cast("bigint").alias("num"))
    return gate.keys_in_range(mapped, units).groupBy("slug").agg(F.count("*").alias("n"), F.min("key").alias("least"))


def gate_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return gate.overall(gate.stray_prefixes(docs).unionByName(gate.glued_tails(docs)))


#: Characters of a passage of the benchmark.
PASSAGE = 60


def _fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(num, fragments): all passages of an item, one from each character on; a shorter item is one passage."""
    items = _table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("num"), T.gate_form(F.col("text")).alias("form"))
    starts = F.sequence(F.lit(1), F.greatest(F.length("form") - PASSAGE + 1, F.lit(1)))
    return items.select("num", F.array_distinct(F.transform(starts, lambda i: F.substr(F.col("form"), i, F.lit(PASSAGE)))).alias("fragments"))


def _doc_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("num"), T.gate_form(F.col("text")).alias("form"))


def containment_own(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose article holds their own title."""
    held = _table(spark, sf_dir, "pages").select(F.col("page_id").alias("num"), "html")
    title = T.gate_form(pages.clean(F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1), P.ARTICLE_PAGES.entities))
    titles = held.select("num", F.filter(F.array(title), lambda f: F.length(f) >= 18).alias("fragments"))
    body = F.transform(pages.raw_paragraphs(F.col("html"), P.ARTICLE_PAGES), lambda p: T.gate_form(pages.clean(p, P.ARTICLE_PAGES.entities)))
    return gate.contained_in_own(titles, held.select("num", F.array_join(body, " ").alias("form")))


def containment_foreign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items a passage of which is in a document of another number."""
    passages = _fragments(spark, sf_dir).select("num", F.explode("fragments").alias("fragment"))
    found = gate.contained_elsewhere(passages, _doc_forms(spark, sf_dir), least=PASSAGE)
    shorter = passages.where(F.length("fragment") < PASSAGE)
    if not shorter.isEmpty():
        found = found.unionByName(gate.contained_elsewhere(shorter, _doc_forms(spark, sf_dir)))
    return found.select(F.col("num").alias("item_id"), F.col("other").alias("doc_id")).distinct()


# ---- packages ------------------------------------------------------------------------------------


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id").distinct()
    return docs.join(labels, "doc_id", "left_semi").select("source", F.col("doc_id").cast("int").alias("num"), F.col("text").alias("sharh"))


def package_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packages.package(_entries(spark, sf_dir))
    return packed.select("source", F.size("entries").alias("n_entries"), F.sha2(F.array_join(F.transform("entries", lambda e: F.concat_ws(":", e["num"].cast("string"), e["sharh"])), "\n"), 256).alias("entries_sha256"))


def package_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entries written as a JSON document a source, and read back."""
    with Scratch(spark, "packages") as path:
        packages.write_documents(_entries(spark, sf_dir), path)
        return cut(packages.read_documents(spark, path).select("source", "num", F.sha2("sharh", 256).alias("sharh_sha256")))


def package_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packages.coverage(_entries(spark, sf_dir))


def book_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole plan: lines cut into segments, aligned with the benchmark by text, put out as entries."""
    lines = _lines(spark, sf_dir)
    rows = segment.islands(lines, ["doc_id"], ["line_ix"], F.length("line") < SHORT_LINE).where("seg_ix > 0")
    parts = F.transform(F.sort_array(F.collect_list(F.struct("line_ix", "line"))), lambda p: p["line"])
    segs = rows.groupBy("doc_id", "seg_ix").agg(F.array_join(parts, "\n").alias("text")).withColumn("seg_ix", F.col("doc_id") * 1_000_000 + F.col("seg_ix"))
    return books.global_entries(_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("unit_ix"), "text"), segs.select("seg_ix", "text"), P.MARKER_GLOBAL).select("unit_ix", "seg_ix", "best", F.length("text").alias("n_chars"))


_ALL = (page_status, crawl_work, page_paragraphs, paragraph_runs, clean_text, page_documents, normalize_text, gate_text, content_words, doc_frequency, rare_words, text_fragments, segment_lines, merge_adjacent, sequence_validate, mega_segments, first_wins, direct_map, missing_anti, membership_semi, near_key, xref_forward, xref_reverse, priority_fill, overlap_best_second, overlap_global, title_match, number_agreement, window_align_numbered, window_align_marker, window_align_other, span_concat, chapter_interpolate, next_header, gate_numbering, gate_adjacent_dups, gate_prefix, gate_tail, gate_range, gate_overall, containment_own, containment_foreign, package_entries, package_documents, package_coverage, book_global)
QUERIES = {f.__name__: f for f in _ALL} | BOOK_QUERIES
ORACLES = TABLE_ORACLES | BOOK_ORACLES
