"""Segmentation, alignment, spans and gate on fixtures written by hand."""

import pytest
from pyspark.sql import functions as F

from tessera import profiles as P
from tessera import queries
from tessera.operators import align, gate, lookup, segment, spans
from tessera.plans import books
from tessera.queries import QUERIES

RUNS = "array<struct<cls:string,text:string>>"


def paragraphs(spark, texts, runs=None):
    rows = [(1, 1, i, t, (runs or {}).get(i, [("", t)])) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, f"book_id int, page int, para_ix int, text string, runs {RUNS}")


def segs(df):
    return [(r.seg_ix, r.hdr_num, r.header, list(r.parts)) for r in df.orderBy("seg_ix").collect()]


def test_numbered_segments(spark):
    long = "3 " + "نص " * 400
    got = segs(segment.numbered_segments(paragraphs(spark, ["ضائع", "1 حدثنا فلان", "شرح", "7 باب كذا", "8 خاتمة كذا", long, "الحديث 9 كذا", "ذيل"])))
    assert got == [(1, 1, "1 حدثنا فلان", ["شرح"]), (2, 8, "8 خاتمة كذا", [long]), (3, 9, "", ["الحديث 9 كذا", "ذيل"])]


def test_sequence_and_merge(spark):
    rows = [(1, True), (900, False), (2, False), (70, False), (63, True), (61, False), (55, False)]
    df = spark.createDataFrame([(1, i, n, f) for i, (n, f) in enumerate(rows)], "book_id int, seg_ix int, n int, forced boolean")
    assert [r.n for r in segment.keep_sequence(df, ["book_id"], ["seg_ix"], "n", "forced").orderBy("seg_ix").collect()] == [1, 2, 63, 61]
    cut = spark.createDataFrame([(1, 0, 5, "h", ["a"], 1), (1, 1, 5, "", ["b"], 1), (1, 2, 5, "x", ["c"], 2), (1, 3, 0, "", ["d"], 2), (1, 4, 5, "", ["e"], 3)], "book_id int, seg_ix int, hdr_num int, header string, parts array<string>, page int")
    assert segs(segment.merge_adjacent(cut)) == [(0, 5, "h", ["a", "b", "c"]), (4, 5, "", ["e"])]


@pytest.mark.parametrize(("after", "want"), [(False, [(1, 5, "after", ["after", "more"])]), (True, [(1, 5, "before", ["after", "more"])])])
def test_marker_inside_a_paragraph(spark, after, want):
    df = paragraphs(spark, ["lost", "x", "more"], {1: [("", "before"), ("c4", "[5]"), ("", "after")]})
    assert segs(segment.marker_segments(df, after=after)) == want


def test_marker_gives_what_stands_before_it_to_the_segment_before(spark):
    df = paragraphs(spark, ["x", "y"], {0: [("c4", "[1]"), ("", "one")], 1: [("", "tail"), ("c4", "[٢]"), ("", "two"), ("c4", "[3]")]})
    assert segs(segment.marker_segments(df)) == [(1, 1, "one", ["one", "tail"]), (2, 2, "two[3]", ["two[3]"])]


def test_other_ways_to_cut(spark):
    assert segs(segment.header_segments(paragraphs(spark, ["4 حدثنا فلان", "شرح"]))) == [(1, 4, "4 حدثنا فلان", ["شرح"])]
    opening = "حدثنا فلان بن فلان " + "كذا " * 12 + "عن فلان"
    assert segs(segment.formula_segments(paragraphs(spark, [opening, "شرح"]))) == [(1, None, opening, [opening, "شرح"])]
    head = "هذا عنوان طويل بما يكفي ليكون رأسا"
    assert segs(segment.styled_segments(paragraphs(spark, ["x", "y"], {0: [("c2", head), ("", "z")]}))) == [(1, None, head, ["x", "y"])]


def test_mega_segments_have_no_words(spark):
    df = spark.createDataFrame([(1, "عنوان طويل", ["x" * 60_000]), (2, "عنوان طويل", ["x" * 60_001])], "seg_ix int, header string, parts array<string>")
    assert [len(r.head_words) for r in segment.signatures(df).orderBy("seg_ix").collect()] == [2, 0]


def test_chapter_headers_near_each_other(spark):
    text = ["كتاب الإيمان", "نص (كتاب الإيمان)", "x", "x", "كتاب الإيمان\nكتاب الصلاة"]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(text)], "book_id int, page_ix int, text string")
    assert [(r.page_ix, r.title) for r in segment.chapter_headers(df).orderBy("header_ix").collect()] == [(0, "كتاب الإيمان"), (4, "كتاب الإيمان"), (4, "كتاب الصلاة")]


def test_near_key_and_priority(spark):
    units = spark.createDataFrame([(5,)], "num int")
    near = lambda rows: tuple(lookup.near_key(units, spark.createDataFrame(rows, "key int, s int"), "num", "key", F.col("s"), least=3).first())
    assert near([(4, 3), (5, 3), (6, 7)]) == (5, 1, 6, 7) and near([(4, 3), (5, 3), (6, 2)]) == (5, -1, 4, 3)
    edges = spark.createDataFrame([(1, 7, 0, 1), (1, 8, 1, 1), (9, 1, 0, 9)], "src int, dst int, pos int, src_ix int")
    usable = spark.createDataFrame([(8,), (9,)], "num int")
    one = spark.createDataFrame([(1,)], "num int")
    forward, reverse = lookup.forward_reference(one, edges, usable), lookup.reverse_reference(one, edges, usable)
    assert forward.first().target == 8 and reverse.first().target == 9
    assert [(r.target, r.priority) for r in lookup.by_priority([forward, reverse], ["num"]).collect()] == [(8, 0)]


def test_ties_have_no_margin(spark):
    scores = spark.createDataFrame([(1, 4, 5), (1, 2, 5), (2, 3, 1)], "unit_ix int, seg_ix int, score bigint")
    assert [tuple(r) for r in align.best_and_second(scores, ["unit_ix"]).orderBy("unit_ix").collect()] == [(1, 2, 5, 5), (2, 3, 1, 0)]


def test_window_moves_with_matches_and_pruning_changes_nothing(spark):
    words = lambda k: [f"w{k}_{i}" for i in range(8)]
    segments = spark.createDataFrame([("b", k, [*words(k), "same"]) for k in range(600)], "book string, seg_ix bigint, words array<string>")
    order = [0, 1, 300, 2, 3, 590, 301]
    units = spark.createDataFrame([("b", i, i + 1, [*words(k), "same"]) for i, k in enumerate(order)], "book string, unit_ix int, num int, words array<string>")
    ready = units.select("book", "unit_ix", "num", F.size("words").alias("n_words"), F.lit(None).cast("bigint").alias("direct"), F.lit(600).alias("n_segs"), F.lit(7).alias("n_units"))
    scores = [align.overlap(units, segments, ["book"], least=n) for n in (1, 3)]
    got = [{(r.num, r.seg_ix) for r in align.numbered_window(ready, s, ["book"]).collect()} for s in scores]
    assert got[0] == got[1] == {(1, 0), (2, 1), (4, 2), (5, 3)}
    got = [{(r.num, r.seg_ix) for r in align.proportional_window(ready, s, ["book"]).collect()} for s in scores]
    assert got[0] == got[1] and (1, 0) in got[0] and (3, 300) in got[0]


def test_spans(spark):
    anchors = lambda rows: spark.createDataFrame([(1, n, p, 99) for n, p in rows], "book_id int, num int, page_ix int, last_page int")
    got = lambda rows: [(r.first, r.last) for r in spans.anchor_spans(anchors(rows)).orderBy("num").collect()]
    assert got([(1, 10), (2, 12)]) == [(10, 12), (12, 18)] and got([(1, 10), (2, 90)])[0] == (10, 35) and got([(1, 98), (2, 98)]) == [(98, 99), (98, 99)]
    known = spark.createDataFrame([(1, 1, 0, 9, 50), (1, 2, None, None, 50), (1, 3, 20, 30, 50), (1, 4, None, None, 50), (1, 5, 31, 50, 50)], "book_id int, chapter_id int, start int, end int, last_page int")
    assert [(r.chapter_id, r.start, r.end) for r in spans.interpolate(known).orderBy("chapter_id").collect()] == [(1, 0, 9), (2, 10, 19), (3, 20, 30), (5, 31, 50)]


def test_gate(spark):
    units = spark.createDataFrame([("a", 0, 1), ("a", 1, 3), ("a", 2, 2), ("m", 0, 1), ("m", 1, 3), ("m", 2, 2)], "slug string, unit_ix int, num int").withColumn("text", F.lit("نص طويل بما يكفي"))
    expected = spark.createDataFrame([("a", 3, 0, False), ("m", 3, 0, True)], "slug string, canon_max int, tolerance int, unordered boolean")
    assert {(r.slug, r.ok) for r in gate.numbering(units, expected).collect()} == {("a", False), ("m", True)}
    same = "هذا نص متطابق طويل جدا " * 4
    twins = spark.createDataFrame([("b", n, same) for n in (2201, 2202, 2203)], "slug string, num int, text string")
    allowed = spark.createDataFrame(P.IDENTICAL_ALLOWED, "a int, b int")
    assert [tuple(r) for r in gate.identical_neighbours(twins, allowed).collect()] == [("b", 2202, 2203)]
    keys = gate.map_keys(spark.createDataFrame([({"a": {"2": "x", "9": "y"}, "unknown": {"99": "z"}},)], "map map<string,map<string,string>>"))
    assert [tuple(r) for r in gate.keys_in_range(keys, units).collect()] == [("a", 9)]
    assert gate.spot_case(units.withColumn("text", F.col("num").cast("string")), "a", 3, ["3"], 2).first().ok


def test_pairing(spark):
    own, other = "نص الحديث الاول كما ورد في الكتاب", "كلام اخر من حديث مختلف تماما هنا"
    units = spark.createDataFrame([(1, own), (2, other)], "num int, text string")
    entries = spark.createDataFrame([(1, f"قوله ({own[:25]})"), (1, "لا اقتباس"), (2, f"({own[:25]})"), (2, "(قال فلان بن فلان الفلاني هنا)")], "num int, sharh string").withColumn("num", F.col("num") + 0)
    entries = entries.withColumn("num", F.col("num"))
    got = gate.pairing(entries.where("sharh like '%قوله%' or num = 2"), units).first()
    assert (got.verified, got.wrong, got.undecided) == (1, 1, 1) and not got.ok
    assert gate.pairing(entries.where("sharh = 'لا اقتباس'"), units).first().ok


def test_books_end_to_end(spark):
    text = lambda k: " ".join(f"كلمة{chr(0x627 + k)}{chr(0x628 + i)}طويلة" for i in range(12))
    units = spark.createDataFrame([(1, i, i + 1, 1, text(i)) for i in range(4)], "book_id int, unit_ix int, num int, chapter_id int, text string")
    body = "شرح " * 30
    lines = []
    for k in (0, 1, 3):
        lines += [f"{k + 1} حدثنا {text(k)}", body + str(k)]
    got = {r.num: r.sharh for r in books.numbered_book(paragraphs(spark, lines), units).collect()}
    assert set(got) == {1, 2, 4} and got[4].endswith("3")
    marked = paragraphs(spark, ["m"] * 3, {i: [("c4", f"[{k + 1}]"), ("", text(k))] for i, k in enumerate((0, 1, 3))})
    cut = books.cut_book(marked, P.BOOKS["nasai"])
    for kind in ({"global_match": True}, {"force_direct": True}, {}):
        assert {r.num for r in books.marker_book(cut, units, P.BOOKS["nasai"], **kind).collect()} == {1, 2, 4}
    pages = spark.createDataFrame([(1, 0, "كتاب الايمان"), *[(1, 1 + i, text(i) + " " + "زيادة " * 40) for i in range(4)]], "book_id int, page_ix int, text string")
    chapters = spark.createDataFrame([(1, 1, "كتاب الإيمان")], "book_id int, chapter_id int, title string")
    assert {r.num for r in books.chapter_book(pages, units, chapters).collect()} == {1, 2, 3, 4}


def test_each_book_decides_whether_its_numbers_agree(spark):
    text = lambda k: " ".join(f"كلمة{chr(0x627 + k)}{chr(0x628 + i)}طويلة" for i in range(12))
    units = spark.createDataFrame([(b, i, i + 1, 1, text(i)) for b in (1, 2) for i in range(5)], "book_id int, unit_ix int, num int, chapter_id int, text string")
    # the second book's numbers are all two off, so its units are found by their texts
    segments = spark.createDataFrame([(b, i, 1 + (i + 2 * (b - 1)) % 5, text(i), [text(i), f"book {b} segment {i} " + "شرح " * 20], 1) for b in (1, 2) for i in range(5)], "book_id int, seg_ix int, hdr_num int, header string, parts array<string>, page int")
    counts = align.agreement(units.select("book_id", "unit_ix", "num", F.split("text", " ").alias("words")), segments.select("book_id", F.col("hdr_num").alias("num"), F.split("header", " ").alias("words")), by=["book_id"])
    assert {(r.book_id, r.agree, r.disagree) for r in counts.collect()} == {(1, 5, 0), (2, 0, 5)}
    for together in (units, units.where("book_id = 2"), units.where("book_id = 1")):
        got = {(r.book_id, r.num, r.sharh.split("segment ")[1][0]) for r in books.marker_book(segments, together, P.BOOKS["nasai"]).collect()}
        assert got == {(r.book_id, r.num, str(r.num - 1)) for r in together.collect()}


def test_mega_segments_query_keeps_the_limits_of_the_reference(spark, tmp_path):
    words = lambda n: " ".join(f"word{i:05d}" for i in range(n))
    rows = [(1, words(600)), (2, "short\ntext here"), (3, words(6_000) + "\nx"), (4, words(6_000) + "\nxy")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_head, r.n_body) for r in QUERIES["mega_segments"](spark, str(tmp_path)).collect()}
    # the first 2 000 characters hold 200 words; 60 000 characters of parts are the most, line ends not counted
    assert got == {1: (0, 200), 2: (0, 3), 3: (0, 200), 4: (0, 0)}


def test_signatures_exclude_by_the_limits_given(spark):
    df = spark.createDataFrame([(1, "head", ["abcd efgh", "ijkl"]), (2, "head", ["abcd efgh", "ijklm"])], "seg_ix int, header string, parts array<string>")
    got = [(r.head_words, r.body_words) for r in segment.signatures(df, parts_chars=9, most=13).orderBy("seg_ix").collect()]
    assert (got[0][0], set(got[0][1])) == (["head"], {"head", "abcd", "efgh"}) and got[1] == ([], [])


def test_passages_and_titles_cover_the_whole_item(spark, tmp_path):
    item = " ".join(f"passage{i:02d}" for i in range(30))
    items = [(1, item), (2, "a short item of the benchmark"), (3, "too short")]
    docs = [(1, f"x {item[100:170]} y"), (2, f"x {item[130:190]} y"), (3, f"x#{item[130:189]}# y"), (4, item[::-1]), (5, f"in {items[1][1]} too"), (6, "too short"), (7, "passage29 passage28\npassage00")]
    for name, key, rows in (("benchmark", "item_id", items), ("documents", "doc_id", docs)):
        spark.createDataFrame(rows, f"{key} bigint, text string").write.parquet(f"{tmp_path}/{name}.parquet")
    got = {n: sorted(tuple(r) for r in QUERIES[n](spark, str(tmp_path)).collect()) for n in ("containment_foreign", "title_match")}
    own = gate.contained_in_own(queries._fragments(spark, str(tmp_path)), queries._doc_forms(spark, str(tmp_path)))
    assert [tuple(r) for r in own.collect()] == [(1,)] and got["containment_foreign"] == [(1, 2), (2, 5)]
    assert got["title_match"][0] == (1, 1, 7) and [r[0] for r in got["title_match"]] == [1, 2, 3]
