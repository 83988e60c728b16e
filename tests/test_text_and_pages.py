"""Fixtures written by hand for what is easy to get wrong in text and page handling."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from tessera import profiles as P
from tessera.functions import text as T
from tessera.operators import pages
from tessera.sources import package as packages
from tessera.sources import pages as sources


@pytest.fixture(scope="module")
def value(spark):
    def of(text, expression, kind="string"):
        return spark.createDataFrame([(text,)], f"t {kind}").select(expression(F.col("t")).alias("x")).first()["x"]

    return of


def test_search_form_keeps_the_comma_and_folds_letters(value):
    assert value("كَتَبَ، قال", T.search_form) == "كتب، قال"
    assert value("ٱلؤء", T.search_form) == "الو" and value("ٱلؤء", T.gate_form) == "ٱلؤء"
    assert value("  é١٢\n a ", T.search_form) == "12 a" and value(None, T.search_form) is None
    assert T.search_form_of("أُخبرنا ء") == "اخبرنا"
    for once in ("كتب، قال", "12 a", ""):
        assert value(once, T.search_form) == once


def test_number_prefix_backtracks(value):
    both = lambda t: value(t, lambda c: F.struct(*T.number_prefix(c)))
    assert tuple(both("12")) == (1, "2") and tuple(both("12345 foo")) == (1234, "5 foo") and both("x 1")[0] is None


def test_markers_and_predicates(value):
    assert value("الحديث 77 الخ", T.unit_marker) == 77
    assert value(" [٤٢] ", T.bracket_number) == 42 and value("[42] x", T.bracket_number) is None
    assert value("5 وحدثنا فلان", T.header_number) == 5 and value("5 باب", T.header_number) is None
    assert value("باب كذا", T.is_chapter) and value("وكتاب", T.is_chapter) and not value("خاتمه كذا", T.is_chapter)
    assert value("، ١٢ - نص", T.has_stray_prefix) and not value("نص ١٢", T.has_stray_prefix)
    long = "هذا نص طويل " * 12
    assert value(long + ". باب الصلاة", T.has_glued_tail) and not value("قصير باب الصلاة", T.has_glued_tail)
    assert value(long + ". باب الصلاة", T.without_glued_tail).endswith(".")


def test_words_and_lists(value):
    assert value("حدثنا الصلاة الصلاة في قال", T.content_words) == ["الصلاه"]
    assert value("", T.content_words) == [] and value(None, T.content_words) is None
    assert value(list(range(31)), T.second_half, "array<int>") == list(range(15, 31)) and value([1, 2], T.second_half, "array<int>") == [1, 2]
    assert value(["a", " \n", "b"], T.commentary_text, "array<string>") == "a\n\nb"
    assert value([" a ", "ــ", ""], lambda c: T.clean_parts(c, [P.RULE_PART]), "array<string>") == ["a"]
    refs = value(["الحديث ٥ - أطرافه في: ٧، ٩"], lambda c: T.cross_references(F.lit(""), c), "array<string>")
    assert refs == [7, 9]


def test_fragments_start_at_the_comment(value):
    text = "(قبل القول وقبل كل شيء في النص) قوله (هذا نص مقتبس طويل بما يكفي للتحقق) (قصير)"
    assert value(text, T.fragments) == ["هذا نص مقتبس طويل بما يكفي للتحقق"]


def test_runs_are_glued(spark):
    body = "<p>قال <span class=\"c2\">كتب</span> ثم<span class=\"anchor\">ا</span></p>"
    page = f'<div class="nass x">{body}<p class="y">not</p></div> <div'
    df = spark.createDataFrame([(1, page)], "page int, html string")
    got = pages.page_paragraphs(df, P.PageProfile(), ["page"]).collect()
    assert [r.text for r in got] == ["قالكتبثما"]
    assert [(x.cls, x.text) for x in got[0].runs] == [("", "قال"), ("c2", "كتب"), ("", "ثم"), ("", "ا")]


def test_null_and_empty_pages(value):
    split = lambda c: pages.raw_paragraphs(c, P.PageProfile())
    assert value("Just a moment...", split) is None and value(None, split) is None
    assert value("<html>no container</html>", split) == []
    assert value('<div class="nass"><p>a</p></section><p>b</p>', split) == ["a"]


def test_clean_resolves_entities_either_way(value):
    text = " <b>a&amp;b</b>‏&eacute; "
    assert value(text, pages.clean) == "a&bé"
    assert value("&quot;&amp;&copy;", lambda c: pages.clean(c, P.ARTICLE_PAGES.entities)) == '"&©'


def test_files_books_and_packages(spark, tmp_path):
    os.makedirs(tmp_path / "7")
    (tmp_path / "7/3.html").write_bytes(b"a\xffb")
    (tmp_path / "7/12.html").write_bytes(b"x" * 5000)
    root = f"file://{tmp_path}"
    assert [(r.book_id, r.page, r.html) for r in sources.read_cached_pages(spark, root, 1, 5).collect()] == [(7, 3, "ab")]
    work = sources.crawl_work(spark, 11, 13, sources.read_cached_pages(spark, root))
    assert sorted(r.page for r in work.collect()) == [11, 13]
    book = {"id": 1, "metadata": {"id": 1, "length": 1, "arabic": "x", "english": ""}, "chapters": [{"id": 4, "bookId": 1, "arabic": "ب", "english": ""}], "hadiths": [{"id": 9, "idInBook": 1, "chapterId": None, "bookId": 1, "arabic": "ن"}]}
    (tmp_path / "book.json").write_text(json.dumps(book, indent=1, ensure_ascii=False))
    books = sources.read_book(spark, f"{root}/book.json")
    assert [tuple(r) for r in sources.book_units(books).collect()] == [(1, 0, 1, 1, "ن")]
    assert [tuple(r) for r in sources.book_chapters(books).collect()] == [(1, 0, 4, "ب")]
    entries = spark.createDataFrame([("s", 2, "ب"), ("s", 1, "ا"), ("s", 1, "أ")], "source string, num int, sharh string")
    packages.write_packages(packages.package(entries), f"{root}/out")
    part = next(p for p in os.listdir(tmp_path / "out") if p.endswith(".json.gz"))
    assert "ب" in gzip.open(tmp_path / "out" / part).read().decode()
    assert [[e.num for e in r.entries] for r in packages.read_packages(spark, f"{root}/out").collect()] == [[1, 1, 2]]
    assert tuple(packages.coverage(entries).first()) == ("s", 3, 3)


def test_stream_of_pages(spark, tmp_path):
    from tessera.streaming.pages import append_paragraphs, page_stream

    os.makedirs(tmp_path / "in/7")
    page = "<article><p>one</p><p>two</p></article>" + " " * 3000
    (tmp_path / "in/7/1.html").write_text(page)
    for _ in range(2):
        append_paragraphs(page_stream(spark, f"file://{tmp_path}/in"), P.ARTICLE_PAGES, f"file://{tmp_path}/t", f"file://{tmp_path}/c").awaitTermination(60)
        (tmp_path / "in/7/2.html").write_text(page)
    append_paragraphs(page_stream(spark, f"file://{tmp_path}/in"), P.ARTICLE_PAGES, f"file://{tmp_path}/t", f"file://{tmp_path}/c").awaitTermination(60)
    assert sorted((r.page, r.text) for r in spark.read.parquet(f"file://{tmp_path}/t").collect()) == [(1, "one"), (1, "two"), (2, "one"), (2, "two")]


def test_places_beyond_an_integer_are_listed(value):
    part = ["الحديث 5 - أطرافه في: 4763047826333361، ٠٠٧ 0, 99999999999999999999999999999999999999999 12"]
    assert value(part, lambda c: T.listed_places(F.lit(""), c), "array<string>") == ["4763047826333361", "7", "0", "9" * 41, "12"]
    assert value(part, lambda c: T.cross_references(F.lit(""), c), "array<string>") == [None, 7, 0, None, 12]
