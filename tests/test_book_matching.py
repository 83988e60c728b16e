"""Matching whole books without a row for each pair, against scores of all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from tessera import book_queries as B
from tessera.operators import align, passes, segment
from tessera.profiles import MARKER_GLOBAL, MARKER_WINDOW, RELAXED_FILL


def texts(seed, n, longest):
    rng = random.Random(seed)
    return [(f"b{i % 2}", i, sorted({f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(rng.randrange(0, longest))})) for i in range(n)]


@pytest.fixture(scope="module")
def rows(spark):
    units, segments = texts(1, 60, 40), texts(2, 400, 60)
    segments += [("b0", 1_000 + i, units[0][2]) for i in range(3)] + [("b0", 2_000, ["nowhere"]), ("b1", 2_001, []), ("b1", 2_002, None)]
    units += [("b0", 100, ["nothing", "here"]), ("b1", 101, []), ("b0", 102, None)]
    frame = lambda rows, key: spark.createDataFrame(rows, f"book string, {key} bigint, words array<string>")
    return frame(units, "unit_ix"), frame(segments, "seg_ix")


@pytest.mark.parametrize("rules", [MARKER_GLOBAL, RELAXED_FILL])
@pytest.mark.parametrize("size", [7, 10_000])
def test_blocks_find_what_the_search_finds(rows, rules, size, monkeypatch):
    monkeypatch.setattr(align, "BLOCK_UNITS", size)
    monkeypatch.setattr(align, "BLOCK_SEGMENTS", size)
    want = {tuple(r) for r in align.global_match(*rows, rules, ["book"]).collect()}
    assert {tuple(r) for r in align.block_match(*rows, rules, ["book"]).collect()} == want and want
    with pytest.raises(ValueError):
        align.block_match(*rows, MARKER_WINDOW, ["book"])


@pytest.mark.parametrize("chunk", [2, 50_000])
def test_a_window_over_words_is_one_over_scores(spark, chunk, monkeypatch):
    monkeypatch.setattr(passes, "CHUNK", chunk)
    words = lambda k: [f"w{k}_{i}" for i in range(8)]
    segments = spark.createDataFrame([(b, k, [*words(k), "same"]) for b in "ab" for k in range(600)], "book string, seg_ix bigint, words array<string>")
    order = [0, 1, 300, 2, 3, 590, 301, None]
    units = [("a", i, i + 1, None if k is None else [*words(k), "same"], 200 if k == 590 else None) for i, k in enumerate(order)] + [("b", 0, 1, words(5), None)]
    units = spark.createDataFrame(units, "book string, unit_ix int, num int, words array<string>, direct bigint").withColumn("n_words", F.size("words")).withColumn("n_segs", F.lit(600))
    want = {tuple(r) for r in align.numbered_window(units.drop("words"), align.overlap(units, segments, ["book"]), ["book"]).collect()}
    assert {tuple(r) for r in align.numbered_search(units, segments, ["book"]).collect()} == want == {("a", 1, 0), ("a", 2, 1), ("a", 4, 2), ("a", 5, 3), ("a", 7, 301), ("b", 1, 5)}


def test_books_make_no_rows_of_pairs(spark, sf_dir, monkeypatch):
    def fail(*_, **__):
        raise AssertionError("a row for each pair")

    monkeypatch.setattr(align, "overlap", fail)
    monkeypatch.setattr(align, "top_two", fail)
    for query in (B.numbered_book, B.marker_book, B.forced_book):
        assert query(spark, sf_dir).columns == ["book_id", "num", "n_chars", "sharh_sha256"]


def test_narrow_rows_give_the_segments_of_whole_ones(spark, sf_dir):
    paragraphs = B._paragraphs(spark, sf_dir)
    want = segment.validated_segments(segment.numbered_segments(paragraphs)).drop("page")
    got = segment.validated_book(paragraphs).select(*want.columns)
    plain = lambda rows: sorted((r.book_id, r.seg_ix, r.hdr_num, r.header, tuple(r.parts)) for r in rows.collect())
    assert plain(got) == plain(want)
