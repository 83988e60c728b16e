"""Ranges of cached pages, by patterns of their numbers."""

import fnmatch

import pytest

from tessera.sources import pages


@pytest.mark.parametrize(("first", "last"), [(0, 0), (0, 9), (1, 1), (1, 12), (7, 123), (99, 101), (100, 199), (494, 7978), (1000, 999), (9, 10_000)])
def test_globs_match_their_numbers_and_no_others(first, last):
    globs = pages.number_globs(first, last)
    for n in [*range(0, 1_300), *range(7_900, 8_100), 9_999, 10_000, 10_001]:
        assert sum(fnmatch.fnmatchcase(str(n), g) for g in globs) == (first <= n <= last)
    assert len(globs) < 40


def test_an_open_range():
    globs = pages.number_globs(57)
    assert all(any(fnmatch.fnmatchcase(str(n), g) for g in globs) == (n >= 57) for n in [*range(0, 2_000), 10**6, 10**9 - 1])


def test_files_out_of_range_are_not_opened(spark, tmp_path):
    for book in (1, 2):
        (tmp_path / str(book)).mkdir()
        for page in (1, 9, 10, 11, 20, 99, 100, 101, 250):
            (tmp_path / str(book) / f"{page}.html").write_bytes(f"page {page}".encode() + b"\xff")
    (tmp_path / "1" / "x10.html").write_text("no page")
    (tmp_path / "1" / "12.txt").write_text("no page")
    (tmp_path / "2" / "5.html").mkdir()  # would fail if it were opened
    read = pages.read_cached_pages(spark, f"file://{tmp_path}", 9, 100)
    assert sorted((r.book_id, r.page, r.html) for r in read.collect()) == [(b, p, f"page {p}") for b in (1, 2) for p in (9, 10, 11, 20, 99, 100)]
    assert len(read.inputFiles()) == 12
    assert pages.read_cached_pages(spark, f"file://{tmp_path}").count() == 18
    assert pages.read_cached_pages(spark, f"file://{tmp_path}", 300, 200).count() == 0
