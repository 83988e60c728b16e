"""Work on books that are cut into chunks, against plain loops."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.operators import passes, segment


@pytest.fixture(scope="module")
def rows(spark):
    """A book with most rows, some with few, and one whose key is null."""
    rng = random.Random(6)
    out = [(rng.choice(["a"] * 8 + ["b", "c", None]), i if rng.random() < 0.97 else None, i, rng.choice([None, *range(0, 60)]), rng.random() < 0.02) for i in range(1_200)]
    return out, spark.createDataFrame(out, "book string, at bigint, ix bigint, n bigint, forced boolean")


def books(rows):
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        out[r[0]].append(r)
    return out


@pytest.mark.parametrize("size", [100, 10_000_000])
def test_running_values(rows, size):
    plain, frame = rows
    counted = passes.running_count(frame, ["book"], ["at", "ix"], F.col("n") % 7 == 0, "c", size)
    both = passes.previous(counted, ["book"], ["at", "ix"], "n", "p", size)
    want = set()
    for book, of_book in books(plain).items():
        count, before = 0, None
        for r in of_book:
            count += r[3] is not None and r[3] % 7 == 0
            want.add((book, r[2], count, before))
            before = r[3]
    assert {(r.book, r.ix, r.c, r.p) for r in both.collect()} == want


@pytest.mark.parametrize("size", [150, 10_000_000])
def test_a_pass_in_chunks_is_one_pass(rows, size, monkeypatch):
    monkeypatch.setattr(passes, "CHUNK", size)
    plain, frame = rows
    want = set()
    for book, of_book in books(plain).items():
        last = 0
        for r in of_book:
            if r[4] or r[3] is not None and last - 5 <= r[3] and abs(r[3] - last) <= 8:
                want.add((book, r[2]))
                last = last if r[3] is None else r[3]
    assert {(r.book, r.ix) for r in segment.keep_sequence(frame, ["book"], ["at", "ix"], "n", "forced", reach=8).collect()} == {w for w in want if w[0] is not None and plain[w[1]][1] is not None}


def test_states_that_never_meet_still_settle(rows, monkeypatch):
    """Each chunk's end depends on its beginning, so rounds go on until the last one is right."""
    monkeypatch.setattr(passes, "CHUNK", 400)
    plain, frame = rows
    schema = frame.select("book", "ix", F.lit(0).cast("bigint").alias("sum")).schema

    def step(state, row):
        total, seen = state or (0, ())
        total += row["n"] or 0
        return (total, (row["ix"],)), (row["ix"], total)

    want = set()
    for book, of_book in books(plain).items():
        total = 0
        for r in of_book:
            total += r[3] or 0
            want.add((book, r[2], total))
    assert {tuple(r) for r in passes.ordered_pass(frame, ["book"], ["at", "ix"], step, schema).collect()} == want


def test_rows_far_apart_share_a_chunk(spark, monkeypatch):
    """Books of few rows take no round, however far their order reaches; a long one takes as many chunks as its rows fill."""
    monkeypatch.setattr(passes, "CHUNK", 100)
    ran, run = [], passes._run
    monkeypatch.setattr(passes, "_run", lambda rows, by, order, step, schema, ends: (ran.append(rows.select(*by, "__chunk").distinct().count()), run(rows, by, order, step, schema, ends))[1])
    step = lambda state, row: ((state or 0) + 1, (row["ix"], (state or 0) + 1))
    for n, rounds in ((90, 0), (250, 1)):
        ran.clear()
        frame = spark.createDataFrame([(b, i * 1_000) for b in ("a", "b") for i in range(n if b == "a" else 50)], "book string, ix bigint")
        schema = frame.select("book", "ix", F.lit(0).cast("bigint").alias("nth")).schema
        found = {tuple(r) for r in passes.ordered_pass(frame, ["book"], ["ix"], step, schema).collect()}
        assert found == {(b, i * 1_000, i + 1) for b in ("a", "b") for i in range(n if b == "a" else 50)}
        assert (len(ran) > 1) == bool(rounds) and max(ran) <= 4
