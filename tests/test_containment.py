"""Containment by minimizers against a search of every text."""

import random

from pyspark.sql import functions as F

from tessera.operators import gate


def test_fragments_are_found_wherever_they_stand(spark):
    rng = random.Random(4)
    draw = lambda n, letters="abcdefgh": "".join(rng.choice(letters) for _ in range(n))
    units = [(i, draw(rng.randrange(0, 300))) for i in range(60)] + [(60, "é" * 40 + "\U0001f600 中文" + "é" * 40), (61, "a" * 500), (62, ""), (63, None)]
    fragments = [(100, "short"), (101, "é" * 20), (101, "a" * 18), (61, "a" * 30), (102, draw(40)), (103, "\U0001f600 中文" + "é" * 18)]
    for i, text in units[:40]:
        if len(text) > 60:
            for lo in (0, len(text) - 25, rng.randrange(0, len(text) - 25)):  # at both ends and between
                fragments.append((rng.choice([i, 500 + i]), text[lo : lo + rng.randrange(18, 26)]))
    fragments += fragments[:10]
    want = sorted({(k, f, i) for k, f in fragments for i, text in units if text and len(f) >= 18 and i != k and f in text})
    got = gate.contained_elsewhere(spark.createDataFrame(fragments, "num int, fragment string"), spark.createDataFrame(units, "num int, form string"))
    assert sorted(map(tuple, got.collect())) == want
    assert len(want) > 30


def test_a_text_is_thinned_to_few_pieces(spark):
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefghijklmnopqrst") for _ in range(5_000))
    rows = spark.createDataFrame([(text,)], "t string")
    assert rows.select(F.size(gate.grid_pieces(F.col("t"), 60))).first()[0] <= 5_000 / 31
    for least in (1, 12, 18, 60):
        grid = set(rows.select(gate.grid_pieces(F.col("t"), least)).first()[0])
        for at in (0, 1, 17, 2_345, 5_000 - least):
            assert grid & set(rows.select(gate.first_pieces(F.substr("t", F.lit(at + 1), F.lit(least)), least)).first()[0])


def test_nothing_to_find(spark):
    none = spark.createDataFrame([], "num int, fragment string")
    units = spark.createDataFrame([(1, "a text that is long enough")], "num int, form string")
    assert gate.contained_elsewhere(none, units).count() == 0
    assert gate.contained_elsewhere(spark.createDataFrame([(2, "a text that is long")], "num int, fragment string"), units.limit(0)).count() == 0
