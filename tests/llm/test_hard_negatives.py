import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import hard_negatives
from tessera.llm.hard_negatives import Block, mine_negatives

SCHEMA = "vec_id bigint, label int, embedding array<float>, key string, raw string, norm double"


def brute(rows, is_anchor, positives=5, negatives=5, low=80):
    kept = []
    for i, label, v in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * x) for x in v]
        if all(abs(x) < 2**63 for x in q):
            kept.append((i, label, q))
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for a, (i, label, q) in enumerate(kept):
        if i is None or not is_anchor(i):
            continue
        score = [(max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(q, v, strict=False)))), j, m) for j, m, v in kept]
        liked = sorted((s for b, s in enumerate(score) if b != a and s[2] == label), key=order)[:positives]
        for p, j, _ in liked:
            hard = sorted((s for s in score if s[2] != label and low * p <= 100 * s[0] <= 100 * p), key=order)[:negatives]
            out += [(i, j, rank, n, p, s) for rank, (s, n, _) in enumerate(hard, 1)]
    return sorted(map(str, out))


def float32(rows):
    return [(i, label, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, label, v in rows]


def got(frame):
    return sorted(str((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score)) for r in frame.collect())


@pytest.fixture(scope="module")
def varied():
    """Norms over three orders of magnitude, one vector that a third of all rows share, ties, null ids and repeated rows."""
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(0, 4)), (rng.normal(size=8) * 10 ** rng.uniform(-2, 1)).tolist()) for i in range(300)]
    rows += [(1_000 + i, i % 3, [0.5] * 8) for i in range(160)]
    rows += [(None, 1, [0.5] * 8), (None, 2, [0.5] * 8), rows[100], rows[100], (100, 2, [0.25] * 8), (200, 3, [1.0, 2.0]), (110, 1, []), (120, 2, [0.0] * 8)]
    rows += [(130, None, [1.0] * 8), (140, 1, None), (150, 1, [1.0, None]), (160, 1, [float("nan")] * 8), (170, 1, [float("inf")] * 8), (180, 1, [1e30] * 8)]
    return float32(rows)


@pytest.mark.parametrize("sizes", [(16_384, 8_192), (40, 7), (7, 100)])
def test_negatives_equal_brute_force(spark, varied, sizes, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BUCKET_ROWS", 16)
    frame = spark.createDataFrame([(*r, "k", "r", 1.0) for r in varied], SCHEMA).repartition(3)
    mined = mine_negatives(frame, F.col("vec_id") % 10 == 0, share_rows=sizes[0], block_anchors=sizes[1])
    want = brute(varied, lambda i: i % 10 == 0)
    assert got(mined) == want and len(want) > 200


def test_scores_beyond_double_precision(spark):
    rows = float32([(10 * i, i % 2, [2.0 ** (20 + i), 3.0, -(2.0**20)]) for i in range(12)] + [(5, 1, [2.0**50] * 3), (15, 0, [2.0**50] * 3), (25, 0, [2.0**50, 1.0, 1.0])])
    frame = spark.createDataFrame([(*r, "k", "r", 1.0) for r in rows], SCHEMA)
    assert got(mine_negatives(frame, F.col("vec_id") % 5 == 0, low=1)) == brute(rows, lambda i: i % 5 == 0, low=1)


def test_few_rows(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert mine_negatives(nothing, F.lit(True)).count() == 0
    one = spark.createDataFrame([(100, 1, [1.0], "k", "r", 1.0)], SCHEMA)
    assert mine_negatives(one, F.lit(True)).count() == 0
    assert mine_negatives(one, F.lit(False)).count() == 0
    few = spark.createDataFrame([(100, 1, [1.0]), (7, 1, [0.5]), (8, 2, [0.45])], "vec_id bigint, label int, embedding array<double>")
    assert got(mine_negatives(few, F.col("vec_id") == 100)) == [str((100, 7, 1, 8, 128 * 256, 115 * 256))]


def test_buckets_that_no_window_can_reach_are_pruned():
    one = lambda x: np.array(x, "<i8").tobytes()
    anchor = (1, "a", one([3, 4]), 5.0, [{"slot": 1, "lo": 40, "hi": 100}])
    block = Block([anchor], 2, False, codes := {})
    assert block.meet([(2, 20, "b", one([6, 8]), 10.0), (3, 30, "b", one([10, 0]), 10.0), (4, 40, "a", one([6, 8]), 10.0)], codes)
    assert block.held.tolist() == [[1]]  # 50 lies in the window, 30 doesn't, the third has the anchor's label
    assert block.meet([(5, 50, "b", one([9, 5]), 10.3)], codes) and block.limits().tolist() == [[47]]
    assert not block.meet([(6, 60, "b", one([5, 5]), 7.1)], codes)  # 5 * 7.1 reaches neither 40 nor the running second score
