"""Hard negatives by norm-bucketed search.

By Cauchy and Schwarz an inner product is at most the product of both norms. Candidates are sorted by norm into bands, from
long to short, and bands are searched in waves of 1, 2, 4, ... bands. An anchor enters a band only while its norm times the
longest norm there reaches the lower limit of one of its windows, or the running k-th score of a window that is full.
Inside a band, candidates arrive in buckets, again from long to short, which the same bound prunes with what the task
itself has found. The same search finds the positives, with one window without limits.

Blocks of anchors meet shares of a band in tasks of bounded size; of each window a task gives its best k at most.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, mapped, small, spread

#: Rows of a band's share, anchors of a block, and rows of a bucket.
SHARE_ROWS = 16_384
BLOCK_ANCHORS = 8_192
BUCKET_ROWS = 2_048
#: Bands that the norms are cut into at most; longer tables have more shares a band.
MOST_BANDS = 256
#: Anchors whose scores a task holds at a time.
STRIP = 256
LEAST, MOST = -(1 << 63), (1 << 63) - 1
#: Sums of products of integers are exact in double precision below this.
EXACT = float(1 << 52)
TASK = "part string, block int, band int, share int, role int, key bigint, vec_id bigint, label string, raw binary, norm double, windows array<struct<slot:int,lo:bigint,hi:bigint>>"


def quantised(rows: DataFrame, width: int, scale: int) -> DataFrame:
    """(key, vec_id, label, raw, norm): components as floor(scale * x) in 64-bit integers, shorter vectors padded with zeros; what can't be compared is left out."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, raw, norm = [], [], []
            for i, x in enumerate(batch.column(3)):
                if not x.is_valid or x.values.null_count:
                    continue
                with np.errstate(over="ignore", invalid="ignore"):
                    v = np.floor(scale * x.values.to_numpy(zero_copy_only=False).astype(np.float64))
                if not (np.abs(v) < 2.0**63).all():  # not finite, or no 64-bit integer
                    continue
                keep.append(i)
                raw.append(np.pad(v.astype("<i8"), (0, width - len(v))).tobytes())
                norm.append(float(np.sqrt((v * v).sum())))
            yield pa.RecordBatch.from_arrays([*batch.select(["key", "vec_id", "label"]).take(pa.array(keep, pa.int64())).columns, pa.array(raw, pa.binary()), pa.array(norm, pa.float64())], ["key", "vec_id", "label", "raw", "norm"])

    return mapped(rows.select("key", "vec_id", "label", "v"), work, "key bigint, vec_id bigint, label string, raw binary, norm double")


def _scores(a: np.ndarray, b: np.ndarray, reach: float) -> np.ndarray:
    """Integer inner products of all rows of a and b, whose norms multiply to `reach` at most."""
    if reach < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T  # Python's integers, held to 64 bits at the end
    return np.clip(exact, LEAST, MOST).astype(np.int64)


class Block:
    """A block of anchors and the best k that each of their windows has met so far."""

    def __init__(self, rows: list[tuple], k: int, same: bool, codes: dict[str, int]):
        self.k, self.same = k, same
        self.keys = np.array([r[0] for r in rows], np.int64)
        self.labels = np.array([codes.setdefault(r[1], len(codes)) for r in rows])
        self.x = np.frombuffer(b"".join(r[2] for r in rows), "<i8").reshape(len(rows), -1)
        self.norm = np.array([r[3] for r in rows])
        self.slots = max(len(r[4]) for r in rows)
        shape = (len(rows), self.slots)
        self.slot, self.lo, self.hi = np.zeros(shape, np.int32), np.full(shape, MOST), np.full(shape, LEAST)
        for i, r in enumerate(rows):
            for j, w in enumerate(r[4]):
                self.slot[i, j], self.lo[i, j], self.hi[i, j] = w["slot"], w["lo"], w["hi"]
        self.score = np.full((*shape, k), LEAST)
        self.id = np.zeros((*shape, k), np.int64)
        self.bare = np.zeros((*shape, k), bool)  # without an id
        self.held = np.zeros(shape, np.int64)

    def limits(self) -> np.ndarray:
        """What a score has to reach: the window's lower limit, or its k-th score once it is full."""
        return np.where(self.held == self.k, np.maximum(self.lo, self.score[:, :, -1]), self.lo)

    def meet(self, rows: list[tuple], codes: dict[str, int]) -> bool:
        """Compare a bucket, in descending order of norms; False if no anchor can reach its longest row, nor any later one."""
        longest = rows[0][4]
        limits = self.limits()
        able = np.flatnonzero(self.norm * longest * (1 + 1e-9) + 1 >= limits.min(1).astype(np.float64))
        if not len(able):
            return False
        keys, bare = np.array([r[0] for r in rows], np.int64), np.array([r[1] is None for r in rows])
        ids, labels = np.array([r[1] or 0 for r in rows], np.int64), np.array([codes.setdefault(r[2], len(codes)) for r in rows])
        x = np.frombuffer(b"".join(r[3] for r in rows), "<i8").reshape(len(rows), -1)
        for i in range(0, len(able), STRIP):
            at = able[i : i + STRIP]
            scores = _scores(self.x[at], x, float(self.norm[at].max()) * longest)
            alike = self.labels[at][:, None] == labels
            fit = alike & (self.keys[at][:, None] != keys) if self.same else ~alike
            for j in range(self.slots):
                r, c = np.nonzero(fit & (scores >= limits[at, j][:, None]) & (scores <= self.hi[at, j][:, None]))
                if len(r):
                    self._keep(at, j, r, scores[r, c], ids[c], bare[c])
        return True

    def _keep(self, at: np.ndarray, j: int, r: np.ndarray, score: np.ndarray, ids: np.ndarray, bare: np.ndarray) -> None:
        """Merge hits of window j, r being rows of `at`, with what it holds: higher scores first, ties by smaller id, those without one last."""
        hit = np.unique(r)
        old_r, old_c = np.nonzero(np.arange(self.k) < self.held[at[hit], j][:, None])
        old = at[hit[old_r]], j, old_c
        r = np.concatenate((hit[old_r], r))
        score, ids, bare = np.concatenate((self.score[old], score)), np.concatenate((self.id[old], ids)), np.concatenate((self.bare[old], bare))
        order = np.lexsort((ids, bare, ~score, r))  # ~score falls as score rises, without overflow
        r, score, ids, bare = r[order], score[order], ids[order], bare[order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        top = place < self.k
        to = at[r[top]], j, place[top]
        self.score[to], self.id[to], self.bare[to] = score[top], ids[top], bare[top]
        self.held[at[hit], j] = np.minimum(np.bincount(r, minlength=len(at))[hit], self.k)

    def found(self) -> pa.RecordBatch:
        i, j, c = np.nonzero(np.arange(self.k) < self.held[:, :, None])
        ids = pa.array(self.id[i, j, c], pa.int64(), mask=self.bare[i, j, c])
        return pa.RecordBatch.from_arrays([pa.array(self.keys[i]), pa.array(self.slot[i, j]), pa.array(self.score[i, j, c]), ids], ["key", "slot", "score", "vec_id"])


def _compare(batches: Iterable[pa.RecordBatch], k: int, same: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by task, anchors first, then candidates from long to short; gives each window's best."""
    task, anchors, bucket, block, going, codes = None, [], [], None, True, {}

    def close() -> Iterator[pa.RecordBatch]:
        if bucket and block and going:
            block.meet(bucket, codes)
        if block and block.held.any():
            yield block.found()

    for batch in batches:
        for *group, role, key, vec_id, label, raw, norm, windows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if group != task:
                yield from close()
                task, anchors, bucket, block, going, codes = group, [], [], None, True, {}
            if role == 0:
                anchors.append((key, label, raw, norm, windows))
                continue
            if block is None and anchors:
                block, anchors = Block(anchors, k, same, codes), []
            if block is None or not going:
                continue
            bucket.append((key, vec_id, label, raw, norm))
            if len(bucket) == BUCKET_ROWS:
                going, bucket = block.meet(bucket, codes), []
    yield from close()


def _best(found: DataFrame, k: int) -> DataFrame:
    """The first k of each window."""
    order = Window.partitionBy("key", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(anchors: DataFrame, windows: DataFrame, rows: DataFrame, k: int, same: bool, share_rows: int = SHARE_ROWS, block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """(key, slot, rank, score, vec_id): of each window of an anchor the first k rows, by score and then id, whose score lies in it.

    anchors and rows: key, vec_id, label, raw, norm, rows also with their band; windows: key, slot, lo, hi. same: candidates are the other rows
    of an anchor's label, else the rows of all other labels.
    """
    part = F.col("label") if same else F.lit("")
    seats = rows.withColumn("part", part)
    at = F.row_number().over(Window.partitionBy("part").orderBy("band"))  # as many rows as there are bands
    bands = seats.groupBy("part", "band").agg(F.ceil(F.count("*") / share_rows).cast("int").alias("shares"), F.max("norm").alias("reach"))
    bands = cut(bands.withColumn("wave", F.floor(F.log2(at)).cast("int")))
    waves = bands.agg(F.max("wave")).first()[0]
    blocks = small(cut(anchors.groupBy(part.alias("part")).agg(F.ceil(F.count("*") / block_anchors).cast("int").alias("blocks"))), 100_000)
    callers = anchors.withColumn("part", part).join(blocks, "part").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")).drop("blocks", "vec_id")
    best, group = None, ["part", "block", "band", "share"]
    for wave in range(-1 if waves is None else waves + 1):
        now = windows
        if best is not None:
            full = best.groupBy("key", "slot").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") == k)
            now = windows.join(full, ["key", "slot"], "left").select("key", "slot", F.greatest("lo", "kth").alias("lo"), "hi")
        now = cut(now.groupBy("key").agg(F.min("lo").alias("need"), F.sort_array(F.collect_list(F.struct("slot", "lo", "hi"))).alias("windows")))
        here = small(cut(bands.where(F.col("wave") == wave)), 100_000)
        reached = F.col("norm") * F.col("reach") * (1 + 1e-9) + 1 >= F.col("need")
        calls = callers.join(now, "key").join(here, "part").where(reached).withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
        tasks = cut(callers.select("part", "block", "key", "norm").join(now.select("key", "need"), "key").join(here, "part").where(reached).select("part", "block", "band", "shares").distinct())
        if tasks.isEmpty():
            continue
        met = small(tasks, 100_000)
        met = met.withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")
        placed = seats.join(here.select("part", "band", "shares"), ["part", "band"]).withColumn("share", F.pmod(F.xxhash64(F.lit("share"), "key"), F.col("shares")).cast("int"))
        placed = placed.join(met, ["part", "band", "share"]).select(*group, F.lit(1).alias("role"), "key", "vec_id", "label", "raw", "norm", F.lit(None).cast("array<struct<slot:int,lo:bigint,hi:bigint>>").alias("windows"))
        calls = calls.select(*group, F.lit(0).alias("role"), "key", F.lit(None).cast("bigint").alias("vec_id"), "label", "raw", "norm", "windows")
        dealt = calls.unionByName(placed).repartition(spread(rows), *group).sortWithinPartitions(*group, "role", F.desc("norm"))
        found = mapped(dealt, lambda batches: _compare(batches, k, same), "key bigint, slot int, score bigint, vec_id bigint")
        best = cut(_best(found if best is None else found.unionByName(best.drop("rank")), k))
    return best if best is not None else windows.select("key", "slot", F.lit(0).alias("rank"), F.col("lo").alias("score"), F.lit(None).cast("bigint").alias("vec_id")).limit(0)


def mine_negatives(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", share_rows: int = SHARE_ROWS, block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """Rows of other labels that score nearly as high with an anchor as one of its positives does.

    Components count as floor(scale * x), a score is the inner product. Anchors are the rows where `anchor`, over vec_id and label, holds; the
    positives of one are its first `positives` other rows of the same label. For each, the first `negatives` rows of other labels are returned whose
    score is at least `low` percent of the positive's and at most all of it: anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.
    Higher scores come first, ties by smaller vec_id, a null vec_id last.

    Rows with a null label or vector, with a null or non-finite component, or one whose scaled value exceeds 64 bits take no part. Shorter
    vectors, also empty ones, count as padded with zeros. Scores are held to 64 bits. Rows of one vec_id are rows like any other, so a repeated row may be its
    twin's positive, and a repeated anchor gives its rows again. A positive with a negative score has no negatives. Other columns are
    ignored, an empty table gives no rows.
    """
    rows = vectors.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v")).where("label is not null and v is not null")
    width = max(1, vectors.agg(F.max(F.size(vector_col))).first()[0] or 0)
    rows = cut(quantised(rows, width, scale))
    n = rows.count()
    bands = min(MOST_BANDS, -(-n // share_rows))
    edges = sorted(set(rows.approxQuantile("norm", [i / bands for i in range(1, bands)], 0.001))) if bands > 1 else []
    band = F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e > F.col("norm"))) if edges else F.lit(0)
    rows = rows.withColumn("band", band.cast("int"))
    anchors = cut(rows.where(anchor).drop("band"))
    whole = anchors.select("key", F.lit(0).alias("slot"), F.lit(LEAST).cast("bigint").alias("lo"), F.lit(MOST).cast("bigint").alias("hi"))
    liked = search(anchors, whole, rows, positives, True, share_rows, block_anchors).select("key", F.col("rank").alias("slot"), F.col("score").alias("positive_score"), F.col("vec_id").alias("positive_id"))
    windows = liked.where("positive_score >= 0").select("key", "slot", F.ceil(F.col("positive_score").cast("decimal(20,0)") * low / 100).cast("bigint").alias("lo"), F.col("positive_score").alias("hi"))
    asking = anchors.join(windows.select("key").distinct(), "key", "left_semi")
    mined = search(asking, windows, rows, negatives, False, share_rows, block_anchors).select("key", "slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = mined.join(liked, ["key", "slot"]).join(anchors.select("key", F.col("vec_id").alias("anchor_id")), "key")
    return cut(named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
