"""Near-duplicate embeddings by an inverted multi-index.

Each half of the unit vectors has a codebook of its own; the two form a grid of cells. Every vector is
listed in its cell and visits cells in the order of its distance to both centroids (the
multi-sequence algorithm), as many as reach the target recall on pairs at and above the threshold. Vectors
met in a visited cell are compared by their cosine in double precision.

Cells are worked in blocks of bounded size, each a matrix product; a block gives every vector's number of links and a
spanning forest of the links, never the pairs themselves.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, mapped, small, spread

#: Codebooks and the number of visits are fitted on about this many distinct vectors; all vectors are indexed.
SAMPLE = 20_000
CALIBRATION = 4_000
BLOCK = 2_048
VISITORS = 16_384


@dataclass(frozen=True)
class MultiIndex:
    """Codebooks of both halves and the number of cells that a vector visits, its own included."""

    left: np.ndarray
    right: np.ndarray
    visits: int

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.left.shape[1]
        return _squares(unit[:, :half], self.left), _squares(unit[:, half:], self.right)

    def cells(self, d1: np.ndarray, d2: np.ndarray) -> list[int]:
        """Multi-sequence traversal of one vector's distances: the nearest cells of the grid in order."""
        o1, o2 = d1.argsort(kind="stable"), d2.argsort(kind="stable")
        heap, seen, out, k = [(d1[o1[0]] + d2[o2[0]], 0, 0)], {(0, 0)}, [], len(d2)
        while heap and len(out) < self.visits:
            _, i, j = heapq.heappop(heap)
            out.append(int(o1[i]) * k + int(o2[j]))
            for a, b in ((i + 1, j), (i, j + 1)):
                if a < len(d1) and b < k and (a, b) not in seen:
                    seen.add((a, b))
                    heapq.heappush(heap, (d1[o1[a]] + d2[o2[b]], a, b))
        return out


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)


def _codebook(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's algorithm from distinct random rows."""
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(12):
        near = _squares(x, centres).argmin(1)
        for c in range(len(centres)):
            own = x[near == c]
            if len(own):
                centres[c] = own.mean(0)
    return centres


def fit_index(unit: np.ndarray, k: int, threshold: float, recall: float, labels: np.ndarray, seed: int = 5) -> MultiIndex:
    """Codebooks of k centroids, and the visits that find `recall` of pairs at the threshold or above.

    The pairs are those of the sample, and sampled vectors with copies turned away by a random angle up to the threshold.
    """
    rng = np.random.default_rng(seed)
    half = unit.shape[1] // 2
    index = MultiIndex(_codebook(unit[:, :half], k, rng), _codebook(unit[:, half:], k, rng), 1)
    some = rng.permutation(len(unit))[:CALIBRATION]
    x = unit[some]
    away = rng.normal(size=x.shape)
    away -= (away * x).sum(1, keepdims=True) * x
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)
    cosine = rng.uniform(threshold, 1, len(x))[:, None]
    ranks = [_ranks(index, x, cosine * x + np.sqrt(1 - cosine**2) * away)]
    real = []
    for label in np.unique(labels[some]):
        own = x[labels[some] == label]
        for i in range(0, len(own), 500):
            a, b = np.nonzero(own[i : i + 500] @ own.T >= threshold)
            apart = a + i != b
            take = np.flatnonzero(apart)
            take = rng.choice(take, min(len(take), 5_000), replace=False)
            if len(take):
                real.append(_ranks(index, own[a[take] + i], own[b[take]]))
    ranks += [np.concatenate(real)] if real else []
    visits = max(int(np.quantile(r, recall, method="higher")) + 1 for r in ranks)
    return MultiIndex(index.left, index.right, visits)


def _ranks(index: MultiIndex, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many cells each x visits before that of its y."""
    out = []
    for i in range(0, len(x), 256):
        d1, d2 = index.distances(x[i : i + 256])
        e1, e2 = index.distances(y[i : i + 256])
        at = np.arange(len(d1))
        goal = d1[at, e1.argmin(1)] + d2[at, e2.argmin(1)]
        out.append((d1[:, :, None] + d2[:, None, :] < goal[:, None, None]).sum((1, 2)))
    return np.concatenate(out)


def _units(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)
    with np.errstate(over="ignore", under="ignore"):
        x = x / np.abs(x).max(1, keepdims=True)
        return x / np.sqrt((x * x).sum(1, keepdims=True))


def _doubles(rows: DataFrame, width: int) -> DataFrame:
    """Vectors as little-endian doubles, shorter ones padded with zeros to `width`; null if they can't be compared."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column(2):
                values = x.values if x.is_valid else None
                if values is None or values.null_count or not len(values):
                    out.append(None)
                    continue
                v = values.to_numpy(zero_copy_only=False).astype("<f8")
                out.append(np.pad(v, (0, width - len(v))).tobytes() if np.isfinite(v).all() and v.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["vec_id", "label", "raw"])

    return mapped(rows, work, "vec_id bigint, label string, raw binary")


def near_vectors(vectors: DataFrame, threshold: float = 0.93, recall: float = 0.995, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", sample: int = SAMPLE) -> DataFrame:
    """Links between vectors of equal label whose cosine reaches the threshold, found with at least about the given recall.

    Returns a row per input row: vec_id, n_links (other rows linked directly), component (smallest
    vec_id reachable by links, itself included), kept (vec_id equals component). Vectors that are null, empty,
    zero or hold null or non-finite values, and those with a null label, link with nothing and
    stay. Shorter vectors count as padded with zeros. Equal vectors of a label form one class that
    is compared once, and always link. Rows with equal vec_id are rows like any other; a null vec_id is the
    smallest only where there is no other. Other columns are ignored, an empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    width = max(2, width)
    for seed in range(8):
        keyed = cut(_doubles(rows, width).withColumn("key", F.when(F.col("raw").isNotNull() & F.col("label").isNotNull(), F.xxhash64(F.lit(seed), "label", "raw"))))
        classes = cut(keyed.where("key is not null").groupBy("key", "label", "raw").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first_id")))
        if classes.groupBy("key").count().where("count > 1").isEmpty():
            break
    else:
        raise RuntimeError("two vectors share their 64-bit key under every seed")
    sizes = classes.agg(F.count("*").alias("n"), F.approx_count_distinct("label").alias("labels")).first()
    out = ["vec_id", "n_links", "component", "kept"]
    if not sizes["n"]:
        return keyed.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component"), F.lit(True).alias("kept"))
    scale = 1 << 30
    drawn = classes.where(F.pmod(F.xxhash64(F.lit("sample"), "key"), F.lit(scale)) < min(scale, -(-sample * scale // sizes["n"]))).select("key", "raw", "label").limit(2 * sample).collect()
    drawn = sorted(drawn, key=lambda r: r["key"]) or classes.select("key", "raw", "label").limit(1).collect()
    k = 1 << max(1, min(8, int(np.log2(max(4, sizes["n"] / sizes["labels"] / 64)) / 2)))
    index = fit_index(_units([bytes(r["raw"]) for r in drawn]), k, threshold, recall, np.array([r["label"] for r in drawn]))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d1, d2 = index.distances(_units(batch.column(2).to_pylist()))
            visits = [index.cells(a, b) for a, b in zip(d1, d2, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([v[0] for v in visits], pa.int32()), pa.array(visits, pa.list_(pa.int32()))], ["key", "label", "raw", "copies", "cell", "visits"])

    listed = cut(mapped(classes.select("key", "label", "raw", "copies"), place, "key bigint, label string, raw binary, copies bigint, cell int, visits array<int>"))
    calls = listed.select("label", "cell", "key", F.explode("visits").alias("at"))
    loads = calls.groupBy("label", "at").agg(F.count("*").alias("visitors"), F.count_if(F.col("cell") == F.col("at")).alias("residents")).where("residents > 0")
    loads = small(cut(loads.select(F.col("label").alias("l"), "at", F.ceil(F.col("residents") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("visitors") / VISITORS).cast("int").alias("shares"))), 100_000)
    seated = listed.join(loads, (F.col("label") == F.col("l")) & (F.col("cell") == F.col("at"))).withColumn("own", F.pmod(F.hash("key"), F.col("blocks")))
    residents = seated.select("label", "at", F.col("own").alias("block"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(0).alias("role"), "key", "raw", "copies", "cell", "visits")
    callers = listed.select("*", F.explode("visits").alias("to")).join(loads, (F.col("label") == F.col("l")) & (F.col("to") == F.col("at")))
    # a resident calls at the blocks before its own, a visitor at all blocks
    last = F.when(F.col("cell") == F.col("at"), F.pmod(F.hash("key"), F.col("blocks")) - 1).otherwise(F.col("blocks") - 1)
    callers = callers.withColumn("last", last).where("last >= 0").select("label", "at", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("block"), F.pmod(F.xxhash64(F.lit("share"), "key"), F.col("shares")).cast("int").alias("share"), F.lit(1).alias("role"), "key", "raw", "copies", "cell", "visits")
    group = ["label", "at", "block", "share"]
    tasks = residents.unionByName(callers).repartition(spread(listed), *group).sortWithinPartitions(*group, "role", "key")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _compare(batches, threshold)

    met = cut(mapped(tasks, compare, "key bigint, links bigint, root bigint"))
    links = met.where("links > 0").groupBy("key").agg(F.sum("links").alias("links"))
    merged = components(met.where("root is not null"), "key", "root")
    named = cut(classes.select("key", "first_id", "copies").join(merged.select(F.col("id").alias("key"), "component"), "key", "left").withColumn("component", F.coalesce("component", "key")))
    least = cut(named.groupBy("component").agg(F.min("first_id").alias("least")))
    info = cut(named.join(least, "component").join(links, "key", "left").select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "least"))
    done = keyed.select("vec_id", "key").join(info, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return cut(done.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component"), component.eqNullSafe(F.col("vec_id")).alias("kept")).select(*out))


def _compare(batches: Iterable[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group, residents first, to partial link counts and edges of a spanning forest."""
    group, seats, calls = None, [], []
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(10)]
        for label, at, block, share, role, *row in zip(*columns, strict=True):
            if (label, at, block, share) != group:
                yield from _block(group, seats, calls, threshold, True)
                group, seats, calls = (label, at, block, share), [], []
            (calls if role else seats).append(row)
            if len(calls) >= BLOCK:
                yield from _block(group, seats, calls, threshold, False)
                calls = []
    yield from _block(group, seats, calls, threshold, True)


def _block(group, seats: list, calls: list, threshold: float, last: bool) -> Iterator[pa.RecordBatch]:
    if not seats:
        return
    keys, units = np.array([r[0] for r in seats]), _units([r[1] for r in seats])
    weight = np.array([r[2] for r in seats])
    near = units @ units.T >= threshold
    np.fill_diagonal(near, False)
    root = _roots(near)
    out_key, out_links, out_root = [], [], []
    if last and group[3] == 0:  # residents among themselves count in one share only
        links = near @ weight
        out_key += keys.tolist()
        out_links += links.tolist()
        out_root += [int(keys[r]) if r != i else None for i, r in enumerate(root)]
    if calls:
        k2, w2 = np.array([r[0] for r in calls]), np.array([r[2] for r in calls])
        hit = _units([r[1] for r in calls]) @ units.T >= threshold
        homes, at = np.array([r[3] for r in calls]), group[1]
        # of two vectors that visit each other's cell, the pair counts in the lower cell
        lower = {c for c in set(homes.tolist()) if c < at}
        if lower:
            visited = [set(r[4]) for r in seats]
            for c in lower:
                back = np.array([c in v for v in visited])
                hit[np.ix_(homes == c, back)] = False
        out_key += k2.tolist() + keys.tolist()
        out_links += (hit @ weight).tolist() + (hit.T @ w2).tolist()
        out_root += [None] * (len(k2) + len(keys))
        for i in np.flatnonzero(hit.any(1)):
            for r in np.unique(root[hit[i]]):
                out_key.append(int(k2[i]))
                out_links.append(0)
                out_root.append(int(keys[r]))
        if not (last and group[3] == 0):
            for i, r in enumerate(root):
                if r != i and hit[:, i].any():
                    out_key.append(int(keys[i]))
                    out_links.append(0)
                    out_root.append(int(keys[r]))
    keep = [i for i in range(len(out_key)) if out_links[i] or out_root[i] is not None]
    if keep:
        yield pa.RecordBatch.from_arrays([pa.array([out_key[i] for i in keep], pa.int64()), pa.array([int(out_links[i]) for i in keep], pa.int64()), pa.array([out_root[i] for i in keep], pa.int64())], ["key", "links", "root"])


def _roots(near: np.ndarray) -> np.ndarray:
    """The smallest row number of each row's component in a symmetric matrix of links."""
    root = np.arange(len(near))
    while True:
        low = np.minimum(root, np.where(near, root[None, :], len(near)).min(1, initial=len(near)))
        low = low[low]
        if (low == root).all():
            return root
        root = low
