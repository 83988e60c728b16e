"""Helpers that the training-data operators share: shared storage, lineage cuts, hashing, components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The contracts' white space: U+0020 and U+0009 to U+000D.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of an Arrow batch where the session has Spark's default of 64 MB, of which a task holds several copies on both sides.
BATCH_BYTES = 4 << 20
_BATCH, _DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a temporary one where that is unset on a local master (tests)."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not base and not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not base:
        base = getattr(context, "_tessera_dir", None) or "file://" + tempfile.mkdtemp(prefix="tessera-")
        context._tessera_dir = base
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(base)
    return base


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint; Spark removes its files once nothing refers to them."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def free(spark: SparkSession) -> None:
    """Have Spark remove the shuffles that nothing needs any more: it does so when the driver collects garbage, which may be long after."""
    spark._jvm.System.gc()


def release() -> None:
    """Give memory that a task has freed back to the system, as workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # other C libraries have no such call
        pass


def mapped(df: DataFrame, work: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow in batches of bounded size; the worker gives its freed memory back after each task."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH) == _DEFAULT:
        conf.set(_BATCH, str(BATCH_BYTES))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            release()

    return df.mapInArrow(task, schema)


class Scratch:
    """A folder in shared storage for written tables, removed when the block ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def __enter__(self) -> str:
        return self.path

    def __exit__(self, *_) -> None:
        remove(self.spark, self.path)


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a materialised table if a count shows that it has at most `rows` rows; else leave it to be shuffled."""
    return F.broadcast(df) if df.count() <= rows else df


#: Bits of an id's hash by which texts are told apart before they are moved: a bound on the rows that are broadcast.
ID_BITS = 22


def _id_bits(column: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.col(column).cast("bigint")), 64 - ID_BITS)


def by_ids(rows: DataFrame, named: DataFrame, column: str, there: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose id may be among the named ones, and those whose id isn't; neither is moved. A null id counts as an id."""
    bits = F.broadcast(cut(named.select(_id_bits(there).alias("__bits")).distinct()))
    same = _id_bits(column) == F.col("__bits")
    return rows.join(bits, same, "left_semi"), rows.join(bits, same, "left_anti")


def spread(df: DataFrame) -> int:
    """Shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


#: Edges that one task contracts at most: some tens of megabytes.
ONE_TASK_EDGES = 200_000


def contract(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the same components: each partition's become a star for each of its own components.

    Memory is bounded by a partition's edges; what arrives by a hash of u is a small part of all.
    """

    def stars(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            top = x
            while root[top] != top:
                top = root[top]
            while root[x] != top:
                root[x], x = top, root[x]
            return top

        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                root.setdefault(u, u)
                root.setdefault(v, v)
                a, b = find(u), find(v)
                if a != b:
                    root[max(a, b)] = min(a, b)
        nodes = list(root)
        for i in range(0, len(nodes), 50_000):
            part = [x for x in nodes[i : i + 50_000] if find(x) != x]
            yield pa.RecordBatch.from_arrays([pa.array([find(x) for x in part], pa.int64()), pa.array(part, pa.int64())], ["u", "v"])

    return mapped(edges, stars, "u bigint, v bigint")


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """Connected components of an edge list: (id, component), the component being its smallest id.

    Edges are contracted within their partitions first. If few are left by count, one task contracts the rest, with the same
    result. Else minimum labels travel along the edges and labels jump to their label's label, so a chain of n
    nodes needs about log n rounds. Joins have one row per id on one side, which leaves AQE free to
    split a hot id on the other. Nodes are those that occur in an edge; a null end is ignored.
    An edge list that doesn't settle in `rounds` rounds raises an error.
    """
    both = edges.select(F.col(a).cast("bigint").alias("u"), F.col(b).cast("bigint").alias("v")).where("u is not null and v is not null and u <> v")
    both = cut(contract(contract(both).repartition(spread(edges), "v")).distinct())
    if both.count() <= ONE_TASK_EDGES:
        stars = cut(contract(both.repartition(1)))
        return stars.select(F.col("v").alias("id"), F.col("u").alias("component")).unionByName(stars.select(F.col("u").alias("id"), F.col("u").alias("component")).distinct())
    both = cut(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    labels = cut(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("l")))
    for _ in range(rounds):
        near = both.join(labels.withColumnRenamed("u", "v"), "v").groupBy("u").agg(F.min("l").alias("m"))
        low = labels.join(near, "u").select("u", F.least("l", "m").alias("m"), F.col("l").alias("was"))
        jump = labels.select(F.col("u").alias("m"), F.col("l").alias("j"))
        labels = cut(low.join(jump, "m", "left").select("u", F.least("m", "j").alias("l"), (F.least("m", "j") != F.col("was")).alias("moved")))
        if labels.where("moved").isEmpty():
            return labels.select(F.col("u").alias("id"), F.col("l").alias("component"))
        labels = labels.drop("moved")
    raise RuntimeError(f"components did not settle in {rounds} rounds")


# ---- hashing on numpy arrays -------------------------------------------------------------------

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the hash base and of its inverse, grown as needed."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            with np.errstate(over="ignore"):
                size = max(n, 1 << 16)
                cls.up = np.cumprod(np.concatenate(([np.uint64(1)], np.full(size, BASE))))
                cls.down = np.cumprod(np.concatenate(([np.uint64(1)], np.full(size, BASE_INVERSE))))
        return cls.up, cls.down
