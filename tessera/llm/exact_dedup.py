"""Exact deduplication over a log-structured merge index of text digests.

Rows flow through bounded memtables; a full one is flushed as a run sorted by digest, written as
Parquet with Bloom filters and min/max statistics on the digest. Compaction reads all runs, each range of
digests in order, and merges equal neighbours into one level that keeps the smallest identifier and the count. A filter
of the digests that occur more than once tells which texts are needed: all others are never moved. A digest hit is only a
candidate: its bytes are compared with those of the row that stays, and rows that differ are grouped
anew by their whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, cut, mapped, remove, small, spread

#: A run of white space that isn't already one space.
_UNEVEN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
MEMTABLE_ROWS = 200_000
#: Leading bits of a digest that the filter of repeated digests keeps, which bounds it to 2 ** FILTER_BITS rows.
FILTER_BITS = 20
#: Rows of (id, digest) that are broadcast at most.
GONE_ROWS = 500_000


def normalised(text: Column) -> Column:
    """The text with each run of white space replaced by one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _UNEVEN, " ")


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


class LsmIndex:
    """A persistent digest index in shared storage: add() flushes runs, compact() merges them, probe() looks up."""

    _FILTERED = {"parquet.bloom.filter.enabled#digest": "true", "parquet.bloom.filter.expected.ndv#digest": "1000000"}

    def __init__(self, spark: SparkSession, path: str, memtable_rows: int = MEMTABLE_ROWS):
        self.spark, self.path, self.memtable_rows, self.runs, self.level = spark, path, memtable_rows, 0, 0

    def add(self, rows: DataFrame) -> None:
        """Flush (digest binary, id bigint) as sorted runs; an id may be null, which never wins over another."""
        capacity = self.memtable_rows

        def memtable(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table: dict[bytes, list] = {}
            for batch in batches:
                for digest, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    held = table.get(digest)
                    if held is None:
                        table[digest] = [row, 1]
                        if len(table) >= capacity:
                            yield run(table)
                            table = {}
                    else:
                        held[1] += 1
                        if row is not None and (held[0] is None or row < held[0]):
                            held[0] = row
            if table:
                yield run(table)

        def run(table: dict[bytes, list]) -> pa.RecordBatch:
            digests = sorted(table)
            return pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array([table[d][0] for d in digests], pa.int64()), pa.array([table[d][1] for d in digests], pa.int64())], ["digest", "id", "n"])

        flushed = mapped(rows.select("digest", F.col("id").cast("bigint").alias("id")), memtable, "digest binary, id bigint, n bigint")
        flushed.write.options(**self._FILTERED).parquet(f"{self.path}/run={self.runs}")
        self.runs += 1

    def compact(self) -> None:
        """Merge the last level and all runs since, in the order of their digests, into a new level that is sorted within each file."""
        parts = [f"{self.path}/run={i}" for i in range(self.runs)] + ([f"{self.path}/level={self.level}"] if self.level else [])
        runs = self.spark.read.parquet(*parts)

        def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = None  # the entry that the next row may add to
            for batch in batches:
                out = []
                for digest, row, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                    if held is not None and held[0] == digest:
                        held[2] += n  # the smallest identifier comes first, nulls last
                        continue
                    if held is not None:
                        out.append(held)
                    held = [digest, row, n]
                yield entries(out)
            if held is not None:
                yield entries([held])

        def entries(out: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([e[0] for e in out], pa.binary()), pa.array([e[1] for e in out], pa.int64()), pa.array([e[2] for e in out], pa.int64())], ["digest", "id", "n"])

        ordered = runs.select("digest", "id", "n").repartition(spread(runs), "digest").sortWithinPartitions("digest", F.col("id").asc_nulls_last())
        mapped(ordered, merge, "digest binary, id bigint, n bigint").write.options(**self._FILTERED).parquet(f"{self.path}/level={self.level + 1}")
        for part in parts:
            remove(self.spark, part)
        self.level, self.runs = self.level + 1, 0

    def entries(self) -> DataFrame:
        """(digest, id, n) of the compacted level."""
        return self.spark.read.parquet(f"{self.path}/level={self.level}")

    def probe(self, digests: list[bytes]) -> DataFrame:
        """Entries of a few digests; statistics and Bloom filters skip the row groups without them."""
        return self.entries().where(F.col("digest").isin([bytearray(d) for d in digests]))


def _leading(digest: str) -> Column:
    """FILTER_BITS bits of a digest's hash."""
    return F.shiftright(F.hash(digest), 32 - FILTER_BITS)


def exact_groups(docs: DataFrame, digest: Callable[[Column], Column] = sha256_digest, memtable_rows: int = MEMTABLE_ROWS) -> DataFrame:
    """Groups of documents whose white-space-normalised texts are equal.

    Returns a row per input row: doc_id, keep_id (the smallest doc_id of the group), group_size,
    kept, digest (of the normalised text). Only doc_id and text are read, other columns are ignored.
    Null texts count as empty, and empty texts equal each other. Rows with equal doc_id and text
    count separately in group_size and are all `kept` if theirs is the smallest id. A null doc_id
    stays only in a group without any other id; its keep_id is then null. An empty table gives no rows.
    """
    spark = docs.sparkSession
    text = normalised(F.col("text"))
    keys = cut(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), digest(text).alias("digest")))
    with Scratch(spark, "lsm") as path:
        index = LsmIndex(spark, path, memtable_rows)
        index.add(keys.select("digest", F.col("doc_id").alias("id")))
        index.compact()
        repeated = index.entries().where("n > 1").select("digest", F.col("id").alias("keep_id"), F.col("n").alias("group_size"))
        bodies = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), digest(text).alias("digest"), text.alias("body"))
        repeated = cut(repeated)
        wanted = F.broadcast(cut(repeated.select(_leading("digest").alias("__bits")).distinct()))
        hits = cut(bodies.join(wanted, _leading("digest") == F.col("__bits"), "left_semi").join(repeated, "digest"))
        # materialised, so that AQE may split a hot digest of the join below, whose both sides are then plain exchanges
        keepers = cut(hits.where("doc_id <=> keep_id").groupBy("digest").agg(F.min("body").alias("kept_body")))
        compared = hits.join(keepers, "digest", "left").select("doc_id", "digest", "body", F.col("body").eqNullSafe(F.col("kept_body")).alias("same"))
        differ = cut(compared.where("not same").select("doc_id", "digest", "body"))
        grouped = keys.join(repeated, "digest", "left").select("doc_id", "digest", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"))
        if not differ.isEmpty():
            grouped = _split_collisions(hits, differ, grouped, repeated)
        return cut(grouped.select("doc_id", "keep_id", F.col("group_size").cast("bigint").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest"))


def _split_collisions(hits: DataFrame, differ: DataFrame, grouped: DataFrame, repeated: DataFrame) -> DataFrame:
    """Where texts share a digest but not their bytes, group the rows of that digest by whole text."""
    clashing = differ.select("digest").distinct()
    exact = hits.join(clashing, "digest", "left_semi").groupBy("digest", "body").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    redone = hits.join(clashing, "digest", "left_semi").select("doc_id", "digest", "body").join(exact, ["digest", "body"]).select("doc_id", "digest", "keep_id", "group_size")
    return grouped.join(clashing, "digest", "left_anti").unionByName(redone)


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, each with all its columns; of repeated rows of one doc_id and text, one stays.

    Nulls are treated as in exact_groups; an empty table stays empty. Only the few columns that decide are shuffled, unless
    more than GONE_ROWS rows go.
    """
    groups = cut(exact_groups(docs).groupBy("doc_id", "digest", "kept").agg(F.count("*").alias("rows")))
    named = lambda rows: small(cut(rows.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__key"))), GONE_ROWS)
    marked = docs.withColumn("__digest", sha256_digest(normalised(F.col("text"))))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__key"))
    stay = marked.join(named(groups.where("not kept")), same, "left_anti")
    twice = groups.where("kept and rows > 1")
    if not twice.isEmpty():
        twice = named(twice)
        stay = stay.join(twice, same, "left_anti").unionByName(stay.join(twice, same, "left_semi").dropDuplicates(["doc_id", "__digest"]))
    return stay.drop("__digest")
