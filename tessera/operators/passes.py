"""Ordered work on books of any length: running values by chunks, and passes whose steps depend on earlier ones.

A book's order begins with an integer; rows whose integers fall into the same stretch of it are a chunk, which is what one task
sorts. Values that run through a book (counts, the row before, the next value) take a pass over each chunk, one
row a chunk that tells what it hands on, and a window over those rows.

A pass whose decisions depend on earlier ones runs over all chunks at once, each from a guess of the state in which it
begins. Where the chunk before ends in another state than was guessed, the chunk runs again from that one, until all states
meet. What a pass forgets soon (a pointer, a last number) meets after few rounds; the result is that of one pass in any case.
"""

from __future__ import annotations

import json
import tempfile
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..storage import cut, small

Step = Callable[[Any, dict], tuple[Any, tuple | None]]

#: The stretch of a book's order that is one chunk.
CHUNK = 50_000


def chunk_of(order: str, size: int | None = None) -> Column:
    """The chunk of a row, by the first column of its book's order; rows without one come first, as in any ascending order."""
    return F.coalesce(F.floor(F.col(order).cast("double") / (size or CHUNK)).cast("bigint"), F.lit(-(1 << 62)))


def running_count(rows: DataFrame, by: Sequence[str], order: Sequence[str], begins: Column, name: str, size: int | None = None) -> DataFrame:
    """Add how many rows of the book, up to this one in order, hold `begins`."""
    by = list(by)
    rows = rows.withColumn("__begins", F.coalesce(begins, F.lit(False))).withColumn("__chunk", chunk_of(order[0], size))
    counted = rows.groupBy(*by, "__chunk").agg(F.count_if("__begins").alias("__n"))
    earlier = Window.partitionBy(*by).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.select(*by, "__chunk", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__handed"))
    inside = Window.partitionBy(*by, "__chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("__here", F.count_if("__begins").over(inside))
    return _with(local, before, [*by, "__chunk"]).withColumn(name, F.col("__handed") + F.col("__here")).drop("__begins", "__chunk", "__here", "__handed")


def running_max(rows: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, name: str, size: int | None = None) -> DataFrame:
    """Add the greatest value of the book up to this row in order."""
    by = list(by)
    rows = rows.withColumn("__value", value).withColumn("__chunk", chunk_of(order[0], size))
    most = rows.groupBy(*by, "__chunk").agg(F.max("__value").alias("__most"))
    before = most.select(*by, "__chunk", F.max("__most").over(Window.partitionBy(*by).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)).alias("__handed"))
    inside = Window.partitionBy(*by, "__chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("__here", F.max("__value").over(inside))
    return _with(local, before, [*by, "__chunk"]).withColumn(name, F.greatest("__handed", "__here")).drop("__value", "__chunk", "__here", "__handed")


def previous(rows: DataFrame, by: Sequence[str], order: Sequence[str], value: str, name: str, size: int | None = None) -> DataFrame:
    """Add the value of the row before in the book's order; null for the first row."""
    by = list(by)
    rows = rows.withColumn("__chunk", chunk_of(order[0], size))
    last = rows.groupBy(*by, "__chunk").agg(F.max_by(value, F.struct(*order)).alias("__last"))
    before = last.select(*by, "__chunk", F.lag("__last").over(Window.partitionBy(*by).orderBy("__chunk")).alias("__handed"))
    place = Window.partitionBy(*by, "__chunk").orderBy(*order)
    local = rows.withColumn("__place", F.row_number().over(place)).withColumn("__lag", F.lag(value).over(place))
    found = F.when(F.col("__place") == 1, F.col("__handed")).otherwise(F.col("__lag"))
    return _with(local, before, [*by, "__chunk"]).withColumn(name, found).drop("__chunk", "__place", "__lag", "__handed")


def _with(rows: DataFrame, of_chunks: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join what chunks are handed, by keys that may be null."""
    there = of_chunks.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *[c for c in of_chunks.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    return rows.join(there, same, how).drop(*[f"__k{i}" for i in range(len(keys))])


class Board:
    """Segments in order with their words as hashes: a file of the task, of which only what is looked at is held."""

    def __init__(self):
        self.file, self.segs, self.ends, self.shown = tempfile.TemporaryFile(), array("q"), array("q", [0]), None

    def add(self, seg: int, words: np.ndarray | None) -> None:
        words = np.empty(0, np.int64) if words is None else words
        self.file.write(words.tobytes())
        self.segs.append(seg)
        self.ends.append(self.ends[-1] + len(words))

    def _show(self, low: int | None, high: int | None) -> None:
        """Sort the words of the segments from low on and below high; what has been sorted last stays."""
        if self.shown == (low, high):
            return
        self.file.flush()
        segs, ends = np.frombuffer(self.segs, np.int64), np.frombuffer(self.ends, np.int64)
        first, last = (0, len(segs)) if low is None else np.searchsorted(segs, [low, high])
        n = int(ends[last] - ends[first])
        words = np.fromfile(self.file, np.int64, n) if self.file.seek(8 * int(ends[first])) >= 0 and n else np.empty(0, np.int64)
        order = words.argsort(kind="stable")
        self.owner = np.repeat(np.arange(last - first), np.diff(ends[first : last + 1]))[order]
        self.words, at = np.unique(words[order], return_index=True)
        self.starts, self.near = np.append(at, n), segs[first:last].copy()
        self.shown = (low, high)

    def count(self, words: np.ndarray | None, low: int | None = None, high: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The segments in range, in order, and how many of the distinct words each has."""
        self._show(low, high)
        if words is None or not len(self.words):
            return self.near, np.zeros(len(self.near), np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        at = at[self.words[at] == words]
        begin, n = self.starts[at], self.starts[at + 1] - self.starts[at]
        listed = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.near, np.bincount(self.owner[listed], minlength=len(self.near))


def ordered_pass(rows: DataFrame, by: Sequence[str], order: Sequence[str], step: Step, schema: StructType, size: int | None = None, beside: DataFrame | None = None) -> DataFrame:
    """What `step` puts out over each book's rows in order.

    beside: segments (*by, seg_ix, words), the words as hashes, that a book's chunks read first; a row then has them as `board`.

    step(state, row) returns the state after a row and the values that follow the book's keys in the output (None: no
    row); the state is None where a book begins, and else holds integers, strings, nulls, and tuples of these. A null key is a book of its own.
    """
    by = list(by)
    rows = rows.withColumn("__stretch", chunk_of(order[0], size))
    stretches = cut(rows.groupBy(*by, "__stretch").agg(F.count("*").alias("__rows")))
    long = cut(stretches.groupBy(*by).agg(F.count("*").alias("__n"), F.sum("__rows").alias("__all")).where((F.col("__n") > 1) & (F.col("__all") > (size or CHUNK))).select(*by, F.lit(True).alias("__long")))
    if long.isEmpty():
        begun = lambda rows: rows.withColumn("__chunk", F.lit(0).cast("bigint")).withColumn("__state", F.lit(None).cast("string"))
        return _run(_beside(begun(rows), None if beside is None else begun(beside)), by, order, step, schema, False)
    # a chunk is as many stretches as hold enough rows: where a book's rows lie far apart, each stretch has few
    earlier = F.coalesce(F.sum("__rows").over(Window.partitionBy(*by).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = cut(_with(stretches, small(long), by, "left").withColumn("__chunk", F.when(F.col("__long"), F.floor(earlier / (size or CHUNK))).otherwise(0).cast("bigint")).drop("__rows", "__long"))
    rows = _with(rows, small(placed), [*by, "__stretch"]).drop("__stretch")
    chunks, long = cut(placed.select(*by, "__chunk").distinct()), long.drop("__long")
    several = cut(_with(rows, small(long), by))
    states = cut(_with(chunks, small(long), by).withColumn("__state", F.lit(None).cast("string")))
    changed, ends = None, None
    along = Window.partitionBy(*by).orderBy("__chunk")
    while True:
        todo = states if changed is None else changed
        todo = small(cut(todo))
        ran = _run(_beside(_with(several, todo, [*by, "__chunk"]), None if beside is None else _with(beside, todo, by)), by, order, step, schema, True)
        ends = cut(ran if ends is None else ran.unionByName(_without(ends, todo, [*by, "__chunk"])))
        reached = ends.select(*by, "__chunk", F.lag("__end").over(along).alias("__state"))
        fresh = cut(_with(states.withColumnRenamed("__state", "__was"), reached, [*by, "__chunk"]))
        changed = fresh.where(~F.col("__was").eqNullSafe(F.col("__state"))).drop("__was")
        states = fresh.drop("__was")
        if changed.isEmpty():
            break
    others = _without(chunks, states, [*by, "__chunk"]).withColumn("__state", F.lit(None).cast("string"))
    begun = states.unionByName(others)
    return _run(_beside(_with(rows, begun, [*by, "__chunk"]), None if beside is None else _with(beside, begun, by)), by, order, step, schema, False)


def board_pass(rows: DataFrame, beside: DataFrame, by: Sequence[str], order: Sequence[str], step: Step, schema: StructType) -> DataFrame:
    """An ordered pass over keys that are small enough for one chunk each."""
    begun = lambda rows: rows.withColumn("__chunk", F.lit(0).cast("bigint")).withColumn("__state", F.lit(None).cast("string"))
    return _run(_beside(begun(rows), begun(beside)), list(by), order, step, schema, False)


def _beside(rows: DataFrame, beside: DataFrame | None) -> DataFrame:
    if beside is None:
        return rows
    return rows.withColumn("__beside", F.lit(False)).unionByName(beside.withColumn("__beside", F.lit(True)), allowMissingColumns=True)


def _without(ends: DataFrame, todo: DataFrame, keys: list[str]) -> DataFrame:
    gone = todo.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    return ends.join(gone, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)], "left_anti")


def _frozen(x: Any) -> Any:
    return tuple(map(_frozen, x)) if isinstance(x, list) else x


def _run(rows: DataFrame, by: list[str], order: Sequence[str], step: Step, schema: StructType, ends: bool) -> DataFrame:
    """A pass over each chunk from its `__state`: what step puts out, or with `ends` the state after each chunk (*by, __chunk, __end)."""
    keys = [*by, "__chunk"]
    out = rows.select(*keys, F.lit("").alias("__end")).schema if ends else schema
    arrow, names, beside = to_arrow_schema(out), out.names, "__beside" in rows.columns

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, state, board = None, None, None
        for batch in batches:
            found_rows = []
            for row in _with_words(batch) if beside else batch.to_pylist():
                key = tuple(row[b] for b in keys)
                if key != chunk:
                    if ends and chunk is not None:
                        found_rows.append(dict(zip(names, (*chunk, json.dumps(state)), strict=True)))
                    chunk, state, board = key, _frozen(json.loads(row["__state"] or "null")), Board() if beside else None
                if beside:
                    if row["__beside"]:
                        board.add(row["seg_ix"], row["words"])
                        continue
                    row["board"] = board
                state, found = step(state, row)
                if found is not None and not ends:
                    found_rows.append(dict(zip(names, (*key[:-1], *found), strict=True)))
            yield pa.RecordBatch.from_pylist(found_rows, schema=arrow)
        if ends and chunk is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, (*chunk, json.dumps(state)), strict=True))], schema=arrow)

    if beside:
        # by number, as such a pass takes longer than its bytes tell
        dealt = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
        return dealt.sortWithinPartitions(*keys, F.desc("__beside"), *order, "seg_ix").mapInArrow(work, out)
    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(work, out)


def _with_words(batch: pa.RecordBatch) -> Iterator[dict]:
    """A batch's rows, their `words` as numpy arrays."""
    at = batch.schema.get_field_index("words")
    words = batch.column(at)
    values, ends, none = words.values.to_numpy(zero_copy_only=False), words.offsets.to_numpy(), words.is_null().to_numpy(zero_copy_only=False)
    for i, row in enumerate(batch.drop_columns(["words"]).to_pylist()):
        yield row | {"words": None if none[i] else values[ends[i] : ends[i + 1]]}
