"""Keyed lookups between units and segments: first wins, direct, near keys, cross-references, filling by priority."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row for each key, that of the least `order`; an aggregate, so copies of a key combine before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    picked = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("__row"))
    return picked.select(*keys, "__row.*")


def direct_map(units: DataFrame, numbered: DataFrame, number: str = "num") -> DataFrame:
    """Units with the row of equal number; numbered has one row per number."""
    return units.join(numbered, number)


def without(units: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    return units.join(found.select(*keys), list(keys), "left_anti")


def among(units: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    return units.join(found.select(*keys), list(keys), "left_semi")


def near_key(units: DataFrame, candidates: DataFrame, unit_key: str, key: str, score: Column, offsets: Sequence[int] = (-1, 0, 1), least: float | Column = 1, by: Sequence[str] = ()) -> DataFrame:
    """For each unit the best candidate whose key is the unit's plus an offset; ties go to the earliest offset.

    `score` is an expression over the joined row. Returns the unit's columns, offset, key and score.
    """
    called = units.withColumn("offset", F.explode(F.array(*[F.lit(o) for o in offsets]))).withColumn("__at", F.col(unit_key) + F.col("offset"))
    met = called.join(candidates, [called["__at"] == candidates[key], *[called[b] == candidates[b] for b in by]]).select(*[called[c] for c in units.columns], called["offset"], candidates[key].alias(key), score.alias("score"))
    best = met.groupBy(*units.columns).agg(F.min_by(F.struct("offset", key, "score"), F.struct(-F.col("score"), F.col("offset"), F.col(key))).alias("b"))
    return best.select(*units.columns, "b.*").where(F.col("score") >= least)


def forward_reference(units: DataFrame, edges: DataFrame, usable: DataFrame) -> DataFrame:
    """(num, target): the first usable one of the numbers that a unit's segment lists; edges (src, dst, pos), usable (num)."""
    met = units.select("num").join(edges, F.col("num") == F.col("src")).join(usable.select(F.col("num").alias("dst")).distinct(), "dst")
    return met.groupBy("num").agg(F.min_by("dst", F.struct("pos", "dst")).alias("target"))


def reverse_reference(units: DataFrame, edges: DataFrame, usable: DataFrame) -> DataFrame:
    """(num, target): the usable number listed first in the book (by src_ix) that lists the unit."""
    met = units.select("num").join(edges, F.col("num") == F.col("dst")).join(usable.select(F.col("num").alias("src")).distinct(), "src")
    return met.groupBy("num").agg(F.min_by("src", F.struct("src_ix", "src")).alias("target"))


def by_priority(sources: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Rows of the first source that has a key; `priority` tells which (from 0)."""
    ranked = [s.withColumn("priority", F.lit(i)) for i, s in enumerate(sources)]
    every = ranked[0]
    for r in ranked[1:]:
        every = every.unionByName(r)
    return first_wins(every, keys, "priority")


def lowest(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int = 1) -> DataFrame:
    """The first n rows of each key, with their `rank` from 1."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n)


def one_each(rows: DataFrame, keys: Sequence[str], items: Column | str, name: str) -> DataFrame:
    """(*keys, name): a row for each item of an array that isn't null.

    An inner explode would make Spark compute the array twice, once to see that it isn't empty.
    """
    return rows.select(*keys, F.explode_outer(items).alias(name)).where(F.col(name).isNotNull())
