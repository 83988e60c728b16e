"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Each document draws an exponential key divided by its quality weight; within a source, documents are
taken in order of the key until the source's word budget is used up. Whole passes over a source
(epochs) come first, the rest is a fraction of one more pass. Where a document doesn't fit any more, the
order goes on with those that do, so a source ends close to its budget.

What the mix takes follows from a few keys per source, which are found by prefix sums over key buckets. So
documents are never sorted as a whole, and their texts are never moved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, small

#: Rows that a key bucket should hold; a source is cut into as many buckets as that needs.
BUCKET_ROWS = 4_000
MAX_EPOCHS = 3
#: How often the order goes on with smaller documents after one that doesn't fit.
PASSES = 4
#: Sources, or buckets of all sources, that are broadcast at most; beyond that they are joined by a shuffle.
BROADCAST_ROWS = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def text_quality(text: Column, size: Column) -> Column:
    """A weight in (0, 1]: 1 where words have about six characters on average, less the further from that."""
    mean = (F.length(text) + 1) / size
    return F.when(size > 0, 1 / (1 + F.abs(F.log(mean / 6.5)))).otherwise(F.lit(1.0))


def uniform(doc_id: Column, text: Column, seed: int) -> Column:
    """A number in (0, 1) from id and text alone, the same in every run: 52 bits of an MD5 digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), F.coalesce(F.md5(text), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), epochs: int = MAX_EPOCHS, share: float = 1.0) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    Sources in order of their code points, null last, take `weights` in turn. They share `share` of all
    words by weight; a target over `epochs` times its source is cut to that, and what is cut is shared
    out by weight among the rest until none is above. Cut sources are those of least
    size/weight, so one pass in that order finds them all; there is a row per source, not per document.
    """
    ranked = sizes.withColumn("__w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1) % len(weights) + 1).cast("int")))
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy(F.col("__cap") / F.col("__w"), F.col("source").isNull(), F.col("source").cast("binary")).rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumn("__cap", F.col("source_size") * float(epochs)).withColumn("__all", F.sum("source_size").over(every) * float(share)).withColumn("__weights", F.sum("__w").over(every))
    ranked = ranked.withColumn("__left", F.col("__all") - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))).withColumn("__rest", F.col("__weights") - F.coalesce(F.sum("__w").over(before), F.lit(0.0)))
    ranked = ranked.withColumn("__full", F.col("__left") * F.col("__w") / F.col("__rest") > F.col("__cap"))
    ranked = ranked.withColumn("__free", F.sum(F.when(F.col("__full"), 0.0).otherwise(F.col("__w"))).over(every)).withColumn("__held", F.sum(F.when(F.col("__full"), F.col("__cap")).otherwise(0.0)).over(every))
    return ranked.select("source", "source_size", F.when(F.col("__full"), F.col("__cap")).otherwise((F.col("__all") - F.col("__held")) * F.col("__w") / F.col("__free")).alias("target"))


def _keyed(docs: DataFrame, seed: int, quality: Column | None) -> list[Column]:
    """The columns doc_id, source, size, q (quality weight) and key of documents."""
    text = F.col("text")
    size = word_count(text)
    q = F.greatest(F.coalesce(text_quality(text, size) if quality is None else quality.cast("double"), F.lit(1e-6)), F.lit(1e-6))
    q = F.when(F.isnan(q), F.lit(1e-6)).otherwise(q)
    key = -F.log(uniform(F.col("doc_id").cast("bigint"), text, seed)) / q
    return [F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"), q.alias("q"), key.alias("key")]


def _by_source(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with the columns of their source's plan."""
    named = plan.withColumnRenamed("source", "__s")
    return rows.join(small(named, BROADCAST_ROWS), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")


def _bucket() -> Column:
    """The key bucket of a row: its place in the distribution of its source's keys, which is a mixture of exponential ones."""
    below = F.aggregate("mixture", F.lit(0.0), lambda total, part: total + part["share"] * (1 - F.exp(-F.col("key") * part["q"])))
    return F.least(F.floor(below * F.col("buckets")), F.col("buckets") - 1).cast("bigint")


def _more(passes: int, position: Column, border: str) -> Column:
    """Whether a row is taken once more, by the borders that a plan has so far."""
    taken = F.lit(False)
    for p in range(passes):
        before = F.col(f"{border}{p}").isNull() | (position < F.col(f"{border}{p}"))
        inside = before if not p else before & F.col(f"{border}{p - 1}").isNotNull() & (position > F.col(f"{border}{p - 1}")) & (F.col("size") <= F.col(f"left{p - 1}"))
        taken = taken | F.coalesce(inside, F.lit(False))
    return taken


def mix_plan(rows: DataFrame, weights: Sequence[float], epochs: int, bucket_rows: int) -> DataFrame:
    """What decides over the documents of a source, a row per source: target, whole epochs, and the borders of one more.

    rows has source, size, q, key and tie. `at0` is the position (key, tie) of the first document that exceeds the budget, `left0` what is
    left of the budget there; the order goes on behind it with documents of at most that size, and so on. `last` is
    the first document of all that are left whose size is nearer to what is left than nothing; null if there is none.
    """
    totals = cut(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")))
    shares = rows.groupBy("source", F.round(2 * F.log2("q")).alias("level")).agg(F.avg("q").alias("q"), F.count("*").alias("rows"))
    mixture = shares.groupBy(F.col("source").alias("s2")).agg(F.collect_list(F.struct("q", "rows")).alias("parts"))
    plan = source_targets(totals.select("source", "source_size"), weights, epochs).join(totals.select(F.col("source").alias("s3"), "n"), F.col("source").eqNullSafe(F.col("s3"))).join(mixture, F.col("source").eqNullSafe(F.col("s2")))
    plan = plan.withColumn("whole", F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(epochs))).otherwise(F.lit(1)).cast("int"))
    rest = F.when((F.col("source_size") > 0) & (F.col("whole") < epochs), F.col("target") - F.col("whole") * F.col("source_size")).otherwise(F.lit(0.0))
    parts = F.transform("parts", lambda x: F.struct(x["q"].alias("q"), (x["rows"] / F.col("n")).alias("share")))
    plan = cut(plan.select("source", "source_size", "target", "whole", rest.alias("rest"), F.greatest(F.lit(1), F.ceil(F.col("n") / bucket_rows)).cast("bigint").alias("buckets"), parts.alias("mixture")))
    position = F.struct("key", "tie")
    for p in range(PASSES):
        budget = "rest" if not p else f"left{p - 1}"
        able = _by_source(rows.where("size > 0"), plan).where(F.col(budget) > 0)
        if p:
            able = able.where((F.col("size") <= F.col(budget)) & (position > F.col(f"at{p - 1}")))
        able = able.withColumn("bucket", _bucket())
        order = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = able.groupBy("source", "bucket", budget).agg(F.sum("size").alias("bucket_size")).withColumn("start", F.coalesce(F.sum("bucket_size").over(order), F.lit(0)))
        sums = cut(sums.select(F.col("source").alias("__s"), F.col("bucket").alias("__b"), "bucket_size", "start", F.col(budget).alias("budget")))
        edges = sums.where("start <= budget and start + bucket_size > budget")
        at_edge = able.join(small(edges, BROADCAST_ROWS), F.col("source").eqNullSafe(F.col("__s")) & (F.col("bucket") == F.col("__b")))
        running = F.col("start") + F.sum("size").over(Window.partitionBy("source").orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        over = at_edge.select("source", position.alias("at"), "size", "budget", running.alias("running")).where("running > budget")
        crossing = over.groupBy(F.col("source").alias("__s")).agg(F.min(F.struct("at", (F.col("budget") - F.col("running") + F.col("size")).alias("left"))).alias("c"))
        used = sums.groupBy(F.col("__s").alias("__t")).agg((F.first("budget") - F.sum("bucket_size")).alias("all_left"))
        plan = plan.join(crossing, F.col("source").eqNullSafe(F.col("__s")), "left").join(used, F.col("source").eqNullSafe(F.col("__t")), "left")
        # without a crossing document all that may be are taken; without any that may be, or without a budget, none is
        none = F.struct(F.lit(float("-inf")).alias("key"), F.lit(-1).cast("bigint").alias("tie"))
        at = F.when(F.col(budget).isNull() | (F.col(budget) <= 0), none).otherwise(F.col("c.at"))
        plan = cut(plan.withColumn(f"at{p}", at).withColumn(f"left{p}", F.coalesce("c.left", "all_left", F.col(budget), F.lit(0.0))).drop("__s", "__t", "c", "all_left"))
    left = F.col(f"left{PASSES - 1}")
    able = _by_source(rows.where("size > 0"), plan).where((F.col("rest") > 0) & ~_more(PASSES, position, "at") & (F.col("size") < 2 * left))
    last = able.groupBy(F.col("source").alias("__s")).agg(F.min(position).alias("last"))
    return cut(plan.join(last, F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s"))


def _copies(position: Column, border: str, last: str) -> Column:
    more = _more(PASSES, position, border) | F.coalesce(position == F.col(last), F.lit(False))
    return F.when(F.col("size") == 0, F.greatest(F.col("whole"), F.lit(1))).otherwise(F.col("whole") + more.cast("int")).cast("int")


def mix_sources(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), seed: int = 17, quality: Column | None = None, epochs: int = MAX_EPOCHS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """How many words the mix takes of every document.

    Returns a row per input row: doc_id, source, size (words; null text: 0), source_size, target (of the
    source), copies (times the document is taken), taken (size times copies). `quality` is a positive
    weight column (null or not positive: the least weight). Documents of one source are ordered by
    -ln(u)/quality, where u comes from id and text. A document that exceeds what is left of the budget is passed over and
    smaller ones behind it go on, `PASSES` times in all; then one more is taken if that comes nearer
    to the target. Repeated rows are taken in turn. Documents of size 0 take nothing away and are taken at least once. A null
    source is a source like any other, a null id a value like any other. An empty table gives no rows; other columns are ignored.

    A source's documents are cut into key buckets of about `bucket_rows`, so that a hot source never meets in one task:
    bucket sums are added up first (a row per bucket), then only the bucket in which the budget ends is ordered.
    """
    rows = cut(docs.select(*_keyed(docs, seed, quality)).withColumn("tie", F.monotonically_increasing_id()))
    plan = mix_plan(rows, weights, epochs, bucket_rows)
    copies = _copies(F.struct("key", "tie"), "at", "last")
    return _by_source(rows, plan).select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).cast("bigint").alias("taken"))


def take_mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), seed: int = 17, quality: Column | None = None, epochs: int = MAX_EPOCHS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The mixed documents: rows that the mix takes n times appear n times, with all their columns.

    Nulls, empty tables and extra columns are treated as in mix_sources. Rows are judged where they lie, by their keys; repeated rows at a
    border are treated alike.
    """
    rows = cut(docs.select(*_keyed(docs, seed, quality)).withColumn("tie", F.monotonically_increasing_id()))
    plan = mix_plan(rows, weights, epochs, bucket_rows)
    plan = plan.select(F.col("source").alias("__s"), "whole", "last.key", *[f"left{p}" for p in range(PASSES)], *[F.col(f"at{p}.key").alias(f"at{p}") for p in range(PASSES)])
    plan = plan.select([F.col(c).alias(c if c == "__s" else f"__{c}") for c in plan.columns])
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), *[c.alias(n) for c, n in zip(_keyed(docs, seed, quality), ("doc_id", "source", "size", "q", "key"), strict=True)])
    joined = named.join(small(plan, BROADCAST_ROWS), F.col("source").eqNullSafe(F.col("__s")))
    flat = joined.select("__row", "size", F.col("key").alias("position"), F.col("__whole").alias("whole"), F.col("__key").alias("last"), *[F.col(f"__{c}{p}").alias(f"{c}{p}") for c in ("left", "at") for p in range(PASSES)])
    copied = flat.withColumn("copies", _copies(F.col("position"), "at", "last")).where("copies > 0")
    return copied.select("__row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("__row.*")
