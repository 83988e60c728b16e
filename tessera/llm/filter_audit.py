"""How quality filters interact: every order of them, as paths of a trie of survivor tables.

A node of the trie is the set of filters applied so far, whatever their order, and its table holds the documents that are
left. The trie is walked depth first: a node's survivors are persisted, each of its edges (a filter yet to apply) counts
what it removes from them, and the next node is entered with what the edge leaves. Nodes that another order has reached
before are not entered again, so n filters take 2^n nodes for n! orders.
"""

from __future__ import annotations

from itertools import permutations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, Scratch, cut

def filters() -> dict[str, Column]:
    """Failure conditions by letter, over the columns of `measured`: few words, few distinct ones, many capitals, odd characters, a copy of an earlier text."""
    return {
        "A": F.col("words") < 200,
        "B": 100 * F.col("distinct_words") < 50 * F.col("words"),
        "C": 100 * F.col("capitals") > 3 * F.col("code_points"),
        "D": F.col("odd"),
        "E": F.col("copy"),
    }


def measured(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What the filters look at, a row per document: part, words, distinct_words, capitals, code_points, odd, copy, good, toxic.

    A null text counts as empty, a null lang as the part ''. copy: some row with a smaller doc_id has an equal text; a null
    doc_id is neither smaller nor larger than any. Texts are compared by SHA-256. good and toxic: some row of `labels` with
    this doc_id, which isn't null, says so. Repeated rows are counted each.
    """
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(text, SPACES), "")
    split = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("t"), words.alias("w"))
    rows = cut(split.select(
        "doc_id", "part", F.size("w").cast("bigint").alias("words"), F.size(F.array_distinct("w")).cast("bigint").alias("distinct_words"),
        F.length(F.regexp_replace("t", "[^A-Z]+", "")).cast("bigint").alias("capitals"), F.length("t").cast("bigint").alias("code_points"),
        F.col("t").rlike("[#$%&*|]").alias("odd"), F.unhex(F.sha2("t", 256)).alias("digest"),
    ))
    # the first of equal texts, met by id and digest, so that a text that very many documents share is no hot key
    first = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    said = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    judged = rows.join(first, ["digest", "doc_id"], "left").join(said.where("good or toxic"), "doc_id", "left")
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return judged.select("part", "words", "distinct_words", "capitals", "code_points", "odd", copy.alias("copy"), F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def count_edges(rows: DataFrame, conditions: dict[str, Column], path: str) -> int:
    """Walk the trie over `rows`; write a row per node, part and edge to `path`, and return the number of nodes walked.

    Columns: part, node (letters of the filters applied, sorted), filter, entered (documents of the node), removed, good_lost,
    toxic_lost. Survivors are persisted on disk and in memory, at most as many tables as there are filters at a time; what a
    lost executor held is computed again from `rows`.
    """
    seen: set[frozenset[str]] = set()

    def walk(node: frozenset[str], left: DataFrame) -> None:
        seen.add(node)
        edges = [f for f in conditions if f not in node]
        if not edges:
            return
        left = left.persist(StorageLevel.MEMORY_AND_DISK)
        tallies = [F.struct(F.lit(f).alias("filter"), F.count_if(c).alias("removed"), F.count_if(c & F.col("good")).alias("good_lost"), F.count_if(c & F.col("toxic")).alias("toxic_lost")) for f, c in conditions.items() if f in edges]
        counts = left.groupBy("part").agg(F.count("*").alias("entered"), *(t.alias(f"edge_{f}") for f, t in zip(edges, tallies, strict=True)))
        edge = F.explode(F.array(*(f"edge_{f}" for f in edges))).alias("edge")
        counts.select("part", F.lit("".join(sorted(node))).alias("node"), "entered", edge).select("part", "node", "entered", "edge.*").write.mode("append").parquet(path)
        for f in edges:
            if node | {f} not in seen:
                walk(node | {f}, left.where(~conditions[f]))
        left.unpersist()

    walk(frozenset(), rows)
    return len(seen)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter removes at each step of every order, by part.

    Returns a row per part (each lang; null counts as ''), order and step: part, filter_order, step, kept (documents after the
    step), removed (by the step), redundant (failing the step's filter, removed by an earlier one), unique_fails (failing this filter
    only), good_lost and toxic_lost (removed here and labelled so), shapley (what the filter removes, summed over
    all orders). Other columns are ignored; an empty table of documents gives no rows; for the other odd cases see `measured`.
    """
    spark, conditions = docs.sparkSession, filters()
    letters = sorted(conditions)
    with Scratch(spark, "audit") as path:
        kept = [*(c.alias(f"fails_{f}") for f, c in conditions.items()), "part", "good", "toxic"]
        measured(docs, labels).select(*kept).write.parquet(f"{path}/rows")
        flags = {f: F.col(f"fails_{f}") for f in letters}
        count_edges(spark.read.parquet(f"{path}/rows"), flags, f"{path}/edges")
        edges = spark.read.parquet(f"{path}/edges")
        steps = [("".join(order), i + 1, f, "".join(sorted(order[:i])), "".join(x for x in letters if x != f)) for order in permutations(letters) for i, f in enumerate(order)]
        steps = F.broadcast(spark.createDataFrame(steps, "filter_order string, step int, filter string, node string, others string"))  # as many rows as orders have steps
        every = edges.where("node = ''").select("part", "filter", F.col("removed").alias("failing")).join(steps, "filter")
        alone = edges.select("part", "filter", F.col("node").alias("others"), F.col("removed").alias("unique_fails"))
        # a part that a node has nothing left of has no row there: nothing entered
        out = every.join(edges, ["part", "node", "filter"], "left").join(alone, ["part", "filter", "others"], "left").na.fill(0)
        worth = F.sum("removed").over(Window.partitionBy("part", "filter"))  # as many rows as there are steps of orders
        out = out.select("part", "filter_order", "step", (F.col("entered") - F.col("removed")).alias("kept"), "removed", (F.col("failing") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", worth.alias("shapley"))
        return cut(out)
