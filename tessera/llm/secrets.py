"""Secret scans over a trigram inverted index, in DataFrame functions only.

A Boolean query over trigrams is derived from each rule's pattern. Postings (trigram, document) are
made for the trigrams of these queries and intersected; the documents that are left are verified with the
pattern itself. A rule whose pattern demands no trigram scans every text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product
from re import _parser as regex_parser

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, small


@dataclass(frozen=True)
class SecretRule:
    """`pattern` finds matches from left to right; those whose `group` has under `least` characters are dropped."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    base: bool = False


#: The base kinds in the contract's order, then those that the operator adds.
RULES = (
    SecretRule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    SecretRule("access", r"AKIA[A-Z0-9]{16,}", 20, 0, True),  # a run of under 20 characters can't hold one of 20
    SecretRule("hex", r"[0-9a-f]{24,}", 24, 0, True),
    SecretRule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    SecretRule("hosting", r"gh[pousr]_[A-Za-z0-9]{36,}", 40),
)

_MOST_STRINGS = 64
Clauses = frozenset[frozenset[str]]


def trigram_query(pattern: str) -> Clauses:
    """Trigrams that a match must hold, in lower case, as alternatives (or) of sets (and); empty: no demand.

    Literal stretches are expanded to the strings they can be, over groups, alternatives, small classes
    and small repetitions; each string demands its trigrams. Of the stretches of a pattern all demands hold.
    """
    return _demands(regex_parser.parse(pattern))


def _strings(items) -> set[str] | None:
    """All strings that a parsed sequence can be, lower-cased, or None if they are too many."""
    done = {""}
    for op, value in items:
        name = str(op)
        if name == "LITERAL":
            part = {chr(value).lower()}
        elif name == "IN":
            part = set()
            for kind, x in value:
                if str(kind) == "LITERAL":
                    part.add(chr(x).lower())
                elif str(kind) == "RANGE" and x[1] - x[0] < 16:
                    part |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
                else:
                    return None
        elif name == "SUBPATTERN":
            part = _strings(value[3])
        elif name == "BRANCH":
            each = [_strings(x) for x in value[1]]
            part = None if None in each else set().union(*each)
        elif name == "MAX_REPEAT" and value[1] is not regex_parser.MAXREPEAT and value[1] <= 4:
            one = _strings(value[2])
            part = None if one is None else {"".join(x) for n in range(value[0], value[1] + 1) for x in product(one, repeat=n)}
        elif name == "AT":
            part = {""}
        else:
            part = None
        if part is None or len(done) * len(part) > _MOST_STRINGS:
            return None
        done = {a + b for a in done for b in part}
    return done


def _of_strings(strings: set[str]) -> Clauses:
    clauses = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    least = frozenset(c for c in clauses if not any(d < c for d in clauses))
    return frozenset() if frozenset() in least else least


def _demands(items) -> Clauses:
    query: Clauses = frozenset()
    run: list = []

    def meet(a: Clauses, b: Clauses) -> Clauses:
        if not a or not b:
            return a or b
        return frozenset(x | y for x in a for y in b) if len(a) * len(b) <= _MOST_STRINGS else min(a, b, key=len)

    for item in [*items, None]:
        if item is not None and _strings([*run, item]) is not None:
            run.append(item)
            continue
        query = meet(query, _of_strings(_strings(run)))
        run = []
        if item is None:
            break
        if _strings([item]) is not None:
            run = [item]
            continue
        name, value = str(item[0]), item[1]
        if name == "SUBPATTERN":
            query = meet(query, _demands(value[3]))
        elif name == "BRANCH":
            each = [_demands(x) for x in value[1]]
            query = meet(query, frozenset() if any(not e for e in each) else frozenset().union(*each))
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and value[0] > 0:
            query = meet(query, _demands(value[2]))
    return query


def postings(rows: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """The inverted index (trigram, *keys) over the lower-cased `text` of rows, for the given trigrams."""
    held = F.filter(F.array(*[F.when(F.col("__lower").contains(t), F.lit(t)) for t in trigrams]), lambda t: t.isNotNull())
    return rows.withColumn("__lower", F.lower("text")).select(*[c for c in rows.columns if c != "text"], F.explode(held).alias("trigram"))


def candidates(rows: DataFrame, queries: dict[str, Clauses]) -> DataFrame:
    """(*keys, rules): for each key the rules one of whose clauses has all its trigrams in the text."""
    keys = [c for c in rows.columns if c != "text"]
    terms = [(rule, i, t, 1 << bit) for rule, clauses in queries.items() for i, clause in enumerate(sorted(clauses, key=sorted)) for bit, t in enumerate(sorted(clause))]
    full = {(rule, i): 0 for rule, i, _, _ in terms}
    for rule, i, _, bit in terms:
        full[rule, i] |= bit
    spark = rows.sparkSession
    values = ", ".join(f"('{r}', {i}, '{t.replace(chr(39), chr(39) * 2)}', {bit}L, {full[r, i]}L)" for r, i, t, bit in terms)
    query = spark.sql(f"select * from values {values} as q(rule, clause, trigram, bit, full)")
    listed = postings(rows, sorted({t for _, _, t, _ in terms})).join(F.broadcast(query), "trigram")
    met = listed.groupBy(*keys, "rule", "clause").agg(F.bit_or("bit").alias("bits"), F.first("full").alias("full")).where("bits = full")
    return met.groupBy(*keys).agg(F.collect_set("rule").alias("rules"))


def _lengths(text: Column, rule: SecretRule) -> Column:
    """Of each match from left to right: characters since the match before, its characters, those of its group."""
    size = lambda x: F.length(x)
    gaps = F.transform(F.split(text, rule.pattern, -1), size)
    whole = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), 0), size)
    part = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), rule.group), size) if rule.group else whole
    return F.filter(F.arrays_zip(gaps.alias("gap"), whole.alias("size"), part.alias("part")), lambda m: m["size"].isNotNull())


def _numbered(order: int):
    return lambda m, i: F.struct(F.lit(order).alias("kind_order"), i.alias("at"), m["gap"].alias("gap"), m["size"].alias("size"), m["part"].alias("part"))


def secret_spans(docs: DataFrame, rules: Sequence[SecretRule] = RULES, broadcast_rows: int = 100_000) -> DataFrame:
    """All secrets in every whole text: (doc_id, text_hash, kind, kind_order, base, start, end), a row per span.

    Positions are code points, the end exclusive. Null texts count as empty. Rows with equal doc_id and
    text give their spans once; a null doc_id is a value like any other. Other columns are ignored. Rules
    without mandatory trigrams run over all texts, the others over the candidates of the index; these
    are joined by broadcast if they are few, by a shuffle else.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    scanned = rows.withColumn("rules", F.array().cast("array<string>"))
    if queries:
        found = small(cut(candidates(rows, queries)), broadcast_rows).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "rules")
        scanned = rows.join(found, rows["doc_id"].eqNullSafe(found["__id"]) & (rows["text_hash"] == found["__hash"]), "left").drop("__id", "__hash")
    text = F.col("text")
    lists = []
    for order, rule in enumerate(rules):
        wanted = F.array_contains("rules", rule.kind) if rule.kind in queries else text.rlike(rule.pattern)
        matched = F.when(wanted, _lengths(text, rule))
        lists.append(F.coalesce(F.transform(matched, _numbered(order)), F.array().cast("array<struct<kind_order:int,at:int,gap:int,size:int,part:int>>")))
    matches = scanned.select("doc_id", "text_hash", F.explode(F.concat(*lists)).alias("m")).select("doc_id", "text_hash", "m.*").distinct()
    so_far = Window.partitionBy("doc_id", "text_hash", "kind_order").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = matches.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far)).withColumn("start", F.col("end") - F.col("size"))
    by_order = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("kind_order") + 1)
    kept = placed.where(F.col("part") >= by_order([r.least for r in rules]))
    return kept.select("doc_id", "text_hash", by_order([r.kind for r in rules]).alias("kind"), "kind_order", by_order([r.base for r in rules]).alias("base"), "start", "end")


def secret_report(docs: DataFrame, rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """A row per input row: doc_id, n_<kind> of each base kind, base_spans and spans (kind:start:end, comma-joined).

    Spans are in order of their start, then of their kind as listed. Texts without secrets have counts of
    0 and empty strings; repeated rows repeat their result.
    """
    found = secret_spans(docs, rules)
    listed = F.sort_array(F.collect_list(F.struct("start", "kind_order", "kind", "end", "base")))
    spell = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    counts = [F.count_if(F.col("kind") == r.kind).alias(f"n_{r.kind}") for r in rules if r.base]
    per_text = found.groupBy("doc_id", "text_hash").agg(*counts, listed.alias("listed"))
    per_text = per_text.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), *[f"n_{r.kind}" for r in rules if r.base], spell(F.filter("listed", lambda s: s["base"])).alias("base_spans"), spell(F.col("listed")).alias("spans"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"))
    joined = rows.join(per_text, rows["doc_id"].eqNullSafe(per_text["__id"]) & (rows["text_hash"] == per_text["__hash"]), "left")
    return joined.select("doc_id", *[F.coalesce(f"n_{r.kind}", F.lit(0)).alias(f"n_{r.kind}") for r in rules if r.base], F.coalesce("base_spans", F.lit("")).alias("base_spans"), F.coalesce("spans", F.lit("")).alias("spans"))
