"""The release gate: declarative checks, each a row (check, scope, metric, threshold, ok)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import profiles as P
from ..functions import text as T
from ..storage import cut, small
from . import scan
from .lookup import one_each
from .passes import previous


def _row(check: str, scope: Column | str, metric: Column, threshold: Column, ok: Column) -> list[Column]:
    scope = F.lit(scope) if isinstance(scope, str) else scope
    return [F.lit(check).alias("check"), scope.alias("scope"), metric.cast("double").alias("metric"), threshold.cast("double").alias("threshold"), ok.alias("ok")]


def numbering(units: DataFrame, expected: DataFrame, least: int = 10) -> DataFrame:
    """Per book (slug): no text under `least` characters, the expected greatest number, few numbers missing, no inversion.

    units (slug, unit_ix, num, text), expected (slug, canon_max, tolerance, unordered). Returns the counts and ok.
    """
    down = previous(units, ["slug"], ["unit_ix"], "num", "before").withColumn("down", F.col("before") > F.col("num"))
    counted = down.groupBy("slug").agg(F.count("*").alias("n"), F.count_if(F.length(T.gate_form(F.coalesce("text", F.lit("")))) < least).alias("n_short"), F.max("num").alias("max_num"), F.count_if("down").alias("n_inversions"))
    ok = (F.col("n_short") == 0) & (F.col("max_num") == F.col("canon_max")) & (F.col("n") >= F.col("canon_max") - F.col("tolerance")) & ((F.col("n_inversions") == 0) | F.col("unordered"))
    return counted.join(expected, "slug").select("slug", "n", "n_short", "max_num", "n_inversions", ok.alias("ok"))


def glued_tails(units: DataFrame, residue: int = 8) -> DataFrame:
    n = F.count_if(T.has_glued_tail(F.col("text")))
    return units.agg(n.alias("n")).select(*_row("glued_tails", "all", F.col("n"), F.lit(residue), F.col("n") <= residue))


def stray_prefixes(units: DataFrame) -> DataFrame:
    n = F.count_if(T.has_stray_prefix(F.col("text")))
    return units.agg(n.alias("n")).select(*_row("stray_prefixes", "all", F.col("n"), F.lit(0), F.col("n") == 0))


def identical_neighbours(units: DataFrame, allowed: DataFrame | None = None, longer: int = 60, by: str = "slug") -> DataFrame:
    """(by, num, next): units whose text equals that of the next number, unless the pair (a, b) is allowed."""
    forms = units.select(by, "num", T.gate_form(F.col("text")).alias("form"))
    after = forms.select(by, (F.col("num") - 1).alias("num"), F.col("form").alias("next_form"))
    pairs = forms.join(after, [by, "num"]).where((F.length("form") > longer) & (F.col("form") == F.col("next_form"))).select(by, "num", (F.col("num") + 1).alias("next"))
    if allowed is None:
        return pairs
    return pairs.join(allowed.select(F.col("a").alias("num"), F.col("b").alias("next")), ["num", "next"], "left_anti").select(by, "num", "next")


def keys_in_range(mapped: DataFrame, units: DataFrame) -> DataFrame:
    """(slug, key) of map keys beyond the book's greatest number; slugs that aren't among the books are left out."""
    most = units.groupBy("slug").agg(F.max("num").alias("max_num"))
    return mapped.join(most, "slug").where(F.col("key") > F.col("max_num")).select("slug", "key")


def map_keys(encyclopedia: DataFrame) -> DataFrame:
    """(slug, key) of a map column {slug: {number: ...}}."""
    inner = encyclopedia.select(F.explode("map").alias("slug", "inner"))
    return inner.select("slug", F.explode(F.map_keys("inner")).alias("key")).select("slug", F.col("key").cast("int").alias("key"))


def spot_case(units: DataFrame, slug: str, num: int, must_have: list[str], differs_from: int) -> DataFrame:
    """A regression pin: a unit holds the given words and differs from another unit."""
    form = lambda n: F.max(F.when(F.col("num") == n, T.gate_form(F.col("text"))))
    at = units.where(F.col("slug") == slug).agg(form(num).alias("a"), form(differs_from).alias("b"))
    has = reduce(lambda x, y: x & y, [F.col("a").contains(w) for w in must_have], F.col("a") != F.col("b"))
    return at.select(*_row("spot_case", slug, F.lit(num), F.lit(num), F.coalesce(has, F.lit(False))))


def contained_in_own(entries: DataFrame, units: DataFrame) -> DataFrame:
    """(num) of entries one of whose `fragments` is a substring of the unit of the same number; units (num, form)."""
    met = entries.select("num", "fragments").join(units.select("num", "form"), "num")
    return met.where(F.exists("fragments", lambda f: F.contains(F.col("form"), f))).select("num").distinct()


def _grid(least: int) -> tuple[int, int]:
    """Characters of a piece, and how far apart a text's pieces stand so that whatever shares `least` characters with it shares one."""
    piece = max(1, min(least, max(12, least // 2)))
    return piece, least - piece + 1


def grid_pieces(form: Column, least: int = 18) -> Column:
    """Hashes of a text's pieces on a grid: any `least` characters of it hold one of them whole."""
    piece, apart = _grid(least)
    return F.transform(F.regexp_extract_all(form, F.lit(f"(?s)(?=(.{{{piece}}})).{{1,{apart}}}"), 1), lambda p: F.xxhash64(p))


def first_pieces(fragment: Column, least: int = 18) -> Column:
    """Hashes of a fragment's pieces from each of its first characters; wherever it stands, one of them is on the grid."""
    piece, apart = _grid(least)
    return F.transform(F.sequence(F.lit(1), F.lit(apart)), lambda i: F.xxhash64(F.substr(fragment, i, F.lit(piece))))


def contained_elsewhere(fragments: DataFrame, units: DataFrame, key: str = "num", least: int = 18) -> DataFrame:
    """(key, fragment, other): fragments (key, fragment) that are a substring of a unit (key, form) with another key.

    Fragments have at least `least` characters; shorter ones aren't looked for. Units are sampled on a grid so fine that each fragment in them
    shares a piece, by which the two meet; only pieces that some fragment has are moved. What meets is verified, and a unit's
    text is moved once for each key that may have a fragment in it.
    """
    asked = fragments.select(F.col(key).alias("__k"), "fragment").where(F.length("fragment") >= least).distinct()
    asked = cut(asked.select("__k", "fragment", F.explode(F.array_distinct(first_pieces(F.col("fragment"), least))).alias("piece")))
    wanted = small(cut(asked.select("piece").distinct()))
    long = units.where(F.length("form") >= least).select(F.col(key).alias("other"), "form")
    held = one_each(long, ["other"], grid_pieces(F.col("form"), least), "piece").join(wanted, "piece", "left_semi").distinct()
    met = asked.join(held, "piece").where(F.col("__k") != F.col("other"))
    met = cut(met.groupBy("__k", "other").agg(F.collect_set("fragment").alias("fragments")))
    few = long.join(small(cut(met.select("other").distinct())), "other", "left_semi")
    found = met.join(few, "other").select("__k", "other", F.explode(F.filter("fragments", lambda f: F.contains(F.col("form"), f))).alias("fragment"))
    return found.select(F.col("__k").alias(key), "fragment", "other").distinct()


def pairing(entries: DataFrame, units: DataFrame, least_rate: float = 0.85, most_wrong: float = 0.05) -> DataFrame:
    """Whether entries quote the unit that they belong to: one row (verified, wrong, undecided, rate, ok).

    entries (num, sharh; a number may occur more than once), units (num, text). An entry is verified by its own unit, wrong if a fragment that doesn't
    open like a narration is in another unit only, else undecided. Without anything to compare the rate holds. No unit's text is moved.
    """
    quoted = cut(entries.select("num", F.xxhash64("num", "sharh").alias("entry"), T.fragments(F.col("sharh")).alias("fragments")))
    each = quoted.select("num", "entry", F.explode("fragments").alias("fragment"))
    held = scan.held(each, units.select("num", T.gate_form(F.col("text")).alias("form")))
    own = cut(each.join(held, ["num", "fragment"], "left_semi").select("entry").distinct().withColumn("verified", F.lit(True)))
    rest = each.join(own, "entry", "left_anti").where(~F.col("fragment").rlike(P.NARRATION_FRAGMENT))
    # another unit has a fragment if the least or the greatest number of those that have it is another
    ends = held.groupBy("fragment").agg(F.min("num").alias("least"), F.max("num").alias("most"))
    elsewhere = rest.join(ends, "fragment").where((F.col("least") != F.col("num")) | (F.col("most") != F.col("num")))
    wrong = elsewhere.select("entry").distinct().withColumn("wrong", F.lit(True))
    judged = quoted.join(own, "entry", "left").join(wrong, "entry", "left")
    counts = judged.agg(F.count_if("verified").alias("verified"), F.count_if("wrong").alias("wrong"), F.count("*").alias("n"))
    total = F.col("verified") + F.col("wrong")
    rate = F.when(total > 0, F.col("verified") / total).otherwise(1.0)
    return counts.select("verified", "wrong", (F.col("n") - total).alias("undecided"), rate.alias("rate"), ((rate >= least_rate) & (F.col("wrong") <= most_wrong * F.col("n"))).alias("ok"))


def overall(checks: DataFrame) -> DataFrame:
    """One row: how many checks there are, how many failed, and whether none did."""
    return checks.agg(F.count("*").alias("n_checks"), F.count_if(~F.col("ok")).alias("n_failed"), F.coalesce(F.bool_and("ok"), F.lit(True)).alias("ok"))
