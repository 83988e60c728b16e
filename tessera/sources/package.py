"""The package sink: one JSON document per source with its entries in the order of their numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRIES = "array<struct<num:int,sharh:string>>"


def package(entries: DataFrame, source: str = "source") -> DataFrame:
    """(source, num, sharh) to (source, entries); a number may occur more than once."""
    return entries.groupBy(source).agg(F.sort_array(F.collect_list(F.struct("num", "sharh"))).alias("entries"))


def write_documents(entries: DataFrame, path: str, source: str = "source") -> None:
    """Write a JSON document a source, {"source": ..., "entries": [...]}, an entry a line, in the order of numbers and texts.

    A document of any length is the lines of the files of its folder, <path>/source=<name>, in the order of their names: entries are dealt out by
    ranges, so no task holds a source, and all files are committed at once.
    """
    rows = entries.select(F.col(source).alias("source"), F.struct("num", "sharh").alias("e"), F.monotonically_increasing_id().alias("__row"))
    # equal entries are told apart, so that one of them is the first and one the last
    ends = rows.groupBy(F.col("source").alias("__of")).agg(F.min(F.struct("e", "__row")).alias("__first"), F.max(F.struct("e", "__row")).alias("__last"))
    here = F.struct("e", "__row")
    opening = F.when(here.eqNullSafe(F.col("__first")), F.concat(F.lit('{"source":'), F.coalesce(F.regexp_extract(F.to_json(F.struct("source")), '^.{10}(.*).$', 1), F.lit("null")), F.lit(',"entries":['))).otherwise("")
    closing = F.when(here.eqNullSafe(F.col("__last")), "]}").otherwise(",")
    lines = rows.join(ends, F.col("source").eqNullSafe(F.col("__of"))).select("source", "e", "__row", F.concat(opening, F.to_json("e"), closing).alias("value"))
    dealt = lines.repartitionByRange("source", "e", "__row").sortWithinPartitions("source", "e", "__row")
    dealt.select("source", "value").write.partitionBy("source").mode("overwrite").text(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(source, num, sharh) of the documents under a path, line by line."""
    lines = spark.read.option("basePath", path).schema("value string, source string").text(path)
    entry = F.regexp_replace(F.regexp_replace("value", r'^\{"source":(?:null|"(?:[^"\\]|\\.)*"),"entries":\[', ""), r"(?:,|\]\})$", "")
    return lines.select("source", F.from_json(entry, "num int, sharh string").alias("e")).select("source", "e.num", "e.sharh")


def write_packages(packages: DataFrame, path: str, compression: str = "gzip", mode: str = "overwrite") -> None:
    packages.write.mode(mode).option("compression", compression).json(path)


def read_packages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"source string, entries {ENTRIES}").json(path)


def coverage(entries: DataFrame, source: str = "source") -> DataFrame:
    """Entries and characters of each source."""
    return entries.groupBy(source).agg(F.count("*").alias("n_entries"), F.sum(F.length("sharh")).alias("n_chars"))
