"""Pages that arrive one after the other, as a Structured Streaming job over a folder of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.pages import page_paragraphs, raw_paragraphs
from ..profiles import PageProfile
from ..sources.pages import lenient_utf8, response_status


def page_stream(spark: SparkSession, root: str) -> DataFrame:
    """(book_id, page, html) of <root>/<book_id>/<page>.html as they appear."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.html").load(root)
    number = lambda g: F.regexp_extract("path", r"/(\d+)/(\d+)\.html$", g).cast("int")
    return files.select(number(1).alias("book_id"), number(2).alias("page"), lenient_utf8(F.col("content")).alias("html"))


def append_paragraphs(pages: DataFrame, profile: PageProfile, target: str, checkpoint: str) -> StreamingQuery:
    """Append the paragraphs of new pages to a Parquet table, each batch once, and stop when there are no more files."""

    def write(batch: DataFrame, number: int) -> None:
        kept = batch.where(response_status(F.col("html")) == "ok")
        page_paragraphs(kept, profile, ["book_id", "page"]).withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(target)

    return pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def paragraph_counts(pages: DataFrame, profile: PageProfile) -> DataFrame:
    """Paragraphs and pages per book so far, as a streaming aggregate."""
    return pages.select("book_id", F.size(raw_paragraphs(F.col("html"), profile)).alias("n")).groupBy("book_id").agg(F.sum("n").alias("n_paragraphs"), F.count("*").alias("n_pages"))
