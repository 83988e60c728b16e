"""JSON documents that are written line by line."""

import json

from pyspark.sql import functions as F

from tessera.sources import package


def test_a_source_is_one_document_over_several_files(spark, tmp_path):
    rows = [("big", i % 700, f'text "{i}" \\ \n line, ]}} {{') for i in range(2_000)] + [("one", 5, "only"), ('odd "name"', 1, ",")] + [("same", 3, "twice")] * 2 + [("bare", None, None)]
    path = f"{tmp_path}/documents"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        package.write_documents(spark.createDataFrame(rows, "source string, num int, sharh string").repartition(3), f"file://{path}")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found, files = {}, {}
    for folder in (tmp_path / "documents").glob("source=*"):
        parts = sorted(folder.glob("part-*"))
        held = json.loads("".join(p.read_text() for p in parts))
        found[held["source"]], files[held["source"]] = [(e.get("num"), e.get("sharh")) for e in held["entries"]], len(parts)
    assert set(found) == {r[0] for r in rows} and files["big"] > 1
    for source, entries in found.items():
        assert entries == sorted(((n, t) for s, n, t in rows if s == source), key=lambda e: (e[0] is not None, e[0], e[1]))
    read = package.read_documents(spark, f"file://{path}")
    assert sorted(map(str, read.select(F.col("source"), "num", "sharh").collect())) == sorted(map(str, spark.createDataFrame(rows, "source string, num int, sharh string").collect()))
