import random

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import spans
from tessera.plans import books

UNITS = "book_id int, chapter_id bigint, unit_ix bigint, num int, text string"


def test_anchors_are_those_of_the_joined_search(spark, monkeypatch):
    monkeypatch.setattr(spans, "STRETCH", 4)
    dice = random.Random(7)
    text = lambda b, i: " ".join([f"common{dice.randrange(12)}" for _ in range(14)] + [f"word{dice.randrange(60)}" for _ in range(14)] + [f"rare{b}x{i + dice.randrange(3)}y{k}" for k in range(dice.randrange(4))])
    texts = {(b, i): text(b, i) for b in (1, 2) for i in range(70)}
    pages = [(b, i, t if dice.random() < 0.7 else texts[b, dice.randrange(70)]) for (b, i), t in texts.items()] + [(1, 70, None)]
    units = [(b, 1 + i // 30, i, i + 1, t) for (b, i), t in texts.items()] + [(1, 1, 90, 91, ""), (1, 1, 91, 92, None), (2, 2, 90, 91, "no such words anywhere")]
    ranges = spark.createDataFrame([(1, 1, 0, 40), (1, 2, 20, 70), (2, 1, 5, 5), (2, 2, 0, 69)], "book_id int, chapter_id bigint, start bigint, end bigint")
    pages = spark.createDataFrame(pages, "book_id int, page_ix bigint, text string").select("book_id", "page_ix", T.content_words(F.col("text")).alias("words"))
    units = spark.createDataFrame(units, UNITS)
    expected = sorted(map(tuple, books.unit_anchors(pages, units.join(ranges, ["book_id", "chapter_id"])).collect()))
    assert sorted(map(tuple, books.chapter_anchors(pages, units, ranges).collect())) == expected and len(expected) > 30


def test_units_and_pages_are_not_paired(spark):
    """All units' openings are on all pages of their chapter, and still no step has a row for each pair."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def written():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
        return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteRecords() for i in range(stages.size())}

    n = 300
    text = lambda i: " ".join([f"common{k}" for k in range(22)] + [f"unit{i}x{k}" for k in range(22)])
    pages = spark.createDataFrame([(1, 0, "كتاب الايمان"), *[(1, 1 + i, text(i)) for i in range(n)]], "book_id int, page_ix bigint, text string")
    units = spark.createDataFrame([(1, 1, i, i + 1, text(i)) for i in range(n)], UNITS)
    chapters = spark.createDataFrame([(1, 1, "كتاب الإيمان")], "book_id int, chapter_id int, title string")
    before = written()
    assert {r.num for r in books.chapter_book(pages, units, chapters).collect()} == set(range(1, n + 1))
    assert max(records for i, records in written().items() if i not in before) < n * n / 4
