import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import gate, scan
from tessera.storage import cut


@pytest.mark.parametrize(("slice_", "positions"), [(1_000_000, 1 << 18), (3, 64)])
def test_fragments_are_found_as_by_brute_force(spark, monkeypatch, slice_, positions):
    monkeypatch.setattr(scan, "SLICE", slice_)
    monkeypatch.setattr(scan, "POSITIONS", positions)
    dice = random.Random(5)
    text = lambda n: "".join(dice.choice("ab é\U0001F600ن") for _ in range(n))
    texts = [text(n) for n in (0, 17, 18, 40, 300, 300, 700)] + ["x" * 90, "ab" * 40, None]
    units = [(i, t) for i, t in enumerate(texts)] + [(4, texts[6]), (None, texts[5])]
    parts = [t[a : a + n] for t in texts if t for a in (0, 5, len(t) // 2, max(0, len(t) - 20)) for n in (18, 20, 33, 150)]
    parts = sorted({p for p in parts if len(p) >= 18} | {texts[4][-10:] + texts[5][:10], "x" * 91, "y" * 30, texts[3] + "é"})
    forms, asked = spark.createDataFrame(units, "num bigint, form string").repartition(2), spark.createDataFrame([(p,) for p in parts * 2], "fragment string")
    got = {tuple(r) for r in scan.held(asked, forms).collect()}
    assert got == {(i, p) for i, t in units for p in parts if i is not None and t is not None and p in t}
    assert scan.held(asked.limit(0), forms).isEmpty() and scan.held(asked, forms.limit(0)).isEmpty()


def test_pairing_moves_no_text(spark):
    """All that is shuffled is far less than the units' texts."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def written():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
        return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteBytes() for i in range(stages.size())}

    dice = random.Random(6)
    texts = ["".join(dice.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(4_000)) for _ in range(200)]
    units = cut(spark.createDataFrame(list(enumerate(texts)), "num bigint, text string"))
    quotes = [(i, f"قوله ({texts[(i + (i % 4 == 1)) % 200][50:110]})" if i % 4 < 2 else f"قوله ({'حدثنا ' + texts[0][:30]})") for i in range(200)]
    before = written()
    got = gate.pairing(spark.createDataFrame(quotes, "num bigint, sharh string"), units).first()
    assert (got.verified, got.wrong, got.undecided) == (50, 50, 100)
    assert sum(n for i, n in written().items() if i not in before) < sum(map(len, texts)) / 4
    # a fragment counts as another unit's only if that has another number
    twice = units.where("num = 3").unionByName(units.where("num = 3"))
    entries = spark.createDataFrame([(3, f"قوله ({texts[3][50:110]})"), (4, f"قوله ({texts[3][50:110]})"), (None, f"قوله ({texts[3][50:110]})")], "num bigint, sharh string")
    assert tuple(gate.pairing(entries.withColumn("num", F.col("num")), twice).first())[:3] == (1, 1, 1)
