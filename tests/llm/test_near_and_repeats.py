import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import common, jaccard_join
from tessera.llm.jaccard_join import jaccard_components, keep_one_per_component
from tessera.llm.repeats import intervals, maximal_repeats, remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def brute_components(rows, n, percent):
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        least[r] = doc if least.get(r) is None else least[r] if doc is None else min(doc, least[r])
    return sorted(str((rows[i][0], len(sets[i]), least[find(i)])) for i in range(len(rows)))


def got(df):
    return sorted(str((r.doc_id, r["size"], r.component)) for r in df.collect())


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_components_equal_brute_force(documents, odd, nothing, n, percent):
    for docs in (documents, odd):
        assert got(jaccard_components(docs, n, percent)) == brute_components([(r.doc_id, r.text) for r in docs.collect()], n, percent)
    assert jaccard_components(nothing, n, percent).count() == 0


def test_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SHARE", 4)
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(60):
        words = list(base)
        for at in rng.choice(120, 3, replace=False):
            words[at] = f"x{k}_{at}"
        rows.append((k, " ".join(words)))
    assert got(jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 90)) == brute_components(rows, 3, 90)


@pytest.mark.parametrize("least", [0, 200_000])
def test_components_of_chains_and_stars(spark, monkeypatch, least):
    monkeypatch.setattr(common, "ONE_TASK_EDGES", least)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(200, 230)] + [(300, 300), (None, 5), (401, 400), (402, 401)]
    found = {r.id: r.component for r in common.components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(7)).collect()}
    assert found == {**dict.fromkeys(range(100, 161), 100), **dict.fromkeys([7, *range(200, 230)], 7), **dict.fromkeys([400, 401, 402], 400)}
    assert common.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_stage_keeps_the_smallest(documents, odd):
    kept = {r.doc_id for r in keep_one_per_component(documents).collect()}
    assert kept == {int(x.split(",")[0][1:]) for x in brute_components([(r.doc_id, r.text) for r in documents.collect()], 5, 80) if x.split(",")[0][1:] == x.rstrip(")").split(", ")[2]}
    assert keep_one_per_component(odd).columns == odd.columns


def brute_repeats(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(b[s : s + length] for _, b in texts for s in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        mask = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if counts[b[s : s + length]] > 1:
                mask[s : s + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(int), [0]))))
        out.append(str((i, len(b), int(mask.sum()), edges[::2].tolist(), edges[1::2].tolist(), bytes(np.frombuffer(b, np.uint8)[~mask]))))
    return sorted(out)


def spans(df):
    return sorted(str((r.doc_id, r.n_bytes, r.n_removed, list(r.lows), list(r.highs), bytes(r.kept))) for r in df.collect())


def test_removal_equals_brute_force(documents, odd, nothing):
    odd = odd.where("text is null or length(text) < 20000")
    for docs in (documents, odd):
        assert spans(remove_repeats(docs)) == brute_repeats([(r.doc_id, r.text) for r in docs.collect()], 400)
    assert remove_repeats(nothing).count() == 0


@pytest.mark.parametrize("crowd", [1, 4096])
def test_short_windows_over_periodic_texts(spark, crowd):
    rng = np.random.default_rng(1)
    rows = [(k, "".join(rng.choice(list("ab"), 60)) + "abcabcabc" * (k % 4) + "z" * (k % 3 * 20)) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert spans(remove_repeats(docs, length=20, gram=8, group_contents=crowd)) == brute_repeats(rows, 20)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=2, max_size=12))
def test_interval_tree(common):
    common[0] = 0
    want = {(d, a, b) for a in range(len(common)) for b in range(a + 1, len(common)) for d in [min(common[a + 1 : b + 1])] if d >= 2 and (a == 0 or common[a] < d) and (b + 1 == len(common) or common[b + 1] < d)}
    assert set(intervals(np.array(common), 2)) == want


def test_maximal_repeats_list_all_occurrences():
    found = list(maximal_repeats([b"xyABCDEF", b"zyABCDEF", b"qqABCDEF"], [2, 2, 2], length=6, gram=4))
    assert sorted((size, column, sorted(rows)) for size, column, rows in found) == [(6, 0, [0, 1, 2]), (7, -1, [0, 1])]


def test_texts_of_thue_morse_kind_stay(spark):
    """A polynomial over single bytes is the same for both texts of a pair, and their stretches are anchored at the gram in the middle."""
    half = lambda x, y: "".join(y if i.bit_count() & 1 else x for i in range(256))
    rows = []
    for seed in (1150, 2150, 2847):
        gram = "".join(np.random.default_rng(seed).choice(list("abcdefgh"), 128))
        rows += [(2 * seed, "x" * 16 + half("-", "Y") + gram + half("Y", "-") + "x" * 16), (2 * seed + 1, "x" * 16 + half("Y", "-") + gram + half("-", "Y") + "x" * 16)]
    assert spans(remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"))) == brute_repeats(rows, 400)


def test_postings_are_packed_by_ranges(spark, documents):
    """A task sends its postings as a row per range of signatures, not as a row each."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def stages():
        found = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None).iterator()
        while found.hasNext():
            stage = found.next()
            yield stage.stageId(), stage.shuffleWriteRecords()

    before = dict(stages())
    assert jaccard_components(documents, 5, 80).count() == documents.count()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    assert max(n for i, n in stages() if i not in before) <= 8 * documents.count()


def test_packed_postings_meet_as_the_signatures_do():
    rng = np.random.default_rng(5)
    sigs = [rng.integers(0, 2**64, 40, dtype=np.uint64) for _ in range(60)]
    for i in range(0, 60, 7):
        sigs[i][:9] = sigs[3][:9]
    units, met, links = {1 << 16: sigs[:30], 2 << 16: sigs[30:]}, set(), set()
    buckets = {}
    for unit, own in units.items():
        for bucket, *rest in jaccard_join._packed(own, 11):
            if bucket < 0:
                links |= {(unit | int(a), unit | int(b)) for a, b in zip(*(np.frombuffer(x, "<u2") for x in rest), strict=True)}
            else:
                buckets.setdefault(bucket, []).append((unit, *rest))
    for rows in buckets.values():
        met |= set(zip(*(side.tolist() for side in jaccard_join._met(rows)), strict=True))
    node = lambda i: (1 + i // 30) << 16 | i % 30
    like = sorted({3, *range(0, 60, 7)})
    assert {x for pair in met | links for x in pair} == {node(i) for i in like}
    heads = {node(min(i for i in like if i < 30)), node(min(i for i in like if i >= 30))}
    assert {b for _, b in met | links} <= heads and len(met) == 1


def test_texts_that_nothing_names_are_not_moved(spark, monkeypatch):
    """Beyond what may be broadcast, only the texts of named documents are shuffled, and the result stays the same."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def written(work):
        """The result, and the records that each of its stages shuffled."""
        def stages():
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
            found = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
            return {found.apply(i).stageId(): found.apply(i).shuffleWriteRecords() for i in range(found.size())}

        before = stages()
        return work(), max([n for i, n in stages().items() if i not in before], default=0)

    text = lambda i: " ".join(f"word{i}x{k}" for k in range(30))
    docs = spark.createDataFrame([(i, text(i)) for i in range(400)] + [(400, text(7) + " end"), (401, text(9) + " end"), (None, text(11) + " end"), (403, None), (404, text(7) + " end")], "doc_id bigint, text string").repartition(3)
    docs = common.cut(docs)
    expected = sorted(map(str, keep_one_per_component(docs).collect()))
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(jaccard_join, "GONE_ROWS", 0)
    left = keep_one_per_component(docs)
    kept, moved = written(left.collect)
    assert sorted(map(str, kept)) == expected and len(kept) == 401 and moved < 50
    classes = spark.createDataFrame([(1, bytearray(b"k"), 7)], "id bigint, key binary, first_id bigint")
    calls = spark.createDataFrame([(1, 5)], "id bigint, call int")
    wanted, moved = written(jaccard_join._wanted(docs, classes, calls).collect)
    assert [r.text for r in wanted] == [text(7)] and moved < 50
