import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tessera.llm.exact_dedup import LsmIndex, drop_exact_copies, exact_groups
from tessera.llm.mixing import mix_sources, source_targets, take_mix

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def brute_groups(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[SPACE.sub(" ", t or "")].append(i)
    out = []
    for i, t in rows:
        ids = groups[SPACE.sub(" ", t or "")]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(SPACE.sub(" ", t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex()) for r in df.collect()), key=str)


def test_groups_equal_brute_force(odd, documents):
    for docs in (odd, documents):
        assert got(exact_groups(docs)) == brute_groups([(r.doc_id, r.text) for r in docs.collect()])


def test_collisions_are_split_by_bytes(odd):
    weak = lambda t: F.unhex(F.hex(F.pmod(F.crc32(t), F.lit(3)).cast("int").cast("string")))
    strong = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_groups(odd).collect()}
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_groups(odd, digest=weak, memtable_rows=2).collect()} == strong


def test_index_is_incremental(spark, tmp_path):
    index = LsmIndex(spark, f"file://{tmp_path}/index", memtable_rows=2)
    for batch in ([(b"b", 5), (b"a", 3), (b"a", None)], [(b"a", 2), (b"c", 9)]):
        index.add(spark.createDataFrame([(bytearray(d), i) for d, i in batch], "digest binary, id bigint"))
        index.compact()
    assert sorted((bytes(r.digest), r.id, r.n) for r in index.entries().collect()) == [(b"a", 2, 3), (b"b", 5, 1), (b"c", 9, 1)]
    assert [(r.id, r.n) for r in index.probe([b"a"]).collect()] == [(2, 3)]


def test_stage_keeps_one_row_with_all_columns(odd, nothing):
    left = drop_exact_copies(odd)
    assert left.columns == odd.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted({(r[0], t) for r in brute_groups([(x.doc_id, x.text) for x in odd.collect()]) if r[3] for t in {x.text for x in odd.collect() if x.doc_id == r[0] and hashlib.sha256(SPACE.sub(" ", x.text or "").encode()).hexdigest() == r[4]}}, key=str)
    assert drop_exact_copies(nothing).count() == 0 and exact_groups(nothing).count() == 0


def test_targets_are_shared_until_none_is_above(spark):
    sizes = {"a": 10, "b": 100, "c": 1000, None: 5}
    rows = source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")).collect()
    total, weights = sum(sizes.values()), {"a": 1, "b": 2, "c": 3, None: 1}
    target, capped = {}, set()
    while True:
        free = {s for s in sizes if s not in capped}
        left = total - sum(3 * sizes[s] for s in capped)
        target = {s: 3 * sizes[s] if s in capped else left * weights[s] / sum(weights[x] for x in free) for s in sizes}
        above = {s for s in free if target[s] > 3 * sizes[s]}
        if not above:
            break
        capped |= above
    for r in rows:
        assert abs(r.target - target[r.source]) < 1e-6


def test_mix_comes_near_its_targets_and_repeats(documents, odd, nothing):
    for docs in (documents, odd):
        rows = mix_sources(docs, bucket_rows=7).collect()
        again = mix_sources(docs.repartition(5), bucket_rows=7).collect()
        assert sorted(map(str, rows)) == sorted(map(str, again)) and len(rows) == docs.count()
        taken, largest = defaultdict(int), defaultdict(int)
        for r in rows:
            assert r.taken == r.size * r.copies and 0 <= r.copies <= 3
            taken[r.source] += r.taken
            largest[r.source] = max(largest[r.source], r.size)
        for r in rows:
            assert abs(taken[r.source] - r.target) <= largest[r.source]
    assert mix_sources(nothing).count() == 0


def test_stage_repeats_rows(documents):
    want = sum(r.copies for r in mix_sources(documents).collect())
    mixed = take_mix(documents)
    assert mixed.columns == documents.columns and mixed.count() == want
