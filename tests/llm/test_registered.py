"""The registered queries over whole tables: against their SQL, or against brute force where SQL has no such thing."""

import hashlib
import os
import zlib
from collections import defaultdict

import duckdb
import public_tokenizers as vocab
import pytest
import tiktoken
from test_exact_and_mixing import SPACE
from test_near_and_repeats import brute_components, brute_repeats
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm.jaccard_join import jaccard_components, keep_one_per_component
from tessera.llm.language_id import identify, keep_identified
from tessera.llm.mixing import take_mix
from tessera.llm.queries import ORACLES, QUERIES, _mix_sql


def plain(rows):
    return sorted(str([int(x) if isinstance(x, float) and x.is_integer() else x for x in r]) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in os.listdir(sf_dir):
        con.sql(f"create view {table.split('.')[0]} as select * from read_parquet('{sf_dir}/{table}')")
    got, want = QUERIES[name](spark, sf_dir), con.sql(ORACLES[name])
    columns = sorted(want.columns)
    assert set(columns) <= set(got.columns)
    assert plain(map(tuple, got.select(*columns).collect())) == plain(want.project(", ".join(f'"{c}"' for c in columns)).fetchall())


def test_repeats_query(spark, sf_dir, documents):
    want = [eval(x) for x in brute_repeats([(r.doc_id, r.text) for r in documents.collect()], 400)]
    want = {(i, n, gone, len(lows), hashlib.sha256(kept).hexdigest()) for i, n, gone, lows, _, kept in want}
    assert {tuple(r) for r in QUERIES["op4_repeat_removal"](spark, sf_dir).collect()} == want


def _tiktoken():
    path = vocab.path("byte_bpe_multi_50k.tiktoken")
    from tessera.llm.bpe import read_ranks

    return tiktoken.Encoding("test", pat_str=vocab.PATTERN, mergeable_ranks={p: i for i, p in enumerate(read_ranks(path))}, special_tokens={})


def _encoded(doc_id, text, model):
    ids = model.encode_ordinary(text or "")
    return doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_codec_query(spark, sf_dir, documents):
    model = _tiktoken()
    assert sorted(tuple(r) for r in QUERIES["op5_bpe_codec"](spark, sf_dir).collect()) == sorted(_encoded(r.doc_id, r.text, model) for r in documents.collect())


def test_planes_query(spark, sf_dir, documents):
    library, at, want = Tokenizer.from_file(vocab.path("byte_bpe_50k.json")), 0, []
    for r in sorted(documents.collect(), key=lambda r: r.doc_id):
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [2]
        want.append((r.doc_id, at, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        at += len(ids)
    assert sorted(tuple(r) for r in QUERIES["op8_token_planes"](spark, sf_dir).collect()) == want


def test_language_query(spark, sf_dir, documents):
    lang = {r.doc_id: r.lang for r in documents.collect()}
    rows = QUERIES["op1_language_id"](spark, sf_dir).collect()
    assert len(rows) == len(lang) and sum(r.lang_pred == lang[r.doc_id] for r in rows if r.held_out) >= 0.95 * sum(r.held_out for r in rows)


def test_marks_are_no_letters(spark):
    docs = spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, "́́ 12", None), (4, "́e", None)], "doc_id bigint, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify(docs).collect()}
    assert got[3] == ("und", 0.0) and got[4][0] != "und"


def test_long_words_that_polynomial_hashes_confuse(spark):
    """Two Thue-Morse words of 1 024 letters collide under every polynomial hash modulo 2 ** 64 with an odd base."""
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    docs = spark.createDataFrame([(1, a), (2, b), (3, a.upper())], "doc_id bigint, text string")
    assert {r.doc_id: r.component for r in jaccard_components(docs, 3, 90).collect()} == {1: 1, 2: 2, 3: 1}


def test_rows_of_one_id_are_judged_by_their_texts(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base), (2, base + " x"), (2, "quite another text of the same id, kept as it is"), (None, base + " y"), (1, base), (5, None), (6, "")]
    kept = keep_one_per_component(spark.createDataFrame(rows, "doc_id bigint, text string"), 5, 80)
    assert sorted(map(str, kept.collect())) == sorted(map(str, spark.createDataFrame([rows[0], rows[2], rows[5], rows[6]], "doc_id bigint, text string").collect()))


def test_stages_on_empty_tables(spark, nothing):
    for stage in (keep_identified, keep_one_per_component, take_mix):
        left = stage(nothing)
        assert left.columns == nothing.columns and left.count() == 0


def test_mix_of_odd_rows(odd):
    mixed = take_mix(odd)
    assert mixed.columns == odd.columns and {str(r) for r in mixed.collect()} <= {str(r) for r in odd.collect()}


def test_pipeline_equals_its_stages_by_brute_force(spark, sf_dir, documents):
    judged = {r.doc_id: r for r in identify(documents).collect()}
    rows = [r for r in documents.collect() if judged[r.doc_id].lang_pred != "und" and judged[r.doc_id].score >= 0.4]
    least = {}
    for r in rows:
        key = SPACE.sub(" ", r.text or "")
        least[key] = min(least.get(key, r.doc_id), r.doc_id)
    rows = [r for r in rows if least[SPACE.sub(" ", r.text or "")] == r.doc_id]
    kept = {i for i, _, c in map(eval, brute_components([(r.doc_id, r.text) for r in rows], 5, 80)) if i == c}
    rows = [r for r in rows if r.doc_id in kept]
    con = duckdb.connect()
    con.register("documents", __import__("pandas").DataFrame([(r.doc_id, r.text, r.source) for r in rows], columns=["doc_id", "text", "source"]))
    taken = {x["doc_id"]: x["taken"] // x["size"] for x in con.sql(_mix_sql()).df().to_dict("records")}
    model = _tiktoken()
    want = sorted(_encoded(r.doc_id, r.text, model) for r in rows for _ in range(int(taken[r.doc_id])))
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, sf_dir).collect()) == want
    assert defaultdict(int, taken) and len(want) > 100
