import base64
import zlib

import numpy as np
import public_tokenizers as vocab
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm.bpe import Encoder, encode_documents, token_digests
from tessera.llm.token_store import JsonTokenizer, chunk_index, from_planes, read_tokens, to_planes, write_tokens

RANKS = vocab.path("byte_bpe_multi_50k.tiktoken")
JSON = vocab.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    return Encoder(RANKS, vocab.PATTERN)


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=vocab.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=80))
def test_any_text_is_encoded_alike_and_comes_back(encoder, reference, text):
    ids = encoder.encode(text)
    assert ids == reference.encode_ordinary(text)
    assert encoder.decode(ids) == text.encode()


def test_documents(encoder, reference, documents, odd, nothing):
    for docs in (documents, odd):
        want = sorted(str((r.doc_id, reference.encode_ordinary(r.text or ""), (r.text or "").encode())) for r in docs.collect())
        assert sorted(str((r.doc_id, list(r.ids), bytes(r.decoded))) for r in encode_documents(docs, RANKS, vocab.PATTERN).collect()) == want
    assert token_digests(nothing, RANKS, vocab.PATTERN).count() == 0


@settings(max_examples=60, deadline=None)
@given(ids=st.lists(st.integers(0, 2**32 - 1), max_size=70), unit=st.sampled_from(["bit", "byte"]))
def test_planes_round_trip(ids, unit):
    block = np.array(ids, "<u4")
    assert from_planes(to_planes(block, unit), len(block), unit).tolist() == ids


@settings(max_examples=100, deadline=None)
@given(text=st.text(max_size=60))
def test_json_tokenizer_equals_library(text):
    ids = np.frombuffer(_json().encode(text), "<u4").tolist()
    assert ids == _json().tokenizer.encode(text, add_special_tokens=False).ids


def _json(held=[]):  # noqa: B006
    if not held:
        held.append(JsonTokenizer(JSON))
    return held[0]


@pytest.mark.parametrize("unit", ["bit", "byte"])
def test_store(spark, odd, nothing, tmp_path, unit):
    path = f"file://{tmp_path}/{unit}"
    write_tokens(odd, path, JSON, end_id=2, shards=3, block_ids=64, unit=unit)
    library = Tokenizer.from_file(JSON)
    rows = [(r.doc_id, np.array(library.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()) for r in odd.collect()]
    read = read_tokens(spark, path, unit).collect()
    assert sorted((str(r.doc_id), bytes(r.ids)) for r in read) == sorted((str(i), b) for i, b in rows)
    ordered = sorted(read, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted((r.doc_id for r in read), key=lambda i: (i is not None, i))
    at = 0
    for r in ordered:
        assert r.start == at and r.n_ids == len(r.ids) // 4
        at += r.n_ids
    assert chunk_index(spark, path).agg({"n_ids": "sum"}).first()[0] == at
    by_library = dict(zip((r.start for r in ordered), (zlib.crc32(b) for _, b in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))), strict=True))
    assert {r.start: r.crc for r in read_tokens(spark, path, unit).selectExpr("start", "crc32(ids) crc").collect()} == by_library
    write_tokens(nothing, f"{path}-none", JSON, end_id=2)
    assert read_tokens(spark, f"{path}-none").count() == 0


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=" \n\t\u00a0\u2003\u001fa1'.s\u4e2d", max_size=40))
def test_white_space_of_any_kind_is_cut_as_the_library_does(text):
    ids = np.frombuffer(_json().encode(text), "<u4").tolist()
    assert ids == _json().tokenizer.encode(text, add_special_tokens=False).ids


def test_long_pretokens_keep_others_remembered():
    tokenizer, merged = JsonTokenizer(JSON), []
    merge = tokenizer._merge
    tokenizer._merge = tokenizer.cache.merge = lambda pretoken: merged.append(pretoken) or merge(pretoken)
    text = "one two three " + "x" * 200
    for _ in range(3):
        assert np.frombuffer(tokenizer.encode(text), "<u4").tolist() == tokenizer.tokenizer.encode(text, add_special_tokens=False).ids
    assert merged.count(" two") == 1
