import hashlib
import re
from collections import Counter
from itertools import permutations

import public_tokenizers as vocab
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm.filter_audit import audit, count_edges, filters, measured
from tessera.llm.pieces import PieceModel, _word_finder, encode_pieces, piece_digests
from tessera.llm.queries import QUERIES

MODEL = vocab.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def model():
    return PieceModel(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@settings(max_examples=400, deadline=None)
@given(text=st.one_of(st.text(max_size=60), st.lists(st.sampled_from(["▁", " ", "a", "in", "the", "ing", "\n", "é", "中", "\U0001f600", "0", ".com", "://", "==", "<0x0A>", "</s>", "\x00", "b", "er", "er e"]), max_size=30).map("".join)))
def test_ids_equal_the_library(model, library, text):
    assert model.encode(text) == library.encode(text, add_eos=True)


def test_every_piece_and_pair_of_pieces(model, library):
    pieces = [p for i, p in enumerate(model.piece) if p in model.cost]
    for a, b in zip(pieces, pieces[1:] + pieces[:1], strict=True):
        assert model.encode(a + b) == library.encode(a + b, add_eos=True)
    word = "strength" * 20_000
    assert model.encode(word) == library.encode(word, add_eos=True)


def test_caches_may_overflow(model, library, monkeypatch):
    monkeypatch.setattr("tessera.llm.pieces.CACHE_WORDS", 3)
    monkeypatch.setattr("tessera.llm.pieces.CACHE_PAIRS", 3)
    for text in ("one two three four five six seven eight", "eight nine ten one", "one" * 40 + " two"):
        assert model.encode(text) == library.encode(text, add_eos=True)


def test_words_are_cut_only_where_no_piece_reaches_across():
    assert _word_finder(["▁a", "ab", ".a", "▁▁"])("▁ab.a▁▁aZ") == ["▁ab", ".a", "▁▁a", "Z"]
    assert _word_finder(["a▁", "ab"])("ab▁a") == ["ab▁a"]
    assert _word_finder(["a.", "ab"])("ab.a") == ["ab.a"]


def test_documents_of_pieces(spark, sf_dir, library, documents, odd, nothing):
    want = sorted(str((r.doc_id, ids := library.encode(r.text or "", add_eos=True), library.decode(ids))) for r in odd.collect())
    assert sorted(str((r.doc_id, list(r.ids), r.decoded)) for r in encode_pieces(odd, MODEL).collect()) == want
    assert piece_digests(nothing, MODEL).count() == 0 == encode_pieces(nothing, MODEL).count()
    want = []
    for r in documents.collect():
        ids = library.encode(r.text or "", add_eos=True)
        want.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(tuple(r) for r in QUERIES["op13_sentence_pieces"](spark, sf_dir).collect()) == sorted(want)


def brute_audit(docs, labels):
    good, toxic = {i for i, q, _ in labels if i is not None and q == 1}, {i for i, _, t in labels if i is not None and t == 1}
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    rows = []
    for i, text, lang in docs:
        t = text or ""
        words = WORD.findall(t)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and least[t] < i}
        rows.append((lang or "", {f for f, x in fails.items() if x}, i in good, i in toxic))
    out, shapley = [], Counter()
    for order in map("".join, permutations("ABCDE")):
        for part in {p for p, *_ in rows}:
            left = [r for r in rows if r[0] == part]
            of_part = left
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[part, f] += len(gone)
                failing = sum(f in r[1] for r in of_part)
                out.append((part, order, step, len(left), len(gone), failing - len(gone), sum(r[1] == {f} for r in of_part), sum(r[2] for r in gone), sum(r[3] for r in gone)))
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


LABELS = "doc_id bigint, quality int, toxic int, part string, text string"


def test_audit_of_odd_rows(spark, odd, nothing):
    rich = " ".join(f"w{i}" for i in range(250))
    extra = [(30, rich, "en"), (31, rich, "en"), (32, rich.replace("w", "W"), "en"), (33, rich + " #", "nl"), (34, "short", "zz"), (35, None, "zz"), (36, "\xa0" + rich, ""), (None, rich, "en")]
    docs = odd.select("*").unionByName(spark.createDataFrame([(i, t, lang) for i, t, lang in extra], "doc_id bigint, text string, lang string"), allowMissingColumns=True)
    said = [(1, 1, 1), (1, 0, 0), (2, None, 1), (31, 1, None), (33, 1, 0), (20, 0, 1), (None, 1, 1), (999, 1, 1)]
    labels = spark.createDataFrame([(*r, "x", "y") for r in said], LABELS)
    got = audit(docs, labels)
    assert sorted(tuple(r) for r in got.collect()) == brute_audit([(r.doc_id, r.text, r.lang) for r in docs.collect()], said)
    assert audit(nothing, labels).count() == 0
    assert audit(docs, labels.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


def test_the_trie_has_a_node_for_each_set_of_filters(spark, odd, tmp_path):
    rows = measured(odd, spark.createDataFrame([], LABELS))
    chosen = {f: c for f, c in filters().items() if f in "ABD"}
    assert count_edges(rows, chosen, f"file://{tmp_path}/edges") == 8
    edges = spark.read.parquet(f"file://{tmp_path}/edges")
    assert {r.node for r in edges.select("node").distinct().collect()} <= {"", "A", "B", "D", "AB", "AD", "BD"}
    # what an edge removes is what the next node no longer has
    entered = {(r.part, r.node): r.entered for r in edges.collect()}
    for r in edges.collect():
        after = "".join(sorted(r.node + r.filter))
        if after != "ABD":
            assert entered.get((r.part, after), 0) == r.entered - r.removed
