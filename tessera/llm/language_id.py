"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of letters (a space stands between words) are hashed to buckets. Document frequencies are
counted over all documents that may be learned from. The classifier is trained with
follow-the-regularised-leader (FTRL-proximal) under elastic-net penalties on a bounded sample of
labelled documents, then a temperature is fitted on a part of the sample that training hasn't seen.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mapped, mix

UNDETERMINED = "und"
BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
#: The classifier is fitted on about this many labelled documents, shared evenly by the languages.
SAMPLE_DOCS = 4_000
CHUNK = 1 << 20
SPACE = 32


@dataclass(frozen=True)
class Training:
    """FTRL-proximal: learning rate alpha and beta, penalties l1 and l2, passes; every fifth sampled document calibrates."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    epochs: int = 3
    seed: int = 7
    calibration_share: float = 0.2


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray  # buckets x languages
    bias: np.ndarray
    idf: np.ndarray
    temperature: float


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """For each code point its lower case if it is a letter, itself if it is a combining mark, else a space."""
    table = np.full(0x110000, SPACE, np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha() or unicodedata.category(x) in ("Mn", "Mc"):
            low = x.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


@lru_cache(maxsize=1)
def mark_table() -> np.ndarray:
    """The code points of combining marks, which belong to words but are no letters."""
    return np.array([c for c in range(0x110000) if unicodedata.category(chr(c)) in ("Mn", "Mc")], np.uint64)


def _has_letter(codes: np.ndarray) -> bool:
    other = codes[codes != SPACE]
    # there are no marks below U+0300
    return bool((other < 0x300).any()) or bool(len(other)) and not np.isin(other, mark_table()).all()


def ngram_counts(text: str) -> np.ndarray | None:
    """Counts by bucket of a whole text's n-grams, taken chunk by chunk; None without a letter."""
    counts, carry, seen = np.zeros(BUCKETS, np.int64), np.array([SPACE], np.uint64), False
    for i in range(0, len(text), CHUNK):
        codes = letter_table()[np.frombuffer(text[i : i + CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.uint64)
        joined = np.concatenate((carry, codes))
        space = joined == SPACE
        keep = np.ones(len(joined), bool)
        keep[len(carry) :] = ~(space[len(carry) :] & space[len(carry) - 1 : -1])
        joined = joined[keep]
        seen = seen or _has_letter(joined[len(carry) :])
        for n in ORDERS:
            start = max(0, len(carry) - n + 1)
            part = joined[start:]
            if len(part) >= n:
                key = np.full(len(part) - n + 1, n, np.uint64)
                for j in range(n):
                    key = key * np.uint64(0x1FFFFF) + part[j : len(part) - n + 1 + j]
                counts += np.bincount((mix(key) >> np.uint64(50)).astype(np.int64), minlength=BUCKETS)
        carry = joined[-(max(ORDERS) - 1) :]
    return counts if seen else None


def _vector(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and their TF-IDF weights (sublinear, of length 1)."""
    at = np.flatnonzero(counts)
    x = (1 + np.log(counts[at])) * idf[at]
    return at, x / np.sqrt(x @ x)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit(examples: list[tuple[int, np.ndarray, np.ndarray]], languages: tuple[str, ...], idf: np.ndarray, training: Training) -> Model:
    """Train on (language number, buckets, TF-IDF weights) and calibrate."""
    k = len(languages)
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))
    rng = np.random.default_rng(training.seed)
    held = max(1, round(1 / training.calibration_share))
    learn = [e for i, e in enumerate(examples) if i % held or len(examples) < 2 * held]
    calibrate = [e for i, e in enumerate(examples) if not i % held] or learn

    def weights(rows) -> np.ndarray:
        zr, nr = z[rows], n[rows]
        shrunk = np.sign(zr) * np.maximum(np.abs(zr) - training.l1, 0)
        return -shrunk / ((training.beta + np.sqrt(nr)) / training.alpha + training.l2)

    for _ in range(training.epochs):
        for i in rng.permutation(len(learn)):
            label, at, x = learn[i]
            rows, values = np.append(at, BUCKETS), np.append(x, 1.0)
            w = weights(rows)
            error = _softmax(values @ w)
            error[label] -= 1
            g = values[:, None] * error
            root = np.sqrt(n[rows])
            squares = n[rows] + g * g
            z[rows] += g - (np.sqrt(squares) - root) / training.alpha * w
            n[rows] = squares
    w = weights(slice(None))
    logits = np.array([x @ w[at] + w[BUCKETS] for _, at, x in calibrate])
    labels = np.array([label for label, _, _ in calibrate])
    loss = lambda t: -np.log(np.maximum(_softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean()
    low, high = np.log(0.02), np.log(20.0)
    for _ in range(60):  # golden section on the logarithm of the temperature
        a, b = high - (high - low) / 1.618034, low + (high - low) / 1.618034
        low, high = (low, b) if loss(np.exp(a)) < loss(np.exp(b)) else (a, high)
    return Model(languages, w[:BUCKETS].astype(np.float32), w[BUCKETS], idf, float(np.exp((low + high) / 2)))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 on division by 4; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(docs: DataFrame, training: Training = Training(), sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """Learn from rows with a lang and an id that isn't held out; None if there is no such row with a letter.

    Document frequencies cover all of these rows. The sample takes each language's rows by a hash of
    the id, evenly over languages, `sample_docs` in all on average and twice that at most; it is
    trained in one task, whose memory is bounded by sample_docs x buckets.
    """
    usable = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    languages = tuple(sorted(counts))

    def frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(BUCKETS + 1, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                found = ngram_counts(text.as_py() or "")
                if found is not None:
                    df[:BUCKETS] += found > 0
                    n += 1
        df[BUCKETS] = n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(df[at])], ["bucket", "n"])

    df = np.zeros(BUCKETS + 1)
    for row in mapped(usable.select("text"), frequencies, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        df[row["bucket"]] = row["n"]
    if not df[BUCKETS]:
        return None
    idf = np.log((1 + df[BUCKETS]) / (1 + df[:BUCKETS])) + 1
    share = max(1, sample_docs // len(languages))
    scale = 1 << 30
    limit = F.create_map(*[x for lang in languages for x in (F.lit(lang), F.lit(min(scale, -(-share * scale // counts[lang]))))])
    drawn = usable.withColumn("h", F.xxhash64(F.lit("sample"), "doc_id")).where(F.pmod("h", F.lit(scale)) < F.element_at(limit, F.col("lang")))

    def vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, text, lang in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                found = ngram_counts(text or "")
                if found is not None:
                    at, x = _vector(found, idf)
                    yield pa.RecordBatch.from_arrays([pa.array([h]), pa.array([languages.index(lang)], pa.int32()), pa.array([at.astype("<u2").tobytes()]), pa.array([x.astype("<f4").tobytes()])], ["h", "label", "at", "x"])

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for batch in batches:
            for label, at, x in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if len(examples) < 2 * sample_docs:
                    examples.append((label, np.frombuffer(at, "<u2").astype(np.int64), np.frombuffer(x, "<f4").astype(np.float64)))
        if examples:
            m = fit(examples, languages, idf, training)
            yield pa.RecordBatch.from_arrays([pa.array([m.weights.astype("<f4").tobytes()]), pa.array([m.bias.astype("<f8").tobytes()]), pa.array([m.temperature])], ["weights", "bias", "temperature"])

    sample = mapped(drawn.select("h", "text", "lang"), vectors, "h bigint, label int, at binary, x binary")
    fitted = mapped(sample.repartition(1).sortWithinPartitions("h", "label"), learn, "weights binary, bias binary, temperature double").collect()
    if not fitted:
        return None
    row = fitted[0]
    return Model(languages, np.frombuffer(row["weights"], "<f4").reshape(BUCKETS, len(languages)), np.frombuffer(row["bias"], "<f8"), idf, row["temperature"])


def judge(text: str | None, model: Model | None) -> tuple[str, float]:
    """The language of one text and its calibrated probability."""
    found = ngram_counts(text) if model and text else None
    if found is None:
        return UNDETERMINED, 0.0
    at, x = _vector(found, model.idf)
    p = _softmax((x @ model.weights[at].astype(np.float64) + model.bias) / model.temperature)
    best = int(p.argmax())
    return model.languages[best], float(p[best])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every whole text, a row per input row; only doc_id and text are read.

    lang_pred is `und` and score 0 if the text is null, is empty or has no letter, or if there is no
    model. Equal texts get equal predictions; ties go to the language that sorts first. An empty table
    gives no rows.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            judged = [judge(text.as_py(), model) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([j[0] for j in judged], pa.string()), pa.array([j[1] for j in judged], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return mapped(rows, work, "doc_id bigint, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, **options) -> DataFrame:
    """Train on the labelled rows of docs, then predict every row."""
    return predict(docs, train(docs, **options))


def keep_identified(docs: DataFrame, least_score: float = 0.4, **options) -> DataFrame:
    """The documents whose text has a language, with all columns: those without a letter, and those no language fits well, go."""
    model = train(docs, **options)
    at = docs.columns.index("text")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            judged = [judge(text.as_py(), model) for text in batch.column(at)]
            yield batch.filter(pa.array([lang != UNDETERMINED and score >= least_score for lang, score in judged], pa.bool_()))

    return mapped(docs, work, docs.schema)
