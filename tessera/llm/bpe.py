"""Byte-level BPE by a sentencepiece model that is serialised straight from a rank file.

Each byte stands for one printable character, so every rank is a piece; a piece's score is its
negative rank, which makes sentencepiece merge pairs in the order of the ranks. Normalisation is the
identity. Text is cut by a pre-token pattern first, each pre-token is encoded by itself, and ids are
decoded by the inverse byte mapping.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import mapped

#: Pre-tokens that a worker remembers with their ids; beyond that it starts afresh.
CACHE_PIECES = 100_000
#: Characters of pre-tokens longer than this are not remembered.
CACHE_CHARS = 64
#: Unicode's White_Space property, which is narrower than str.isspace (no U+001C to U+001F).
WHITE_SPACE = r"\x09-\x0D\x20\x85\xA0  -     　"


def byte_characters() -> list[str]:
    """A printable character for every byte: itself where it is printable, else the next one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file, by rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    ranked = sorted((int(rank), base64.b64decode(piece)) for piece, rank in pairs)
    if [r for r, _ in ranked] != list(range(len(ranked))):
        raise ValueError("ranks must be 0 to n - 1 without gaps")
    return [piece for _, piece in ranked]


def _varint(n: int) -> bytes:
    out = b""
    while n >= 0x80:
        out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
    return out + bytes([n])


def _field(number: int, value: bytes | int | float | bool) -> bytes:
    """One protocol buffer field: bytes are length-delimited, floats fixed to 32 bits, others varints."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(int(value))


def sentencepiece_model(pieces: list[bytes]) -> bytes:
    """A serialised BPE ModelProto whose ids are the ranks; the unknown piece comes last.

    Fields by number - model: 1 pieces, 2 trainer_spec, 3 normalizer_spec; piece: 1 text, 2 score,
    3 type (1 normal, 2 unknown); trainer: 3 model_type (2 BPE), 4 vocab_size, 24 treat white space as
    suffix, 40 to 43 ids of unk, bos, eos, pad; normalizer: 1 name, 3 add_dummy_prefix,
    4 remove_extra_whitespaces, 5 escape_whitespaces.
    """
    letters = byte_characters()
    body = b"".join(_field(1, _field(1, "".join(letters[b] for b in piece).encode()) + _field(2, -float(rank)) + _field(3, 1)) for rank, piece in enumerate(pieces))
    body += _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    none = (1 << 64) - 1
    trainer = _field(3, 2) + _field(4, len(pieces) + 1) + _field(40, len(pieces)) + _field(41, none) + _field(42, none) + _field(43, none)
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return body + _field(2, trainer) + _field(3, normalizer)


def _ranges(code_points: list[int]) -> str:
    """A character class body for sorted code points."""
    out, start = [], 0
    for i in range(1, len(code_points) + 1):
        if i == len(code_points) or code_points[i] != code_points[i - 1] + 1:
            out.append(f"\\U{code_points[start]:08X}-\\U{code_points[i - 1]:08X}")
            start = i
    return "".join(out)


@lru_cache(maxsize=4)
def pretoken_finder(pattern: str) -> Callable[[str], list[str]]:
    """findall of a pattern in which \\s means Unicode's White_Space.

    The classes \\p{L} and \\p{N} are spelled out once, as the standard library's engine has no names for them. It
    tests characters up to U+FFFF by table but later ones range by range, so texts without those have their own form.
    """
    low, full = _spelled(pattern, 0x10000), _spelled(pattern, 0x110000)
    high = re.compile("[\U00010000-\U0010FFFF]").search
    return lambda text: full(text) if high(text) else low(text)


def _spelled(pattern: str, end: int) -> Callable[[str], list[str]]:
    import regex

    everything = "".join(map(chr, chain(range(0xD800), range(0xE000, end))))
    members = {rf"\p{{{name}}}": _ranges([ord(c) for c in regex.findall(rf"\p{{{name}}}", everything)]) for name in "LN"}
    members[r"\s"] = WHITE_SPACE
    out, inside = [], False
    for part in re.findall(r"\\p\{\w\}|\\.|.", pattern):
        inside = part == "[" or inside and part != "]"
        if part == r"\S":
            part = f"[^{WHITE_SPACE}]"
        elif part in members:
            part = members[part] if inside else f"[{members[part]}]"
        out.append(part)
    return re.compile("".join(out)).findall


class Encoder:
    """Encodes texts to ranks and decodes them; a known pre-token is its own rank, others go through sentencepiece."""

    def __init__(self, ranks_path: str, pattern: str):
        import sentencepiece

        self.pieces = read_ranks(ranks_path)
        self.rank = {piece: i for i, piece in enumerate(self.pieces)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.pieces))
        self.findall = pretoken_finder(pattern)
        self.table = {i: c for i, c in enumerate(byte_characters())}
        self.cache: dict[str, tuple[int, ...]] = {}
        self.decimal = [str(i) for i in range(len(self.pieces))]

    def _learn(self, pretokens: set[str]) -> dict[str, tuple[int, ...]]:
        """Ids of pre-tokens: those that are a piece have its rank, sentencepiece merges the others."""
        known, spelled = {}, {}
        for pretoken in pretokens:
            raw = pretoken.encode()
            rank = self.rank.get(raw)
            if rank is None:
                spelled[pretoken] = raw.decode("latin-1").translate(self.table)
            else:
                known[pretoken] = (rank,)
        known.update(zip(spelled, map(tuple, self.model.encode(list(spelled.values()), num_threads=1)), strict=True))
        return known

    def encode(self, text: str) -> list[int]:
        pretokens = self.findall(text)
        unknown = set(pretokens).difference(self.cache)
        if unknown:
            if len(self.cache) + len(unknown) > CACHE_PIECES:
                self.cache.clear()
                unknown = set(pretokens)
            learned = self._learn(unknown)
            if len(unknown) > CACHE_PIECES or max(map(len, unknown)) > CACHE_CHARS:
                found = {p: learned.get(p) or self.cache[p] for p in set(pretokens)}
                return list(chain.from_iterable(map(found.__getitem__, pretokens)))
            self.cache.update(learned)
        return list(chain.from_iterable(map(self.cache.__getitem__, pretokens)))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(ranks_path: str, pattern: str) -> Encoder:
    """One encoder a worker and vocabulary."""
    return Encoder(ranks_path, pattern)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>, decoded binary) of every whole text, a row per input row.

    Null texts count as empty and have no ids. Null doc_ids pass through, repeated rows give repeated
    results, other columns are ignored, an empty table gives no rows. The vocabulary is read from
    `ranks_path` on each executor.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(ranks_path, pattern)
        for batch in batches:
            for row in range(batch.num_rows):
                ids = model.encode(batch.column(1)[row].as_py() or "")
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, 1), pa.array([ids], pa.list_(pa.int32())), pa.array([model.decode(ids)], pa.binary())], ["doc_id", "ids", "decoded"])

    return mapped(docs.selectExpr("cast(doc_id as bigint) doc_id", "text"), work, "doc_id bigint, ids array<int>, decoded binary")


def token_digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode_documents with digests in place of the long columns.

    The ids are joined by commas, the digests are lowercase hex; rows are treated as in encode_documents.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(ranks_path, pattern)
        decimal = model.decimal.__getitem__
        for batch in batches:
            n, hashed, decoded = [], [], []
            for text in batch.column(1):
                ids = model.encode(text.as_py() or "")
                n.append(len(ids))
                hashed.append(hashlib.sha256(",".join(map(decimal, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(model.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(hashed), pa.array(decoded)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return mapped(docs.selectExpr("cast(doc_id as bigint) doc_id", "text"), work, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
