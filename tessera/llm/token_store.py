"""Token ids on disk as compressed bit or byte planes.

A store is a Parquet dataset, so writes commit as a whole and any Hadoop file system holds it. Documents
are laid out in ascending doc_id order over shards; in each shard the ids are cut into blocks of a
fixed size, every block is transposed into planes (the n-th bit or byte of all its ids), and each
plane is compressed by itself. A row holds a block: `shard`, `block`, `first` and `n_ids` are its entry of the chunk
index, `planes` its ids, and `pieces` the documents in it. So a block can be read by itself, wherever
a file is split; only documents over a border between blocks are put together from several rows.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import byte_characters, pretoken_finder
from .common import mapped

#: How byte-level tokenizers cut text before merging (a fixed value of the vocabulary's format).
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK_IDS = 65_536
CACHE_PIECES = 400_000
CACHE_CHARS = 64
LITTLE = np.dtype("<u4")
#: Bytes of text that a shard holds, about, so that the number of shards follows from the data; with so many shards they grow
#: instead, as the driver holds their borders. A shard is written and read in constant memory.
SHARD_BYTES = 8 << 20
MOST_SHARDS = 50_000
#: A document in a block: its number and first id in the shard, its ids in all, and how many stand in the block.
_PIECES = "array<struct<doc_id: bigint, number: bigint, start: bigint, size: bigint, n: bigint>>"
_SCHEMA = f"shard int, block int, first bigint, n_ids bigint, planes array<binary>, pieces {_PIECES}"
_ARROW = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("planes", pa.list_(pa.binary())), ("pieces", pa.list_(pa.struct([(name, pa.int64()) for name in ("doc_id", "number", "start", "size", "n")])))])


class JsonTokenizer:
    """A byte-level BPE tokenizer file. Text is cut once and pre-tokens are merged by the library's model."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.findall = pretoken_finder(BYTE_LEVEL_PATTERN)
        self.table = {i: c for i, c in enumerate(byte_characters())}
        self.cache = _Remembered(self._merge)

    def _merge(self, pretoken: str) -> bytes:
        letters = pretoken.encode().decode("latin-1").translate(self.table)
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def encode(self, text: str) -> bytes:
        """The ids as little-endian 32-bit integers, as the library's encode() gives them."""
        if any(a in text for a in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, LITTLE).tobytes()
        if len(self.cache) > CACHE_PIECES:
            self.cache.clear()
        return b"".join(map(self.cache.__getitem__, self.findall(text)))


class _Remembered(dict):
    """Pre-tokens with their ids; one that isn't there is merged, and remembered unless it is long or there are too many."""

    def __init__(self, merge: Callable[[str], bytes]):
        self.merge = merge

    def __missing__(self, pretoken: str) -> bytes:
        ids = self.merge(pretoken)
        if len(pretoken) <= CACHE_CHARS and len(self) <= CACHE_PIECES:
            self[pretoken] = ids
        return ids


@lru_cache(maxsize=2)
def json_tokenizer(path: str) -> JsonTokenizer:
    return JsonTokenizer(path)


def to_planes(ids: np.ndarray, unit: str = "bit") -> list[bytes]:
    """Planes of a block of 32-bit ids, lowest first; planes above the highest that is used are left out."""
    bits = int(ids.max(initial=0)).bit_length()
    raw = np.ascontiguousarray(ids.astype(LITTLE).view(np.uint8).reshape(-1, 4)[:, : (bits + 7) // 8].T)
    if unit == "byte":
        return [column.tobytes() for column in raw]
    return [np.packbits(raw[i // 8] & np.uint8(1 << i % 8), bitorder="little").tobytes() for i in range(bits)]


def from_planes(planes: list[bytes], n: int, unit: str = "bit", first: int = 0) -> np.ndarray:
    """The n ids from the `first` on; only their part of the planes is gone through."""
    raw = np.zeros((4, n), np.uint8)
    low = first // 8
    for i, plane in enumerate(planes):
        if unit == "byte":
            raw[i] = np.frombuffer(plane, np.uint8)[first : first + n]
            continue
        part = np.frombuffer(plane, np.uint8)[low : (first + n + 7) // 8]
        raw[i // 8] |= np.unpackbits(part, bitorder="little")[first - 8 * low : first - 8 * low + n] << np.uint8(i % 8)
    return np.ascontiguousarray(raw.T).reshape(-1).view(LITTLE)


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None, shards: int | None = None, block_ids: int = BLOCK_IDS, unit: str = "bit", level: int = 1) -> None:
    """Encode every whole text and write a store at `path`; only doc_id and text are read.

    Documents are in ascending doc_id order, null ids first, repeated ids in the order of their id
    bytes; null texts count as empty. `end_id`, if given, ends each document. An empty table gives an empty store.
    """
    n = shards or min(MOST_SHARDS, max(1, -(-(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SHARD_BYTES)))
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"))
    bounds = np.unique(np.array(ids.na.drop().approxQuantile("doc_id", [i / n for i in range(1, n)], max(1 / (20 * n), 1e-6)) if n > 1 else [], np.float64))
    tail = np.array([] if end_id is None else [end_id], LITTLE).tobytes()

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = json_tokenizer(tokenizer_path)
        for batch in batches:
            held = batch.column(0).to_pylist()
            out = [tokenizer.encode(text.as_py() or "") + tail for text in batch.column(1)]
            at = [0 if i is None else int(np.searchsorted(bounds, i, "right")) for i in held]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), batch.column(0), pa.array([_narrow(x) for x in out], pa.binary())], ["shard", "doc_id", "ids"])

    def lay_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=level).compress
        shard, number, first, block, written, waiting, pieces, held = None, 0, 0, 0, 0, [], [], 0

        def block_row(end: int) -> tuple:
            """The next block: the first `end` of the ids that wait, with the pieces of documents that begin before its end."""
            nonlocal block, written, waiting, pieces, held
            joined = np.concatenate(waiting) if waiting else np.zeros(0, LITTLE)
            inside, rest, stop = [], [], written + end
            for doc_id, k, start, size in pieces:
                here = min(stop, start + size) - max(written, start)
                inside.append((doc_id, k, start, size, max(0, here)))
                if start + size > stop:
                    rest.append((doc_id, k, start, size))
            row = shard, block, written, end, [squeeze(p) for p in to_planes(joined[:end], unit)], [dict(zip(("doc_id", "number", "start", "size", "n"), p, strict=True)) for p in inside]
            block, written, waiting, pieces, held = block + 1, stop, [joined[end:]], rest, held - end
            return row

        def rows() -> Iterator[tuple]:
            nonlocal shard, number, first, block, written, waiting, pieces, held
            for batch in batches:
                for at, doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                    if at != shard:
                        if pieces:
                            yield block_row(held)
                        shard, number, first, block, written, waiting, pieces, held = at, 0, 0, 0, 0, [], [], 0
                    got, size = _widen(raw.as_py()), _count(raw)
                    pieces.append((doc_id, number, first, size))
                    first, number = first + size, number + 1
                    while held + len(got) >= block_ids:  # fill the block up; what is left goes on in the next
                        fits = block_ids - held
                        waiting.append(got[:fits])
                        held, got = block_ids, got[fits:]
                        yield block_row(block_ids)
                    waiting.append(got)
                    held += len(got)
            if pieces:
                yield block_row(held)

        yield from _batches(rows())

    encoded = mapped(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), encode, "shard int, doc_id bigint, ids binary")
    placed = encoded.repartition(n, "shard").sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "ids")
    mapped(placed, lay_out, _SCHEMA).write.option("compression", "none").parquet(path)


def _narrow(raw: bytes) -> bytes:
    """Ids below 65 536 as 16-bit integers, for the shuffle; the first byte tells."""
    ids = np.frombuffer(raw, LITTLE)
    return b"\2" + ids.astype("<u2").tobytes() if ids.max(initial=0) < 65_536 else b"\4" + raw


def _widen(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if raw[0] == 2 else LITTLE, offset=1).astype(LITTLE)


def _count(raw: pa.Scalar) -> int:
    """How many ids a narrowed document has."""
    data = memoryview(raw.as_buffer())
    return (len(data) - 1) // data[0]


def _batches(rows: Iterable[tuple], most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(map(len, row[4])) + 40 * len(row[5])
        if size >= most_bytes:
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], f.type) for i, f in enumerate(_ARROW)], schema=_ARROW)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], f.type) for i, f in enumerate(_ARROW)], schema=_ARROW)


def chunk_index(spark: SparkSession, path: str) -> DataFrame:
    """(shard, block, first, n_ids) of every block of a store."""
    return spark.read.schema(_SCHEMA).parquet(path).select("shard", "block", "first", "n_ids")


def read_tokens(spark: SparkSession, path: str, unit: str = "bit") -> DataFrame:
    """(doc_id, start, n_ids, ids) of every document of a store, ids as little-endian 32-bit integers.

    `start` counts the ids of all documents before it. The shards' totals, a row each, are added up on the driver.
    Blocks are read where they lie; only documents that stand in several blocks are shuffled.
    """
    totals = {r["shard"]: r["n"] for r in chunk_index(spark, path).groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()}
    base, at = {}, 0
    for shard in sorted(totals):
        base[shard], at = at, at + totals[shard]

    def decoded(whole: bool) -> DataFrame:
        def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import zstandard

            expand = zstandard.ZstdDecompressor().decompress
            for batch in batches:
                for shard, first, n, planes, pieces in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                    mine = [p for p in pieces if (p["n"] == p["size"]) is whole]
                    if not mine:
                        continue
                    expanded = [expand(p) for p in planes]
                    begin = [max(first, p["start"]) - first for p in mine]
                    if whole:
                        raw = memoryview(from_planes(expanded, n, unit).tobytes())
                        ids = [bytes(raw[4 * b : 4 * (b + p["n"])]) for b, p in zip(begin, mine, strict=True)]
                    else:  # the ends of a block
                        ids = [from_planes(expanded, p["n"], unit, b).tobytes() for b, p in zip(begin, mine, strict=True)]
                    columns = [[shard] * len(mine), [p["number"] for p in mine], [first + b - p["start"] for b, p in zip(begin, mine, strict=True)], [p["doc_id"] for p in mine], [base[shard] + p["start"] for p in mine], [p["size"] for p in mine]]
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array(ids, pa.binary())], ["shard", "number", "part", "doc_id", "start", "n_ids", "ids"])

        stored = spark.read.schema(_SCHEMA).parquet(path).select("shard", "first", "n_ids", "planes", "pieces")
        return mapped(stored, decode, "shard bigint, number bigint, part bigint, doc_id bigint, start bigint, n_ids bigint, ids binary")

    def put_together(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            joined = [b"".join(p["ids"] for p in parts) for parts in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(joined, pa.binary())], ["doc_id", "start", "n_ids", "ids"])

    out = "doc_id bigint, start bigint, n_ids bigint, ids binary"
    over = decoded(False).groupBy("shard", "number", "doc_id", "start", "n_ids").agg(F.sort_array(F.collect_list(F.struct("part", "ids"))).alias("parts"))
    return decoded(True).select("doc_id", "start", "n_ids", "ids").unionByName(mapped(over.select("doc_id", "start", "n_ids", "parts"), put_together, out))
