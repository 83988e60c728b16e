"""Exact Jaccard self-join on word n-grams by vertical partitioning of a global n-gram order.

All n-grams have one global order: by hash, the most frequent ones behind all others. Sets of one band of
sizes cut the order of the rarer n-grams into so many fragments that two similar sets, whose difference has a bound, must
agree in a whole one; the set of a fragment is its signature. Documents that share a signature are candidates: each is
paired with the smallest of its signature's list, so pairs grow with the documents and not with the squares of lists.

For those pairs the global order is cut into `FRAGMENTS` fragments; the overlap in each fragment is counted
in a task of its own, without a pair that the fragment alone rules out, and the partial counts are summed per pair.
Candidate groups whose pairs leave them in several components are compared in blocks of bounded
size as matrix products, so that no link is lost.

Equal sets form one class first, so copies are never paired.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_ids, components, cut, free, mapped, mix, small, spread

#: Parts of the global order whose overlaps are counted by themselves; the last holds the frequent n-grams.
FRAGMENTS = 4
#: The most frequent n-grams that go to the end of the global order: so many at most, a bound on what is sent to executors.
FREQUENT = 50_000
#: Frequencies are counted over all documents in chunks of so many n-grams; a chunk passes on what it has three times or more.
COUNT_CHUNK = 1_000_000
TEXT_CHUNK = 1 << 20
#: Signatures that a task combines before it sends them on.
COMBINE = 500_000
#: N-grams to a range of signatures, about: what one task of the join holds at a time.
BUCKET_GRAMS = 1_000_000
#: Partners of one class that a task compares with it; more are shared out over tasks.
SHARE = 256
#: Classes on a side of a block, and n-grams in a matrix of it.
BLOCK = 256
BLOCK_GRAMS = 4_000_000
COLUMNS = 8_192
#: Rows of a table of (id, text hash) that is broadcast at most.
GONE_ROWS = 500_000
#: Representatives that are broadcast at most, when their texts are read again.
BROADCAST_ROWS = 200_000
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += np.uint8(32)
#: Short texts are hashed together in groups of about so many characters.
GROUP_CHARS = 1 << 16
#: Bytes of a word that are hashed in lanes of eight; longer words go through BLAKE2b.
LANE_BYTES = 64
_LANE_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
_BREAK = re.compile(r"[\x20\x09-\x0D]")


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of a whole text's words, A-Z lower-cased, in order; long texts are cut at white space."""
    out, i = [], 0
    while i < len(text):
        stop = _BREAK.search(text, min(len(text), i + TEXT_CHUNK))
        end = stop.end() if stop else len(text)
        out.append(_word_hashes(text[i:end]))
        i = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _word_hashes(text: str) -> np.ndarray:
    return _hashed(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8))[0]


def _hashed(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words of UTF-8 bytes.

    A word is a chain of eight-byte lanes, each of which passes through a bijection of 64 bits, so words of up to eight
    bytes and one length never collide and others do only by chance.
    """
    word = np.zeros(len(raw) + 2, bool)
    np.logical_not(_SPACE[raw], out=word[1:-1])
    edges = np.flatnonzero(word[1:] != word[:-1])
    start, end = edges[::2], edges[1::2]
    size = end - start
    low = np.concatenate((_LOWER[raw], np.zeros(8, np.uint8)))
    lanes = np.ndarray((len(raw) + 1,), "<u8", low, strides=(1,))
    hashes = mix(size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    for at in range(0, LANE_BYTES, 8):
        open_ = np.flatnonzero(size > at) if at else slice(None)
        if at and not len(open_):
            break
        lane = lanes[start[open_] + at] & _LANE_MASK[np.minimum(size[open_] - at, 8)]
        hashes[open_] = mix((hashes[open_] + np.uint64(0x9E3779B97F4A7C15)) ^ lane)
    for i in np.flatnonzero(size > LANE_BYTES):
        hashes[i] = int.from_bytes(hashlib.blake2b(low[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return hashes, start


def _grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-grams of a word sequence of n words or more, in order."""
    grams = np.full(len(words) - n + 1, n, np.uint64)
    for j in range(n):
        grams = mix(grams * np.uint64(0x2545F4914F6CDD1D) + words[j : len(words) - n + 1 + j])
    return grams


def ngram_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; the whole sequence if there are fewer words."""
    words = word_hashes(text or "")
    return np.unique(_grams(words, min(n, len(words)))) if len(words) else words


def ngram_sets(texts: Iterable[str | None], n: int) -> Iterator[np.ndarray]:
    """ngram_set of each text; short ones are hashed together, so that numpy works on long arrays."""
    held, size = [], 0
    for text in texts:
        text = text or ""
        if len(text) >= GROUP_CHARS:
            yield from _together(held, n)
            yield ngram_set(text, n)
            held, size = [], 0
            continue
        held.append(text)
        size += len(text)
        if size >= GROUP_CHARS:
            yield from _together(held, n)
            held, size = [], 0
    yield from _together(held, n)


def _together(texts: list[str], n: int) -> Iterator[np.ndarray]:
    if not texts:
        return
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    words, starts = _hashed(np.frombuffer(b" ".join(raw), np.uint8))
    ends = np.cumsum([len(r) + 1 for r in raw])
    cuts = np.concatenate(([0], np.searchsorted(starts, ends)))
    grams = _grams(words, n) if len(words) >= n else words[:0]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b - a >= n:
            own = np.sort(grams[a : b - n + 1])
            new = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=new[1:])
            yield own[new]
        else:
            yield _grams(words[a:b], b - a) if b > a else words[:0]


def set_key(grams: np.ndarray) -> bytes:
    """A 128-bit key of a whole set."""
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def class_id(key: bytes, seed: int) -> int:
    """A signed 64-bit number of a key; another seed gives other numbers."""
    return int.from_bytes(hashlib.blake2b(key, digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "little", signed=True)


def frequent_ngrams(docs: DataFrame, n: int, most: int = FREQUENT) -> np.ndarray:
    """Hashes of the most frequent n-grams, most frequent last, by lossy counting over all documents."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                grams, counts = np.unique(np.concatenate(held), return_counts=True)
                often = counts >= 3
                yield pa.RecordBatch.from_arrays([pa.array(grams[often].view(np.int64)), pa.array(counts[often])], ["gram", "n"])
                held.clear()

        for batch in batches:
            for grams in ngram_sets(batch.column(0).to_pylist(), n):
                held.append(grams)
                size += len(grams)
                if size >= COUNT_CHUNK:
                    yield from flush()
                    size = 0
        yield from flush()

    counted = mapped(docs.select("text"), count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    rows = counted.orderBy(F.desc("n"), "gram").limit(most).collect()
    return np.array([r["gram"] for r in reversed(rows)], np.int64).view(np.uint64)


def prefix_length(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1


@lru_cache(maxsize=1)
def _frequent(frequent: bytes) -> tuple[np.ndarray, np.ndarray]:
    at = np.frombuffer(frequent, np.uint64)
    order = np.argsort(at)
    return at[order], order


class _Order:
    """The global order: n-grams that aren't frequent by their hash, then the frequent ones, least frequent first."""

    def __init__(self, frequent: np.ndarray):
        self.sorted, self.at = _frequent(frequent.tobytes())

    def parted(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rarer n-grams of a sorted set, by hash, and the ranks of its frequent ones."""
        if not len(self.sorted):
            return grams, self.at[:0]
        where = np.minimum(np.searchsorted(self.sorted, grams), len(self.sorted) - 1)
        often = self.sorted[where] == grams
        return grams[~often], np.sort(self.at[where[often]])

    def fragments(self, grams: np.ndarray) -> list[np.ndarray]:
        """A set by fragments of the order: ranges of hashes, and last the ranks of the frequent n-grams."""
        rare, often = self.parted(grams)
        n = FRAGMENTS - 1
        cuts = np.searchsorted(rare, np.array([f * ((1 << 64) // n) for f in range(1, n)], np.uint64))
        return [*np.split(rare, cuts), often.astype(np.uint64)]


@lru_cache(maxsize=8)
def _bands(percent: int) -> list[int]:
    return [1]


def band_of(size: int, percent: int) -> int:
    """The band of a size: sets that are similar enough are of one band or of two that follow each other."""
    bounds = _bands(percent)
    while bounds[-1] <= size:
        bounds.append(max(bounds[-1] + 1, (bounds[-1] - 1) * 100 // percent + 1))
    low, high = 0, len(bounds) - 1
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if bounds[middle] <= size else (low, middle)
    return low


@lru_cache(maxsize=4096)
def scheme(band: int, percent: int) -> tuple[int, int]:
    """(most, parts) for pairs whose smaller set is of the band: n-grams that one of them has alone at most, and fragments of the order."""
    bounds = _bands(percent)
    while len(bounds) <= band + 1:
        bounds.append(max(bounds[-1] + 1, (bounds[-1] - 1) * 100 // percent + 1))
    smaller = bounds[band + 1] - 1
    most = (smaller + smaller * 100 // percent) * (100 - percent) // (100 + percent)
    return most, most + 1 + (most + 1) // 3


def signatures(grams: np.ndarray, order: _Order, percent: int) -> np.ndarray:
    """Hashes of which two sets that are similar enough, but not equal, share one at least.

    At most `most` n-grams are in one set only, so of more fragments than that one is the same in both. It
    isn't empty if a set fills more than `most` fragments. Sets that fill fewer add the n-grams of their prefix, as
    two such sets that are similar share one of those.
    """
    rare, often = order.parted(grams)
    own, out, thin = band_of(len(grams), percent), [], False
    scrambled = mix(rare ^ np.uint64(0xA0761D6478BD642F))
    for band in range(max(0, own - 1), own + 1):
        most, parts = scheme(band, percent)
        if not most:
            continue
        if len(rare):
            at = ((rare >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            heads = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            tag = np.uint64((band + 1) * 0x8EBC6AF09C88C6E3 % (1 << 64))
            out.append(mix(np.add.reduceat(scrambled, heads) + mix(at[heads] + tag)))
        thin = thin or not len(rare) or len(heads) <= most
    if thin:
        prefix = np.concatenate((rare, often.astype(np.uint64)))[: prefix_length(len(grams), percent)]
        kind = np.arange(len(prefix)) >= len(rare)
        out.append(mix(prefix ^ np.where(kind, np.uint64(0x589965CC75374CC3), np.uint64(0x1D8E4E27C47D124F))))
    return np.concatenate(out) if out else grams[:0]


def _rows(docs: DataFrame, n: int, seed: int) -> DataFrame:
    """(doc_id, mark, size, key, id) of every document; size 0 has no key and no id."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys = [], []
            for grams in ngram_sets((t.as_py() for t in batch.column(2)), n):
                sizes.append(len(grams))
                keys.append(set_key(grams) if len(grams) else None)
            ids = [None if k is None else class_id(k, seed) for k in keys]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], ["doc_id", "mark", "size", "key", "id"])

    return mapped(docs.select("doc_id", "mark", "text"), work, "doc_id bigint, mark bigint, size bigint, key binary, id bigint")


def _packed(sigs: list[np.ndarray], n_buckets: int) -> Iterator[tuple]:
    """A task's documents, numbered in order, as rows (bucket, low, high, owners), and last the links (a, b) among themselves.

    A signature has one posting a task, that of the first document with it; postings take eight bytes each, six of
    the signature, in ascending order, and two of the document's number.
    """
    sig, owners = np.concatenate(sigs), np.repeat(np.arange(len(sigs)), [len(s) for s in sigs])
    at = np.argsort(sig, kind="stable")
    sig, owners = sig[at], owners[at]
    heads = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
    first = np.repeat(owners[heads], np.diff(np.concatenate((heads, [len(sig)]))))
    apart = owners != first
    links = np.unique(np.stack((owners[apart], first[apart])), axis=1)
    sig, owners = sig[heads], owners[heads].astype("<u2")
    bucket = ((sig >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)
    edges = np.concatenate((np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))), [len(sig)]))
    low, high = (sig >> np.uint64(16)).astype("<u4"), (sig >> np.uint64(48)).astype("<u2")
    for i, j in zip(edges[:-1], edges[1:], strict=True):
        yield int(bucket[i]), low[i:j].tobytes(), high[i:j].tobytes(), owners[i:j].tobytes()
    yield -1, *(side.astype("<u2").tobytes() for side in links)


def _met(rows: list[tuple[int, bytes, bytes, bytes]]) -> np.ndarray:
    """Pairs (document, first document of its signature's list) of a bucket's postings (unit, low, high, owners)."""
    low, high = (np.concatenate([np.frombuffer(r[k], kind) for r in rows]).astype(np.uint64) for k, kind in ((1, "<u4"), (2, "<u2")))
    sig = (high << np.uint64(32)) | low
    nodes = np.concatenate([np.frombuffer(r[3], "<u2").astype(np.int64) | r[0] for r in rows])
    at = np.lexsort((nodes, sig))
    sig, nodes = sig[at], nodes[at]
    heads = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
    first = np.repeat(nodes[heads], np.diff(np.concatenate((heads, [len(sig)]))))
    apart = nodes != first
    return np.unique(np.stack((nodes[apart], first[apart])), axis=1)


def _candidates(docs: DataFrame, n: int, percent: int, frequent: np.ndarray, seed: int, n_buckets: int) -> DataFrame:
    """Pairs (a, b) of class ids whose components hold all pairs that may link.

    A task joins its own documents first and sends one of each signature on, so that a list that every
    document is in has an entry per task. Postings name documents by a task's unit and their number in it, and
    are packed by ranges of signatures; a range is read at once. 48 bits of a signature are sent, which can only add pairs.
    """

    def combine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, sigs, ids, held = _Order(frequent), [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not sigs:
                return
            classes = np.array(ids, np.int64)
            # a unit is named by what is in it, so a task that runs again names it alike; its low 16 bits number documents
            unit = class_id(classes.tobytes() + b"".join(s[:1].tobytes() for s in sigs), seed) >> 16 << 16
            rows = [(b if b >= 0 else unit % n_buckets, int(b < 0), unit, low, high, owners) for b, low, high, owners in ((*r, b"") if r[0] < 0 else r for r in _packed(sigs, n_buckets))]
            rows.append((unit % n_buckets, 2, unit, classes.astype("<i8").tobytes(), b"", b""))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["bucket", "kind", "unit", "low", "high", "owners"])
            sigs.clear()
            ids.clear()

        for batch in batches:
            for grams in ngram_sets((t.as_py() for t in batch.column(0)), n):
                if len(grams) and len(found := signatures(grams, order, percent)):
                    sigs.append(found)
                    ids.append(class_id(set_key(grams), seed))
                    held += len(found)
                if held >= COMBINE or len(sigs) == 1 << 16:
                    yield from flush()
                    held = 0
        yield from flush()

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []

        def pairs(kind: int, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(x), kind, np.int32)), pa.array(x), pa.array(y)], ["kind", "x", "y"])

        for batch in batches:
            for at, kind, unit, low, high, owners in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != bucket and held:
                    yield pairs(0, *_met(held))
                    held.clear()
                bucket = at
                if kind == 0:
                    held.append((unit, low, high, owners))
                elif kind == 1:
                    yield pairs(0, *(np.frombuffer(side, "<u2").astype(np.int64) | unit for side in (low, high)))
                else:
                    of_unit = np.frombuffer(low, "<i8")
                    yield pairs(2, np.arange(len(of_unit)) | unit, of_unit)
        if held:
            yield pairs(0, *_met(held))

    sent = mapped(docs.select("text"), combine, "bucket int, kind int, unit bigint, low binary, high binary, owners binary")
    found = cut(mapped(sent.repartition(n_buckets, "bucket").sortWithinPartitions("bucket"), join, "kind int, x bigint, y bigint"))
    free(docs.sparkSession)
    named = found.where("kind = 2").select("x", F.col("y").alias("id")).distinct()
    links = found.where("kind = 0").select("x", "y").distinct()
    links = links.join(named.withColumnRenamed("id", "a"), "x").select(F.col("y").alias("x"), "a").join(named.withColumnRenamed("id", "b"), "x").where("a <> b")
    # copies of a class may lead different lists, and so pair it both ways
    return cut(links.groupBy(F.least("a", "b"), F.greatest("a", "b")).agg(F.min(F.struct("a", "b")).alias("pair")).select("pair.*"))


def _wanted(docs: DataFrame, classes: DataFrame, calls: DataFrame) -> DataFrame:
    """(text, key, id, *) of a document of each class that `calls` (id, *) names; repeated rows give it more than once.

    Beyond what is broadcast, only texts whose id may be named are moved.
    """
    named = cut(calls.join(classes.select("id", "key", F.col("first_id").alias("__id")), "id"))
    held = docs.select("doc_id", "text").where("text is not null")
    if named.count() <= BROADCAST_ROWS:
        named = F.broadcast(named)
    else:
        held, _ = by_ids(held, named, "doc_id", "__id")
    return held.join(named, F.col("doc_id").eqNullSafe(F.col("__id"))).drop("doc_id", "__id")


def _pair_links(docs: DataFrame, classes: DataFrame, pairs: DataFrame, n: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """The pairs (a, b) that link: overlaps counted by fragment, each in a task of its own, and summed per pair."""
    shares = cut(pairs.groupBy("b").agg(F.ceil(F.count("*") / SHARE).cast("int").alias("shares")))
    guests = pairs.join(shares, "b").select(F.col("a").alias("id"), F.struct(F.col("b").alias("at"), F.pmod(F.xxhash64("a"), "shares").cast("int").alias("share"), F.lit(1).alias("role")).alias("call"))
    hosts = shares.select(F.col("b").alias("id"), F.explode(F.transform(F.sequence(F.lit(0), F.col("shares") - 1), lambda s: F.struct(F.col("b").alias("at"), s.alias("share"), F.lit(0).alias("role")))).alias("call"))
    calls = guests.unionByName(hosts).groupBy("id").agg(F.collect_list("call").alias("calls"))

    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = _Order(frequent)
        columns = [[] for _ in range(7)]
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["at", "share", "part", "role", "id", "size", "grams"])
            for c in columns:
                c.clear()

        for batch in batches:
            rows = batch.num_rows
            keys, ids, calls = (batch.column(i).to_pylist() for i in (1, 2, 3))
            for i, grams in zip(range(rows), ngram_sets((t.as_py() for t in batch.column(0)), n), strict=True):
                if set_key(grams) != keys[i]:
                    continue
                for f, piece in enumerate(order.fragments(grams)):
                    raw = piece.astype("<u8").tobytes()
                    for call in calls[i]:
                        for column, value in zip(columns, (call["at"], call["share"], f, call["role"], ids[i], len(grams), raw), strict=True):
                            column.append(value)
                        held += len(raw) + 64
                if held >= 4 << 20:
                    yield from flush()
                    held = 0
        yield from flush()

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, host, size_b, last = None, None, 0, None
        for batch in batches:
            out = ([], [], [], [])
            for at, share, f, role, who, size, raw in zip(*(batch.column(i).to_pylist() for i in range(6)), batch.column(6), strict=True):
                grams = np.frombuffer(raw.as_buffer(), "<u8")
                if role == 0:
                    group, host, size_b, last = (at, share, f), grams.copy(), size, None
                    continue
                if group != (at, share, f) or who == last:
                    continue
                last, need = who, -(-percent * (size + size_b) // (100 + percent))
                if 100 * min(size, size_b) < percent * max(size, size_b) or not len(host) or not len(grams):
                    continue
                where = np.minimum(np.searchsorted(host, grams), len(host) - 1)
                common = int((host[where] == grams).sum())
                # what one of them has alone in this fragment may not exceed all that is left for the whole sets
                if common and len(grams) + len(host) - 2 * common <= size + size_b - 2 * need:
                    for column, value in zip(out, (who, at, common, need), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["a", "b", "common", "need"])

    wanted = _wanted(docs, classes, calls).select("text", "key", "id", "calls")
    parts = mapped(wanted, part, "at bigint, share int, part int, role int, id bigint, size bigint, grams binary")
    ordered = parts.repartition(spread(docs), "at", "share", "part").sortWithinPartitions("at", "share", "part", "role", "id")
    counted = mapped(ordered, count, "a bigint, b bigint, common bigint, need bigint")
    return counted.groupBy("a", "b").agg(F.sum("common").alias("common"), F.max("need").alias("need")).where("common >= need").select("a", "b")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of one list with all of the other."""
    total = np.zeros((len(left), len(right)), np.float64)
    sides = [(np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets]), len(sets)) for sets in (left, right)]
    both = np.intersect1d(sides[0][0], sides[1][0])
    for i in range(0, len(both), COLUMNS):
        part = both[i : i + COLUMNS]
        matrices = []
        for grams, owner, rows in sides:
            at = np.minimum(np.searchsorted(part, grams), len(part) - 1)
            hit = part[at] == grams
            m = np.zeros((rows, len(part)), np.float32)
            m[owner[hit], at[hit]] = 1
            matrices.append(m)
        total += matrices[0] @ matrices[1].T
    return total


def _block_links(rows: Iterable[tuple], percent: int) -> Iterator[tuple[int, int]]:
    """Rows (group, i, j, side, key, grams) sorted by group, i, j, side to edges of a spanning forest of the links in each block."""
    task, sides = None, ([], [])

    def finish() -> Iterator[tuple[int, int]]:
        left = sides[0]
        right = sides[1] or left
        if not left:
            return
        sets = [[np.frombuffer(g, "<u8") for _, g in side] for side in (left, right)]
        common = _overlaps(*sets)
        sizes = [np.array([len(s) for s in side], np.float64) for side in sets]
        near = 100 * common >= percent * (sizes[0][:, None] + sizes[1][None, :] - common)
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.get(x, x) != x:
                root[x] = root.get(root[x], root[x])
                x = root[x]
            return x

        for a, b in zip(*np.nonzero(near), strict=True):
            x, y = find(left[a][0]), find(right[b][0])
            if x != y:
                root[max(x, y)] = min(x, y)
                yield x, y

    for group, i, j, side, key, grams in rows:
        if (group, i, j) != task:
            yield from finish()
            task, sides = (group, i, j), ([], [])
        if not sides[side] or sides[side][-1][0] != key:  # a repeated row gives its set again
            sides[side].append((key, grams))
    yield from finish()


def _group_links(docs: DataFrame, classes: DataFrame, members: DataFrame, percent: int, n: int) -> DataFrame:
    """Edges (a, b) that connect the linked classes of each group; members has (id, size, group)."""
    blocks = members.groupBy("group").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / BLOCK_GRAMS)).cast("int").alias("blocks"))
    placed = cut(members.join(cut(blocks), "group").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))

    def grams_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(1).to_pylist()
            for i, grams in enumerate(ngram_sets((t.as_py() for t in batch.column(0)), n)):
                if set_key(grams) == keys[i]:
                    one = batch.slice(i, 1)
                    yield pa.RecordBatch.from_arrays([*one.columns[2:6], pa.array([grams.astype("<u8").tobytes()], pa.binary())], ["id", "group", "own", "blocks", "grams"])

    wanted = _wanted(docs, classes, placed.select("id", "group", "own", "blocks")).select("text", "key", "id", "group", "own", "blocks")
    sets = mapped(wanted, grams_of, "id bigint, group bigint, own int, blocks int, grams binary")
    # block (i, j), i <= j, meets the classes of i on the left with those of j on the right
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least(x, F.col("own")).alias("i"), F.greatest(x, F.col("own")).alias("j"), F.when(x < F.col("own"), 1).otherwise(0).alias("side")))
    tasks = sets.select("group", F.explode(others).alias("at"), "id", "grams").select("group", "at.i", "at.j", "at.side", "id", "grams")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in range(5)), (g.as_buffer() for g in batch.column(5)), strict=True))
        found = []
        for edge in _block_links(rows, percent):
            found.append(edge)
            if len(found) >= 10_000:
                yield _edges(found)
                found = []
        yield _edges(found)

    ordered = tasks.repartition(spread(docs), "group", "i", "j").sortWithinPartitions("group", "i", "j", "side", "id")
    return mapped(ordered, work, "a bigint, b bigint")


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["a", "b"])


def _judged(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, mark, size, id) of every row, and the component (id, label) of each class that has links; docs has doc_id, mark and text."""
    for seed in range(8):
        rows = cut(_rows(docs, n, seed))
        classes = cut(rows.where("id is not null").groupBy("key").agg(F.first("id").alias("id"), F.min("doc_id").alias("first_id"), F.first("size").alias("size")))
        if classes.groupBy("id").count().where("count > 1").isEmpty():
            break
    else:
        raise RuntimeError("two sets share their 64-bit number under every seed")
    frequent = frequent_ngrams(docs, n)
    n_grams = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    pairs = _candidates(docs, n, percent, frequent, seed, max(spread(docs), -(-n_grams // BUCKET_GRAMS)))
    free(docs.sparkSession)
    direct = cut(_pair_links(docs, classes, pairs, n, percent, frequent))
    free(docs.sparkSession)
    groups, linked = components(pairs), components(direct)
    # what is left: groups whose pairs leave them in several components
    state = cut(groups.select("id", F.col("component").alias("group")).join(linked, "id", "left").select("id", "group", F.coalesce("component", "id").alias("label")))
    open_ = cut(state.groupBy("group").agg((F.min("label") != F.max("label")).alias("open")).where("open").select("group"))
    members = cut(state.join(open_, "group").join(classes.select("id", "size"), "id").select("id", "size", "group"))
    rest = direct.limit(0) if members.isEmpty() else cut(_group_links(docs, classes, members, percent, n))
    free(docs.sparkSession)
    merged = components(direct.unionByName(rest))
    return rows.select("doc_id", "mark", "size", "id"), merged.select("id", F.col("component").alias("label"))


def _with_marks(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Components of documents whose word n-gram sets have a Jaccard similarity of percent/100 or more.

    Words are runs of other than U+0020 and U+0009 to U+000D, A-Z lower-cased; a text with fewer than n words is
    one n-gram. Returns a row per input row: doc_id, size (of the set), component (smallest doc_id
    reachable by links, itself included). Null and empty texts, and those of white space only, have
    size 0 and link with nothing. Rows with equal ids and different texts are judged by their texts;
    a null doc_id never is the smallest unless its component has no other. Other columns are ignored; an empty table gives no rows.
    N-grams are compared by 64 bits of hash, whole sets by 128.
    """
    ids, merged = _judged(_with_marks(docs), n, percent)
    named = ids.join(merged, "id", "left").withColumn("label", F.coalesce("label", "id"))
    least = cut(named.where("id is not null").groupBy("label").agg(F.min("doc_id").alias("component")))
    return cut(named.join(least, "label", "left").select("doc_id", "size", F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component")))


def keep_one_per_component(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The documents with one row of each component, with all columns; those without words all stay.

    The smallest doc_id stays; a null one only in a component without another. Rows are judged by id and text
    together: of rows with one id, those with other texts stay or go by themselves, and of repeated rows one stays.
    Null texts have no words and stay. An empty table stays empty.
    """
    marked = _with_marks(docs)
    ids, merged = _judged(marked, n, percent)
    rows = ids.where("id is not null").groupBy("doc_id", "mark", "id").agg(F.count("*").alias("rows"))
    rows = cut(rows.join(merged, "id", "left").withColumn("label", F.coalesce("label", "id")))
    best = cut(rows.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("best")))
    placed = rows.join(best, "label").select("doc_id", "mark", "rows", (F.col("best.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("best.mark") == F.col("mark"))).alias("stays"))
    gone = cut(placed.where("not stays").select(F.col("doc_id").alias("__id"), F.col("mark").alias("__gone")))
    again = cut(placed.where("stays and rows > 1").select(F.col("doc_id").alias("__id"), F.col("mark").alias("__gone")))
    kept = docs.withColumn("__mark", F.xxhash64("text"))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("__id")) & (F.col("__mark") == F.col("__gone"))
    if gone.count() <= GONE_ROWS:
        left = kept.join(F.broadcast(gone), same, "left_anti")
    else:
        maybe, others = by_ids(kept, gone, "doc_id", "__id")
        left = maybe.join(gone, same, "left_anti").unionByName(others)
    if not again.isEmpty():
        twice = left.join(small(again, GONE_ROWS), same, "left_semi").dropDuplicates(["doc_id", "__mark"])
        left = left.join(small(again, GONE_ROWS), same, "left_anti").unionByName(twice)
    return left.drop("__mark")
