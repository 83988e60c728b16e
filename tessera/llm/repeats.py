"""Removal of repeated passages by enhanced suffix arrays and their common-prefix interval tree.

A string of `length` bytes is a window. Every window has an anchor, the least hash of the k-grams in it,
so equal windows have equal anchors wherever they stand. Windows of one anchor that follow each other
are kept together as one stretch of bytes. Stretches meet by their anchor; those that are equal are one content with a
count, and only anchors with several contents are sorted.

All windows of an anchor are aligned at it, so the suffix array of a batch of contents splits by column:
going from right to left, each column's order and its array of longest common prefixes follow from
those of the column before. A stack scan of the prefix array gives the interval tree; intervals
whose occurrences differ in the byte to the left (or begin their stretch) are maximal repeats.

A stretch's content stands for its bytes within an anchor. The hash is a polynomial over scrambled lanes of eight bytes: one over
single bytes, modulo 2 ** 64, is the same for texts of Thue-Morse kind that differ, even at this size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, Powers, cut, mapped, mix, small, spread

LENGTH = 400
GRAM = 128
#: Bytes of a document that are scanned at once; windows over a border belong to the chunk they begin in.
CHUNK = 4 << 20
_POSITION = np.uint64((1 << 24) - 1)
#: Contents of an anchor that are sorted in one task; anchors with more have their windows counted by digest instead.
GROUP_CONTENTS = 4_096
BATCH_CONTENTS = 4_096


def stretches(raw: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """(start, size, offset of the anchor, anchor, content, times, span) of a document's stretches, as arrays chunk by chunk.

    A run of equal stretches in a row (text of one repeated byte) comes as its first, with `times` over 1 and the
    `span` of them all.
    """
    lane = min(8, gram)
    for base in range(0, len(raw) - length + 1, CHUNK):
        part = raw[base : base + CHUNK + length - 1]
        n = len(part)
        up, down = Powers.to(n + 1)
        lanes = np.ndarray((n - lane + 1,), "<u8", np.concatenate((part, np.zeros(8, np.uint8))), strides=(1,)) & np.uint64((1 << 8 * lane) - 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(lanes ^ BASE) * up[: len(lanes)])))
        grams = mix((sums[gram - lane + 1 :] - sums[: n - gram + 1]) * down[: n - gram + 1])
        least = grams & ~_POSITION | np.arange(len(grams), dtype=np.uint64)
        width, reach = length - gram + 1, 1
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < width:
            least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
        at = (least & _POSITION).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        last = np.concatenate((first[1:], [len(at)])) - 1
        anchor, size = at[first], last - first + length
        content = mix((sums[first + size - lane + 1] - sums[first]) * down[first] + size.astype(np.uint64))
        key = grams[anchor]
        new = np.concatenate(([True], (content[1:] != content[:-1]) | (key[1:] != key[:-1])))
        head = np.flatnonzero(new)
        times = np.diff(np.concatenate((head, [len(new)])))
        end = (first + size)[np.concatenate((head[1:], [len(new)])) - 1]
        yield first[head] + base, size[head], anchor[head] - first[head], key[head], content[head], times, end - first[head]


def _scan(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """A row per document with arrays of its stretches."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [[] for _ in range(7)]
            for text in batch.column(2):
                raw = np.frombuffer(text.as_buffer() or b"", np.uint8)
                found = [np.concatenate(x) for x in zip(*stretches(raw, length, gram), strict=True)] or [np.zeros(0, np.int64)] * 7
                for column, values in zip(columns, found, strict=True):
                    column.append(values)
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
            lists = []
            for column, kind in zip(columns, kinds, strict=True):
                offsets = np.concatenate(([0], np.cumsum([len(c) for c in column]))).astype(np.int32)
                flat = np.concatenate(column) if column else np.zeros(0, np.int64)
                flat = flat.view(np.int64) if flat.dtype == np.uint64 else flat.astype(kind.to_pandas_dtype())
                lists.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], ["doc_id", "h", "start", "size", "offset", "anchor", "content", "times", "span"])

    whole = docs.where(F.octet_length("text") >= length)
    return mapped(whole, work, "doc_id bigint, h bigint, start array<int>, size array<int>, offset array<int>, anchor array<bigint>, content array<bigint>, times array<int>, span array<int>")


def sort_columns(rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The enhanced suffix array of aligned strings by column, from right to left.

    rows: a string per row, -1 where it has not begun or has ended. Yields (column, order, common): rows in the order of what they
    have from the column on, and the length of the prefix that each shares with the one before.
    """
    m, width = rows.shape
    order, common = np.arange(m), np.zeros(m, np.int32)
    turned = np.ascontiguousarray(rows.T)
    levels = max(1, int(m).bit_length())
    for c in range(width - 1, -1, -1):
        symbol = turned[c][order]
        by = np.argsort(symbol, kind="stable")
        # least common prefix between two rows of equal symbol: a range minimum over the old array
        table = [common]
        for j in range(1, levels):
            step = 1 << (j - 1)
            if step >= m:
                break
            table.append(np.minimum(table[-1], np.concatenate((table[-1][step:], np.zeros(step, np.int32)))))
        before, here = by[:-1], by[1:]
        span = np.maximum(here - before, 1)
        level = np.log2(span).astype(np.int64)
        stacked = np.stack(table)
        low = np.minimum(stacked[level, np.minimum(before + 1, m - 1)], stacked[level, np.maximum(here - (1 << level) + 1, 0)])
        same = (symbol[before] == symbol[here]) & (symbol[here] >= 0)
        common = np.zeros(m, np.int32)
        common[1:] = np.where(same, low + 1, 0)
        order = order[by]
        yield c, order, common


def intervals(common: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """The interval tree of a prefix array by a stack scan: (length, first, last) of intervals of at least `least`, inner ones first."""
    out, stack = [], []
    for i in range(1, len(common) + 1):
        length, left = int(common[i]) if i < len(common) else 0, i - 1
        while stack and stack[-1][0] > length:
            depth, left = stack.pop()
            if depth >= least:
                out.append((depth, left, i - 1))
        if length and (not stack or stack[-1][0] < length):
            stack.append((length, left))
    return out


def maximal_repeats(contents: list[bytes], offsets: list[int], length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, int, list[int]]]:
    """(size, column start relative to the anchor, row numbers) of every maximal repeat of aligned contents."""
    left = length - gram
    rows = np.full((len(contents), left + length), -1, np.int16)
    for i, (content, offset) in enumerate(zip(contents, offsets, strict=True)):
        rows[i, left - offset : left - offset + len(content)] = np.frombuffer(content, np.uint8)
    for c, order, common in sort_columns(rows):
        long = np.flatnonzero(common >= length)
        if not len(long):
            continue
        before = rows[:, c - 1] if c else np.full(len(rows), -1, np.int16)
        # blocks of rows that share `length` bytes; those alike to the left as well are found one column on
        cuts = np.flatnonzero(np.diff(long) > 1) + 1
        for block in np.split(long, cuts):
            first, last = block[0] - 1, block[-1]
            symbols = before[order[first : last + 1]]
            if symbols[0] >= 0 and (symbols == symbols[0]).all():
                continue
            for size, a, b in intervals(common[first : last + 1], length):
                own = symbols[a : b + 1]
                if own[0] < 0 or (own != own[0]).any():
                    yield size, c - left, order[first + a : first + b + 1].tolist()


def _verdicts(mixed: DataFrame, length: int, gram: int) -> DataFrame:
    """(anchor, content, lows, highs): the repeated byte ranges of contents (anchor, content, offset, n, body)."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current, group = [], None, []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if row[0] != current:
                    held += group
                    current, group = row[0], []
                    if len(held) >= BATCH_CONTENTS:
                        yield judged(held)
                        held = []
                group.append(row)
        held += group
        if held:
            yield judged(held)

    def judged(held: list[tuple]) -> pa.RecordBatch:
        covered = [[(0, len(body))] if n > 1 else [] for _, _, _, n, body in held]
        for size, column, rows in maximal_repeats([r[4] for r in held], [r[2] for r in held], length, gram):
            for r in rows:
                covered[r].append((held[r][2] + column, held[r][2] + column + size))
        merged = [_merged(c) for c in covered]
        keep = [i for i, c in enumerate(merged) if c]
        return pa.RecordBatch.from_arrays([pa.array([held[i][0] for i in keep], pa.int64()), pa.array([held[i][1] for i in keep], pa.int64()), pa.array([[a for a, _ in merged[i]] for i in keep], pa.list_(pa.int32())), pa.array([[b for _, b in merged[i]] for i in keep], pa.list_(pa.int32()))], ["anchor", "content", "lows", "highs"])

    placed = mixed.select("anchor", "content", "offset", "n", "body").repartition(spread(mixed), "anchor").sortWithinPartitions("anchor", "content")
    return mapped(placed, work, "anchor bigint, content bigint, lows array<int>, highs array<int>")


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _by_digest(hot: DataFrame, length: int) -> DataFrame:
    """As _verdicts, for anchors with very many contents: each window's digest is counted, a window is a row."""

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, content, offset, n, body in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                starts = range(len(body) - length + 1)
                digests = [hashlib.blake2b(body[s : s + length], digest_size=16).digest() for s in starts]
                k = len(digests)
                yield pa.RecordBatch.from_arrays([pa.array([anchor] * k, pa.int64()), pa.array([content] * k, pa.int64()), pa.array(starts, pa.int32()), pa.array([n] * k, pa.int64()), pa.array(digests, pa.binary())], ["anchor", "content", "low", "n", "digest"])

    rows = cut(mapped(hot.select("anchor", "content", "offset", "n", "body"), windows, "anchor bigint, content bigint, low int, n bigint, digest binary"))
    often = cut(rows.groupBy("anchor", "digest").agg(F.sum("n").alias("all")).where("all > 1").select("anchor", "digest"))
    met = rows.join(often, ["anchor", "digest"], "left_semi").groupBy("anchor", "content").agg(F.collect_list("low").alias("lows"))
    return met.select("anchor", "content", "lows", F.transform("lows", lambda x: x + length).alias("highs"))


def repeated_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_contents: int = GROUP_CONTENTS) -> DataFrame:
    """(doc_id, h, low, high, anchor, content): byte ranges of texts that lie in a string of `length` bytes that starts anywhere else too.

    docs has doc_id, h (a hash of id and text) and text. Ranges of one document may overlap; equal (anchor,
    content) are occurrences of the same stretch. Strings are judged as bytes of UTF-8 and never cross documents.
    """
    scanned = cut(_scan(docs.select("doc_id", "h", "text"), length, gram))
    spots = scanned.select("doc_id", "h", F.explode(F.arrays_zip("start", "size", "offset", "anchor", "content", "times", "span")).alias("s")).select("doc_id", "h", "s.*")
    anchors = scanned.select(F.explode(F.arrays_zip("anchor", "content", "times")).alias("s")).select("s.*").groupBy("anchor").agg(F.sum("times").alias("n"), F.min("content").alias("low"), F.max("content").alias("high"))
    anchors = cut(anchors.where("n > 1").select("anchor", (F.col("low") != F.col("high")).alias("mixed")))
    met = cut(spots.join(anchors, "anchor"))
    # stretches whose anchor has no other content, and runs of equal ones, are repeats as they are
    alike = met.where("not mixed or times > 1").select("doc_id", "h", F.col("start").alias("low"), (F.col("start") + F.col("span")).alias("high"), "anchor", "content")
    contents = met.where("mixed").groupBy("anchor", "content").agg(F.sum("times").alias("n"), F.min(F.struct("doc_id", "h", "start", "size", "offset")).alias("at"))
    contents = cut(contents.select("anchor", "content", "n", "at.*"))
    per_doc = contents.groupBy("doc_id", "h").agg(F.collect_list(F.struct("start", "size", "offset", "anchor", "content", "n")).alias("wanted"))
    per_doc = cut(per_doc)
    sources = _only(docs, small(per_doc.select("doc_id", "h"), 200_000)).dropDuplicates(["doc_id", "h"])

    def bodies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, wanted in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                raw = bytes(text.as_buffer() or b"")
                cols = [[w[k] for w in wanted] for k in ("anchor", "content", "offset", "n")]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int64()), pa.array([raw[w["start"] : w["start"] + w["size"]] for w in wanted], pa.binary())], ["anchor", "content", "offset", "n", "body"])

    keyed = sources.join(per_doc.select(F.col("doc_id").alias("d2"), F.col("h").alias("h2"), "wanted"), F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("h") == F.col("h2"))).select("text", "wanted")
    cut_out = cut(mapped(keyed, bodies, "anchor bigint, content bigint, offset int, n bigint, body binary"))
    crowded = cut(contents.groupBy("anchor").count().where(F.col("count") > group_contents).select("anchor"))
    if crowded.isEmpty():
        verdicts = _verdicts(cut_out, length, gram)
    else:
        verdicts = _verdicts(cut_out.join(crowded, "anchor", "left_anti"), length, gram).unionByName(_by_digest(cut_out.join(crowded, "anchor", "left_semi"), length))
    verdicts = cut(verdicts)
    found = met.where("mixed").join(verdicts, ["anchor", "content"]).select("doc_id", "h", "start", "anchor", "content", F.explode(F.arrays_zip("lows", "highs")).alias("r"))
    found = found.select("doc_id", "h", (F.col("start") + F.col("r.lows")).alias("low"), (F.col("start") + F.col("r.highs")).alias("high"), "anchor", "content")
    return alike.unionByName(found)


def _only(docs: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    k = keys.select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"))
    return docs.join(k, docs["doc_id"].eqNullSafe(k["__id"]) & (docs["h"] == k["__h"]), how)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_contents: int = GROUP_CONTENTS) -> DataFrame:
    """Remove each byte that lies in a string of `length` bytes which also starts elsewhere, in the same document or another.

    Returns a row per input row: doc_id, n_bytes, n_removed, lows and highs (the maximal removed runs,
    byte positions, ends exclusive), kept (binary, the bytes that stay). Null texts count as empty, texts under `length` bytes
    keep all; overlapping occurrences count; strings are judged on the input. Rows with equal doc_id and
    text repeat each other and are removed where they are long enough. A null doc_id is a value
    like any other, other columns are ignored, an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("h"), "text")
    ranges = repeated_ranges(docs, length, gram, group_contents)
    per_doc = cut(ranges.select("doc_id", "h", "low", "high").groupBy("doc_id", "h").agg(F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs")))
    keys = small(per_doc.select("doc_id", "h"), 200_000)

    def strip(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, text, lows, highs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                raw = bytes(text.as_buffer() or b"")
                runs = _merged(list(zip(lows, highs, strict=True)))
                kept, at = [], 0
                for a, b in runs:
                    kept.append(raw[at:a])
                    at = b
                kept.append(raw[at:])
                yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), pa.array([len(raw)], pa.int64()), pa.array([sum(b - a for a, b in runs)], pa.int64()), pa.array([[a for a, _ in runs]], pa.list_(pa.int64())), pa.array([[b for _, b in runs]], pa.list_(pa.int64())), pa.array([b"".join(kept)], pa.binary())], ["doc_id", "n_bytes", "n_removed", "lows", "highs", "kept"])

    marked = per_doc.select(F.col("doc_id").alias("d2"), F.col("h").alias("h2"), "lows", "highs")
    touched = _only(docs, keys).join(marked, F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("h") == F.col("h2"))).select("doc_id", "text", "lows", "highs")
    stripped = mapped(touched, strip, "doc_id bigint, n_bytes bigint, n_removed bigint, lows array<bigint>, highs array<bigint>, kept binary")
    nothing = F.array().cast("array<bigint>")
    whole = _only(docs, keys, "left_anti").select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), F.lit(0).cast("bigint").alias("n_removed"), nothing.alias("lows"), nothing.alias("highs"), F.col("text").cast("binary").alias("kept"))
    return whole.unionByName(stripped)
