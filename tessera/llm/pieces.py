"""Sentencepiece BPE by a table of prefixes.

Merges only ever join neighbours, so cutting the encoding of a text behind any of its tokens leaves the encoding of that
prefix. Every prefix thus has one last token, and a token ends a prefix exactly if it is compatible with the
last token of what stands before it: if the library, given the two alone, would return the two. An automaton over all pieces
names the tokens that end at each character, the test picks the one, and ids are read off the table from its end.

Texts are cut first where no piece reaches across, which changes nothing and lets a worker remember words.
"""

from __future__ import annotations

import hashlib
import math
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import mapped

#: Words that a worker remembers with their ids, characters of the longest one, and pairs of tokens that it has tested.
CACHE_WORDS = 200_000
CACHE_CHARS = 64
CACHE_PAIRS = 300_000
SPACE = "▁"


class PieceModel:
    """Encodes with a sentencepiece BPE model by the prefix table and decodes with the library."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        self.library = library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = library.get_piece_size()
        self.piece = [library.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i))]
        if any(library.is_unused(i) for i in plain):
            raise ValueError("models with unused pieces are not supported")
        self.of_byte = {int(self.piece[i][1:-1], 16): i for i in range(n) if library.is_byte(i)}
        if len(self.of_byte) != 256:
            raise ValueError("the model has no piece for every byte")
        #: What is merged first has the least cost; equal costs go from left to right.
        self.cost = {self.piece[i]: -library.get_score(i) for i in plain}
        self.automaton = ahocorasick.Automaton()
        for i in plain:
            self.automaton.add_word(self.piece[i], i)
        self.automaton.make_automaton()
        self.end_ids = (library.eos_id(),)
        self.words = _word_finder([self.piece[i] for i in plain])
        self.merges: dict[int, tuple | None] = {}
        self.pairs: dict[int, bool] = {}
        self.size = [len(p) for p in self.piece]
        self.decimal = [str(i) for i in range(n)]
        #: Words and their ids as 32-bit integers; when the one is full it becomes the older one.
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _text(self, token: int) -> str:
        """A token's characters; those from n on stand for a character without a piece."""
        n = len(self.piece)
        return self.piece[token] if token < n else chr(token - n)

    def _history(self, token: int) -> tuple[list[float], list[str], list[str]] | None:
        """Costs of the merges that build a token, and its first and last symbol before each and after all; None if merges don't build it."""
        if token in self.merges:
            return self.merges[token]
        symbols, costs = list(self._text(token)), []
        heads, tails = [symbols[0]], [symbols[-1]]
        while len(symbols) > 1:
            best, at = min((self.cost.get(symbols[i] + symbols[i + 1], math.inf), i) for i in range(len(symbols) - 1))
            if best == math.inf:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            costs.append(best)
            heads.append(symbols[0])
            tails.append(symbols[-1])
        found = (costs, heads, tails) if len(symbols) == 1 else None
        self.merges[token] = found
        return found

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges of two tokens side by side end with the two: no merge across their border comes first.

        Both histories run in the order of costs, the left one first where costs are equal, as its merges stand further left.
        """
        a, b = self._history(left), self._history(right)
        if a is None or b is None:
            return False
        i = j = 0
        while True:
            next_a = a[0][i] if i < len(a[0]) else math.inf
            next_b = b[0][j] if j < len(b[0]) else math.inf
            across = self.cost.get(a[2][i] + b[1][j], math.inf)
            if across < next_a and across <= next_b and across != math.inf:
                return False
            if next_a == next_b == math.inf:
                return True
            if next_a <= next_b:
                i += 1
            else:
                j += 1

    def _table(self, word: str) -> list[int]:
        """The last token of every prefix of a word, by the prefix's length."""
        pairs, size, n = self.pairs, self.size, len(self.piece)
        if len(pairs) > CACHE_PAIRS:
            pairs.clear()
        last = [n + ord(c) for c in word]  # a character that no token ends at stands for itself
        done = -1
        for end, token in self.automaton.iter(word):
            if end == done:
                continue
            before = end - size[token]
            if before < 0:
                fits = self._history(token) is not None
            else:
                key = last[before] << 22 | token  # ids stay under 2 ** 22: pieces and code points
                fits = pairs.get(key)
                if fits is None:
                    fits = pairs[key] = self.compatible(last[before], token)
            if fits:
                last[end], done = token, end
        return last

    def _word_ids(self, word: str) -> bytes:
        """Ids of a word as 32-bit integers, from the table's end backwards; characters without a piece become their bytes."""
        last, size, n, at, out = self._table(word), self.size, len(self.piece), len(word), []
        while at > 0:
            token = last[at - 1]
            if token < n:
                out.append(token)
                at -= size[token]
            else:
                out += [self.of_byte[b] for b in reversed(chr(token - n).encode())]
                at -= 1
        out.reverse()
        return array("i", out).tobytes()

    def encode(self, text: str) -> list[int]:
        """Ids of a text, then the end id."""
        words = self.words(self.library.normalize(text))
        if len(self.cache) > CACHE_WORDS:
            self.older, self.cache = self.cache, {}
        cache, older, long = self.cache, self.older, {}
        for word in set(words).difference(cache):
            keep = cache if len(word) <= CACHE_CHARS and len(cache) <= 2 * CACHE_WORDS else long
            keep[word] = older.get(word) or self._word_ids(word)
        found = map(cache.__getitem__, words) if not long else (cache.get(w) or long[w] for w in words)
        return [*array("i", b"".join(found)), *self.end_ids]

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


def _word_finder(pieces: list[str]):
    """findall that cuts a normalised text only between characters that stand side by side in no piece.

    Words are runs of spaces, then other characters, then letters, as far as the pieces allow for such cuts; a character that
    occurs in no longer piece is a word of its own. A vocabulary that joins these otherwise isn't cut at all.
    """
    beside = {(a, b) for piece in pieces for a, b in zip(piece, piece[1:], strict=False)}
    joined = {c for pair in beside for c in pair}
    letters, others = {c for c in joined if c.isalpha()}, {c for c in joined if not c.isalpha() and c != SPACE}
    if any(b == SPACE != a or (a in letters and b in others) for a, b in beside):
        return lambda text: [text] if text else []
    spell = lambda chars: "".join(map(re.escape, sorted(chars)))
    letter, other = (f"[{spell(x)}]" if x else "(?!)" for x in (letters, others))
    return re.compile(f"{SPACE}*{other}*{letter}+|{SPACE}*{other}+|{SPACE}+|.", re.DOTALL).findall


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    """One model a worker and file."""
    return PieceModel(path)


def encode_pieces(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>, decoded string) of every whole text, a row per input row; ids end with the model's end id.

    Null texts count as empty and have the end id only. Null doc_ids pass through, repeated rows give repeated
    results, other columns are ignored, an empty table gives no rows. The model is read from `path` on each executor.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            for row in range(batch.num_rows):
                ids = model.encode(batch.column(1)[row].as_py() or "")
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, 1), pa.array([ids], pa.list_(pa.int32())), pa.array([model.decode(ids)], pa.string())], ["doc_id", "ids", "decoded"])

    return mapped(docs.selectExpr("cast(doc_id as bigint) doc_id", "text"), work, "doc_id bigint, ids array<int>, decoded string")


def piece_digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode_pieces with digests in place of the long columns.

    The ids are joined by spaces, the digests are lowercase hex; rows are treated as in encode_pieces.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        decimal = model.decimal.__getitem__
        for batch in batches:
            n, hashed, decoded = [], [], []
            for text in batch.column(1):
                ids = model.encode(text.as_py() or "")
                n.append(len(ids))
                hashed.append(hashlib.sha256(" ".join(map(decimal, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(model.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(hashed), pa.array(decoded)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return mapped(docs.selectExpr("cast(doc_id as bigint) doc_id", "text"), work, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
