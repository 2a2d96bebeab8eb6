"""Byte-level BPE: encoding and decoding as monoid trees.

A text is cut into pieces by the vocabulary's pattern, and each piece is encoded by itself. The encoding of a piece is a
reduction over a binary tree: its halves are encoded, and the join repairs what the cut has separated. To join, a window
around the boundary is encoded anew; it grows until its outermost tokens are the ones that stood there before, or it has
reached the ends.

Why this is exact: merges happen in order of rank and each involves neighbours only. Let every two neighbouring tokens
of a sequence be what BPE makes of their joined bytes. Then BPE makes the whole sequence of all the bytes: consider the
first merge that would cross one of the boundaries; until then the two tokens beside it were built up as if they stood
alone, so the same merge would have happened for the two alone. Inside each half, inside the window, and where window
and half meet in an unchanged token, neighbours are such pairs.

Decoding concatenates the bytes of the tokens, again in halves up the tree.

Defined results: a null text counts as empty; an empty text has no tokens and decodes to no bytes. A piece may be as long
as the text; its encoding takes n log n steps. Each row is encoded for itself, so repeated rows get equal results, and an
empty table gives an empty result. Other columns of the input stay; those with the names of the results are replaced.
"""

import base64
import heapq
import re
from collections.abc import Iterator
from functools import cache, lru_cache
from struct import pack

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm.common import batches, col, fresh, strings

LEAF_BYTES = 6
#: Encoded pieces and short runs that a worker keeps for the next time they come, up to these lengths. Results do not
#: depend on it.
REMEMBERED_PIECES = 150_000
REMEMBERED_CHARACTERS = 32
REMEMBERED_RUNS = 100_000
RUN_BYTES = 12
#: Longer runs are merged with a heap.
HEAP_BYTES = 96

#: Texts of which the results are handed on together.
ROWS_AT_ONCE = 250

_NONE = 1 << 62

#: Up to this character both libraries agree on what letters and numbers are.
_SAME_UP_TO = "\u0557"
_MAY_DIFFER = re.compile("[^\x00-\u0557]")


@cache
def _classes() -> tuple:
    ranks = {bytes([i]): i for i in range(256)}
    theirs = [tiktoken.Encoding(p, pat_str=p, mergeable_ranks=ranks, special_tokens={}) for p in (r"\p{L}", r"\p{N}")]
    return theirs, [regex.compile(p) for p in (r"\p{L}", r"\p{N}")]


@lru_cache(maxsize=100_000)
def _stand_in(character: str) -> str:
    """A character of the class that the tokenizer library has for ``character``; empty if ``regex`` has the same."""
    theirs, ours = _classes()
    expected = [bool(e.encode_ordinary(character)) for e in theirs]
    if expected == [bool(p.match(character)) for p in ours]:
        return ""
    return "a" if expected[0] else "1" if expected[1] else "!"


class Vocabulary:
    """Ranks of tokens and the pattern that cuts texts into pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # pieces of the time before ``known`` was full
        self.runs: dict[bytes, list[int]] = {}

    @classmethod
    def from_text(cls, text: str, pattern: str) -> "Vocabulary":
        """From lines of a token in base 64 and its rank."""
        pairs = (line.split() for line in text.splitlines() if line.strip())
        return cls({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)

    def merged(self, data: bytes) -> list[int]:
        """The tokens of a run of bytes, by merging the pair of lowest rank, leftmost first, until no pair has a rank."""
        ids = self.runs.get(data)
        if ids is None:
            ids = self._merged_short(data) if len(data) <= HEAP_BYTES else self._merged_long(data)
            if len(data) <= RUN_BYTES:
                if len(self.runs) >= REMEMBERED_RUNS:
                    self.runs.clear()
                self.runs[data] = ids
        return ids

    def _merged_short(self, data: bytes) -> list[int]:
        rank_of = self.ranks.get
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = [rank_of(data[i : i + 2], _NONE) for i in range(len(data) - 1)]  # of each part with the next
        while ranks:
            best = min(ranks)
            if best == _NONE:
                break
            i = ranks.index(best)
            part = parts[i] = parts[i] + parts.pop(i + 1)
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank_of(part + parts[i + 1], _NONE)
            if i:
                ranks[i - 1] = rank_of(parts[i - 1] + part, _NONE)
        return [self.ranks[p] for p in parts]

    def _merged_long(self, data: bytes) -> list[int]:
        """The same with a heap of pairs. Entries whose place has changed since are skipped."""
        ranks, n = self.ranks, len(data)
        ends = list(range(1, n + 1))  # of the part that starts there; 0 for none
        before = list(range(-1, n - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(start: int) -> None:
            middle = ends[start]
            if middle < n:
                rank = ranks.get(data[start : ends[middle]])
                if rank is not None:
                    heapq.heappush(heap, (rank, start, ends[middle]))

        for start in range(n - 1):
            offer(start)
        while heap:
            _, start, end = heapq.heappop(heap)
            middle = ends[start]
            if not middle or middle >= n or ends[middle] != end:
                continue
            ends[start], ends[middle] = end, 0
            if end < n:
                before[end] = start
            offer(start)
            if before[start] >= 0:
                offer(before[start])
        out, start = [], 0
        while start < n:
            out.append(ranks[data[start : ends[start]]])
            start = ends[start]
        return out

    def reduced(self, data: bytes) -> list[int]:
        """The tokens of a run of bytes, by halves."""
        if len(data) <= LEAF_BYTES:
            return self.merged(data)
        middle = len(data) // 2
        return self.joined(self.reduced(data[:middle]), self.reduced(data[middle:]))

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        """The tokens of two neighbouring runs from the tokens of each."""
        width = 1
        while True:
            a, b = min(width, len(left)), min(width, len(right))
            first, last = left[-a], right[b - 1]
            if width == 1:
                new = self.merged(self.token_bytes[first] + self.token_bytes[last])
            else:
                new = self.merged(b"".join(map(self.token_bytes.__getitem__, left[len(left) - a :] + right[:b])))
            if (a == len(left) or new[0] == first) and (b == len(right) or new[-1] == last):
                return left[: len(left) - a] + new + right[b:]
            width *= 2

    def encode_piece(self, piece: str) -> bytes:
        data = piece.encode()
        rank = self.ranks.get(data)
        ids = [rank] if rank is not None else self.reduced(data)
        return pack(f"<{len(ids)}I", *ids)

    def pieces(self, text: str) -> list[str]:
        """The matches of the pattern, with letters and numbers as the tokenizer library has them.

        ``regex`` knows characters of a later Unicode version. Where a text has one that the two put in different
        classes, the matches are found in a text with stand-ins and cut out of the real one.
        """
        if not _MAY_DIFFER.search(text):
            return self.pattern.findall(text)
        stand_ins = {ord(c): s for c in set(text) if c > _SAME_UP_TO and (s := _stand_in(c))}
        if not stand_ins:
            return self.pattern.findall(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(stand_ins))]

    def encode(self, text: str) -> bytes:
        """The tokens of ``text`` as little-endian unsigned 32-bit numbers."""
        known, out = self.known, []
        for piece in self.pieces(text):
            ids = known.get(piece)
            if ids is None:
                ids = self.older.get(piece) or self.encode_piece(piece)
                if len(piece) <= REMEMBERED_CHARACTERS:
                    if len(known) >= REMEMBERED_PIECES:
                        self.older, self.known = known, {}
                        known = self.known
                    known[piece] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The bytes that little-endian unsigned 32-bit numbers stand for."""
        return self._concatenated(np.frombuffer(ids, "<u4").tolist())

    def _concatenated(self, ids: list[int]) -> bytes:
        if len(ids) <= 4096:
            return b"".join(map(self.token_bytes.__getitem__, ids))
        middle = len(ids) // 2
        return self._concatenated(ids[:middle]) + self._concatenated(ids[middle:])


_open: dict[tuple[str, str], Vocabulary] = {}


def vocabulary_in_task(file: str, pattern: str) -> Vocabulary:
    """The vocabulary that ``ship`` has sent along, read once per Python worker."""
    path = SparkFiles.get(file)
    if (path, pattern) not in _open:
        with open(path) as lines:
            _open[path, pattern] = Vocabulary.from_text(lines.read(), pattern)
    return _open[path, pattern]


def ship(spark: SparkSession, path: str) -> str:
    """Send a rank file to every executor; its name there. The files of public vocabularies have about a megabyte."""
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def encoded(text: Column, file: str, pattern: str) -> Column:
    """The packed tokens (little-endian unsigned 32-bit numbers) of a text."""

    @F.pandas_udf("binary")
    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = vocabulary_in_task(file, pattern)
        for batch in batches(texts, ROWS_AT_ONCE):
            yield pd.Series([vocabulary.encode(t or "") for t in strings(batch)], dtype=object)

    return encode.asNondeterministic()(text)  # so that no later step repeats the call


def coded(text: Column, file: str, pattern: str) -> Column:
    """The packed tokens of a text and the bytes that they decode to, from one Python worker: (token_ids, decoded)."""

    @F.pandas_udf("token_ids binary, decoded binary")
    def both(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vocabulary = vocabulary_in_task(file, pattern)
        for batch in batches(texts, ROWS_AT_ONCE):
            ids = [vocabulary.encode(t or "") for t in strings(batch)]
            yield pd.DataFrame({"token_ids": ids, "decoded": [vocabulary.decode(x) for x in ids]}, dtype=object)

    return both.asNondeterministic()(text)


def decoded(ids: Column, file: str, pattern: str) -> Column:
    """The bytes of packed tokens; null stays null."""

    @F.pandas_udf("binary")
    def decode(packed: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = vocabulary_in_task(file, pattern)
        for batch in batches(packed, ROWS_AT_ONCE):
            yield pd.Series([None if p is None else vocabulary.decode(p) for p in batch.tolist()], dtype=object)

    return decode.asNondeterministic()(ids)


def encode_documents(docs: DataFrame, vocabulary_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` (packed, see ``encoded``) and ``n_tokens``."""
    file = ship(docs.sparkSession, vocabulary_path)
    out = docs.withColumn("token_ids", encoded(col(text_col), file, pattern))
    return out.withColumn("n_tokens", (F.octet_length("token_ids") / 4).cast("bigint"))


def decode_documents(docs: DataFrame, vocabulary_path: str, pattern: str, ids_col: str = "token_ids") -> DataFrame:
    """``docs`` with ``decoded``, the bytes that the tokens in ``ids_col`` stand for."""
    file = ship(docs.sparkSession, vocabulary_path)
    return docs.withColumn("decoded", decoded(col(ids_col), file, pattern))


def round_trip(docs: DataFrame, vocabulary_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``token_ids``, ``n_tokens``, ``decoded``, and ``exact``: whether decoding gives the text back."""
    file = ship(docs.sparkSession, vocabulary_path)
    both = fresh("coded", docs)
    out = docs.withColumn(both, coded(col(text_col), file, pattern))
    exact = F.col(f"{both}.decoded") == F.encode(F.coalesce(col(text_col), F.lit("")), "UTF-8")
    return (
        out.withColumn("exact", exact)
        .withColumn("token_ids", F.col(f"{both}.token_ids"))
        .withColumn("n_tokens", (F.octet_length("token_ids") / 4).cast("bigint"))
        .withColumn("decoded", F.col(f"{both}.decoded"))
        .drop(both)
    )
