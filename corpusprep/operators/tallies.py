"""Words and pairs of tokens, counted inside a task for each batch of documents.

A row leaves the task for each distinct word or pair of a batch, not for each
word of a text. Counts of batches add up to those of a corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from corpusprep.functions.text import ALPHA, WORD
from corpusprep.operators.points import flags, in_class
from corpusprep.operators.trigrams import slices

# Rows that a task hands over at once.
_ROWS = 100_000


def word_tallies(docs: DataFrame, text: Column, by: Column) -> DataFrame:
    """(by, word, n) of the ``functions.text.alpha_words`` of each batch of texts."""
    chosen = docs.select(by.alias("by"), text.alias("text"))
    schema = T.StructType([chosen.schema["by"]]).add("word", "string").add("n", "long")
    letters, others = (in_class(docs.sparkSession, c) for c in (ALPHA, f"[{WORD}&&[^{ALPHA}]]"))
    return chosen.mapInArrow(partial(_words, letters, others), schema)


def pair_tallies(docs: DataFrame, tokens: Column) -> DataFrame:
    """(w, nx, n) of each batch: how often token ``w`` is followed by ``nx``, which is null at a document's end."""
    schema = T.StructType().add("w", "string").add("nx", "string").add("n", "long")
    return docs.select(tokens.alias("tokens")).mapInArrow(_pairs, schema)


def _words(letters: bytes, others: bytes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = flags(letters) + 2 * flags(others).astype(np.uint8)
    for batch in batches:
        spoken: dict = {}
        for by, text in zip(batch["by"].to_pylist(), batch["text"].to_pylist()):
            if text is not None:
                spoken.setdefault(by, []).append(text)
        for by, texts in spoken.items():
            found = pa.concat_tables(_counted(texts[begin:end], kinds) for begin, end in slices(texts))
            found = found.group_by("word").aggregate([("n", "sum")])
            word = pc.cast(found["word"], pa.string()).combine_chunks()
            key = pa.array([by] * len(word), batch.schema.field("by").type)
            yield from _handed([key, word, found["n_sum"].combine_chunks()], ["by", "word", "n"])


def _counted(texts: list[str], kinds: np.ndarray) -> pa.Table:
    """(word, n): runs of letters, marks, digits and underscores that have letters only."""
    text = "\n".join([*texts, ""])
    letters = np.frombuffer(text.encode(), np.uint8)
    chars = np.frombuffer(text.encode("utf-32-le"), "<u4")
    kind = kinds[chars]
    edges = np.flatnonzero(np.diff(kind > 0, prepend=False))
    begins, ends = edges[::2], edges[1::2]
    other = np.append(0, np.cumsum(kind > 1))
    alpha = other[begins] == other[ends]
    begins, ends = begins[alpha], ends[alpha]
    if len(letters) > len(chars):
        place = np.append(0, np.cumsum(1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)))
        begins, ends = place[begins], place[ends]
    inside = np.zeros(len(letters) + 1, np.int8)
    inside[begins] = 1
    inside[ends] = -1
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    offsets = np.append(0, np.cumsum(ends - begins))
    words = pa.Array.from_buffers(pa.large_string(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(letters[inside])])
    coded = words.dictionary_encode()
    n = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
    return pa.table({"word": coded.dictionary, "n": pa.array(n, pa.int64())})


def _flat(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct tokens, the place of each token in them (-1 for null), and the number of tokens of each document."""
    coded = lists.flatten().dictionary_encode()
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return coded.dictionary, coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64), sizes


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        distinct, place, sizes = _flat(batch["tokens"])
        after = np.append(place[1:], -1)
        after[np.cumsum(sizes)[sizes > 0] - 1] = -1
        codes, n = np.unique((place * (len(distinct) + 1) + after + 1)[place >= 0], return_counts=True)
        place, after = np.divmod(codes, len(distinct) + 1)
        following = distinct.take(pa.array(after - 1, mask=after == 0))
        yield from _handed([distinct.take(pa.array(place)), following, pa.array(n, pa.int64())], ["w", "nx", "n"])


def _handed(columns: list[pa.Array], names: list[str]) -> Iterator[pa.RecordBatch]:
    rows = pa.RecordBatch.from_arrays(columns, names=names)
    for begin in range(0, len(rows), _ROWS):
        yield rows.slice(begin, _ROWS)
