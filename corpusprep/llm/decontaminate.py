"""Benchmark decontamination with an FM-index per shard of documents.

A window is a run of ``window`` words of a benchmark item; an item with fewer words is one window. Each task builds an
FM-index over the words of a shard of its documents, searches all windows in it backwards, and locates the occurrences by
the sampled positions. Words inside an occurrence are hit; runs of them are the spans to remove.

Words that no item has end an occurrence just as the end of a document does, so each run of such words stands as one
separator in the index, and runs of benchmark words shorter than the shortest window are left out of it. Nothing that
could hold a window is.

The benchmark is the query set: the driver reads it in blocks of at most ``BLOCK_BYTES`` bytes of text, and each block is
sent to the tasks by itself. Documents stay where they are read; only with several blocks are findings of a document
brought together by a shuffle.

Defined results: a null text has no words, and a text or item without words has no windows. An item with a null id
removes words but is not listed. Items that repeat are listed once. Texts of any length are read whole. Rows of documents
that repeat each get their own, equal, result. Empty tables give empty results, an empty benchmark no hits. Other columns
of the input stay; the one for the result is replaced.
"""

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.llm.common import col, fresh, strings
from corpusprep.llm.fm_index import FMIndex
from corpusprep.work import written

WINDOW = 10
BLOCK_BYTES = 4 << 20
#: Bytes of text in a shard, unless one document has more.
SHARD_BYTES = 16 << 20

SEPARATOR = 1
_LOWER = bytes(
    ord(" ") if c < 0x30 or 0x3A <= c <= 0x40 or 0x5B <= c <= 0x60 or 0x7B <= c <= 0x7F else c + 32 * (0x41 <= c <= 0x5A)
    for c in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

#: Words as numbers from 0, spans of characters (end excluded), and the ids of items as strings.
RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField(c, T.IntegerType()) for c in ("start", "end")]))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def words_of(text: str | None) -> list[bytes]:
    """Runs of letters and digits and of all that is not ASCII, with A-Z in lower case."""
    return (text or "").encode().translate(_LOWER).split()


class Phrases:
    """The windows of a block of items as rows of word numbers, right-aligned, and the items that each is from."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.numbers: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set] = defaultdict(set)
        for item, text in items:
            words = [self.numbers.setdefault(w, len(self.numbers) + SEPARATOR + 1) for w in words_of(text)]
            for start in range(max(1, len(words) - window + 1) if words else 0):
                found[tuple(words[start : start + window])].add(item)
        self.lengths = np.array([len(w) for w in found], np.int64)
        self.rows = np.zeros((len(found), window), np.int64)
        for row, phrase in zip(self.rows, found):
            row[window - len(phrase) :] = phrase
        self.items = [sorted(i for i in of if i is not None) for of in found.values()]

    def search(self, texts: list[str | None]) -> list[tuple[int, np.ndarray, list[str]]]:
        """For each text of a shard the number of its words, the places of the hit ones, and the items."""
        parts, sizes = [], []
        for text in texts:
            words = words_of(text)
            sizes.append(len(words))
            parts.append(np.fromiter(map(self.numbers.get, words, repeat(0)), np.int32, len(words)))
            parts.append(np.zeros(1, np.int32))  # no window goes on into the next text
        nothing = np.zeros(0, np.int64)
        if not len(self.rows) or not parts:
            return [(n, nothing, []) for n in sizes]
        symbols = np.concatenate(parts)
        first = np.concatenate(([0], np.cumsum(np.array(sizes) + 1)))
        edges = np.flatnonzero(np.diff(np.concatenate(([0], symbols > 0, [0]))))
        starts, ends = edges[::2], edges[1::2]
        enough = ends - starts >= self.lengths.min()
        starts, ends = starts[enough], ends[enough]
        hit = np.zeros(len(symbols) + 1, np.int64)
        owners: dict[int, set] = defaultdict(set)
        if len(starts):
            lengths = ends - starts + 1  # with the separator behind each run
            within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            places = np.repeat(starts, lengths) + within
            index = FMIndex(np.where(within == np.repeat(ends - starts, lengths), SEPARATOR, symbols[places]))
            low, high = index.search(self.rows, self.lengths)
            times = high - low
            which = np.repeat(np.arange(len(times)), times)
            suffixes = np.repeat(low - (np.cumsum(times) - times), times) + np.arange(times.sum())
            at = places[index.locate(suffixes)]
            np.add.at(hit, at, 1)
            np.add.at(hit, at + self.lengths[which], -1)
            docs = np.searchsorted(first, at, side="right") - 1
            for doc, phrase in np.unique(np.stack((docs, which), axis=1), axis=0).tolist():
                owners[doc].update(self.items[phrase])
        inside = np.flatnonzero(np.cumsum(hit) > 0)
        bounds = np.searchsorted(inside, first)
        return [
            (n, inside[bounds[k] : bounds[k + 1]] - first[k], sorted(owners[k]) if k in owners else [])
            for k, n in enumerate(sizes)
        ]


def merged_spans(text: str, hit: np.ndarray) -> list[dict[str, int]]:
    """The runs of hit words as spans of characters."""
    if not len(hit):
        return []
    places = [m.span() for m in _WORD.finditer(text)]
    cuts = np.flatnonzero(np.diff(hit) > 1)
    runs = zip(hit[np.concatenate(([0], cuts + 1))].tolist(), hit[np.concatenate((cuts, [len(hit) - 1]))].tolist())
    return [{"start": places[a][0], "end": places[b][1]} for a, b in runs]


def shards(texts: list[str | None]) -> Iterator[list[str | None]]:
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text or "")
        if size >= SHARD_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def _search_column(text: Column, phrases) -> Column:
    @F.pandas_udf(RESULT)
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for shard in shards(strings(batch)):
                for text, (n, hit, items) in zip(shard, phrases.value.search(shard)):
                    rows.append((n, len(hit), merged_spans(text or "", hit), items))
            yield pd.DataFrame(rows, columns=RESULT.names)

    return apply.asNondeterministic()(text)


def _joined(text: Column, findings: Column) -> Column:
    """One finding from those of several blocks."""

    @F.pandas_udf(RESULT)
    def apply(texts: pd.Series, many: pd.Series) -> pd.DataFrame:
        rows = []
        for text, found in zip(strings(texts), many):
            taken = np.zeros(len(text or "") + 1, bool)
            for one in found:
                for span in one["spans"]:
                    taken[span["start"] : span["end"]] = True
            hit = np.array([k for k, m in enumerate(_WORD.finditer(text or "")) if taken[m.start()]], np.int64)
            items = sorted({i for one in found for i in one["items"]})
            rows.append((max((one["n_words"] for one in found), default=0), len(hit), merged_spans(text or "", hit), items))
        return pd.DataFrame(rows, columns=RESULT.names)

    return apply(text, findings)


def benchmark_blocks(
    benchmark: DataFrame, item_col: str, text_col: str, max_bytes: int
) -> Iterator[list[tuple[str | None, str | None]]]:
    """The items (id as string, text) in blocks of about ``max_bytes`` bytes; an item is never split."""
    items = benchmark.select(
        col(item_col).cast("string").alias("item"), F.coalesce(col(text_col), F.lit("")).alias("text")
    ).distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0))).first()[0]
    count = -(-total // max(1, max_bytes // 2)) if total > max_bytes else 1
    for k in range(count):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == k).orderBy("item", "text").collect()
        yield [(r.item, r.text) for r in rows]


def find_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    out: str = "overlap",
    max_block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with a struct column ``out`` (``RESULT``)."""
    return _with_findings(docs, _sent(benchmark, item_col, item_text_col, window, max_block_bytes), text_col, out)


def _sent(benchmark: DataFrame, item_col: str, text_col: str, window: int, max_bytes: int) -> list:
    """A broadcast for each block of the benchmark."""
    context = benchmark.sparkSession.sparkContext
    return [context.broadcast(Phrases(items, window)) for items in benchmark_blocks(benchmark, item_col, text_col, max_bytes)]


def _with_findings(docs: DataFrame, sent: list, text_col: str, out: str) -> DataFrame:
    if len(sent) == 1:
        return docs.withColumn(out, _search_column(col(text_col), sent[0]))
    docs = docs.drop(out)
    key = fresh("row", docs)
    numbered = written(docs.withColumn(key, F.monotonically_increasing_id()), "numbered")
    parts = [
        numbered.select(key, _search_column(col(text_col), phrases).alias("one")).where(
            (F.size("one.spans") > 0) | F.lit(i == 0)
        )
        for i, phrases in enumerate(sent)
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionAll(part)
    many = fresh("findings", numbered)
    found = union.groupBy(key).agg(F.collect_list("one").alias(many))  # as many as there are blocks
    return numbered.join(found, key).withColumn(out, _joined(col(text_col), F.col(many))).drop(many, key)


def cut(text: str, spans: list) -> str:
    kept, end = [], 0
    for span in spans:
        kept.append(text[end : span["start"]])
        end = span["end"]
    return "".join(kept) + text[end:]


def cleaned(texts: list[str | None], spans: list, blocks: list[Phrases]) -> list[str | None]:
    """Texts without the spans found in them, and without what their removal has brought together; None where none was."""
    out: list[str | None] = [None] * len(texts)
    changed = [k for k, s in enumerate(spans) if s is not None and len(s)]
    for k in changed:
        out[k] = cut(texts[k], list(spans[k]))
    while changed:
        hits = defaultdict(list)
        for phrases in blocks:  # all of them on the same text, so that it does not matter how items are put into blocks
            for k, (_, hit, _) in zip(changed, phrases.search([out[k] for k in changed])):
                if len(hit):
                    hits[k].append(hit)
        for k, several in hits.items():
            out[k] = cut(out[k], merged_spans(out[k], np.unique(np.concatenate(several))))
        changed = sorted(hits)
    return out


def _clean_column(text: Column, found: Column, sent: list) -> Column:
    @F.pandas_udf("string")
    def apply(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series(cleaned(strings(texts), spans.tolist(), [phrases.value for phrases in sent]), dtype=object)

    return apply(text, found)


def _search_and_clean_column(text: Column, phrases) -> Column:
    """The finding and the cleaned text (null if nothing was cut), from one Python worker."""

    @F.pandas_udf(T.StructType([*RESULT.fields, T.StructField("clean", T.StringType())]))
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for shard in shards(strings(batch)):
                found = phrases.value.search(shard)
                spans = [merged_spans(text or "", hit) for text, (_, hit, _) in zip(shard, found)]
                clean = cleaned(shard, spans, [phrases.value])
                rows += [(n, len(hit), s, items, c) for (n, hit, items), s, c in zip(found, spans, clean)]
            yield pd.DataFrame(rows, columns=[*RESULT.names, "clean"])

    return apply.asNondeterministic()(text)


def remove_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    out: str = "overlap",
    max_block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """As ``find_overlaps``, with the spans cut out of the text. No document goes.

    Where cutting brings words together that make a window, they are cut too, until the text has none.
    """
    sent = _sent(benchmark, item_col, item_text_col, window, max_block_bytes)
    if len(sent) == 1:
        both = fresh("found", docs)
        found = docs.withColumn(both, _search_and_clean_column(col(text_col), sent[0]))
        result = F.struct(*[F.col(f"{both}.{name}") for name in RESULT.names])
        found = found.withColumn(text_col, F.coalesce(F.col(f"{both}.clean"), col(text_col)))
        return found.withColumn(out, result).drop(both)
    found = _with_findings(docs, sent, text_col, out)
    clean = F.when(F.size(f"{out}.spans") > 0, _clean_column(col(text_col), F.col(f"{out}.spans"), sent))
    return found.withColumn(text_col, F.coalesce(clean, col(text_col)))
