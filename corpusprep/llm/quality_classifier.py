"""Quality scores by histogram gradient-boosted trees over statistics of documents.

Each text becomes a row of numbers (``STATISTICS``). Training puts every statistic into at most ``BINS`` bins by its
quantiles and grows complete trees of one depth, level by level: for each node the gradients of the logistic loss are
summed per bin, and the cut of the largest gain is taken. The trees are kept as arrays (statistic and threshold of every
inner node, value of every leaf), and a batch of documents walks down all trees at once by numpy indexing.

Training reads at most ``max_rows`` labelled documents, those whose ids hash lowest; the driver gets their statistics,
never texts. Scoring reads every document where it is.

Defined results: a null text counts as empty; an empty one has statistics like any other. Texts of any length are read
whole. Equal texts get equal scores, also in repeated rows. Without labels of both kinds every score is the share of
label 1 among the labels, or 0.5 without any. An empty table gives an empty result. Other columns of the input stay; one
called ``score`` is replaced.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import starmap
from math import log1p
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import col, strings

STATISTICS = (
    "characters", "words", "word_length", "capitals", "digits", "symbols", "exclamations", "bars", "stops",
    "distinct_words", "equal_neighbours", "distinct_lines", "words_per_line", "ended_lines", "short_words", "other_bytes",
)
BINS = 64
MAX_ROWS = 20_000
THRESHOLD = 0.3

_CAPITALS = bytes(range(0x41, 0x5B))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&<>@^~=+_{}[]\\/"
_HIGH = bytes(range(0x80, 0x100))


def statistics(text: str | None) -> tuple[float, ...]:
    data = (text or "").encode()
    words = data.split()
    lines = [line for line in map(bytes.strip, data.split(b"\n")) if line]
    size, n, n_lines = max(1, len(data)), max(1, len(words)), max(1, len(lines))

    def share(characters: bytes) -> float:
        return 1 - len(data.translate(None, characters)) / size if data else 0.0

    return (
        log1p(len(data)),
        log1p(len(words)),
        sum(map(len, words)) / n,
        share(_CAPITALS),
        share(_DIGITS),
        share(_SYMBOLS),
        data.count(b"!") / n,
        data.count(b"|") / n,
        data.count(b".") / n,
        len(set(words)) / n,
        sum(starmap(eq, zip(words, words[1:]))) / n,
        len(set(lines)) / n_lines,
        log1p(len(words) / n_lines),
        sum(line.endswith((b".", b"!", b"?")) for line in lines) / n_lines,
        sum(map((4).__gt__, map(len, words))) / n,
        share(_HIGH),
    )


@dataclass(frozen=True)
class Trees:
    """``feature`` and ``threshold``: (trees, 2^depth - 1), children of node i at 2i + 1 and 2i + 2; ``leaf``: (trees, 2^depth)."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        trees, inner = self.feature.shape
        rows, each = np.arange(len(x))[:, None], np.arange(trees)[None, :]
        node = np.zeros((len(x), trees), np.int64)
        for _ in range((inner + 1).bit_length() - 1):
            right = x[rows, self.feature[each, node]] > self.threshold[each, node]
            node = 2 * node + 1 + right
        return _sigmoid(self.base + self.leaf[each, node - inner].sum(axis=1))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def grow(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, ridge: float = 1.0, least: float = 2.0
) -> Trees:
    """Boosted trees for rows ``x`` with labels 0 or 1. ``least``: the least sum of second derivatives in a child."""
    inner = 2**depth - 1
    features, thresholds = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    leaves = np.zeros((trees, inner + 1))
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    if len(set(y.tolist())) < 2:
        return Trees(base, features, thresholds, leaves)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS)[1:-1], method="lower")) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    n, m = x.shape
    columns = np.arange(m) * BINS
    margin = np.full(n, base)
    for t in range(trees):
        p = _sigmoid(margin)
        gradient, curve = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            nodes = 2**level
            cell = ((node * m * BINS)[:, None] + columns + binned).ravel()
            size = nodes * m * BINS
            g = np.bincount(cell, np.repeat(gradient, m), size).reshape(nodes, m, BINS).cumsum(axis=2)
            h = np.bincount(cell, np.repeat(curve, m), size).reshape(nodes, m, BINS).cumsum(axis=2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
            gain[(h < least) | (all_h - h < least)] = -1
            best = gain.reshape(nodes, -1).argmax(axis=1)
            value = gain.reshape(nodes, -1)[np.arange(nodes), best]
            f, cut = best // BINS, best % BINS
            split = value > 1e-9
            first = nodes - 1
            features[t, first : first + nodes] = np.where(split, f, 0)
            for k in np.flatnonzero(split):
                thresholds[t, first + k] = edges[f[k]][cut[k]]
            right = split[node] & (binned[np.arange(n), f[node]] > cut[node])
            node = 2 * node + right
        g, h = np.bincount(node, gradient, inner + 1), np.bincount(node, curve, inner + 1)
        leaves[t] = -rate * g / (h + ridge)
        margin += leaves[t][node]
    return Trees(base, features, thresholds, leaves)


def _statistics_column(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def apply(texts: pd.Series) -> pd.Series:
        return pd.Series([list(statistics(t)) for t in strings(texts)], dtype=object)

    return apply(text)


def held_out(id_: Column, folds: int = 5) -> Column:
    """Whether a document is kept from training: the CRC-32 of its id as text is divisible by ``folds``."""
    return F.coalesce(F.crc32(id_.cast("string")) % folds == 0, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_rows: int = MAX_ROWS,
    folds: int = 5,
) -> Trees:
    """Trees from at most ``max_rows`` labelled documents that are not held out.

    Ids and labels that are null are left out; an id with several labels takes the smallest.
    """
    marks = (
        labels.select(col(id_col).alias("id"), col(label_col).cast("int").alias("label"))
        .dropna()
        .where(~held_out(F.col("id"), folds))
        .groupBy("id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(max_rows)
    )
    texts = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    found = texts.join(F.broadcast(marks), "id").select("id", "label", _statistics_column(F.col("text")).alias("x"))
    rows = found.orderBy(F.xxhash64("id"), "id", "x").limit(max_rows).collect()  # an id may have several rows
    rows.sort(key=lambda r: (r.id, r.x))
    x = np.array([r.x for r in rows], float).reshape(len(rows), len(STATISTICS))
    return grow(x, np.array([float(r.label > 0) for r in rows]))


def scored(text: Column, trees: Trees) -> Column:
    @F.pandas_udf("double")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.array([statistics(t) for t in strings(batch)], float).reshape(len(batch), len(STATISTICS))
            yield pd.Series(trees.score(x), dtype="float64")

    return apply(text)


def score_documents(docs: DataFrame, trees: Trees, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``, from 0 to 1: how likely label 1 is."""
    return docs.withColumn("score", scored(col(text_col), trees))
