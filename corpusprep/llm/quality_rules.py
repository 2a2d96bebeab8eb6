"""Quality rules: a linear-chain conditional random field labels the lines of each document.

Every line that has a word is content or boilerplate. The field scores a labelling by what each line looks like and by
which label follows which; Viterbi decoding finds the best labelling of the whole document, and the share of characters
in content lines decides whether the document stays. A few plain counts come with it and reject documents beforehand.

The weights are fitted to a bounded sample of documents with a quality label (``max_docs``, the ones whose ids hash
lowest). No line labels exist, so each line takes the label of its document. The penalty pulls the weights towards
``PRIOR``: without labelled documents they are ``PRIOR``. The weight of staying is not learned: labels never change inside
a document that has one label, so such documents would only teach that they never change.

Defined results: a null or empty text has no words, so ``n_words`` is 0 and it is rejected. Texts of any length are read
whole; a document is one row and one task reads it. Repeated rows and repeated ids each get their own, equal, result. An
empty table gives an empty result. Other columns of the input stay; one that is called ``quality_rules`` is replaced.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusprep.llm.common import batches, col, fresh, strings, text_hash

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_CONTENT_SHARE = 0.5

BOILERPLATE, CONTENT = 0, 1

#: What a line is described by, each a number from 0 to 1, and the weight for "content" before any document is seen.
FEATURES = {
    "one": 0.5,
    "symbols": -6.0,  # share of characters that are symbols, times 5
    "shouted": -3.0,  # share of letters that are capitals
    "exclaimed": -2.0,  # share of words that end in ! or ?
    "repetitive": -3.0,  # share of words that the line has had before
    "seen": -1.0,  # the same line came earlier
    "sentence": 0.5,  # ends as a sentence does
    "short": 0.0,  # up to three words
    "long": 0.5,  # twenty words or more
    "bare": -1.0,  # share of words without a letter or digit
    "common": 1.0,  # share of words of one to three letters
}
#: Weight of keeping the label of the line before.
PRIOR_STAY = 1.0
PRIOR = (tuple(FEATURES.values()), PRIOR_STAY)

Weights = tuple[tuple[float, ...], float]

RESULT = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, labels string, content_share double, kept boolean"
)


def repeated_words(words: list) -> int:
    """Words that lie in a window of three found at least twice in ``words``."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1].ravel()
    _, which, times = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    again = times[which.ravel()] > 1
    inside = np.zeros(n, bool)
    for shift in range(3):
        inside[shift : n - 2 + shift] |= again
    return int(inside.sum())


def line_features(line: str, words: list[bytes], seen: bool) -> list[float]:
    n = len(words)
    size = max(1, len(line))
    letters = sum(map(str.isalpha, line)) if n < 4 else len(line) - n + 1
    capitals = sum(map(str.isupper, line))
    ends = sum(w[-1] in b"!?" for w in words)
    bare = sum(len(w) < 3 and not w.isalnum() and w.isascii() for w in words)
    return [
        1.0,
        min(1.0, 5 * sum(map(line.count, SYMBOLS)) / size),
        min(1.0, capitals / max(1, letters)),
        ends / n,
        1 - len(set(words)) / n,
        float(seen),
        float(words[-1][-1] in b".!?:;"),
        float(n <= 3),
        float(n >= 20),
        bare / n,
        sum(len(w) <= 3 for w in words) / n,
    ]


def described(text: str | None) -> tuple[list[tuple[int, list[float]]], int, int]:
    """For each line with a word its length and features; how many equal an earlier one; how many words there are."""
    lines, seen, repeats, n_words = [], set(), 0, 0
    for line in (text or "").split("\n"):
        words = line.encode().split()
        if not words:
            continue
        again = line in seen
        seen.add(line)
        repeats += again
        n_words += len(words)
        lines.append((len(line), line_features(line, words, again)))
    return lines, repeats, n_words


def viterbi(scores: list[float], stay: float) -> list[int]:
    """The best labels when content scores ``scores[i]``, boilerplate 0, and an unchanged label ``stay``. Ties: content."""
    back: list[tuple[int, int]] = []
    low, high = 0.0, scores[0]
    for score in scores[1:]:
        to_low = CONTENT if high >= low + stay else BOILERPLATE
        to_high = CONTENT if high + stay >= low else BOILERPLATE
        back.append((to_low, to_high))
        low, high = max(high, low + stay), max(high + stay, low) + score
    label = CONTENT if high >= low else BOILERPLATE
    labels = [label]
    for step in reversed(back):
        label = step[label]
        labels.append(label)
    return labels[::-1]


def judge(text: str | None, weights: Weights, min_share: float) -> tuple:
    lines, n_dup_lines, n_words = described(text)
    text = text or ""
    word_chars = len(text) - sum(map(text.count, SPACES))
    n_symbols = sum(map(text.count, SYMBOLS))
    n_repeat = repeated_words(text.encode().split())
    failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words
    labels, share = [], 0.0
    if lines:
        unary, stay = np.array([f for _, f in lines]) @ np.array(weights[0]), weights[1]
        labels = viterbi(unary.tolist(), stay)
        share = sum(n for (n, _), y in zip(lines, labels) if y == CONTENT) / sum(n for n, _ in lines)
    marks = "".join("bc"[y] for y in labels)
    return n_words, word_chars, n_symbols, n_dup_lines, n_repeat, failed, marks, share, not failed and share >= min_share


def sequence_gradient(x: np.ndarray, y: np.ndarray, real: np.ndarray, w: np.ndarray, stay: float):
    """Gradient of the log likelihood of label sequences ``y``; rows of ``x`` are documents, padded where not ``real``."""
    n, length, _ = x.shape
    unary = np.zeros((n, length, 2))
    unary[:, :, CONTENT] = x @ w
    step = np.array([[stay, 0.0], [0.0, stay]])
    forward, backward = np.zeros((n, length, 2)), np.zeros((n, length, 2))
    forward[:, 0] = unary[:, 0]
    for t in range(1, length):
        moved = np.logaddexp.reduce(forward[:, t - 1, :, None] + step, axis=1) + unary[:, t]
        forward[:, t] = np.where(real[:, t, None], moved, forward[:, t - 1])
    for t in range(length - 2, -1, -1):
        moved = np.logaddexp.reduce((backward[:, t + 1] + unary[:, t + 1])[:, None, :] + step, axis=2)
        backward[:, t] = np.where(real[:, t + 1, None], moved, backward[:, t + 1])
    total = np.logaddexp.reduce(forward[:, -1], axis=1)
    marginal = np.exp(forward + backward - total[:, None, None])[:, :, CONTENT]
    off = np.where(real, y - marginal, 0.0)
    pair = real[:, 1:]
    same = np.exp(
        forward[:, :-1, :] + step.diagonal() + unary[:, 1:, :] + backward[:, 1:, :] - total[:, None, None]
    ).sum(axis=2)
    stays = np.where(pair, (y[:, 1:] == y[:, :-1]) - same, 0.0)
    return np.einsum("nt,ntf->f", off, x), stays.sum()


def fit_weights(examples: list[tuple[list[list[float]], int]], rounds: int = 150, pull: float = 5.0) -> Weights:
    """Weights of the highest penalised likelihood for (line features, label of the document) examples."""
    prior = np.array(PRIOR[0])
    examples = sorted((e for e in examples if e[0]), key=lambda e: len(e[0]))
    if len({label for _, label in examples}) < 2:
        return PRIOR
    blocks = []
    for start in range(0, len(examples), 256):  # of similar length, so that little is padded
        part = examples[start : start + 256]
        length = len(part[-1][0])
        x = np.zeros((len(part), length, len(FEATURES)))
        real = np.zeros((len(part), length), bool)
        for i, (lines, _) in enumerate(part):
            x[i, : len(lines)] = lines
            real[i, : len(lines)] = True
        blocks.append((x, np.repeat([[label] for _, label in part], length, axis=1), real))
    theta, mean, spread = prior.copy(), np.zeros(len(FEATURES)), np.zeros(len(FEATURES))
    for i in range(1, rounds + 1):
        gradient = -pull * (theta - prior)
        for x, y, real in blocks:
            gradient += sequence_gradient(x, y, real, theta, PRIOR_STAY)[0]
        mean, spread = 0.9 * mean + 0.1 * gradient, 0.99 * spread + 0.01 * gradient**2
        theta = theta + 0.1 * (mean / (1 - 0.9**i)) / (np.sqrt(spread / (1 - 0.99**i)) + 1e-8)
    return tuple(theta.tolist()), PRIOR_STAY


#: Lines of a training document, unless ``train`` is told otherwise; the driver holds max_docs times as many at most.
MAX_TRAINING_LINES = 400


def _features(text: Column) -> Column:
    @F.pandas_udf("array<array<double>>")
    def apply(texts: pd.Series) -> pd.Series:
        return pd.Series([[f for _, f in described(t)[0]] for t in strings(texts)])

    return apply(text)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_docs: int = 1_500,
    max_lines: int = MAX_TRAINING_LINES,
) -> Weights:
    """Weights from a sample: at most ``max_docs`` labelled documents, of those the ones of up to ``max_lines`` lines.

    ``labels``: (id, quality). An id with several labels takes the smallest; ids and labels that are null are left out.
    The driver gets the features of the sampled lines, never texts.
    """
    marks = (
        labels.select(col(id_col).alias("id"), F.col("quality").cast("int").alias("label"))
        .dropna()
        .groupBy("id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(max_docs)
    )
    texts = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    texts = texts.where(F.size(F.split("text", "\n")) <= max_lines)
    found = texts.join(F.broadcast(marks), "id")
    found = found.select("id", text_hash(F.col("text")).alias("hash"), _features(F.col("text")).alias("lines"), "label")
    rows = found.orderBy(F.xxhash64("id"), "id", "hash").limit(max_docs).collect()  # an id may have several rows
    rows.sort(key=lambda r: (r.id, r.label, len(r.lines), r.hash))
    return fit_weights([([list(f) for f in r.lines], int(r.label > 0)) for r in rows])


def judged(text: Column, weights: Weights = PRIOR, min_share: float = MIN_CONTENT_SHARE) -> Column:
    """The counts, labels and verdict for a text as one struct (``RESULT``); ``labels`` has c or b for each line with a word."""
    fields = [f.split()[0] for f in RESULT.split(", ")]

    @F.pandas_udf(RESULT)
    def apply(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches(texts, 500):
            yield pd.DataFrame([judge(t, weights, min_share) for t in strings(batch)], columns=fields)

    return apply(text.cast(StringType()))


def apply_rules(
    docs: DataFrame, text_col: str = "text", weights: Weights = PRIOR, min_share: float = MIN_CONTENT_SHARE
) -> DataFrame:
    """``docs`` with a struct column ``quality_rules``."""
    return docs.withColumn("quality_rules", judged(col(text_col), weights, min_share))


def keep_good(
    docs: DataFrame, text_col: str = "text", weights: Weights = PRIOR, min_share: float = MIN_CONTENT_SHARE
) -> DataFrame:
    """The rows of ``docs`` that are kept, with the columns they had."""
    verdict = fresh("verdict", docs)
    return docs.withColumn(verdict, judged(col(text_col), weights, min_share)).where(f"{verdict}.kept").drop(verdict)
