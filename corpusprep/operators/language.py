"""Language of each document: a trained trigram model, or a stopword vote.

The model is two aggregations over labelled texts. Trigrams are counted for each
batch of texts in its task, so what is shuffled goes with the distinct trigrams. A
document is scored in its task by a model that is small enough to be sent there,
otherwise by joining its trigrams with the model and summing per document. Whole
texts are used for training and for scoring.

Weights are whole millionths, so a sum does not depend on the order of its parts
and a retried task cannot change a label.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.functions.text import LETTERS, letter_trigrams, words
from corpusprep.operators import trigrams
from corpusprep.operators.points import flags, in_class
from corpusprep.work import LITERAL_ENTRIES, broadcast_if_small, explode_each, keyed, small_rows, unkeyed, written

# Fixed value: label of a text whose language cannot be told.
OTHER = "Other"

_MILLION = 1_000_000
_MAX_LANGUAGES = 1000

# Cells (trigrams times languages) of a model that is sent to the tasks whole.
MODEL_CELLS = 2_000_000


@dataclass(frozen=True)
class LanguageModel:
    """Naive Bayes with add-one smoothing.

    ``weights`` has one row per known trigram, with a column ``w<i>`` for each
    language: what the trigram adds to the score beyond an unknown trigram.
    ``unknown[i]`` is the weight of an unknown trigram.
    """

    languages: list[str]
    unknown: list[int]
    weights: DataFrame


def trigram_counts(labelled: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, gram, n) over labelled texts."""
    spoken = labelled.select(F.col(lang_col).alias("lang"), F.lower(text_col).alias("text"))
    schema = T.StructType([spoken.schema["lang"], T.StructField("gram", T.StringType()), T.StructField("n", T.LongType())])
    counted = partial(_counted, in_class(labelled.sparkSession, LETTERS))
    return spoken.mapInArrow(counted, schema).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _counted(letters: bytes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letter = flags(letters)
    for batch in batches:
        spoken: dict[str | None, list[str]] = {}
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            if text is not None:
                spoken.setdefault(lang, []).append(text)
        for lang, texts in spoken.items():
            codes, n = trigrams.counted(texts, letter)
            grams = pa.array([trigrams.unpack(code) for code in codes.tolist()], pa.string())
            langs = pa.array([lang] * len(grams), batch.schema.field("lang").type)
            yield pa.RecordBatch.from_arrays([langs, grams, pa.array(n)], names=["lang", "gram", "n"])


def train_language_model(labelled: DataFrame, text_col: str, lang_col: str) -> LanguageModel:
    """Train on every labelled text. The counts are written and then read twice."""
    labelled = labelled.where(F.col(lang_col).isNotNull())
    counts = written(trigram_counts(labelled, text_col, lang_col), "trigram_counts")
    totals = small_rows(counts.groupBy("lang").agg(F.sum("n").alias("total")), _MAX_LANGUAGES)
    if totals is None:
        raise ValueError(f"{lang_col} has more than {_MAX_LANGUAGES} values; it should hold language codes")
    totals = sorted(totals)
    kinds = counts.agg(F.countDistinct("gram")).first()[0]
    languages = [row["lang"] for row in totals]
    unknown = [round(-math.log(row["total"] + kinds) * _MILLION) for row in totals]
    gain = F.round(F.log(F.col("n") + 1) * _MILLION).cast("bigint")
    weights = counts.groupBy("gram").agg(
        *[
            F.coalesce(F.max(F.when(F.col("lang") == code, gain)), F.lit(0)).alias(f"w{i}")
            for i, code in enumerate(languages)
        ]
    )
    return LanguageModel(languages, unknown, written(weights, "trigram_weights"))


def predict_language(
    docs: DataFrame, text_col: str, model: LanguageModel, out: str = "pred_lang", key: str | None = None,
    model_cells: int = MODEL_CELLS,
) -> DataFrame:
    """Add the best-scoring language, or ``Other`` for texts without any trigram.

    Equal scores go to the first language in alphabetical order. A model of more
    than ``model_cells`` is not sent to the tasks but joined with the trigrams.
    """
    given = key
    docs, key = keyed(docs, key)
    indices = range(len(model.languages))
    weights = _small_weights(model, model_cells)
    if weights is None:
        grams = explode_each(docs, [key], letter_trigrams(F.col(text_col)), "gram")
        found = grams.join(broadcast_if_small(model.weights), "gram", "left")
        counts = [F.lit(1).alias("_n"), *[F.coalesce(f"w{i}", F.lit(0)).alias(f"_s{i}") for i in indices]]
        found = found.select(key, *counts)
    else:
        found = docs.select(key, _scorer(*weights, in_class(docs.sparkSession, LETTERS))(F.coalesce(F.lower(text_col), F.lit(""))).alias("_sums"))
        found = found.select(key, *[F.get("_sums", F.lit(i)).alias(name) for i, name in enumerate(["_n", *[f"_s{i}" for i in indices]])])
    sums = found.groupBy(key).agg(*[F.sum(name).alias(name) for name in ["_n", *[f"_s{i}" for i in indices]]]).where("_n > 0")
    scores = [F.col(f"_s{i}") + F.col("_n") * model.unknown[i] for i in indices]
    labels = sums.select(key, _best(scores, model.languages).alias(out))
    labelled = docs.drop(out).join(labels, key, "left").withColumn(out, F.coalesce(out, F.lit(OTHER)))
    return unkeyed(labelled, given)


def _small_weights(model: LanguageModel, cells: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Sorted trigrams and a row of weights for each language, if the model has at most so many cells."""
    limit = cells // max(1, len(model.languages))
    table = model.weights.limit(limit + 1).toPandas()
    if len(table) > limit:
        return None
    codes = np.array([trigrams.pack(gram) for gram in table["gram"]], np.int64)
    order = np.argsort(codes)
    rows = [np.append(table[f"w{i}"].to_numpy(np.int64)[order], 0) for i in range(len(model.languages))]
    return codes[order], np.array(rows, np.int64).reshape(len(model.languages), len(codes) + 1)


def _scorer(known: np.ndarray, weights: np.ndarray, letters: bytes):
    @F.pandas_udf("array<bigint>")
    def sums(texts: pd.Series) -> pd.Series:
        return pd.Series(list(trigrams.summed(texts.tolist(), known, weights, flags(letters))), dtype=object)

    return sums


def _best(scores: list[Column], names: list[str]) -> Column:
    """Name of the highest score; ``names`` are sorted, the first of equals wins."""
    return F.array_max(F.array(*_ranked(scores, names)))["name"]


def _ranked(scores: list[Column], names: list[str]) -> list[Column]:
    return [
        F.struct(score.alias("score"), F.lit(-i).alias("order"), F.lit(name).alias("name"))
        for i, (score, name) in enumerate(zip(scores, names))
    ]


def vote_language(
    docs: DataFrame,
    text_col: str,
    stopwords: DataFrame,
    out: str = "pred_lang",
    key: str | None = None,
    literal_entries: int = LITERAL_ENTRIES,
) -> DataFrame:
    """Add the language whose stopwords (lang, word) make up most of the words.

    Equal votes go to the first language in alphabetical order; no votes give
    ``Other``. Cheap and untrained, but it can only choose among languages that
    have a list.
    """
    listed = stopwords.select("lang", F.lower("word").alias("word")).dropna()
    columns = [c for c in docs.columns if c != out] + [out]
    rows = small_rows(listed, literal_entries)
    if rows is None:
        return _vote_by_join(docs, text_col, listed.distinct(), out, key).select(columns)
    by_lang: dict[str, list[str]] = {}
    for row in sorted(set(rows)):
        by_lang.setdefault(row["lang"], []).append(row["word"])
    # Words are found once; the votes then count over the same array.
    voted = docs.withColumn("_words", words(F.lower(text_col)))
    votes = [F.size(F.filter("_words", _is_in(listed))) for listed in by_lang.values()]
    names = list(by_lang)
    return voted.withColumn(out, _vote_result(votes, names)).select(columns)


def _is_in(listed: list[str]):
    return lambda word: word.isin(listed)


def _vote_result(votes: list[Column], names: list[str]) -> Column:
    no_vote = F.struct(F.lit(0).alias("score"), F.lit(1).alias("order"), F.lit(OTHER).alias("name"))
    return F.array_max(F.array(no_vote, *_ranked([F.coalesce(v, F.lit(0)) for v in votes], names)))["name"]


def _vote_by_join(docs: DataFrame, text_col: str, listed: DataFrame, out: str, key: str | None) -> DataFrame:
    given = key
    docs, key = keyed(docs, key)
    spoken = explode_each(docs, [key], words(F.lower(text_col)), "word")
    votes = spoken.join(broadcast_if_small(listed), "word").groupBy(key, "lang").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("n"), "lang"))["lang"].alias(out))
    labelled = docs.drop(out).join(best, key, "left").withColumn(out, F.coalesce(out, F.lit(OTHER)))
    return unkeyed(labelled, given)


def keep_language(docs: DataFrame, lang: str, label: str = "pred_lang") -> DataFrame:
    """Rows whose label is the wanted language."""
    return docs.where(F.col(label) == lang)
