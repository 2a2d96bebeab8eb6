"""Language of web pages by Bayesian fusion of evidence.

For each page the posterior of a language is the product of four parts:

- the likelihood of the text, from character trigrams in hash buckets, learned from labelled documents. Neighbouring
  trigrams overlap and are not independent, so its logarithm counts with the weight ``TEMPER``;
- the likelihood of the language that the markup declares, given the language: declarations are often wrong or missing;
- the likelihood of the last label of the host name, the address suffix, given the language;
- the prior of the host, smoothed towards that of its domain (the last two labels), which is smoothed towards that of
  all pages. A page's own text is left out of the counts of its host and domain.

The last three are learned from all pages: each page adds its posterior by text alone to the counts of its declaration,
suffix, host and domain. Counts are whole numbers of millionths, so that results do not depend on the order of tasks.
They are summed in the tasks first; a host with a third of all pages is a row from each task. Counts go back to the pages
by joins, broadcast while the table is small.

The text model is fitted to at most ``max_docs`` labelled documents, whose ids hash lowest; the driver gets bucket counts.

Defined results: a null page counts as empty, and a page without text has the same text likelihood for all languages. A
missing or unusual declaration or address is a value of its own. Texts of any length are read whole. Each row gets its
own result, equal for equal rows except for what leaving out a page's own text changes for neither. Of equal posteriors
the language that sorts first is taken. Without labelled documents the language is null. Empty tables give empty results.
Only the columns named are read.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import col, strings
from corpusprep.llm.html_extract import DROPPED, lines_of
from corpusprep.work import broadcast_if_small, written

BUCKETS = 1 << 14
MAX_DOCS = 3_000
TEMPER = 0.05
#: Pages that a prior of the level above weighs, in the prior of a host or domain.
PRIOR_PAGES = 5.0
#: Added to every count of a declaration or suffix.
SMOOTHING = 0.5
UNIT = 1_000_000


def trigram_buckets(text: str) -> np.ndarray:
    """The bucket of each trigram of the lower-cased text; runs of what is no letter count as one space."""
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    codes = np.frombuffer(f" {' '.join(letters.split())} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    mixed = codes[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (mixed ^ codes[2:]) * np.uint64(0xFF51AFD7ED558CCD)
    return ((mixed >> np.uint64(40)) % np.uint64(BUCKETS)).astype(np.int64)


@dataclass(frozen=True)
class TextModel:
    """``weights``: the logarithm of the likelihood of each bucket (rows) for each language (columns)."""

    languages: tuple[str, ...]
    weights: np.ndarray

    def score(self, text: str) -> np.ndarray:
        found = trigram_buckets(text)
        if not len(found):
            return np.zeros(len(self.languages))
        return np.bincount(found, minlength=BUCKETS) @ self.weights


def fit(counts: dict[str, np.ndarray]) -> TextModel:
    """The model for the bucket counts of each language."""
    languages = tuple(sorted(counts))
    table = np.array([counts[x] for x in languages], float).reshape(len(languages), BUCKETS).T + 0.5
    return TextModel(languages, np.log(table / table.sum(axis=0)) if languages else np.zeros((BUCKETS, 0)))


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_docs: int = MAX_DOCS
) -> TextModel:
    """Bucket counts of a bounded sample, added up in the tasks. Rows without id, text or language are left out."""
    chosen = docs.select(col(id_col).alias("id")).dropna().distinct().orderBy(F.xxhash64("id"), "id").limit(max_docs)
    rows = docs.select(col(id_col).alias("id"), col(lang_col).alias("lang"), col(text_col).alias("text")).dropna()

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for frame in frames:
            for lang, text in zip(frame["lang"], frame["text"]):
                found = np.bincount(trigram_buckets(text), minlength=BUCKETS)
                sums[lang] = sums[lang] + found if lang in sums else found
        for lang, found in sums.items():
            some = np.flatnonzero(found)
            yield pd.DataFrame({"lang": lang, "bucket": some, "n": found[some]})

    sampled = rows.join(F.broadcast(chosen), "id").select("lang", "text")
    counted = sampled.mapInPandas(count, "lang string, bucket int, n bigint")
    counts: dict[str, np.ndarray] = {}
    for lang, bucket, n in counted.groupBy("lang", "bucket").agg(F.sum("n")).collect():
        counts.setdefault(lang, np.zeros(BUCKETS, np.int64))[bucket] = n
    return fit(counts)


def page_text(page: str | None) -> str:
    """The lines of a page that its markup does not drop."""
    lines, kinds = lines_of(page)
    best = max(kinds, default=DROPPED)
    return "\n".join(line for line, kind in zip(lines, kinds) if kind == best or best == DROPPED)


def _text_scores(page: Column, model: TextModel) -> Column:
    @F.pandas_udf("array<double>")
    def apply(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in pages:
            yield pd.Series([(TEMPER * model.score(page_text(p))).tolist() for p in strings(batch)], dtype=object)

    return apply(page)


def _each(n: int, value) -> Column:
    return F.array(*[value(i) for i in range(n)])


def _normal(logs: Column) -> Column:
    """The probabilities that belong to logarithms."""
    most = F.array_max(logs)
    powers = F.transform(logs, lambda x: F.exp(x - most))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))


def identify(
    pages: DataFrame, model: TextModel, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per row of ``pages``: the id, ``host``, ``declared`` ('' for none), ``text_lang`` (by text alone), ``lang``
    and its ``posterior``, rounded to six places."""
    n = len(model.languages)
    names = F.array(*[F.lit(x) for x in model.languages]).cast("array<string>")
    url, page = F.coalesce(col(url_col), F.lit("")), F.coalesce(col(html_col), F.lit(""))
    declared = F.lower(F.regexp_extract(page, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b", 1))
    host = F.regexp_replace(F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", 1)), r"^.*@|:\d*$|\.$", "")
    base = pages.select(
        col(id_col).alias("id"),
        host.alias("host"),
        F.regexp_extract(host, r"([^.]*\.[^.]*)$", 1).alias("domain"),
        F.regexp_extract(host, r"([^.]*)$", 1).alias("suffix"),
        declared.alias("declared"),
        _text_scores(col(html_col), model).alias("logs"),
    )
    if not n:
        empty = F.lit(None).cast("string")
        return base.select(
            F.col("id").alias(id_col), "host", "declared", empty.alias("text_lang"), empty.alias("lang"),
            F.lit(None).cast("double").alias("posterior"),
        )
    own = F.transform(_normal(F.col("logs")), lambda p: F.round(p * UNIT).cast("bigint"))
    base = written(base.withColumn("own", own), "text_scores")

    def counts(key: str) -> DataFrame:
        sums = base.groupBy(key).agg(_each(n, lambda i: F.sum(F.get("own", F.lit(i)))).alias(f"by_{key}"))
        return broadcast_if_small(written(sums, f"by_{key}"))

    joined = reduce(lambda rows, key: rows.join(counts(key), key), ("declared", "suffix", "domain", "host"), base)
    per_language = base.agg(_each(n, lambda i: F.sum(F.get("own", F.lit(i))))).first()[0]
    everywhere = [(c or 0) / UNIT for c in per_language] if per_language else [0.0] * n
    total = sum(everywhere)
    kinds = {key: written(base.select(key).distinct(), key).count() for key in ("declared", "suffix")}

    def known(key: str, i: int) -> Column:
        """The likelihood of what a page has for ``key``, given language i."""
        seen = F.get(f"by_{key}", F.lit(i)) / UNIT
        return (seen + SMOOTHING) / (everywhere[i] + SMOOTHING * max(1, kinds[key]))

    def prior(key: str, i: int, above: Column) -> Column:
        """The share of language i among the other pages with the same value of ``key``, smoothed towards ``above``."""
        others = [(F.get(f"by_{key}", F.lit(j)) - F.get("own", F.lit(j))) / UNIT for j in range(n)]
        return (others[i] + PRIOR_PAGES * above) / (reduce(lambda a, b: a + b, others) + PRIOR_PAGES)

    def fused(i: int) -> Column:
        overall = F.lit((everywhere[i] + 1) / (total + n))
        by_host = prior("host", i, prior("domain", i, overall))
        return F.get("logs", F.lit(i)) + F.log(known("declared", i)) + F.log(known("suffix", i)) + F.log(by_host)

    posteriors = joined.withColumn("posteriors", _normal(_each(n, fused)))
    best = F.array_position("posteriors", F.array_max("posteriors"))
    by_text = F.array_position("logs", F.array_max("logs"))
    return posteriors.select(
        F.col("id").alias(id_col),
        "host",
        "declared",
        F.get(names, (by_text - 1).cast("int")).alias("text_lang"),
        F.get(names, (best - 1).cast("int")).alias("lang"),
        F.round(F.array_max("posteriors"), 6).alias("posterior"),
    )
