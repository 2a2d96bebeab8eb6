"""Two-word phrases learned over the whole corpus and merged into each document.

Counts use one pass over the documents: every token is counted together with the
token after it, so token counts are sums of pair counts. Partial aggregation in
the scanning tasks leaves at most one row per distinct pair and task, however
frequent a pair is.

No step orders or groups the tokens of a document across rows. Pairs come from
the token array of one row, and only the positions of found phrases travel back
to their document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from corpusprep.functions.text import join_tokens, next_pairs
from corpusprep.work import broadcast_if_small, explode_each, keyed, unkeyed, written

# Phrase settings and the sign between merged words.
MIN_COUNT = 2
THRESHOLD = 20.0
DELIMITER = "_"

# Binary logarithm of the registers of a sketch: 16,384, for a standard error of 0.8 %.
SKETCH_PRECISION = 14


def follow_counts(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(w, nx, n): how often token ``w`` is followed by ``nx``; null at a document's end."""
    return follows(docs, tokens).groupBy("w", "nx").agg(F.count(F.lit(1)).alias("n"))


def follows(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(w, nx) for every token, uncounted: enough for a sketch, which takes repeats."""
    return docs.select(F.inline_outer(next_pairs(F.col(tokens))).alias("w", "nx")).where("w IS NOT NULL")


def unigram_counts(follows: DataFrame) -> DataFrame:
    """(token, n) from ``follow_counts``."""
    return follows.groupBy(F.col("w").alias("token")).agg(F.sum("n").alias("n"))


def bigram_counts(follows: DataFrame) -> DataFrame:
    """(w, nx, n) for pairs of adjacent tokens of one document."""
    return follows.where("nx IS NOT NULL")


def vocabulary(follows: DataFrame) -> DataFrame:
    """(key, n, is_token) over tokens and joined pairs, which share one dictionary.

    A token that itself reads ``a_b`` and the pair (a, b) are the same entry.
    """
    tokens = unigram_counts(follows).select(F.col("token").alias("key"), "n", F.lit(True).alias("is_token"))
    pairs = bigram_counts(follows).select(F.concat_ws(DELIMITER, "w", "nx").alias("key"), "n", F.lit(False).alias("is_token"))
    return tokens.unionAll(pairs).groupBy("key").agg(F.sum("n").alias("n"), F.max("is_token").alias("is_token"))


def score_phrases(
    pairs: DataFrame, tokens: DataFrame, size: int, min_count: int = MIN_COUNT, threshold: float = THRESHOLD
) -> DataFrame:
    """Pairs that are phrases: (w, nx, n, n_w, n_nx, score).

    ``pairs`` (w, nx, n) and ``tokens`` (token, n) hold dictionary counts and
    ``size`` is the number of dictionary entries V. The score is
    ``(n - min_count) / (n_w * n_nx) * V``; a phrase scores above the threshold.
    """
    if threshold >= 0:
        # Rarer pairs cannot score above zero, and most pairs are rare.
        pairs = pairs.where(F.col("n") > min_count)
    scored = (
        pairs.join(tokens.select(F.col("token").alias("w"), F.col("n").alias("n_w")), "w")
        .join(tokens.select(F.col("token").alias("nx"), F.col("n").alias("n_nx")), "nx")
        # Doubles, because the product of two large counts does not fit a bigint.
        .withColumn(
            "score", (F.col("n") - min_count) / (F.col("n_w").cast("double") * F.col("n_nx")) * F.lit(float(size))
        )
    )
    return scored.where(F.col("score") > threshold).select("w", "nx", "n", "n_w", "n_nx", "score")


def learn_phrases(
    docs: DataFrame, tokens: str = "tokens", min_count: int = MIN_COUNT, threshold: float = THRESHOLD
) -> DataFrame:
    """The phrase table of a corpus, written to the work folder.

    Most pairs are too rare to score and only count for the size of the dictionary.
    They are counted while the others are written, and go nowhere.
    """
    counts = written(token_counts(docs, tokens), "unigram_counts")
    if threshold < 0 or _like_pairs(counts):
        return learn_from_counts(written(follow_counts(docs, tokens), "follow_counts"), min_count, threshold)
    return _learn(counts, bigram_counts(follow_counts(docs, tokens)), min_count, threshold)


def token_counts(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(token, n) of a corpus."""
    said = explode_each(docs, [], F.col(tokens), "token").where("token IS NOT NULL")
    return said.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def _like_pairs(counts: DataFrame) -> bool:
    """Whether a token may read like a pair, so that the two are one dictionary entry."""
    return not counts.where(F.contains("token", F.lit(DELIMITER))).isEmpty()


def _learn(counts: DataFrame, pairs: DataFrame, min_count: int, threshold: float, size: int | None = None) -> DataFrame:
    """The phrase table from dictionary counts; of ``pairs``, which are read once, only those that can score are written."""
    seen = Observation()
    pairs = pairs.observe(seen, F.count(F.lit(1)).alias("pairs"))
    frequent = written(pairs.where(F.col("n") > min_count), "frequent_pairs")
    if size is None:
        size = counts.count() + seen.get["pairs"]
    return written(score_phrases(frequent, counts, size, min_count, threshold), "phrases")


def learn_from_counts(
    follows: DataFrame, min_count: int = MIN_COUNT, threshold: float = THRESHOLD, estimated_size: bool = False
) -> DataFrame:
    """The phrase table from counts (w, nx, n) that are a written table, with one row for each pair.

    The size of the dictionary is counted, or with ``estimated_size`` taken from a sketch, see ``vocabulary_sketch``.
    """
    counts = written(unigram_counts(follows), "unigram_counts")
    pairs = bigram_counts(follows)
    estimate = vocabulary_size(vocabulary_sketch(follows)) if estimated_size else None
    if not _like_pairs(counts):
        # No token can read like a pair, so every count is its dictionary entry.
        if threshold >= 0:
            return _learn(counts, pairs, min_count, threshold, estimate)
        size = estimate if estimated_size else counts.count() + pairs.count()
    else:
        vocab = written(vocabulary(follows), "vocabulary")
        pairs = pairs.select("w", "nx", F.concat_ws(DELIMITER, "w", "nx").alias("key")).join(vocab, "key")
        counts = vocab.where("is_token").withColumnRenamed("key", "token")
        size = estimate if estimated_size else vocab.count()
    return written(score_phrases(pairs, counts, size, min_count, threshold), "phrases")


def merge_counts(counts: DataFrame) -> DataFrame:
    """(w, nx, n) of a whole corpus from the counts of its parts, which may repeat a pair.

    Most pairs are in one part only. Adding up before the shuffle would leave nearly as many rows and keep all of a
    scan in memory, so rows are shuffled first and added up in the smaller partitions.
    """
    counts = counts.repartition("w", "nx")
    return counts.groupBy("w", "nx").agg(F.sum("n").alias("n"))


def vocabulary_sketch(follows: DataFrame, precision: int = SKETCH_PRECISION) -> DataFrame:
    """One row (sketch) from which the number of dictionary entries can be estimated.

    Sketches of parts of a corpus can be put in one table. An entry counts once,
    however often and in however many parts it is, so nothing is grouped and no
    entry is shuffled; ``follows`` need not be counted.
    The relative standard error is about ``1.04 / 2 ** (precision / 2)``.
    """
    keys = F.array("w", F.when(F.col("nx").isNotNull(), F.concat_ws(DELIMITER, "w", "nx")))
    entries = follows.select(F.explode(keys).alias("key"))
    return entries.agg(F.hll_sketch_agg("key", precision).alias("sketch"))


def vocabulary_size(sketches: DataFrame) -> int:
    """The estimated number of dictionary entries of all ``sketches`` (sketch) together; 0 without any."""
    return sketches.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0))).first()[0]


def merge_phrases(
    docs: DataFrame, phrases: DataFrame, tokens: str = "tokens", out: str = "lemmas", key: str | None = None
) -> DataFrame:
    """Add ``out``: tokens joined by spaces, with phrases merged by ``_``.

    Merging goes from left to right and a merged pair is not extended, so of
    three tokens that form two overlapping phrases the first two are merged.
    """
    given = key
    docs, key = keyed(docs, key)
    pairs = explode_each(docs, [key], next_pairs(F.col(tokens)), "pair")
    pairs = pairs.select(key, "pos", "pair.*").toDF(key, "pos", "w", "nx")
    table = broadcast_if_small(phrases.select("w", "nx"))
    hits = pairs.where("nx IS NOT NULL").join(table, ["w", "nx"], "left_semi")
    found = hits.groupBy(key).agg(F.array_sort(F.collect_list("pos")).alias("_hits"))
    joined = docs.join(found, key, "left")
    plain = join_tokens(F.col(tokens))
    merged = F.when(F.col("_hits").isNull(), plain).otherwise(_merge(F.col(tokens), F.col("_hits")))
    return unkeyed(joined.withColumn(out, merged).drop("_hits"), given)


def _merge(tokens: Column, hits: Column) -> Column:
    """Merge at ``hits``, the sorted positions of tokens that begin a phrase.

    A hit right behind a merged one is its second word, so of a run of hits every
    second one is merged, from the first. Runs are found by their two ends, which
    takes time in proportion to the hits.
    """
    firsts = F.filter(hits, lambda p, i: (i == 0) | (F.get(hits, i - 1) < p - 1))
    lasts = F.filter(hits, lambda p, i: (i == F.size(hits) - 1) | (F.get(hits, i + 1) > p + 1))
    begins = F.flatten(F.zip_with(firsts, lasts, lambda first, last: F.sequence(first, last, F.lit(2))))
    ends = F.concat(F.array(F.lit(0)), F.transform(begins, lambda p: p + 2))
    stretches = F.zip_with(
        ends,
        F.concat(begins, F.array(F.size(tokens))),
        lambda start, stop: F.concat(
            F.slice(tokens, start + 1, stop - start),
            F.when(
                stop < F.size(tokens), F.array(F.concat_ws(DELIMITER, F.get(tokens, stop), F.get(tokens, stop + 1)))
            ).otherwise(F.array().cast("array<string>")),
        ),
    )
    return join_tokens(F.flatten(stretches))
