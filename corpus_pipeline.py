"""From raw documents to tokens: five stages, each on what its predecessor kept.

1. Quality rules reject documents whose lines are mostly boilerplate, or that are too short or repeat themselves.
2. Line dedup takes out lines that the corpus has elsewhere already, also when they differ a little.
3. SimHash near-dedup keeps one document of each group.
4. Decontamination cuts out passages of the benchmark.
5. Byte-level BPE turns texts into tokens and back.

Stages 2 and 4 change texts; ``n_chars`` follows. A document that has lost all its text stays as an empty one until
SimHash, to which empty documents are copies of each other.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm import bpe, decontaminate, line_dedup, quality_rules, simhash
from corpusprep.llm.common import table
from corpusprep.llm.queries import BPE_RANKS
from corpusprep.work import written


#: Bytes of texts that a Python worker of a stage gets at once. Workers serve all stages and keep what they have grown to.
BATCH_BYTES = "8m"


def _in_small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("bigint"))


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _in_small_batches(spark)
    weights = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    return quality_rules.keep_good(docs, weights=weights)


def drop_copied_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _in_small_batches(spark)
    return _counted(line_dedup.drop_copies(docs)).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _in_small_batches(spark)
    return simhash.drop_near_duplicates(docs, shingle=3, max_bits=3)


def cut_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _in_small_batches(spark)
    return _counted(decontaminate.remove_overlaps(docs, table(spark, sf_dir, "benchmark"))).select(docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, the packed token_ids, and whether they decode to the text."""
    _in_small_batches(spark)
    path = public_tokenizers.path(BPE_RANKS)
    tokens = bpe.round_trip(docs, path, public_tokenizers.PATTERN)
    return tokens.select("doc_id", "lang", "source", "n_tokens", "token_ids", "exact")


STAGES = [
    ("quality_rules", keep_good_documents),
    ("line_dedup", drop_copied_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", cut_benchmark_passages),
    ("byte_bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs


#: Near-duplicate lines, SimHash groups and tokens are not for SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None
