"""Phrase counts that are kept while files arrive.

Each micro-batch leaves a table of its own counts, under its batch number. A
batch that is repeated after a failure replaces its table, so no text is counted
twice. Counts of all batches add up to those of one run over all files. A table has
the counts as tasks found them, with several rows for some pairs: adding up all
batches moves pairs once, so that adding up each of them before would only move
them once more.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.operators import phrases, tallies
from corpusprep.streaming.incremental import process_new_files, read_processed
from corpusprep.work import written


def count_new_files(
    spark: SparkSession,
    source: str,
    store: str,
    checkpoint: str,
    tokenise: Callable[[DataFrame], DataFrame],
    tokens: str = "tokens",
    schema=None,
    max_files_per_batch: int | None = None,
) -> int:
    """Count the pairs of files in ``source`` not seen before; returns the input rows read.

    ``tokenise`` gets a batch and returns it with the column ``tokens``.
    """

    def step(batch: DataFrame) -> DataFrame:
        return tallies.pair_tallies(tokenise(batch), F.col(tokens))

    return process_new_files(spark, source, store, checkpoint, step, schema, max_files_per_batch)


def counts_so_far(spark: SparkSession, store: str) -> DataFrame | None:
    """(w, nx, n) over all batches, written; None before the first."""
    counted = read_processed(spark, store)
    return None if counted is None else written(phrases.merge_counts(counted), "follow_counts")
