"""Seconds per headline query on one machine; prints one JSON line.

Every query runs twice and the better time counts, so that the start-up of the
virtual machine is not measured. The tables are single small files, so splits are
set to 4 MB to give every core work; times with another setting do not compare.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from corpusprep.plans.catalog import QUERIES  # noqa: E402

HEADLINE = (
    "tokens_alpha", "lemmas_column", "acronym_expand", "contraction_expand", "lang_vote", "lang_predict_nb",
    "pos_filter", "unigram_counts", "phrase_scores", "phrase_merge", "embed_hash", "embedding_join", "prepare_titled",
    "lang_filter", "prepare_fields", "prepare_embedded", "incremental_embed", "embed_word2vec", "user_model", "csv_round_trip",
    "pos_context", "lemma_guess", "csv_split",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus)))
        # The tables are single small files; smaller splits give every core work.
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["scan_parquet"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        runs = []
        for _ in range(2):
            began = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - began)
        seconds[name] = round(min(runs), 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
                "cpus": int(cpus),
                "documents": spark.read.parquet(f"{folder}/documents.parquet").count(),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
