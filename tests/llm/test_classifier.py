import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusprep.llm import quality_classifier as qc
from corpusprep.llm.queries import QUERIES
from tests.llm.frames import LONG, no_documents, odd_documents


def walk(trees, row):
    """One row down all trees, node by node."""
    total = trees.base
    for feature, threshold, leaf in zip(trees.feature, trees.threshold, trees.leaf):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
        total += leaf[node - len(feature)]
    return 1 / (1 + np.exp(-total))


def test_arrays_give_what_a_walk_gives():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    trees = qc.grow(x, y, trees=20, depth=3)
    scores = trees.score(x)
    assert scores[:50] == pytest.approx([walk(trees, r) for r in x[:50]])
    assert ((scores > 0.5) == (y > 0)).mean() > 0.95
    fresh = rng.normal(size=(400, 5))
    assert ((trees.score(fresh) > 0.5) == ((fresh[:, 0] > 0.3) ^ (fresh[:, 1] > 0))).mean() > 0.85


def test_labels_of_one_kind_or_none():
    x = np.zeros((10, 3))
    assert qc.grow(x, np.ones(10)).score(x).min() > 0.99
    assert qc.grow(x[:0], np.zeros(0)).score(x) == pytest.approx(0.5)
    assert qc.grow(x, np.arange(10) % 2.0).score(x) == pytest.approx(0.5)  # nothing to tell them apart by


def test_statistics_are_finite_for_any_text():
    for text in (None, "", " \n", "!", "é🙂\x00", "x" * 100_000, LONG, "\n" * 1000, "| # |"):
        values = qc.statistics(text)
        assert len(values) == len(qc.STATISTICS) and np.isfinite(values).all()
    assert qc.statistics(None) == qc.statistics("")


def test_odd_documents(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (4, None), (6, 0), (2, 1), (7, 1)], "doc_id bigint, quality int")
    trees = qc.train(docs, labels)
    rows = qc.score_documents(docs, trees).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    by_text = {}
    for r in rows:
        by_text.setdefault(r["text"] or "", set()).add(r["score"])
    assert all(len(s) == 1 for s in by_text.values())
    assert qc.score_documents(no_documents(spark), trees).count() == 0
    none = qc.train(no_documents(spark), labels)
    assert {r["score"] for r in qc.score_documents(docs, none).collect()} == {0.5}


def test_held_out_documents_never_train(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels = spark.read.parquet(f"{data}/labels.parquet")
    turned = labels.withColumn("quality", F.when(qc.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = qc.train(docs, labels), qc.train(docs, turned)
    assert (one.leaf == two.leaf).all() and one.base == two.base


def test_query_on_held_out_documents(spark, data):
    rows = {r["doc_id"]: r for r in QUERIES["op9_quality_classifier"](spark, data.replace("0.001", "0.01")).collect()}
    assert len(rows) == 1000
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3)
    marks = spark.read.parquet(f"{data.replace('0.001', '0.01')}/labels.parquet").collect()
    held = [(rows[m["doc_id"]]["predicted"], m["quality"]) for m in marks if rows[m["doc_id"]]["held_out"]]
    assert np.mean([p == q for p, q in held]) > 0.95
