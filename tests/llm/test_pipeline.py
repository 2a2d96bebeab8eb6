import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from checks.compare import connect, difference
from corpusprep.llm import bpe, quality_rules
from corpusprep.llm.queries import BPE_RANKS, ORACLE_SQL, QUERIES
from corpusprep.work import written
from tests.conftest import plan_text
from tests.llm.frames import DOCUMENT_SCHEMA, cut_words, hit_words, no_documents, odd_documents, without_copied_lines
from tests.llm.test_simhash import plain_fingerprint


def plain_pipeline(docs, items, weights):
    kept = [(i, t) for i, t in docs if quality_rules.judge(t, weights, quality_rules.MIN_CONTENT_SHARE)[-1]]
    kept = without_copied_lines(kept)
    prints = {i: plain_fingerprint(t) for i, t in kept}
    group = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if group[a] < group[b] and (prints[a] ^ prints[b]).bit_count() <= 3:
                    group[b], changed = group[a], True
    kept = [(i, t) for i, t in kept if group[i] == i]
    return {i: cut_words(t, hit_words(t, items)[1]) for i, t in kept}


def test_run_against_the_plain_version(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").orderBy("doc_id").collect()
    docs = spark.read.parquet(f"{data}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    weights = quality_rules.train(docs, spark.read.parquet(f"{data}/labels.parquet"))
    want = plain_pipeline([(r["doc_id"], r["text"]) for r in rows], items, weights)
    got = corpus_pipeline.run(spark, data).collect()
    with open(public_tokenizers.path(BPE_RANKS)) as lines:
        ranks = bpe.Vocabulary.from_text(lines.read(), public_tokenizers.PATTERN).ranks
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert {r["doc_id"] for r in got} == set(want) and len(got) == len(want) < len(rows)
    for r in got:
        assert np.frombuffer(bytes(r["token_ids"]), "<u4").tolist() == theirs.encode_ordinary(want[r["doc_id"]])
        assert r["exact"] and r["n_tokens"] == len(r["token_ids"]) // 4


def test_every_stage_takes_odd_documents_and_none(spark, data):
    labelled = spark.read.parquet(f"{data}/documents.parquet")
    columns = odd_documents(spark).columns
    for name, stage in corpus_pipeline.STAGES:
        docs = odd_documents(spark)
        out = stage(spark, docs, data)
        if name != "byte_bpe":
            assert out.columns == columns, name
        assert out.count() <= docs.count()
        if name in ("line_dedup", "decontamination", "byte_bpe"):
            assert out.count() == docs.count()
        assert stage(spark, no_documents(spark), data).count() == 0, name
    assert labelled.schema.simpleString() == spark.createDataFrame([], DOCUMENT_SCHEMA).schema.simpleString()


def test_lengths_follow_texts(spark, data):
    for stage in (corpus_pipeline.drop_copied_lines, corpus_pipeline.cut_benchmark_passages):
        out = stage(spark, spark.read.parquet(f"{data}/documents.parquet"), data)
        assert out.where(F.col("n_chars") != F.length("text")).count() == 0


def test_registered(spark):
    names = entry_points.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names) and set(ORACLE_SQL) <= set(entry_points.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_sql(spark, data):
    con = connect(data)
    for name, sql in ORACLE_SQL.items():
        assert difference(QUERIES[name](spark, data), con, sql) is None, name


def test_near_duplicate_stage_broadcasts_no_probes(spark, monkeypatch):
    plans = {}

    def noted(df, name):
        plans[name] = plan_text(df)
        return written(df, name)

    monkeypatch.setattr(corpus_pipeline.simhash, "written", noted)
    docs = written(odd_documents(spark), "documents")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert 0 < kept.count() < docs.count()
    assert "Generate" in plans["links"] and "BroadcastHashJoin" not in plans["links"]
