"""What the physical plans look like, since that decides how they scale."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import corpusprep.work as work
from corpusprep.plans.catalog import QUERIES
from tests.conftest import plan_text


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"embed_word2vec"}))
def test_no_cartesian_products_and_no_single_window(spark, data, name):
    text = plan_text(QUERIES[name](spark, data))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    for number, line in enumerate(text.splitlines()):
        if "SinglePartition" in line:
            # Only one-row results of partial aggregates may come together in one task.
            assert "HashAggregate" in text and "Window" not in text, number


@pytest.mark.parametrize(
    "name,columns",
    [
        ("lemmas_column", {"doc_id", "text", "lang"}),
        ("lang_vote", {"doc_id", "text"}),
        ("max_length", {"text", "source"}),
        ("unprocessed_docs", {"doc_id", "source"}),
    ],
)
def test_scans_read_only_the_columns_they_need(spark, data, name, columns):
    scans = [line for line in plan_text(QUERIES[name](spark, data)).splitlines() if line.startswith("ReadSchema")]
    read = {part.split(":")[0].removeprefix("struct<") for part in scans[0].removeprefix("ReadSchema: ").rstrip(">").split(",")}
    assert read == columns


def test_row_wise_queries_do_not_shuffle(spark, data, monkeypatch):
    monkeypatch.setattr(work, "SPREAD_BYTES_PER_CORE", 0)
    for name in ("tokens_alpha", "lemmas_column", "acronym_expand", "contraction_expand", "lang_vote", "truncate_tokens"):
        text = plan_text(QUERIES[name](spark, data))
        assert "Exchange" not in text, name


def test_exploding_does_not_work_out_the_array_twice(spark, data):
    text = plan_text(QUERIES["lang_model_counts"](spark, data))
    assert text.count("regexp_extract_all") == 1


def test_broadcast_depends_on_the_measured_size(spark):
    table = work.written(spark.range(1000).select(F.col("id").cast("string").alias("k")), "table")
    big = spark.range(10).select(F.col("id").cast("string").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan_text(big.join(work.broadcast_if_small(table), "k"))
        assert "BroadcastHashJoin" not in plan_text(big.join(work.broadcast_if_small(table, max_bytes=1000), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_rows(spark):
    assert len(work.small_rows(spark.range(5), 5)) == 5
    assert work.small_rows(spark.range(6), 5) is None


def test_work_dir_follows_the_session(spark, tmp_path):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert work.work_dir(spark) == named.rstrip("/")
    else:
        assert work.work_dir(spark).startswith("file:")


def test_work_of_this_application_is_cleared(spark):
    path = work.new_path(spark, "t")
    spark.range(3).write.parquet(path)
    assert spark.sparkContext.applicationId in path
    work.clear_work(spark)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_row_keys_are_unique_and_stable(spark):
    df, key = work.keyed(spark.range(1000).repartition(7), None)
    first = sorted(df.collect())
    assert len({r[key] for r in first}) == 1000
    assert sorted(df.collect()) == first
