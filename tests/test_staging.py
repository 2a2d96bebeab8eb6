"""Tables staged by key: texts and tokens move once, when they are staged."""

import re

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from corpusprep import work
from corpusprep.plans.catalog import QUERIES
from tests.conftest import plan_text

WIDE = re.compile(r"\b(text|raw_text|tokens|_tokens|_text|lemmas)#")


def moved(plan: str) -> list[tuple[str, str]]:
    """(how, columns) of each exchange in a formatted plan whose rows have texts or tokens."""
    found = []
    for block in re.split(r"\n\n+", plan):
        if re.match(r"\(\d+\) (Exchange|BroadcastExchange)", block):
            columns = re.search(r"Input \[\d+\]: \[(.*)\]", block)[1]
            how = re.search(r"Arguments: (.*)", block)[1]
            if WIDE.search(columns):
                found.append((how, columns))
    return found


@pytest.mark.parametrize("name", ["lang_filter", "phrase_merge", "embed_hash", "prepare_titled", "pos_filter"])
def test_texts_and_tokens_are_moved_by_staging_only(spark, data, monkeypatch, name):
    plans = []
    for method in ("parquet", "saveAsTable"):
        write = getattr(DataFrameWriter, method)

        def recorded(self, *args, write=write, **kwargs):
            plans.append(plan_text(self._df))
            return write(self, *args, **kwargs)

        monkeypatch.setattr(DataFrameWriter, method, recorded)
    monkeypatch.setattr(work, "SPREAD_BYTES_PER_CORE", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans.append(plan_text(QUERIES[name](spark, data)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [m for plan in plans for m in moved(plan)]
    assert len(exchanges) == 1 and "REPARTITION_BY_NUM" in exchanges[0][0]
    assert not moved(plans[-1])


def test_a_stage_is_found_by_its_key_without_a_shuffle(spark):
    rows = spark.range(1000).select("id", F.col("id").cast("string").alias("text"))
    stage = work.staged(rows, "id", "stage")
    again = work.staged(stage.where("id % 2 = 0"), "id", "again", dealt=True)
    assert sorted(stage.collect()) == sorted(rows.collect()) and again.count() == 500
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("corpusprep_")]
    counts = stage.select("id", F.explode(F.split("text", "")).alias("c")).groupBy("id").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = stage.join(counts, "id").join(again.select("id"), "id", "left_semi")
        assert "Exchange" not in plan_text(joined) and joined.count() == 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_with_equal_or_missing_keys_are_kept(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k bigint, v string")
    assert sorted(r["v"] for r in work.staged(rows, "k", "stage").collect()) == ["a", "b", "c"]
