import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from corpusprep.functions import text as tx
from corpusprep.operators import phrases as ph
from corpusprep.operators.embed import embed_hash
from corpusprep.operators.rewrite import expand_acronyms
from corpusprep.sources import lexicons
from corpusprep.streaming.incremental import PART, finished_parts, process_missing_parts, process_new_files, read_processed
from corpusprep.streaming.phrase_counts import count_new_files, counts_so_far


def step(batch):
    return embed_hash(batch, "raw_text", 8)


def test_second_run_takes_only_new_files(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    assert read_processed(spark, target) is None
    first = spark.createDataFrame([(1, "one"), (2, "two words")], "id bigint, raw_text string")
    first.coalesce(1).write.parquet(source)
    assert process_new_files(spark, source, target, checkpoint, step) == 2
    assert process_new_files(spark, source, target, checkpoint, step) == 0
    assert read_processed(spark, target).count() == 2
    spark.createDataFrame([(3, "three")], first.schema).coalesce(1).write.mode("append").parquet(source)
    assert process_new_files(spark, source, target, checkpoint, step) == 1
    out = read_processed(spark, target)
    assert sorted(r["id"] for r in out.collect()) == [1, 2, 3]
    assert sorted(out.columns) == ["embeddings", "id", "raw_text"]
    assert out.where(F.size("embeddings") == 8).count() == 3


def test_files_with_old_times_are_taken_too(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    spark.createDataFrame([(1, "one")], "id bigint, raw_text string").coalesce(1).write.parquet(source)
    assert process_new_files(spark, source, target, checkpoint, step) == 1
    spark.createDataFrame([(2, "two")], "id bigint, raw_text string").coalesce(1).write.parquet(str(tmp_path / "late"))
    for file in (tmp_path / "late").glob("part-*"):
        old = time.time() - 90 * 86_400
        shutil.copy(file, source)
        os.utime(f"{source}/{file.name}", (old, old))
    assert process_new_files(spark, source, target, checkpoint, step) == 1
    assert {r["id"] for r in read_processed(spark, target).collect()} == {1, 2}


def test_rows_are_counted_when_more_batches_ran_than_progress_is_kept(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    spark.range(0, 8, 1, 8).select("id", F.lit("text").alias("raw_text")).write.parquet(source)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        assert process_new_files(spark, source, target, checkpoint, step, max_files_per_batch=1) == 8
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_a_new_checkpoint_never_writes_over_earlier_output(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, "one")], "id bigint, raw_text string").write.parquet(source)
    process_new_files(spark, source, target, str(tmp_path / "check"), step)
    with pytest.raises(ValueError, match="does not know"):
        process_new_files(spark, source, target, str(tmp_path / "other"), step)
    assert read_processed(spark, target).count() == 1
    with pytest.raises(ValueError, match="overlaps"):
        process_new_files(spark, source, f"{source}/out", str(tmp_path / "third"), step)


def test_parts_that_are_missing_are_processed(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "id int")
    for n in (1, 2, 10):
        df.withColumn("n", F.lit(n)).write.parquet(str(tmp_path / "in" / f"x_part_{n}.parquet"))
    half = tmp_path / "out" / "x_part_2.parquet"
    half.mkdir(parents=True)  # begun and not completed
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    df.write.parquet(f"{target}/x_part_10.parquet")
    assert process_missing_parts(spark, source, target, lambda d: d) == ["x_part_1.parquet", "x_part_2.parquet"]
    assert process_missing_parts(spark, source, target, lambda d: d) == []


def test_missing_parts_are_one_job(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    for n in range(5):
        rows = spark.range(n * 10, n * 10 + 4).withColumn("x", F.col("id") % 2)
        rows.where("id < 40").write.parquet(f"{source}/x_part_{n}.parquet")
    spark.createDataFrame([(9,)], "id bigint").toPandas().to_parquet(tmp_path / "in" / "x_part_7.parquet")
    calls = []

    def step(df):
        calls.append(1)
        return df.groupBy(PART, "x").agg(F.sum("id").alias("total"))

    with pytest.raises(ValueError, match="_part"):
        process_missing_parts(spark, source, target, lambda d: d.drop(PART))
    with pytest.raises(Exception, match="no good"):
        process_missing_parts(spark, source, target, lambda d: d.withColumn("id", F.raise_error(F.lit("no good"))))
    assert not (tmp_path / "out").exists() or not list((tmp_path / "out").iterdir())
    assert len(process_missing_parts(spark, source, target, step, gather=True)) == 6 and calls == [1]
    assert process_missing_parts(spark, source, target, step) == [] and calls == [1]
    for n in (0, 3, 7):
        got = {(r["x"], r["total"]) for r in spark.read.parquet(f"{target}/x_part_{n}.parquet").collect()}
        assert got == ({(None, 9)} if n == 7 else {(0, 20 * n + 2), (1, 20 * n + 4)})
    assert [p.name for p in (tmp_path / "out" / "x_part_4.parquet").iterdir() if not p.name.startswith(".")] == ["_SUCCESS"]


def test_phrase_counts_over_batches(spark, tmp_path):
    source, store, checkpoint = (str(tmp_path / n) for n in ("in", "counts", "check"))
    texts = ["a b a b", "a b c", "", "c c c", "b a"]
    docs = spark.createDataFrame([(i, x.split()) for i, x in enumerate(texts)], "id bigint, tokens array<string>")
    for i in range(len(texts)):
        docs.where(F.col("id") == i).coalesce(1).write.mode("append").parquet(source)
        assert count_new_files(spark, source, store, checkpoint, lambda b: b) == 1
    # The last batch was written and not committed, as after a failure: it is repeated.
    for name in ("4", ".4.crc"):
        (tmp_path / "check" / "commits" / name).unlink(missing_ok=True)
    assert count_new_files(spark, source, store, checkpoint, lambda b: b) == 1
    rows = sorted(map(str, counts_so_far(spark, store).collect()))
    assert rows == sorted(map(str, ph.follow_counts(docs).collect()))
    assert counts_so_far(spark, str(tmp_path / "none")) is None


def test_files_can_be_taken_a_few_at_a_time(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    df = spark.range(0, 40, 1, 4).select("id", F.lit("text").alias("raw_text"))
    df.write.parquet(source)
    rows = process_new_files(spark, source, target, checkpoint, step, max_files_per_batch=1)
    assert rows == 40
    assert len([p for p in (tmp_path / "out").iterdir() if p.name.startswith("batch=")]) == 4
    assert read_processed(spark, target).count() == 40


def test_row_wise_steps_run_on_the_stream_itself(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [(1, "MRI of the knee"), (2, "")]
    spark.createDataFrame(rows, "id bigint, raw_text string").write.parquet(source)
    stream = spark.readStream.schema("id bigint, raw_text string").parquet(source)
    out = expand_acronyms(stream, "raw_text", lexicons.acronyms(spark), F.lit("en"))
    out = out.withColumn("tokens", tx.join_tokens(tx.alpha_words(F.col("raw_text"))))
    query = (
        out.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "check"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    got = {r["id"]: r["tokens"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: "magnetic resonance image of the knee", 2: ""}


def test_phrases_learned_before_are_merged_into_new_files(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    frozen = spark.createDataFrame([("new", "york")], "w string, nx string")
    docs = spark.createDataFrame([(1, ["in", "new", "york"])], "id bigint, tokens array<string>")
    docs.write.parquet(source)
    process_new_files(spark, source, target, checkpoint, lambda b: ph.merge_phrases(b, frozen, key="id"))
    assert read_processed(spark, target).first()["lemmas"] == "in new_york"


def test_finished_parts_by_file_name(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "id int").toPandas()
    for name in ("parquet_embeddings_part_3.parquet", "parquet_embeddings_part_10.parquet", "other.parquet"):
        df.to_parquet(tmp_path / name)
    assert sorted(r["part"] for r in finished_parts(spark, str(tmp_path)).collect()) == [3, 10]


def test_a_step_that_is_folded_away_counts_its_rows_and_commits(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    spark.range(5).select("id", F.lit("text").alias("raw_text")).coalesce(1).write.parquet(source)
    assert process_new_files(spark, source, target, checkpoint, lambda batch: batch.where("false")) == 5
    assert process_new_files(spark, source, target, checkpoint, lambda batch: batch.where("false")) == 0
    assert read_processed(spark, target).count() == 0
