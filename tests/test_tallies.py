from collections import Counter

from pyspark.sql import functions as F

from corpusprep.functions import text as tx
from corpusprep.operators import language, phrases, tallies
from corpusprep.streaming import phrase_counts
from corpusprep.work import explode_each, new_path
from tests.conftest import plan_text

ODD = [
    ("a", "É1 abc_d Straße ǅ ﬁ x²  éa 日本語 \U0001f600a\U00010400b İstanbul ſs K 1a a1 ab é e"),
    (None, "a b a"), ("a", None), ("a", ""), ("b", " "), ("b", "z"), ("b", "z\nz\x00z"), ("c", "".join(map(chr, range(0x4E00, 0x4F00)))),
]


def test_words_of_texts_are_those_of_the_pattern(spark):
    docs = spark.createDataFrame(ODD, "lang string, t string")
    long = explode_each(docs, ["lang"], tx.alpha_words(F.lower("t")), "word")
    right = {(r["lang"], r["word"]): r["count"] for r in long.groupBy("lang", "word").count().collect()}
    found = tallies.word_tallies(docs, F.lower("t"), F.col("lang"))
    sums = found.groupBy("by", "word").agg(F.sum("n").alias("n"))
    assert {(r["by"], r["word"]): r["n"] for r in sums.collect()} == right
    assert right[("b", "z")] == 4 and "Generate" not in plan_text(found)


def test_trigrams_of_texts_are_those_of_the_pattern(spark):
    docs = spark.createDataFrame(ODD, "lang string, t string")
    texts = [(r["lang"], f" {r['t']} ") for r in docs.select("lang", tx.letter_text(F.col("t")).alias("t")).dropna(subset="t").collect()]
    right = Counter((lang, t[i : i + 3]) for lang, t in texts for i in range(len(t) - 2))
    found = language.trigram_counts(docs, "t", "lang")
    assert {(r["lang"], r["gram"]): r["n"] for r in found.collect()} == right
    # No text passes a pattern, neither when it is counted nor when it is scored.
    model = language.train_language_model(docs, "t", "lang")
    labelled = language.predict_language(docs.select(F.monotonically_increasing_id().alias("id"), "t"), "t", model, key="id")
    assert "regexp" not in plan_text(found) and "regexp" not in plan_text(labelled)


def test_scores_by_numbers_are_those_of_the_join(spark):
    docs = spark.createDataFrame([(i, *row) for i, row in enumerate(ODD)], "id int, lang string, t string")
    model = language.train_language_model(docs, "t", "lang")
    by_numbers, by_join = (
        language.predict_language(docs, "t", model, key="id", model_cells=cells).select("id", "pred_lang").collect()
        for cells in (language.MODEL_CELLS, 1)
    )
    assert sorted(by_numbers) == sorted(by_join) and len(by_join) == len(ODD)


def test_pairs_are_counted_where_they_are_read(spark):
    rows = [(["a", "b", "a", "b"],), (["b", None, "a"],), (["c"],), ([],), (None,), (["a", "b"],)]
    docs = spark.createDataFrame(rows, "tokens array<string>").coalesce(1)
    right = sorted(phrases.follow_counts(docs).collect(), key=str)
    found = tallies.pair_tallies(docs, F.col("tokens"))
    assert sorted(phrases.merge_counts(found).collect(), key=str) == right
    assert "Exchange" not in plan_text(found)


def test_a_batch_of_files_is_not_shuffled(spark, monkeypatch):
    base = new_path(spark, "pairs")
    docs = spark.createDataFrame([(["a", "b", "a"],), (["a", "b"],)], "tokens array<string>")
    docs.write.parquet(f"{base}/in")
    plans = []

    def process(spark, source, store, checkpoint, step, *args):
        plans.append(plan_text(step(spark.read.parquet(source))))

    monkeypatch.setattr(phrase_counts, "process_new_files", process)
    phrase_counts.count_new_files(spark, f"{base}/in", f"{base}/counts", f"{base}/checkpoint", lambda batch: batch)
    assert "Exchange" not in plans[0]


def test_counts_of_parts_are_added_up_behind_the_shuffle(spark):
    rows = [("a", "b", 1), ("a", "b", 2), ("a", None, 1), ("a", None, 4), (None, "b", 1)]
    counts = spark.createDataFrame(rows, "w string, nx string, n bigint")
    merged = phrases.merge_counts(counts)
    tree = plan_text(merged).split("\n\n")[0]
    assert sorted(map(tuple, merged.collect()), key=str) == sorted([("a", "b", 3), ("a", None, 5), (None, "b", 1)], key=str)
    assert tree.count("Exchange") == 1 and tree.rindex("HashAggregate") < tree.index("Exchange")
