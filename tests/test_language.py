import collections

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import language
from corpusprep.sources import lexicons


def test_labels_of_unseen_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = language.train_language_model(docs.where("doc_id % 2 = 0"), "text", "lang")
    assert model.languages == ["de", "en", "es", "fr"]
    unseen = docs.where("doc_id % 2 = 1")
    labelled = language.predict_language(unseen, "text", model, key="doc_id")
    right = labelled.where("lang = pred_lang").count()
    assert labelled.count() == unseen.count()
    assert right >= 0.97 * unseen.count()


def test_texts_without_letters_are_other(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = language.train_language_model(docs, "text", "lang")
    rows = [(1, ""), (2, "12 345 --"), (3, None), (4, "der die das und nicht")]
    df = spark.createDataFrame(rows, "id bigint, t string")
    got = {r["id"]: r["pred_lang"] for r in language.predict_language(df, "t", model).collect()}
    assert got == {1: "Other", 2: "Other", 3: "Other", 4: "de"}


def test_equal_scores_go_to_the_first_language(spark):
    labelled = spark.createDataFrame([("b", "same"), ("a", "same"), (None, "other")], "lang string, t string")
    model = language.train_language_model(labelled, "t", "lang")
    out = language.predict_language(spark.createDataFrame([(1, "same")], "id int, t string"), "t", model, key="id")
    assert out.first()["pred_lang"] == "a"


def test_counts_use_the_whole_text(spark):
    text = "a" + " " * 5 + "bcd " * 1000 + "xyz"
    counts = language.trigram_counts(spark.createDataFrame([("l", text)], "lang string, t string"), "t", "lang")
    found = {r["gram"]: r["n"] for r in counts.collect()}
    assert found["bcd"] == 1000 and found["xyz"] == 1 and found[" a "] == 1


def test_too_many_labels_are_refused(spark):
    df = spark.range(1100).select(F.col("id").cast("string").alias("lang"), F.lit("abc").alias("t"))
    with pytest.raises(ValueError, match="more than 1000"):
        language.train_language_model(df, "t", "lang")


@pytest.mark.parametrize("limit", [10_000, 1])
def test_votes(spark, limit):
    rows = [(1, "The cat and the dog"), (2, "el perro y la casa"), (3, "xyz"), (4, ""), (5, "in"), (6, None)]
    df = spark.createDataFrame(rows, "id bigint, t string")
    out = language.vote_language(df, "t", lexicons.default_stopwords(spark), key="id", literal_entries=limit)
    got = {r["id"]: r["pred_lang"] for r in out.collect()}
    assert got == {1: "en", 2: "es", 3: "Other", 4: "Other", 5: "de", 6: "Other"}


def test_large_models_are_not_broadcast(spark, data, monkeypatch):
    from tests.conftest import plan_text

    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = language.train_language_model(docs, "text", "lang")
    usual = language.predict_language(docs, "text", model, key="doc_id").select("doc_id", "pred_lang")
    monkeypatch.setattr(language, "broadcast_if_small", lambda df, *_, **__: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = language.predict_language(docs, "text", model, key="doc_id").select("doc_id", "pred_lang")
        assert "BroadcastHashJoin" not in plan_text(shuffled)
        assert sorted(shuffled.collect()) == sorted(usual.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_trigrams_are_counted_in_the_tasks(spark, data):
    """What is grouped are distinct trigrams of a batch, not one row for each letter."""
    from corpusprep.operators import trigrams
    from tests.conftest import plan_text

    docs = spark.read.parquet(f"{data}/documents.parquet").select("lang", "text")
    counts = language.trigram_counts(docs, "text", "lang")
    model = language.train_language_model(docs, "text", "lang")
    labelled = language.predict_language(docs.withColumn("id", F.monotonically_increasing_id()), "text", model, key="id")
    assert "Generate" not in plan_text(counts) and "Generate" not in plan_text(labelled)

    def by_hand(text):
        letters = f" {' '.join(''.join(c if c.isalpha() else ' ' for c in text.lower()).split())} "
        return [letters[i : i + 3] for i in range(len(letters) - 2)]

    rows = docs.collect()
    expected = collections.Counter((r["lang"], g) for r in rows for g in by_hand(r["text"]))
    assert {(r["lang"], r["gram"]): r["n"] for r in counts.collect()} == expected
    assert trigrams.unpack(trigrams.pack("a😀 ")) == "a😀 "


def test_models_of_any_size_give_the_same_labels(spark, data, monkeypatch):
    from corpusprep.operators import trigrams

    monkeypatch.setattr(trigrams, "CHARACTERS", 500)
    docs = spark.read.parquet(f"{data}/documents.parquet").select(F.col("doc_id").alias("id"), "text", "lang")
    odd = spark.createDataFrame([(-1, "", None), (-2, None, "de"), (-3, "1 2", "en"), (-4, "a", "xx"), (-4, "der", None)], docs.schema)
    docs = docs.unionAll(odd)
    model = language.train_language_model(docs, "text", "lang")
    sent, joined = (
        sorted(language.predict_language(docs, "text", model, key="id", model_cells=cells).select("id", "pred_lang").collect())
        for cells in (10**6, 0)
    )
    assert sent == joined and len(sent) == docs.count()
