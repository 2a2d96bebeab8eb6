"""A third of all rows are copies of one document with one id; tables are too large to broadcast."""

import random

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import language, lemma
from corpusprep.operators import phrases as ph
from corpusprep.operators.embed import embed_hash
from corpusprep.plans import prepare as prep
from corpusprep.sources.mapping import FieldMapping
from tests.test_embed import by_hand
from tests.test_phrases import brute_scores, one_by_one

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
}


@pytest.fixture
def skewed(spark, monkeypatch):
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    for module in (ph, lemma, language):
        monkeypatch.setattr(module, "broadcast_if_small", lambda df, *_, **__: df)
    rng = random.Random(11)
    words = ["alpha", "beta", "gamma", "delta", "new", "york"] + [f"w{chr(97 + i)}" for i in range(26)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 40))) for _ in range(600)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(-1, "new york alpha beta alpha beta alpha")] * 300
    yield rows, spark.createDataFrame(rows, "id bigint, text string").repartition(8)
    for name in SETTINGS:
        spark.conf.unset(name)


def test_phrases(spark, skewed):
    rows, df = skewed
    docs = [t.split() for _, t in rows]
    found = brute_scores(docs, 2, 1.0)
    tokens = lemma.tokenise(df, "text").drop("text")
    learned = ph.learn_phrases(tokens, threshold=1.0)
    assert {(r["w"], r["nx"]) for r in learned.collect()} == set(found)
    got = sorted(tuple(r) for r in ph.merge_phrases(tokens, learned).select("id", "lemmas").collect())
    assert got == sorted((i, one_by_one(t.split(), set(found))) for i, t in rows)


def test_lemmas(spark, skewed):
    rows, df = skewed
    lexicon = spark.createDataFrame(
        [("en", "alpha", "first", "NOUN"), ("en", "beta", "second", "DET")],
        "lang string, form string, lemma string, pos string",
    )
    plan = prep.Preparation(FieldMapping("id", "text"), language_by="code", lexicon=lexicon, ngrams=False)
    out = prep.prepare(df.withColumn("code", F.lit("en")), plan)
    expected = [
        (i, t, " ".join("first" if w == "alpha" else w for w in t.split() if w != "beta")) for i, t in rows
    ]
    assert sorted(tuple(r) for r in out.collect()) == sorted(expected)


def test_vectors_and_languages(spark, skewed):
    rows, df = skewed
    vectors = embed_hash(df, "text", 8).collect()
    assert len(vectors) == len(rows)
    for row in vectors[::50]:
        assert row["embeddings"] == pytest.approx(by_hand(row["text"], 8))
    labelled = df.withColumn("lang", F.when(F.col("id") < 0, "copy").otherwise("rest"))
    model = language.train_language_model(labelled, "text", "lang")
    out = language.predict_language(df, "text", model)
    assert out.count() == len(rows)
    assert out.where("id < 0 AND pred_lang = 'copy'").count() == 300
