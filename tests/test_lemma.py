import re

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import lemma
from tests.conftest import plan_text


@pytest.fixture
def docs(spark):
    rows = [
        (1, "en", ["The", "Houses", "were", "Built", "Polish", "quickly"]),
        (2, "en", []),
        (3, "de", ["the", "Haus"]),
        (4, "en", ["the", "THE"]),
    ]
    return spark.createDataFrame(rows, "id bigint, lang string, tokens array<string>")


@pytest.fixture
def lexicon(spark):
    rows = [
        ("en", "houses", "house", "NOUN"),
        ("en", "built", "build", "VERB"),
        ("en", "polish", "Polish", "PROPN"),
        ("en", "the", "the", "DET"),
        ("en", "were", "be", "AUX"),
        ("de", "Haus", "Haus", "NOUN"),
    ]
    return spark.createDataFrame(rows, "lang string, form string, lemma string, pos string")


def words(spark, *pairs):
    return spark.createDataFrame(list(pairs), "lang string, word string")


def arrays(df):
    return {r["id"]: r["tokens"] for r in df.collect()}


@pytest.mark.parametrize("limit", [100, 0])
def test_stopwords_of_the_row_language_in_any_case(spark, docs, limit):
    stop = words(spark, ("en", "the"), ("en", "the"), ("en", "were"))
    out = lemma.drop_stopwords(docs, "tokens", stop, F.col("lang"), lower=True, key="id", literal_entries=limit)
    assert arrays(out) == {1: ["Houses", "Built", "Polish", "quickly"], 2: [], 3: ["the", "Haus"], 4: []}


@pytest.mark.parametrize("limit", [100, 0])
def test_lemma_stopwords_are_compared_before_lowercasing(spark, docs, lexicon, limit):
    stop = words(spark, ("en", "polish"), ("en", "house"))
    out = lemma.content_lemmas(
        docs, "tokens", F.col("lang"), lexicon=lexicon, lemma_stopwords=stop, key="id", literal_entries=limit
    )
    # "Polish" differs from "polish" and stays; "house" goes.
    assert arrays(out)[1] == ["build", "polish", "quickly"]
    plain = lemma.content_lemmas(docs, "tokens", F.col("lang"), lemma_stopwords=stop, key="id", literal_entries=limit)
    assert arrays(plain)[1] == ["the", "houses", "were", "built", "polish", "quickly"]


def test_parts_of_speech_and_unlisted_forms(spark, docs, lexicon):
    kept = lemma.content_lemmas(docs, "tokens", F.col("lang"), lexicon=lexicon, key="id")
    assert arrays(kept) == {1: ["house", "build", "polish", "quickly"], 2: [], 3: ["the", "haus"], 4: []}
    listed = lemma.content_lemmas(docs, "tokens", F.col("lang"), lexicon=lexicon, keep_unlisted=False, key="id")
    assert arrays(listed) == {1: ["house", "build", "polish"], 2: [], 3: ["haus"], 4: []}
    every = lemma.content_lemmas(docs, "tokens", F.col("lang"), lexicon=lexicon, keep_pos=None, key="id")
    assert arrays(every)[1] == ["the", "house", "be", "build", "polish", "quickly"]


@pytest.mark.parametrize("limit", [100, 0])
def test_both_lists_without_a_lexicon(spark, docs, limit):
    surface, lemmas = words(spark, ("en", "the")), words(spark, ("en", "Built"), ("en", "polish"))
    out = lemma.content_lemmas(
        docs, "tokens", F.col("lang"), surface_stopwords=surface, lemma_stopwords=lemmas, key="id", literal_entries=limit
    )
    assert arrays(out) == {1: ["houses", "were", "polish", "quickly"], 2: [], 3: ["the", "haus"], 4: []}


def test_a_form_with_two_readings_gives_one_token(spark):
    docs = spark.createDataFrame([(1, ["saw"])], "id bigint, tokens array<string>")
    rows = [("en", "saw", "see", "VERB"), ("en", "Saw", "saw", "NOUN")]
    lexicon = spark.createDataFrame(rows, "lang string, form string, lemma string, pos string")
    out = lemma.content_lemmas(docs, "tokens", F.lit("en"), lexicon=lexicon, key="id")
    assert arrays(out) == {1: ["saw"]}


def test_equal_ids_stay_apart_without_a_key(spark, lexicon):
    docs = spark.createDataFrame([(1, ["houses"]), (1, ["built"])], "id bigint, tokens array<string>")
    out = lemma.content_lemmas(docs, "tokens", F.lit("en"), lexicon=lexicon)
    assert sorted(r["tokens"] for r in out.collect()) == [["build"], ["house"]]


def test_small_lists_move_no_rows(spark, docs):
    from tests.conftest import plan_text

    stop = words(spark, ("en", "the"))
    text = plan_text(lemma.content_lemmas(docs, "tokens", F.col("lang"), surface_stopwords=stop))
    assert "Exchange" not in text and "Join" not in text


def test_a_large_lexicon_meets_documents_in_chunks(spark, docs, lexicon, monkeypatch):
    """Tokens are not joined one by one, and rows are those of the broadcast; a key may have several rows."""
    more = spark.createDataFrame([(3, "en", ["Houses", None, "the"]), (3, "de", None), (None, "en", ["polish"])], docs.schema)
    docs = docs.unionByName(more)
    stop, capital = words(spark, ("en", "the"), ("de", "the")), words(spark, ("en", "Polish"))

    def results(literal_entries):
        found = lemma.lookup_lemmas(docs, "tokens", lexicon, F.col("lang"), key="id")[1]
        kept = lemma.content_lemmas(
            docs, "tokens", F.col("lang"), lexicon=lexicon, surface_stopwords=stop, lemma_stopwords=capital, key="id",
            literal_entries=literal_entries,
        )
        return found, kept, [sorted(map(str, rows.collect())) for rows in (found, kept)]

    usual = results(100)[2]
    monkeypatch.setattr(lemma, "is_small", lambda measured: False)
    for literal_entries in (100, 0):
        found, kept, rows = results(literal_entries)
        assert rows == usual
        for plan in map(plan_text, (found, kept)):
            assert "FlatMapCoGroupsInArrow" in plan
            assert not re.search(r"\(\d+\) Exchange\b[^\n]*\nInput \[\d+\]: \[[^\]]*\bpos#[^\]]*\bform#", plan)
