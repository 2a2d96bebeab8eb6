import pytest
from pyspark.sql import functions as F

from corpusprep.operators.embed import embed_hash
from corpusprep.operators.phrases import learn_phrases
from corpusprep.plans import prepare as prep
from corpusprep.sources import lexicons
from corpusprep.sources.mapping import FieldMapping


@pytest.fixture
def source(spark):
    rows = [(i, "en", "new york has it", "red car") for i in range(6)]
    rows += [(6, "es", "la casa y el perro", "red car"), (7, "en", "nan", "red car"), (7, "en", "a city in itself", "blue car")]
    rows += [(8, "en", "", "x"), (9, "en", None, "y")]
    return spark.createDataFrame(rows, "num bigint, code string, body string, head string")


def plan(spark, mapping, **options):
    return prep.Preparation(
        mapping=mapping, language_by="code", acronyms=lexicons.acronyms(spark),
        surface_stopwords=lexicons.default_stopwords(spark), **{"threshold": 0.1, **options},
    )


def test_one_text_column_with_title_and_equal_ids(spark, source):
    out = prep.prepare(source, plan(spark, FieldMapping("num", "body", "head")))
    assert out.columns == ["num", "raw_text", "lemmas"]
    rows = [tuple(r) for r in out.collect()]
    assert rows.count((0, "red car new york has it", "red_car new_york information_technology")) == 1
    # The sentinel counts only when it is the whole cell.
    assert (7, "red car nan", "red_car nan") in rows
    assert (7, "blue car a city in itself", "blue car city itself") in rows
    assert {r[0] for r in rows} == {0, 1, 2, 3, 4, 5, 7, 8, 9} and len(rows) == 10


def test_without_title_unusable_rows_go(spark, source):
    out = prep.prepare(source, plan(spark, FieldMapping("num", "body"), ngrams=False))
    got = {(r["num"], r["lemmas"]) for r in out.collect()}
    assert (0, "new york information technology") in got and (8, "") in got and (9, "") in got
    assert (7, "city itself") in got and len(got) == 9


def test_each_text_column_has_phrases_of_its_own(spark, source):
    out = prep.prepare(source, plan(spark, FieldMapping("num", ("head", "body"))))
    assert out.columns == ["num", "head_raw_text", "body_raw_text", "head_lemmas", "body_lemmas"]
    row = out.where("num = 0").first()
    assert (row["head_lemmas"], row["body_lemmas"]) == ("red_car", "new_york information_technology")


def test_phrases_learned_before_can_be_given(spark, source):
    given = spark.createDataFrame([("york", "information")], "w string, nx string")
    out = prep.prepare(source, plan(spark, FieldMapping("num", "body"), phrases={"raw_text": given}))
    assert out.where("num = 0").first()["lemmas"] == "new york_information technology"


def test_language_by_vote(spark, source):
    config = prep.Preparation(
        mapping=FieldMapping("num", "body"), language_by=lexicons.default_stopwords(spark), lang="es", ngrams=False
    )
    assert [r["num"] for r in prep.prepare(source, config).collect()] == [6]


def test_run_writes_and_takes_up_its_result(spark, source, tmp_path):
    path, target = str(tmp_path / "in.parquet"), str(tmp_path / "out.parquet")
    source.write.parquet(path)
    config = plan(spark, FieldMapping("num", "body"))
    encode = prep.hash_encoder(8)
    both = prep.run(spark, path, target, config, encode=encode, as_text=True)
    assert both == [target, str(tmp_path / "out_embeddings.parquet")]
    assert spark.read.parquet(target).columns == ["num", "raw_text", "lemmas"]
    vectors = spark.read.parquet(both[1])
    assert sorted(vectors.columns) == ["embeddings", "lemmas", "num", "raw_text"]
    assert dict(vectors.dtypes)["embeddings"] == "string"
    assert vectors.where(F.size(F.split("embeddings", " ")) == 8).count() == 9

    # Embeddings only: the lemmas of the earlier run are kept.
    (again,) = prep.run(spark, path, target, config, preprocess=False, encode=encode)
    assert dict(spark.read.parquet(again).dtypes)["embeddings"] == "array<double>"
    # Without an earlier run the source is shaped and embedded.
    (fresh,) = prep.run(spark, path, str(tmp_path / "other"), config, preprocess=False, encode=encode)
    assert fresh == str(tmp_path / "other_embeddings")
    assert spark.read.parquet(fresh).columns == ["num", "raw_text", "embeddings"]


def test_embeddings_of_several_columns(spark):
    df = spark.createDataFrame([(1, "a", "b")], "id int, x_raw_text string, y_raw_text string")
    out = prep.add_embeddings(df, ["x_raw_text", "y_raw_text"], prep.hash_encoder(4, key="id"))
    assert out.columns == ["id", "x_raw_text", "y_raw_text", "x_embeddings", "y_embeddings"]
    expected = embed_hash(df, "y_raw_text", 4, key="id").first()["embeddings"]
    assert out.first()["y_embeddings"] == expected


def test_a_warning_tells_about_long_texts(spark):
    df = spark.createDataFrame([(1, "w " * 10)], "id int, raw_text string")
    with pytest.warns(UserWarning, match="10 words"):
        prep.add_embeddings(df, ["raw_text"], prep.hash_encoder(4, 5, "id"), max_words=5)


def test_errors(spark, source, tmp_path):
    config = plan(spark, FieldMapping("num", "body"))
    with pytest.raises(ValueError, match="nothing to do"):
        prep.run(spark, "/x", "/y", config, preprocess=False)
    with pytest.raises(ValueError, match="does not exist"):
        prep.run(spark, str(tmp_path / "none"), "/y", config)
    with pytest.raises(ValueError, match="'fr' is not supported"):
        prep.run(spark, "/x", "/y", plan(spark, FieldMapping("num", "body"), lang="fr"))
    path = str(tmp_path / "in")
    source.write.parquet(path)
    with pytest.raises(ValueError, match="overlaps"):
        prep.run(spark, path, path, config)
    assert spark.read.parquet(path).count() == 11


def test_learning_is_per_corpus(spark):
    docs = spark.createDataFrame([(1, ["a", "b"])], "id bigint, tokens array<string>")
    assert learn_phrases(docs).count() == 0
