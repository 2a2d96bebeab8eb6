"""Small word lists stay in the expression and large ones are joined: both give the same rows and the same columns."""

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import language, lemma, rewrite
from corpusprep.sources import tables

ROWS = [
    (1, "en", "The R&D of DNA isn't the end, covid-19 COVID it's", ["The", "of", "dna", "x"]),
    (2, None, "the DNA of R&D", ["the", "x"]),
    (3, "es", "R&D y OMS de la covid-19", ["de", "la", "y"]),
    (4, "en", None, None),
    (5, "en", "", []),
    (6, "xx", "the of de la", ["the", None, "x"]),
    (7, "en", "can't CAN’T covid-190 xR&D R&Dx (R&D)", ["x", "x"]),
]
SCHEMA = "id int, lang string, text string, tokens array<string>"
LIMITS = (10_000, 0)


def rows_of(df):
    return df.columns, sorted((tuple(r) for r in df.collect()), key=lambda r: r[df.columns.index("id")])


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture
def stopwords(spark):
    return spark.createDataFrame([("en", "the"), ("en", None), (None, "x"), ("es", "de"), ("en", "the")], "lang string, word string")


@pytest.mark.parametrize("lower", [True, False])
def test_stopwords(docs, stopwords, lower):
    one, two = (
        rows_of(lemma.drop_stopwords(docs, "tokens", stopwords, F.col("lang"), lower=lower, literal_entries=n)) for n in LIMITS
    )
    assert one == two
    by_id = {r[0]: r[3] for r in one[1]}
    assert by_id[4] is None and by_id[2] == ["the", "x"] and by_id[5] == []


@pytest.mark.parametrize("with_lexicon", [True, False])
def test_content_lemmas(spark, docs, stopwords, with_lexicon):
    lexicon = spark.createDataFrame([("en", "dna", "DNA", "NOUN"), (None, "x", "y", "NOUN"), ("en", None, "z", "ADP")], "lang string, form string, lemma string, pos string")
    one, two = (
        rows_of(
            lemma.content_lemmas(
                docs, "tokens", F.col("lang"), lexicon=lexicon if with_lexicon else None, surface_stopwords=stopwords,
                lemma_stopwords=stopwords, literal_entries=n,
            )
        )
        for n in LIMITS
    )
    assert one == two
    assert {r[0]: r[3] for r in one[1]}[2] == ["the", "x"]  # no language, no list


def test_rewriting(spark, docs):
    acronyms = spark.createDataFrame(
        [("en", "R&D", "research"), ("en", "COVID", "virus"), ("en", "COVID-19", "disease"), ("en", "DNA", "acid"), ("en", "DNA", "a"),
         ("es", "COVID", "el virus"), ("es", None, "x"), (None, "OMS", "y"), ("es", "OMS", None)],
        "lang string, acronym string, expansion string",
    )
    one, two = (rows_of(rewrite.expand_acronyms(docs, "text", acronyms, F.col("lang"), literal_entries=n)) for n in LIMITS)
    assert one == two
    text = {r[0]: r[2] for r in one[1]}
    assert text[1] == "The research of a isn't the end, disease virus it's"
    assert text[3] == "R&D y OMS de la el virus-19"
    assert text[7] == "can't CAN’T virus-190 xR&D R&Dx (research)"
    contractions = spark.createDataFrame(
        [("en", "isn't", "is not"), ("en", "can't", "cannot"), ("en", None, "x")], "lang string, contraction string, expansion string"
    )
    one, two = (rows_of(rewrite.expand_contractions(docs, "text", contractions, F.col("lang"), literal_entries=n)) for n in LIMITS)
    assert one == two
    assert {r[0]: r[2] for r in one[1]}[7].startswith("cannot Cannot ")


def test_case_sensitive_compounds(spark):
    docs = spark.createDataFrame([(1, "en", "r&d R&D")], "id int, lang string, text string")
    table = spark.createDataFrame([("en", "R&D", "research")], "lang string, acronym string, expansion string")
    for n in LIMITS:
        out = rewrite.expand_acronyms(docs, "text", table, F.col("lang"), case_sensitive=True, literal_entries=n)
        assert out.first()["text"] == "r&d research"


def test_votes(docs, stopwords):
    one, two = (rows_of(language.vote_language(docs, "text", stopwords, literal_entries=n)) for n in LIMITS)
    assert one == two


def test_an_input_is_never_written_over_however_its_path_is_written(spark, tmp_path, monkeypatch):
    source = tmp_path / "src"
    spark.range(3).write.parquet(str(source))
    df = spark.read.parquet(str(source))
    for path in (f"{tmp_path}/x/../src", f"file:{source}", f"file://{source}/", f"{source}/inside", f"{tmp_path}/./src"):
        with pytest.raises(ValueError, match="overlaps"):
            tables.save_parquet(df, path, inputs=[str(source)])
    here = spark._jvm.org.apache.hadoop.fs.Path("x").getFileSystem(spark._jsc.hadoopConfiguration()).getWorkingDirectory()
    with pytest.raises(ValueError, match="overlaps"):
        tables.save_parquet(df, "some/where", inputs=[f"{here.toUri().getPath()}/some"])
    assert spark.read.parquet(str(source)).count() == 3
