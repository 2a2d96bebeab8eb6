import pytest
from pyspark.sql import functions as F

from corpusprep.functions import text as tx
from corpusprep.operators import quality, shape
from corpusprep.sources.mapping import FieldMapping


@pytest.fixture
def source(spark):
    rows = [(1, "text one", "Title", 5), (2, "", "", 6), (3, "nan", None, 7), (4, None, "Last", 8)]
    return spark.createDataFrame(rows, "id bigint, text string, title string, extra int")


def test_title_goes_in_front_and_an_empty_one_leaves_the_space(source):
    out = shape.apply_mapping(shape.null_fill(source), FieldMapping("id", "text", "title"))
    assert out.columns == ["id", "raw_text"]
    assert [r["raw_text"] for r in out.orderBy("id").collect()] == ["Title text one", " ", " nan", "Last "]


def test_single_field_is_renamed_and_the_rest_pruned(source):
    assert shape.apply_mapping(source, FieldMapping("id", "text")).columns == ["id", "raw_text"]


def test_several_fields_ignore_the_title(source):
    mapping = FieldMapping("id", ("text", "title"), "extra")
    assert shape.apply_mapping(source, mapping).columns == ["id", "text_raw_text", "title_raw_text"]
    assert mapping.language_field == "text"


def test_missing_columns_are_named(source):
    with pytest.raises(ValueError, match=r"\['body'\].*'id', 'text', 'title', 'extra'"):
        shape.apply_mapping(source, FieldMapping("id", "body"))


def test_sentinel_and_null_rows_go_but_empty_texts_stay(spark):
    rows = [("1", "a"), ("2", ""), ("3", "nan"), ("4", None), ("nan", "b"), ("6", "nan ")]
    df = spark.createDataFrame(rows, "id string, raw_text string")
    out = {tuple(r) for r in shape.drop_unusable(df, ["raw_text"]).collect()}
    assert out == {("1", "a"), ("2", ""), (None, "b"), ("6", "nan ")}


def test_output_names():
    assert shape.derived_names(["raw_text"], "lemmas") == ["lemmas"]
    # Names that share the part before the first underscore do not collide.
    assert shape.derived_names(["my_a_raw_text", "my_b_raw_text"], "lemmas") == ["my_a_lemmas", "my_b_lemmas"]
    with pytest.raises(ValueError, match="twice"):
        shape.derived_names(["a_raw_text", "a_raw_text"], "lemmas")


def test_lengths(spark):
    df = spark.createDataFrame([("añ😀", "x"), (None, "abcdef")], "a string, b string")
    assert quality.max_length(df, ["a", "b"]).first() == (3, 6, 6)
    assert quality.max_length(df, ["a"]).first() == (3, 3)
    # A column of nulls only does not hide the other one.
    empty = df.select(F.lit(None).cast("string").alias("a"), "b")
    assert quality.max_length(empty, ["a", "b"]).first()["max_length"] == 6


def test_overlength_counts_words_like_str_split(spark):
    texts = ["", "  ", "a b\tc\nd", "a b c", None, "x " * 400]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    expected = max(len(t.split()) for t in texts if t)
    assert quality.overlength_report(df, "t").first() == (expected, 1, 6)
    assert quality.overlength_report(df, "t", None).first()["n_above_limit"] == 0


def test_duplicate_ids(spark):
    df = spark.createDataFrame([(1,), (2,), (1,), (1,)], "id int")
    assert [tuple(r) for r in quality.duplicate_ids(df, "id").collect()] == [(1, 3)]


def test_alphabetic_tokens_are_dropped_whole_not_split(spark):
    text = "abc1 x-ray niño éa snake_case 42 Straße, it's (end)"
    df = spark.createDataFrame([(text,)], "t string")
    tokens = df.select(tx.alpha_words(F.col("t")).alias("x")).first()["x"]
    assert tokens == ["x", "ray", "niño", "Straße", "it", "s", "end"]


def test_part_number(spark):
    paths = [("/a/b_3/parquet_embeddings_part_12.parquet",), ("/part_4.parquet/x.parquet",), ("part_5.parquet.gz",)]
    df = spark.createDataFrame(paths, "p string").select(tx.part_number(F.col("p")).alias("n"))
    assert [r["n"] for r in df.collect()] == [12, None, None]
