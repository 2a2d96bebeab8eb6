"""Numbers about a corpus that are looked at before the costly steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.text import word_count


def max_length(df: DataFrame, columns: list[str]) -> DataFrame:
    """Longest value in characters: one column per text column, and over all of them."""
    longest = df.agg(*[F.max(F.length(c)).alias(f"max_{c}") for c in columns])
    each = [F.col(f"max_{c}") for c in columns]
    return longest.withColumn("max_length", F.greatest(*each) if len(each) > 1 else each[0])


def overlength_report(df: DataFrame, text_col: str, max_words: int | None = 384) -> DataFrame:
    """Longest text in words and how many texts an encoder with this limit would cut."""
    limit = F.lit(max_words).cast("int")
    return df.select(word_count(F.coalesce(F.col(text_col), F.lit(""))).alias("n")).agg(
        F.coalesce(F.max("n"), F.lit(0)).cast("bigint").alias("max_words"),
        F.count_if(F.col("n") > limit).alias("n_above_limit"),
        F.count(F.lit(1)).alias("n_texts"),
    )


def duplicate_ids(df: DataFrame, id_col: str) -> DataFrame:
    """Ids that occur more than once, with their number of rows."""
    return df.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
