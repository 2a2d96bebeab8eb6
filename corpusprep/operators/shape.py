"""From a source table to a corpus: id column plus raw-text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.sources.mapping import FieldMapping

_SUFFIX = "_raw_text"


def null_fill(df: DataFrame) -> DataFrame:
    """Null text becomes the empty string."""
    return df.fillna("")


def check_columns(df: DataFrame, mapping: FieldMapping) -> None:
    missing = [c for c in mapping.used_columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are not in the source; it has {df.columns}")


def corpus_text_columns(mapping: FieldMapping) -> list[str]:
    """Names of the text columns that ``apply_mapping`` makes."""
    return [f + _SUFFIX for f in mapping.text_fields] if mapping.several else ["raw_text"]


def apply_mapping(df: DataFrame, mapping: FieldMapping, keep: tuple[str, ...] = ()) -> DataFrame:
    """Keep the id and the text column(s), named for the steps that follow.

    One text column becomes ``raw_text``, with the title and a space in front
    when the source has a title. An empty title leaves the space. Several text
    columns become ``<name>_raw_text`` each, and a title is not used.
    """
    check_columns(df, mapping)
    if mapping.several:
        texts = [F.col(f).alias(f + _SUFFIX) for f in mapping.text_fields]
    elif mapping.title:
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (mapping.title, mapping.raw_text)]
        texts = [F.concat_ws(" ", *parts).alias("raw_text")]
    else:
        texts = [F.col(mapping.raw_text).alias("raw_text")]
    return df.select(mapping.id, *texts, *keep)


def drop_unusable(corpus: DataFrame, text_columns: list[str]) -> DataFrame:
    """The cell value ``nan`` becomes null everywhere; rows without all texts go."""
    return corpus.replace("nan", None).dropna(how="any", subset=text_columns)


def derived_names(text_columns: list[str], kind: str) -> list[str]:
    """Names of the ``lemmas`` or ``embeddings`` columns, in order of the text columns.

    A single text column gives the plain name, several give ``<field>_<kind>``.
    """
    if len(text_columns) == 1:
        return [kind]
    names = [c.removesuffix(_SUFFIX) + "_" + kind for c in text_columns]
    if len(set(names)) < len(names):
        raise ValueError(f"text columns {text_columns} give the same output name twice")
    return names
