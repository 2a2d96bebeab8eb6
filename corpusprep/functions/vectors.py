"""Column expressions over embedding vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _numbers(vector: Column, digits: int | None) -> Column:
    def as_text(x: Column) -> Column:
        number = x.cast("string")
        if digits is not None:
            # A decimal prints in plain notation, without an exponent or a negative zero. NaN and the infinities stay.
            number = F.coalesce(x.cast("double").try_cast(f"decimal({18 + digits},{digits})").cast("string"), number)
        return F.coalesce(number, F.lit("NaN"))

    return F.transform(vector, as_text)


def vector_text(vector: Column, digits: int | None = None) -> Column:
    """Numbers separated by one space: as many as the vector has, a missing one as NaN.

    Every number reads back as the same number; with ``digits`` they are rounded instead.
    """
    return F.array_join(_numbers(vector, digits), " ")


def vector_list_text(vector: Column, digits: int | None = None) -> Column:
    """Numbers as ``[a, b, c]``, otherwise as ``vector_text``."""
    return F.concat(F.lit("["), F.array_join(_numbers(vector, digits), ", "), F.lit("]"))


def parse_vector(text: Column) -> Column:
    """Either text form back to an array of doubles."""
    return F.transform(
        F.regexp_extract_all(text, F.lit(r"([^\s,\[\]]+)"), F.lit(1)), lambda x: x.cast("double")
    )

