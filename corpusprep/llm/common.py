"""What the operators share: reading tables, free column names, plain Python values out of Arrow batches."""

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITESPACE = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """The column of exactly this name, dots and quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(wanted: str, *frames: DataFrame) -> str:
    """``wanted``, or the same with underscores behind it when a frame has that column already."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def text_hash(text: Column) -> Column:
    """64 bits that tell apart the texts of rows that share an id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def strings(column: pd.Series) -> list[str | None]:
    """The values of a batch; missing ones are None, whatever pandas made of them."""
    return [v if isinstance(v, str) else None for v in column.tolist()]


def batches(frames: Iterable[pd.Series], size: int = 2_000) -> Iterator[pd.Series]:
    """Arrow batches in smaller pieces, so that what is derived from them stays small."""
    for frame in frames:
        for start in range(0, len(frame), size):
            yield frame.iloc[start : start + size]
