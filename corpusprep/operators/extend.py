"""The place for a user's own model: a Python function over batches of texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from importlib import import_module

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Model = Callable[[list[str]], Sequence]


def apply_model(
    df: DataFrame,
    text_col: str,
    out: str,
    out_type: T.DataType | str,
    open_model: Callable[[], Model],
    batch_size: int = 32,
) -> DataFrame:
    """Add ``out`` by calling a model on lists of at most ``batch_size`` texts.

    ``open_model`` runs once per task, on the worker, and returns the callable;
    load files and open sessions in it. It returns one value per text; a null text
    is given as None. Only the text column goes to Python, the others stay where
    they are. Works on streams as well, since each row is handled on its own.
    """

    @F.pandas_udf(out_type)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = None
        for batch in batches:
            model = model or open_model()
            texts = [t if isinstance(t, str) else None for t in batch.tolist()]
            values = []
            for start in range(0, len(texts), batch_size):
                values.extend(model(texts[start : start + batch_size]))
            yield pd.Series(values, dtype=None if values and isinstance(values[0], (int, float)) else object)

    return df.withColumn(out, run(F.col(text_col)))


def model_encoder(open_model: Callable[[], Model], batch_size: int = 32) -> Callable[[DataFrame, str, str], DataFrame]:
    """An encoder for whole runs from a model that gives a list of numbers for each text."""
    return lambda df, text, out: apply_model(df, text, out, "array<double>", open_model, batch_size)


def named_model(name: str) -> Callable[[], Model]:
    """``package.module:function`` as ``open_model``; the module is imported on the workers."""
    module, _, function = name.partition(":")
    if not function:
        raise ValueError(f"{name!r} is not of the form module:function")
    return lambda: getattr(import_module(module), function)()
