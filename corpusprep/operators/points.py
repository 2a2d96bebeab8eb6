"""Which code points the engine's patterns take as letters, for work on whole texts inside tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

CODE_POINTS = 0x110000


def in_class(spark: SparkSession, listed: str) -> bytes:
    """A bit for each code point: whether it is in the class of characters ``listed`` of a pattern."""
    points = "".join(chr(c) for c in range(CODE_POINTS) if not 0xD800 <= c <= 0xDFFF)
    every = spark.createDataFrame([(points,)], "points string")
    found = every.select(F.regexp_replace("points", f"[^{listed}]+", "")).first()[0]
    flags = np.zeros(CODE_POINTS, bool)
    flags[np.frombuffer(found.encode("utf-32-le"), "<u4")] = True
    return np.packbits(flags).tobytes()


def flags(bits: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
