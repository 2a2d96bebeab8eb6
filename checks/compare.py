"""Run catalogue queries and their SQL side by side and report differences.

    python -m checks.compare /root/testdata/sf0.01 [query …]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

from checks.oracle import ORACLE_SQL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _sorted(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def _kind(column: pd.Series) -> str:
    """The type of a column. Whole numbers with gaps come as floating-point numbers from one engine."""
    numbers = column.dropna()
    if column.hasnans and pd.api.types.is_numeric_dtype(column) and (numbers % 1 == 0).all():
        return "int64"
    return str(column.dtype).lower()


def difference(spark_df, con, sql: str) -> str | None:
    """None when both results are the same, otherwise what differs."""
    ours, theirs = _sorted(spark_df.toPandas()), _sorted(con.execute(sql).df())
    if list(ours.columns) != list(theirs.columns):
        return f"columns {list(ours.columns)} / {list(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    for column in ours.columns:
        if _kind(ours[column]) != _kind(theirs[column]):
            return f"type of {column}: {ours[column].dtype} / {theirs[column].dtype}"
        a, b = ours[column], theirs[column]
        unequal = ~((a == b) | (a.isna() & b.isna()))
        if unequal.any():
            i = unequal.idxmax()
            return f"{column}: {unequal.sum()} of {len(ours)} differ, e.g. {str(a[i])[:300]!r} / {str(b[i])[:300]!r}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    from corpusprep.plans.catalog import QUERIES

    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(str(Path(folder)))
    failed = 0
    for name in names:
        began = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in ORACLE_SQL:
                found = difference(df, con, ORACLE_SQL[name]) or "same"
            else:
                found = f"{df.count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            found = f"ERROR {str(error)[:600]}"
        failed += found.startswith("ERROR") or not (found == "same" or found.endswith("no SQL"))
        print(f"{name:22s} {time.time() - began:6.2f}s  {found}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
