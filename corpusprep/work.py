"""Stage boundaries: where written tables go, row keys, size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Entries that a set or map literal inside an expression may hold.
LITERAL_ENTRIES = 10_000
# Raw bytes of a table that may be broadcast (its hash table is a few times larger).
BROADCAST_BYTES = 64 * 1024 * 1024

# A table with fewer bytes per core than this may be dealt out over all cores.
SPREAD_BYTES_PER_CORE = 16 * 1024 * 1024

ROW_KEY = "_row"


def work_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written stages.

    The cluster names it in ``spark.checkpoint.dir``. A local session without the
    setting gets a temporary folder; any other session without it is refused,
    because a folder on one machine is lost with that machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="corpusprep-"))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{_own_dir(spark)}/{uuid.uuid4().hex}/{name}"


def _own_dir(spark: SparkSession) -> str:
    return f"{work_dir(spark)}/corpusprep/{spark.sparkContext.applicationId}"


def clear_work(spark: SparkSession) -> None:
    """Delete the tables this application has written to its work folder.

    DataFrames that still read them can no longer be used, so call it when all
    results are saved.
    """
    own = spark._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    own.getFileSystem(spark._jsc.hadoopConfiguration()).delete(own, True)


def written(df: DataFrame, name: str, spread: bool = False) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Cuts the lineage: later steps neither recompute ``df`` nor depend on the
    executors that produced it. ``spread`` is for tables of texts, see
    ``spread_small``.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    return spread_small(table, path) if spread else table


def spread_small(df: DataFrame, path: str | list[str]) -> DataFrame:
    """Deal out ``df``, read from ``path``, when its few files leave cores without work.

    A row group is read by one task, however hard that task then works on each
    text. Only small tables are shuffled for this; the bound is in bytes per core.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = files = 0
    for one in [path] if isinstance(path, str) else path:
        pattern = spark._jvm.org.apache.hadoop.fs.Path(one)
        system = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in system.globStatus(pattern) or []:
            summary = system.getContentSummary(found.getPath())
            size += summary.getLength()
            files += summary.getFileCount()
    return df.repartition(cores) if files < cores and size < cores * SPREAD_BYTES_PER_CORE else df


def staged(df: DataFrame, key: str, name: str, dealt: bool = False) -> DataFrame:
    """Write ``df`` once, in buckets of ``key`` that are sorted by it, and read it back.

    Later joins and groupings on the key find each row where it is: only the small
    findings are shuffled to them, never the columns of the table. ``dealt`` says
    that ``df`` is in such a stage's partitions already, so that the write does not
    shuffle it once more. There are as many buckets as the session has shuffle
    partitions, which is what the shuffled side of a join has.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"corpusprep_{uuid.uuid4().hex}"
    rows = df if dealt else df.repartition(buckets, key)
    writer = rows.write.format("parquet").bucketBy(buckets, key).sortBy(key)
    writer.option("path", new_path(spark, name)).saveAsTable(table)
    stage = spark.table(table)
    # The plan holds files and buckets now; the name was only needed to get them into it.
    spark.sql(f"DROP TABLE {table}")
    return stage


def keyed(df: DataFrame, key: str | None) -> tuple[DataFrame, str]:
    """``df`` with a column that identifies each row, and that column's name.

    A ``key`` given by the caller must be unique. Without one a row number is
    assigned and the table is staged, so that every later scan sees the same
    numbers even after a stage is retried.
    """
    if key is not None:
        return df, key
    return staged(df.withColumn(ROW_KEY, F.monotonically_increasing_id()), ROW_KEY, "keyed"), ROW_KEY


def unkeyed(df: DataFrame, given: str | None) -> DataFrame:
    """``df`` without the row number that ``keyed`` added when no key was given."""
    return df if given is not None else df.drop(ROW_KEY)


def small_rows(df: DataFrame, limit: int = LITERAL_ENTRIES) -> list | None:
    """The rows of ``df`` when there are at most ``limit``, otherwise None."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def broadcast_if_small(
    df: DataFrame, measured: DataFrame | None = None, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Mark ``df`` for broadcast only when its measured size is within the bound.

    Beyond the bound the join is left to a shuffle, where adaptive execution
    splits skewed keys. The table is read once to be measured; when it is derived,
    ``measured`` names the table behind it that is at least as large.
    """
    return F.broadcast(df) if is_small(df if measured is None else measured, max_bytes) else df


def is_small(measured: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the raw bytes of a table are within the bound."""
    widths = [_width(f) for f in measured.schema.fields]
    per_row = sum(widths[1:], widths[0]) + F.lit(16)
    return measured.agg(F.coalesce(F.sum(per_row.cast("bigint")), F.lit(0))).first()[0] <= max_bytes


def _width(field: T.StructField) -> Column:
    """Bytes of a value, at least; nested values count as their JSON text."""
    value = F.col("`" + field.name.replace("`", "``") + "`")
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        value = F.to_json(F.struct(value))
    elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.lit(8)
    return F.coalesce(F.octet_length(value), F.lit(0))


def explode_each(df: DataFrame, keep: list, array: Column, name: str) -> DataFrame:
    """One row per array element: ``keep`` columns, ``pos`` from 0, and the element.

    The outer form with a filter behind it, because for the plain form Spark puts
    a filter on the array's size below, and works out the array twice.
    """
    long = df.select(*keep, F.posexplode_outer(array).alias("pos", name))
    return long.where("pos IS NOT NULL")


def regroup(long: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Long form (key, pos, value) back to one array per key, in ``pos`` order."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", value)))
    return long.groupBy(key).agg(F.transform(ordered, lambda e: e[value]).alias(out))


def attach(docs: DataFrame, grouped: DataFrame, key: str, out: str) -> DataFrame:
    """Left-join regrouped arrays to their documents, in the place of ``out``.

    Documents without any element get ``[]``, and those whose array was null keep null.
    """
    empty = F.array().cast("array<string>")
    new = grouped.withColumnRenamed(out, "_regrouped")
    value = F.when(F.col(out).isNotNull(), F.coalesce("_regrouped", empty))
    return docs.join(new, key, "left").withColumn(out, value).select(docs.columns)
