"""Incremental runs: only files that arrived since the last run are processed.

The checkpoint remembers which files were taken. Each micro-batch is written to
a folder of its own with overwrite, so a batch that is repeated after a failure
replaces its half-written output. Files count as new by their path: how old they
are does not matter. The list of files taken stays in the checkpoint, a line for
each, which is the price of never leaving one out.

The checkpoint and the output belong together. A checkpoint that knows nothing is
refused when the target has batches already, as it would begin again and write
over them.

Operators that work within a row also run directly on a stream. Those that
regroup by document run here, on each micro-batch, with models that were trained
before.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions.text import part_number
from corpusprep.sources.tables import path_exists, refuse_overlap

#: The column that tells which numbered part a row is from.
PART = "_part"
_BATCH = "batch"
_ANY_AGE = "36500d"


def process_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    step: Callable[[DataFrame], DataFrame],
    schema=None,
    max_files_per_batch: int | None = None,
) -> int:
    """Apply ``step`` to parquet files in ``source`` not seen before; returns the input rows read.

    ``step`` gets a batch DataFrame and returns what is to be written.
    """
    refuse_overlap(spark, target, [source])
    refuse_overlap(spark, checkpoint, [source])
    if path_exists(spark, target) and not path_exists(spark, f"{checkpoint.rstrip('/')}/metadata"):
        raise ValueError(f"{target} has batches that {checkpoint} does not know; give their checkpoint or a new target")
    reader = spark.readStream.schema(schema or spark.read.parquet(source).schema).option("maxFileAge", _ANY_AGE)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)

    rows: dict[int, int] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        # Counted by itself: what the step's plan leaves of the batch's is up to the optimizer. No column is read for it.
        rows[batch_id] = batch.count()
        step(batch).write.mode("overwrite").parquet(f"{target}/{_BATCH}={batch_id}")

    query = (
        reader.parquet(source)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(rows.values())


def process_missing_parts(
    spark: SparkSession, source: str, target: str, step: Callable[[DataFrame], DataFrame], gather: bool = False
) -> list[str]:
    """Apply ``step`` to the parts ``…_part_<n>.parquet`` of ``source`` whose number ``target`` does not have.

    All of them are one DataFrame and one job. ``step`` has to keep the column
    ``_part``, the number of the part a row is from, which is not in the results;
    columns that only some parts have are null in the others. ``gather`` is for
    steps that regroup rows: it brings the rows of a part together again, in
    several tasks if it is a large one, so that not every task writes a file for
    every part.

    Results are written aside and each is put in place, under the part's name and
    complete, by a rename. A part without its mark of completion is replaced.
    Returns the names taken.
    """
    refuse_overlap(spark, target, [source])
    there = _part_names(spark, source)
    done = {n for n, name in _part_names(spark, target).items() if path_exists(spark, f"{target}/{name}/_SUCCESS")}
    missing = {n: name for n, name in sorted(there.items()) if n not in done}
    if not missing:
        return []
    rows = spark.read.option("mergeSchema", True).parquet(*(f"{source}/{name}" for name in missing.values()))
    # A part is a file or a folder of files.
    number = F.regexp_extract(F.col("_metadata.file_path"), r"part_(\d+)\.parquet(?:/[^/]*)?$", 1).cast("bigint")
    results = step(rows.withColumn(PART, number))
    if PART not in results.columns:
        raise ValueError(f"the step has to keep the column {PART}")
    if gather:
        results = results.hint("rebalance", PART)
    path = spark._jvm.org.apache.hadoop.fs.Path
    aside = f"{target.rstrip('/')}/_new.{uuid.uuid4().hex}"
    system = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        results.write.partitionBy(PART).parquet(aside)
        for n, name in missing.items():
            new, place = path(f"{aside}/{PART}={n}"), path(f"{target}/{name}")
            system.mkdirs(new)  # parts without results have no folder yet
            system.create(path(new, "_SUCCESS")).close()
            system.delete(place, True)
            if not system.rename(new, place):
                raise OSError(f"{new.toString()} could not be moved to {place.toString()}")
    finally:
        system.delete(path(aside), True)
    return list(missing.values())


def _part_names(spark: SparkSession, folder: str) -> dict[int, str]:
    """Number and name of each part in a folder; a part is a file or a folder of files."""
    if not path_exists(spark, folder):
        return {}
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    names = [s.getPath().getName() for s in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
    return {int(m.group(1)): n for n in sorted(names) if (m := re.search(r"part_(\d+)\.parquet$", n))}


def read_processed(spark: SparkSession, target: str) -> DataFrame | None:
    """Everything written so far, or None before the first run."""
    return spark.read.parquet(target).drop(_BATCH) if path_exists(spark, target) else None


def finished_parts(spark: SparkSession, target: str) -> DataFrame:
    """(part): numbers in the names of part files ``…_part_<n>.parquet`` in ``target``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(target)
    return files.select(part_number(F.col("path")).alias("part")).where("part IS NOT NULL").distinct()
