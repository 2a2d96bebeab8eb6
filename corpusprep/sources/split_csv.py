"""Large csv files whose fields hold line breaks, read by many tasks.

A reader that starts in the middle of a file cannot tell whether a line break there
ends a record or stands inside a quoted field. The number of quotes before it can:
it is even outside of fields and odd inside, doubled quotes included. So files are
read line by line in splits, and

1. the quotes of each split are counted; running sums over the splits of a file, one
   small row for each, give the parity at the start of every split;
2. inside a split, running sums of the quotes of its lines tell the true starts of
   records, and how many there were before a line is the number of its record;
3. lines of equal number are one record. What a split has before its first start
   belongs to the last record of an earlier split: such pieces, at most one for each
   split, are put behind that record.

Lines are shuffled once, by split. A record that spans several splits is put together
from its pieces; records are then parsed one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.work import broadcast_if_small, written

QUOTE = '"'


def _quotes(value: Column) -> Column:
    return F.length(value) - F.length(F.translate(value, QUOTE, ""))


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, split, pos, line): ``split`` is where the split starts in the file, ``pos`` rises within it."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("line"),
    )


def split_parity(lines: DataFrame) -> DataFrame:
    """(file, split, before): quotes before each split, modulo two. A file that ends inside a field is refused."""
    counts = lines.groupBy("file", "split").agg(F.sum(_quotes(F.col("line"))).alias("n"))
    so_far = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    last = Window.partitionBy("file")
    sums = counts.withColumns({"before": F.coalesce(F.sum("n").over(so_far), F.lit(0)), "all": F.sum("n").over(last)})
    sums = written(sums.select("file", "split", F.pmod("before", F.lit(2)).alias("before"), F.pmod("all", F.lit(2)).alias("odd")), "splits")
    broken = sums.where("odd = 1").select("file").limit(1).collect()
    if broken:
        raise ValueError(f"{broken[0][0]} has an odd number of quotes: a field is not closed")
    return sums.drop("odd")


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, split, number, record): the text of every record; the header of a file is number 1 of its split 0."""
    lines = _lines(spark, path)
    parity = split_parity(lines)
    placed = lines.join(broadcast_if_small(parity), ["file", "split"])
    within = Window.partitionBy("file", "split").orderBy("pos")
    before_line = F.col("before") + F.coalesce(F.sum(_quotes(F.col("line"))).over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = placed.withColumn("starts", (F.pmod(before_line, F.lit(2)) == 0).cast("int"))
    number = F.sum("starts").over(within.rowsBetween(Window.unboundedPreceding, 0))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "line")))
    text = F.array_join(F.transform(ordered, lambda e: e["line"]), "\n")
    pieces = starts.withColumn("number", number).groupBy("file", "split", "number").agg(text.alias("record"))
    pieces = written(pieces, "pieces")
    # The record that a split's leading piece goes on with is the last one that has started before it.
    started = pieces.where("number > 0").groupBy("file", "split").agg(F.max("number").alias("number"))
    heads = pieces.where("number = 0").select("file", "split", F.lit(None).cast("bigint").alias("number"))
    order = Window.partitionBy("file").orderBy("split", F.col("number").isNotNull()).rowsBetween(Window.unboundedPreceding, -1)
    open_record = F.last(F.when(F.col("number").isNotNull(), F.struct("split", "number")), ignorenulls=True).over(order)
    owners = started.unionByName(heads).withColumn("owner", open_record).where("number IS NULL AND owner IS NOT NULL")
    tails = pieces.where("number = 0").join(owners.select("file", "split", "owner"), ["file", "split"])
    tails = tails.groupBy("file", F.col("owner.split").alias("split"), F.col("owner.number").alias("number")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(tails["split"], "record"))), lambda e: e["record"]), "\n").alias("tail")
    )
    whole = pieces.where("number > 0").join(broadcast_if_small(written(tails, "tails")), ["file", "split", "number"], "left")
    return whole.select("file", "split", "number", F.concat_ws("\n", "record", "tail").alias("record"))


def read_split_csv(spark: SparkSession, path: str | list[str], schema: str | T.StructType) -> DataFrame:
    """A csv table with a header whose quoted fields may span lines; every file is split over tasks.

    Quotes are doubled inside quoted fields, and stand nowhere else. Empty lines are no records.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    found = records(spark, path).where("NOT (split = 0 AND number = 1)")
    line = F.regexp_replace("record", "\r$", "")
    options = {"quote": QUOTE, "escape": QUOTE, "nullValue": "", "emptyValue": "", "maxCharsPerColumn": "-1"}
    rows = found.select(line.alias("line")).where("line <> ''")
    return rows.select(F.from_csv("line", F.lit(schema.toDDL()), options).alias("row")).select("row.*")
