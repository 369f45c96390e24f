"""CSV records that go on over several lines, put together by many tasks per file.

A line break inside quotes is no end of a record. Whether a line begins inside quotes is
told by the parity of the quotes before it in the file (a doubled quote counts twice). So
every split of a file is read by a task of its own: it counts quotes line by line, the
counts of whole splits are summed up over the file, and both together tell each line
whether a record begins there. Records of one line, nearly all, are done; only the lines
of longer ones are brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ampertide.session import materialise


def _quotes() -> Column:
    return F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, split, place in the split, quotes before them in it, and record starts up to them.

    ``_even`` counts starts if the split begins outside quotes, ``_odd`` if it begins inside.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_at"),
    )
    # The order of lines is written down once, so that every reader of it sees the same.
    lines = materialise(lines, "lines")
    split = Window.partitionBy("_file", "_split").orderBy("_at")
    before = F.coalesce(F.sum(_quotes()).over(split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    upto = split.rowsBetween(Window.unboundedPreceding, 0)
    counted = lines.withColumn("_before", before).withColumn("_ends", _quotes() % 2 == 0)
    return counted.withColumns({
        "_even": F.sum((F.col("_before") % 2 == 0).cast("long")).over(upto),
        "_odd": F.sum((F.col("_before") % 2 == 1).cast("long")).over(upto),
    })


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, record, line``: the records of header CSV files, without the header (record 0).

    Line ends inside a record are "\\n". A file that ends inside quotes fails the query by
    name; empty lines between records are none.
    """
    lines = materialise(_lines(spark, path), "counted-lines")
    splits = lines.groupBy("_file", "_split").agg(
        F.sum(_quotes()).alias("_sum"), F.max("_even").alias("_evens"), F.max("_odd").alias("_odds")
    )
    # One row per split of some megabytes, a window per file.
    earlier = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_inside", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)) % 2 == 1)
    own = F.when(F.col("_inside"), F.col("_odds")).otherwise(F.col("_evens"))
    splits = materialise(splits.withColumn("_first", F.coalesce(F.sum(own).over(earlier), F.lit(0))), "splits")
    open_files = splits.groupBy("_file").agg(F.sum("_sum").alias("_sum")).where(F.col("_sum") % 2 == 1).limit(5).collect()
    if open_files:
        raise ValueError(f"a quote is not closed in {sorted(row['_file'] for row in open_files)}")
    placed = lines.join(splits.select("_file", "_split", "_inside", "_first"), ["_file", "_split"])
    starts = (F.col("_before") % 2 == 1) == F.col("_inside")
    number = F.col("_first") + F.when(F.col("_inside"), F.col("_odd")).otherwise(F.col("_even")) - 1
    placed = placed.select("_file", "_split", "_at", "value", starts.alias("_starts"), "_ends", number.alias("record"))
    whole = F.col("_starts") & F.col("_ends")
    short = placed.where(whole & (F.col("value") != "")).select(F.col("_file").alias("file"), "record", F.col("value").alias("line"))
    pieces = placed.where(~whole).groupBy("_file", "record")
    parts = F.sort_array(F.collect_list(F.struct("_split", "_at", "value")))
    long = pieces.agg(F.array_join(F.transform(parts, lambda x: x["value"]), "\n").alias("line"))
    return short.unionByName(long.withColumnRenamed("_file", "file"))
