"""Sinks: overwrite, append, clustered layout and views.

Every sink returns a reader of what it stored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampertide.session import free_name, with_row_tie


def overwrite(df: DataFrame, path: str) -> DataFrame:
    """Drop-and-rebuild sink. ``df`` must not read from ``path``."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def truncate(df: DataFrame, path: str) -> DataFrame:
    """Replace the rows at ``path`` by none, keeping the schema."""
    return overwrite(df.limit(0), path)


def write_csv(df: DataFrame, path: str) -> str:
    """Write header CSV; blanks around values are kept, quotes inside a value are doubled."""
    (
        df.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def clustered(df: DataFrame, path: str, partition_by: Sequence[str], cluster_by: Sequence[str]) -> DataFrame:
    """Store for slice lookups: a folder per partition value, rows sorted inside.

    Equality filters on ``partition_by`` skip folders; filters on ``cluster_by``
    skip files and row groups by their min/max statistics. The range shuffle
    splits a large partition value along ``cluster_by``, and equal rows by their
    place in the input.
    """
    order = [F.col(c) for c in (*partition_by, *cluster_by, "_tie")]
    (
        with_row_tie(df)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("_tie")
        .write.mode("overwrite")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Cells per column of an interleaved layout, as a power of two.
CELL_BITS = 4


def _cell(df: DataFrame, column: str, bits: int, cuts: Sequence | None) -> Column:
    """Which of 2^bits stretches of its column a value falls in: by rank for numbers and times, by hash for the rest."""
    if cuts is None:
        return F.pmod(F.xxhash64(column), F.lit(1 << bits)).cast("int")
    value = _measure(df, column)
    return reduce(lambda a, b: a + b, (F.when(value > F.lit(cut), 1).otherwise(0) for cut in cuts), F.lit(0))


def _measure(df: DataFrame, column: str) -> Column:
    """A number in the order of the column."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.DateType, T.TimestampNTZType)):
        return F.unix_seconds(F.col(column).cast("timestamp")).cast("double")
    return F.col(column).cast("double")


def interleaved(df: DataFrame, path: str, columns: Sequence[str], bits: int = CELL_BITS) -> DataFrame:
    """Store for slices on any subset of ``columns``, whichever comes first.

    Every column is cut into 2^bits cells, numbers and times at their quantiles, other
    values by hash. The bits of the cells, one of each column in turn, are the order of
    rows, so that rows of one cell of any column stand in few stretches, whose files and row
    groups the others' statistics, dictionaries and Bloom filters leave out.
    """
    ranked = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
    numbers = [c for c in columns if isinstance(df.schema[c].dataType, ranked)]
    share = [k / (1 << bits) for k in range(1, 1 << bits)]
    # No more than 2^bits cuts a column.
    cuts = df.agg(*(F.percentile_approx(_measure(df, c), share).alias(c) for c in numbers)).first().asDict() if numbers else {}
    cells = [_cell(df, c, bits, (cuts[c] or []) if c in numbers else None) for c in columns]
    parts = [
        F.shiftleft(F.shiftright(cell, b).bitwiseAND(F.lit(1)).cast("long"), b * len(cells) + k)
        for b in range(bits)
        for k, cell in enumerate(cells)
    ]
    place = free_name(df, "_place")
    tie = free_name(df, "_tie")
    order = [place, *columns, tie]
    writer = (
        with_row_tie(df, tie)
        .withColumn(place, reduce(lambda a, b: a.bitwiseOR(b), parts))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop(place, tie)
        .write.mode("overwrite")
    )
    for column in set(columns) - set(numbers):
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def view(df: DataFrame, name: str) -> DataFrame:
    """Register a virtual view and return it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def table_function(spark: SparkSession, name: str, parameters: Mapping[str, tuple[str, str]], query: str) -> str:
    """Register a view with parameters for SQL users: ``SELECT * FROM name(parameter => value)``.

    ``parameters``: name to (SQL type, SQL text of the default). In ``query`` a parameter
    is ``name.parameter``. A call is unfolded into the query, so its values reach the scan
    like literals. Lasts as long as the session.
    """
    declared = ", ".join(f"{parameter} {kind} DEFAULT {default}" for parameter, (kind, default) in parameters.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({declared}) RETURNS TABLE RETURN {query}")
    return name
