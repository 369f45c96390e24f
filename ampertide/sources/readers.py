"""Readers: header CSV, Parquet and literal rows."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampertide import catalog
from ampertide.sources.records import read_records


MALFORMED = "_malformed"

# The usual dialect: a quote inside a quoted value is doubled. A cell with nothing in it is NULL, a quoted empty text is "".
_DIALECT = {
    "escape": '"',
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\u0001",
    "emptyValue": "",
    "columnNameOfCorruptRecord": MALFORMED,
}


def _whole_rows(rows: DataFrame) -> DataFrame:
    """The same rows, whose cells are all read whatever columns are asked for; else a malformed cell may stay unseen."""
    return rows.where(F.hash(*(F.col(f"`{c}`") for c in rows.columns)) >= F.lit(-(1 << 31)))


def _parsed(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool) -> DataFrame:
    """All rows of header CSV; a malformed one has its text as ``MALFORMED`` and what could be read of it."""
    wide = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    if not multi_line:
        reader = spark.read.schema(wide).options(**_DIALECT).option("header", True).option("enforceSchema", False)
        return _whole_rows(reader.option("columnPruning", False).csv(path))
    records = read_records(spark, path)
    names = T.StructType([T.StructField(name, T.StringType()) for name in schema.names])
    headers = records.where("record = 0").select("line").distinct().limit(2)
    for row in headers.select(F.from_csv("line", F.lit(_ddl(names)), _DIALECT).alias("cells")).select("cells.*").collect():
        if list(row) != schema.names:
            raise ValueError(f"header {list(row)} in place of {schema.names}")
    # No order of conditions is certain, so a header has no cells that could be malformed.
    cells = F.when(F.col("record") > 0, F.from_csv("line", F.lit(_ddl(wide)), {**_DIALECT, "mode": "PERMISSIVE"}))
    return _whole_rows(records.where("record > 0").select(cells.alias("cells")).select("cells.*"))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    """Read header CSV with a declared schema; no pass over the data to infer one.

    A row with too many or too few cells, or a cell that is no value of its column, fails
    the query whatever columns it asks for; ``read_csv_checked`` gives such rows apart.
    ``multi_line`` allows line breaks inside quotes, at the price of a second pass.
    """
    rows = _parsed(spark, path, _struct(schema), multi_line)
    failed = F.raise_error(F.concat(F.lit("Malformed row: "), F.col(MALFORMED))).cast("boolean")
    return rows.where(F.when(F.col(MALFORMED).isNull(), True).otherwise(failed)).drop(MALFORMED)


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The well-formed rows, and the malformed ones: what could be read of them, and their text as ``_malformed``."""
    rows = _parsed(spark, path, _struct(schema), multi_line)
    return rows.where(F.col(MALFORMED).isNull()).drop(MALFORMED), rows.where(F.col(MALFORMED).isNotNull())


def _struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_source(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Read one of the known source files; a blank text cell is "" and not NULL."""
    return read_csv(spark, path, catalog.source_schema(name)).na.fill("")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read Parquet; a known schema saves opening a file to find it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def literal_rows(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A few constant rows as a local relation, whose size the optimizer knows."""
    struct = T.StructType.fromDDL(schema)
    table = pa.Table.from_pylist([dict(zip(struct.names, row)) for row in rows])
    return spark.createDataFrame(table, schema=struct)
