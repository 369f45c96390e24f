"""Stored tables in folders by the hash of their key, and changes that touch few of them.

A merge finds the folders that its source falls in, reads and writes these alone, and
leaves the files of all others as they are. New content is written aside first and then
takes the place of the old, folder by folder; a merge that broke off may be run again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampertide.operators.merging import merge_keep, merge_replace, unique_rows
from ampertide.session import materialise

BUCKET = "_bucket"


@dataclass(frozen=True)
class Bucketed:
    """A table at ``path`` with one row per ``keys``, in ``buckets`` folders.

    Choose ``buckets`` so that a folder holds some hundred megabytes; it cannot change
    later. The hash of a key spreads keys evenly, as no two rows share one.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: Sequence[str]
    buckets: int = 64
    _kinds: dict[str, T.DataType] = field(init=False, repr=False, default_factory=dict)

    def __post_init__(self):
        if BUCKET in self.schema.names:
            raise ValueError(f"{BUCKET} is the column of folders")
        self._kinds.update({f.name: f.dataType for f in self.schema.fields})

    def _of(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _placed(self, df: DataFrame) -> DataFrame:
        """Rows in the table's own columns and types, with their folder; a column that is missing is NULL."""
        unknown = set(df.columns) - set(self._kinds)
        if unknown:
            raise ValueError(f"no such columns: {sorted(unknown)}")
        columns = [(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in self._kinds.items()]
        return df.select(*columns).withColumn(BUCKET, self._of())

    def _write(self, placed: DataFrame, mode: str) -> None:
        # Tasks are cut by size inside folders, so a large folder takes several.
        rows = placed.hint("rebalance", BUCKET)
        rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)

    def create(self, df: DataFrame) -> Bucketed:
        """Store ``df`` as the whole table; a repeated key fails the query."""
        placed = self._placed(unique_rows(df, self.keys)).hint("rebalance", BUCKET)
        placed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BUCKET).parquet(self.path)
        return self

    def read(self, only: Sequence[int] | None = None) -> DataFrame:
        """All rows, or those of some folders; the others are not opened."""
        rows = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(self.path)
        return (rows if only is None else rows.where(F.col(BUCKET).isin(list(only)))).drop(BUCKET)

    def touched(self, source: DataFrame) -> list[int]:
        """Folders that the keys of ``source`` fall in: at most ``buckets`` numbers."""
        found = self._placed(source.select(*self.keys)).select(BUCKET).distinct().collect()
        return sorted(row[0] for row in found)

    def rewrite(self, source: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Replace the touched folders by ``combine(their rows, source)``, which must keep every key of them; returns them."""
        source = materialise(self._placed(source).drop(BUCKET), "merge-source")
        only = self.touched(source)
        if only:
            merged = materialise(self._placed(combine(self.read(only), source)), "merged")
            self._write(merged, "overwrite")
        return only

    def merge_replace(self, source: DataFrame) -> list[int]:
        """Source rows win as a whole, other rows stay; a repeated source key fails the query."""
        return self.rewrite(source, lambda target, rows: merge_replace(target, rows, self.keys))

    def merge_keep(self, source: DataFrame) -> list[int]:
        """Stored rows stay, rows with new keys are added as files beside them; a repeated source key fails the query."""
        source = materialise(self._placed(source).drop(BUCKET), "merge-source")
        only = self.touched(source)
        if only:
            kept = self.read(only)
            new = merge_keep(kept, source, self.keys).join(kept.select(*self.keys), list(self.keys), "left_anti")
            self._write(materialise(self._placed(new), "merged"), "append")
        return only
