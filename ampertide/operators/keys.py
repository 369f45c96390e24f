"""A key dictionary: surrogate ids that later loads keep.

Every key that was ever seen has its id in a stored table. A load looks its keys up in
the folders they fall in, numbers only those that are new, after the highest id so far,
and adds them. Blocks of ids are written down before they are used: a load that broke off
may leave ids that no key has, but no id ever has two keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampertide.operators.bucketed import Bucketed
from ampertide.operators.numbering import ascending, number_rows
from ampertide.session import materialise


class KeyDictionary:
    """Ids 1, 2, ... for the values of ``keys``; one load at a time.

    A NULL part is a value like any other. Text keys compare byte by byte: give folded
    ones (``functions.collation``) where names do not.
    """

    def __init__(self, spark: SparkSession, path: str, keys: T.StructType, id_column: str = "id", buckets: int = 64):
        self.spark, self.keys, self.id_column = spark, keys.names, id_column
        schema = T.StructType([*keys.fields, T.StructField(id_column, T.LongType())])
        self.table = Bucketed(spark, f"{path}/ids", schema, self.keys, buckets)
        self.blocks = f"{path}/blocks"

    def create(self) -> KeyDictionary:
        """An empty dictionary."""
        self.table.create(self.spark.createDataFrame([], self.table.schema))
        self._reserve(0, "overwrite")
        return self

    def _reserve(self, last: int, mode: str = "append") -> None:
        self.spark.range(1).select(F.lit(last).cast("long").alias("last")).write.mode(mode).parquet(self.blocks)

    def highest(self) -> int:
        """The highest id that any load has taken; one row per load is read."""
        return self.spark.read.schema("last long").parquet(self.blocks).agg(F.max("last")).first()[0]

    def _same(self, left: str, right: str) -> Column:
        return reduce(lambda a, b: a & b, (F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in self.keys))

    def learn(self, df: DataFrame) -> int:
        """Give ids to the keys of ``df`` that have none, in the order of the keys; returns how many."""
        wanted = materialise(df.select(*self.keys).distinct(), "keys")
        known = self.table.read(self.table.touched(wanted))
        new = wanted.alias("w").join(known.alias("k"), self._same("w", "k"), "left_anti")
        new = materialise(new, "new-keys")
        count = new.count()
        if count:
            after = self.highest()
            self._reserve(after + count)
            numbered = number_rows(new, ascending(*self.keys), self.id_column, unique=True)
            self.table._write(self.table._placed(numbered.withColumn(self.id_column, F.col(self.id_column) + F.lit(after))), "append")
        return count

    def assign(self, df: DataFrame) -> DataFrame:
        """``df`` with the ids of its keys; new ones are learned first. A frequent key is one row of the dictionary."""
        self.learn(df)
        known = self.table.read(self.table.touched(df)).alias("k")
        found = df.alias("d").join(known, self._same("d", "k"), "left")
        return found.select("d.*", F.col(f"k.{self.id_column}").alias(self.id_column))
