"""Stored sums and counts per group, kept up by what comes and goes.

A group's state is the number of its rows and, per measure, the exact sum and count of
its values. A change is summed in the same form, taken away rows with a minus, and added
to the groups it touches; the rows from before are not read again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampertide.functions.numbers import scaled, unscaled
from ampertide.operators.bucketed import Bucketed

_WIDE = "decimal(38,0)"


class KeptSums:
    """Sums and counts of ``measures`` by ``keys``, stored at ``path``.

    ``measures``: name to (column, number of decimals it has at most). Least and greatest
    values are not kept, as no sum tells them once a row has gone.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: T.StructType, measures: Mapping[str, tuple[Column, int]], buckets: int = 16
    ):
        self.keys, self.measures = keys.names, dict(measures)
        parts = ["_version long", "_rows long", *(f"_sum_{m} {_WIDE}, _n_{m} long" for m in self.measures)]
        schema = T.StructType([*keys.fields, *T.StructType.fromDDL(", ".join(parts)).fields])
        self.table = Bucketed(spark, path, schema, self.keys, buckets)
        self._figures = ["_rows", *(f"_{part}_{m}" for m in self.measures for part in ("sum", "n"))]

    def _summed(self, df: DataFrame, sign: int) -> DataFrame:
        totals = [F.count(F.lit(1)).alias("_rows")]
        for name, (col, digits) in self.measures.items():
            totals += [F.sum(scaled(col, digits).cast("decimal(18,0)")).alias(f"_sum_{name}"), F.count(col).alias(f"_n_{name}")]
        return df.groupBy(*self.keys).agg(*totals).select(
            *self.keys, *((F.lit(sign) * F.coalesce(c, F.lit(0))).cast(self.table._kinds[c]).alias(c) for c in self._figures)
        )

    def _change(self, added: DataFrame | None, removed: DataFrame | None, version: int) -> DataFrame:
        parts = [self._summed(df, sign) for df, sign in ((added, 1), (removed, -1)) if df is not None]
        change = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        sums = [F.sum(c).cast(self.table._kinds[c]).alias(c) for c in self._figures]
        return change.groupBy(*self.keys).agg(*sums).withColumn("_version", F.lit(version).cast("long"))

    def build(self, df: DataFrame) -> KeptSums:
        """The state of all rows of ``df``, in place of what was stored."""
        self.table.create(self._summed(df, 1).withColumn("_version", F.lit(0).cast("long")))
        return self

    def apply(self, version: int, added: DataFrame | None = None, removed: DataFrame | None = None) -> list[int]:
        """Add the sums of ``added``, take away those of ``removed``; returns the folders that were rewritten.

        ``version`` must grow from change to change. A group that has a change already does
        not take it again, so a change that broke off may be applied anew.
        """

        def combined(state: DataFrame, change: DataFrame) -> DataFrame:
            now, more = F.struct("_version", *self._figures), state.columns
            both = state.select(*self.keys, now.alias("_state")).join(
                change.select(*(F.col(k).alias(f"_c_{k}") for k in self.keys), now.alias("_change")),
                _all_equal(self.keys, "_c_"),
                "full",
            )
            fresh = F.col("_change").isNotNull() & (F.coalesce(F.col("_state._version"), F.lit(-1)) < F.col("_change._version"))
            keys = [F.when(F.col("_state").isNull(), F.col(f"_c_{k}")).otherwise(F.col(k)).alias(k) for k in self.keys]
            zero = F.lit(0)
            figures = [
                (F.coalesce(f"_state.{c}", zero) + F.when(fresh, F.coalesce(f"_change.{c}", zero)).otherwise(zero)).alias(c)
                for c in self._figures
            ]
            latest = F.greatest("_state._version", "_change._version").alias("_version")
            return both.select(*keys, latest, *figures).select(*more)

        if added is None and removed is None:
            return []
        return self.table.rewrite(self._change(added, removed, version), combined)

    def read(self, count: str = "n") -> DataFrame:
        """Keys, number of rows and the mean of each measure; groups without rows are gone."""
        means = [
            (unscaled(F.col(f"_sum_{m}"), digits) / F.nullif(F.col(f"_n_{m}"), F.lit(0).cast("bigint"))).alias(m)
            for m, (_, digits) in self.measures.items()
        ]
        return self.table.read().where("_rows > 0").select(*self.keys, F.col("_rows").alias(count), *means)


def _all_equal(keys: Sequence[str], prefix: str) -> Column:
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"{prefix}{key}"))
    return same
