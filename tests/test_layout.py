"""Layout for slices on any column: rows that scans read."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ampertide.sources.sinks import interleaved


def rows_read(df):
    """Rows that the scan gave out, after files and row groups were left out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout") / "t")
    n = 200_000
    df = spark.range(n).select(
        F.pmod(F.xxhash64("id"), F.lit(50)).cast("int").alias("year"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("number"),
        F.concat(F.lit("area "), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(200)).cast("string")).alias("area"),
        "id",
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return n, df, interleaved(df, path, ["year", "number", "area"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("test, most", [("year = 7", 0.55), ("number between 10 and 30", 0.55), ("area = 'area 17'", 0.55), ("year = 7 and area = 'area 17'", 0.35)])
def test_slice_on_any_column_leaves_files_out(stored, test, most):
    n, df, table = stored
    found = table.where(test)
    assert rows_read(found) <= most * n
    assert sorted(r.id for r in found.collect()) == sorted(r.id for r in df.where(test).collect())


def test_all_rows_are_kept(spark, tmp_path, stored):
    n, _, table = stored
    assert table.count() == n and table.select("id").distinct().count() == n
    odd = spark.createDataFrame([(None, None, 1), ("a", None, 2), ("a", 5.0, 3), ("a", 5.0, 3)], "t string, _place double, _tie int")
    assert sorted(map(str, interleaved(odd, str(tmp_path / "o"), ["t", "_place"]).collect())) == sorted(map(str, odd.collect()))
    assert interleaved(odd.limit(0), str(tmp_path / "e"), ["t", "_place"]).collect() == []
