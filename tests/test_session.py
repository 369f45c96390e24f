"""Numbers of rows that no other row has."""

from __future__ import annotations

import pytest

from ampertide.session import free_name, with_row_id


def test_row_ids_are_exact(spark, tmp_path):
    spark.range(0, 1000, 1, 7).selectExpr("id", "id % 5 AS v", "'x' AS _file").write.parquet(str(tmp_path / "t"))
    rows = with_row_id(spark.read.parquet(str(tmp_path / "t")), "_row")
    first = {r["_row"]: r["id"] for r in rows.collect()}
    assert len(first) == 1000 and rows.columns == ["id", "v", "_file", "_row"]
    assert {r["_row"]: r["id"] for r in rows.repartition(3).collect()} == first
    assert len({n >> 40 for n in first}) == 7
    stored = with_row_id(spark.createDataFrame([(1,), (1,)], "a int"), "n").collect()
    assert len({r.n for r in stored}) == 2
    assert with_row_id(spark.createDataFrame([], "a int"), "n").collect() == []
    with pytest.raises(ValueError):
        with_row_id(stored and spark.createDataFrame([(1,)], "n int"), "n")


def test_free_name(spark):
    df = spark.createDataFrame([(1, 2)], "_row int, __row int")
    assert free_name(df, "_row") == "___row" and free_name(df, "x") == "x"
