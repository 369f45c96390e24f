"""Reconciliation by checksums, orphans from bitmaps, parameter views, documents of unlike types."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ampertide.functions import variants
from ampertide.operators import quality
from ampertide.sources.sinks import table_function


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_equal_results_join_no_rows(spark):
    a = spark.range(2000).select("id", (F.col("id") * 1.5).alias("v"))
    result = quality.reconcile(a, a.repartition(3), ["id"], ["v"], 0.0)
    assert result.collect() == []
    assert "Join" not in result._jdf.queryExecution().optimizedPlan().toString() or "LocalRelation <empty>" in result._jdf.queryExecution().optimizedPlan().toString()


def test_only_differing_leaves_are_joined(spark, monkeypatch):
    seen = []
    real = quality._differing
    monkeypatch.setattr(quality, "_differing", lambda a, b: seen.append(real(a, b)) or seen[-1])
    a = spark.range(5000).select(F.col("id").cast("int").alias("k"), F.lit(1.0).alias("v"))
    b = a.where("k <> 17").withColumn("v", F.when(F.col("k") == 99, 2.0).otherwise(1.0)).withColumn("k", F.col("k").cast("long"))
    b = b.unionByName(spark.createDataFrame([(7777, 1.0)], "k long, v double"))
    assert rows_of(quality.reconcile(a, b, ["k"], ["v"], 0.1)) == sorted([(17, 1.0, None), (99, 1.0, 2.0), (7777, None, 1.0)], key=str)
    assert len(seen[0]) == 3


def test_reconcile_nulls_and_tolerance(spark):
    a = spark.createDataFrame([(1, 1.0), (2, None), (None, 5.0), (4, 1.0)], "k int, v double")
    b = spark.createDataFrame([(1, 1.05), (2, 0.0), (None, 5.0), (4, 1.0)], "k int, v double")
    assert rows_of(quality.reconcile(a, b, ["k"], ["v"], 0.1)) == [(2, None, 0.0)]
    assert quality.reconcile(a.limit(0), b.limit(0), ["k"], ["v"], 0.1).collect() == []


@pytest.mark.parametrize("most", [0, 64 << 20])
def test_orphans(spark, most):
    parent = spark.createDataFrame([(k,) for k in (0, 1, 63, 64, -1, -64, -65, 2**62, None)], "p long")
    children = [(i, k) for i, k in enumerate([0, 2, 63, 65, -1, -2, -64, -65, -66, 2**62, 2**62 + 1, None, 64, 0, 0])]
    child = spark.createDataFrame(children, "c int, fk long")
    found = quality.orphans(child, "fk", parent, "p", most)
    assert sorted(r.fk for r in found.collect()) == [-66, -2, 2, 65, 2**62 + 1]
    assert quality.orphans(child, "fk", parent.limit(0), "p", most).count() == 14
    assert quality.orphans(child.limit(0), "fk", parent, "p", most).collect() == []


def test_children_are_not_shuffled(spark, tmp_path):
    spark.range(1000).selectExpr("id AS fk").write.parquet(str(tmp_path / "c"))
    child = spark.read.parquet(str(tmp_path / "c"))
    plan = quality.orphans(child, "fk", spark.range(900).toDF("p"), "p")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_parameter_view_reaches_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 3 AS g").write.parquet(str(tmp_path / "t"))
    spark.read.parquet(str(tmp_path / "t")).createOrReplaceTempView("_numbers")
    table_function(spark, "numbers_of", {"g": ("INT", "NULL"), "least": ("INT", "0")}, "SELECT * FROM _numbers n WHERE (numbers_of.g IS NULL OR n.g = numbers_of.g) AND n.id >= numbers_of.least")
    assert spark.sql("SELECT * FROM numbers_of()").count() == 100
    one = spark.sql("SELECT * FROM numbers_of(least => 50, g => 1)")
    assert one.count() == sum(i % 3 == 1 for i in range(50, 100))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,50)" in plan and "EqualTo(g,1)" in plan


def test_fields_of_unlike_kinds(spark):
    texts = ['{"p": 5}', '{"p": "7"}', '{"p": null}', "{}", '{"p": 7.5}', "bad", None, '{"p": true}', '{"p": {"q": 1}}', '{"p": [1]}', '{"p": 1e300}']
    doc = F.col("d")
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(variants.document(F.col("t")).alias("d")).select(
        variants.kind(doc, "$.p"), variants.number(doc, "$.p"), variants.exceeds(doc, "$.p", 5.0), variants.exceeds(doc, "$.p", "6"), variants.differs(doc, "$.p", 5.0)
    )
    assert [tuple(r) for r in rows.collect()] == [
        ("number", 5.0, False, False, False), ("text", None, False, True, True), ("null", None, False, False, True), ("missing", None, False, False, True),
        ("number", 7.5, True, False, True), ("missing", None, False, False, True), ("missing", None, False, False, True), ("boolean", None, False, False, True),
        ("object", None, False, False, True), ("array", None, False, False, True), ("number", 1e300, True, False, True),
    ]


def test_merged_sketches_tell_the_whole(spark):
    rows = spark.range(6000).select(F.col("id").alias("n"), F.when(F.col("id") % 3 == 0, "often").otherwise(F.concat(F.lit("v"), F.col("id").cast("string"))).alias("t"), F.lit(None).cast("string").alias("none"))
    parts = [quality.sketch(rows.where(c)) for c in ("id < 1000", "id between 1000 and 4999", "id > 4999", "id < 0")]
    found = {r.column_name: r for r in quality.read_sketch(quality.merge_sketches(*parts)).collect()}
    whole = {r.column_name: r for r in quality.quick_profile(rows).collect()}
    for name, r in found.items():
        w = whole[name]
        assert (r.n_rows, r.n_nulls, r.null_pct, r.type_class, r.least_value, r.greatest_value) == (w.n_rows, w.n_nulls, w.null_pct, w.type_class, w.least_value, w.greatest_value)
    assert abs(found["n"].n_distinct - 6000) < 300 and abs(found["t"].n_distinct - 4001) < 200 and found["none"].n_distinct == 0
    assert abs(found["n"].quantiles[1] - 3000) < 120 and found["none"].quantiles is None
    assert tuple(found["t"].frequent[0]) == ("often", 2000)
    assert quality.read_sketch(quality.merge_sketches(quality.sketch(rows.limit(0)))).collect() == []
