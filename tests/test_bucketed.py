"""Merges that touch few folders, ids that later loads keep, sums kept up by changes."""

from __future__ import annotations

import os
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampertide.operators.bucketed import Bucketed
from ampertide.operators.keys import KeyDictionary
from ampertide.operators.upkeep import KeptSums

SCHEMA = T.StructType().add("k", "integer").add("name", "string").add("v", "double")


def files(path):
    return {f"{d}/{f}": os.path.getmtime(f"{d}/{f}") for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    rows = [(i, f"n{i}", float(i)) for i in range(200)]
    return Bucketed(spark, str(tmp_path / "t"), SCHEMA, ["k"], 32).create(spark.createDataFrame(rows, SCHEMA))


def test_merge_replace_leaves_other_files(spark, table):
    before = files(table.path)
    source = spark.createDataFrame([(3, "new", None), (1000, "more", 1.0)], SCHEMA)
    only = table.merge_replace(source)
    assert 1 <= len(only) <= 2
    after = files(table.path)
    same = {f for f in before if after.get(f) == before[f]}
    touched = {f for f in before if any(f"_bucket={b}/" in f for b in only)}
    assert same == set(before) - touched and touched
    expected = [(i, f"n{i}", float(i)) for i in range(200) if i != 3] + [(3, "new", None), (1000, "more", 1.0)]
    assert rows_of(table.read()) == sorted(expected, key=str)


def test_merge_keep_adds_files_only(spark, table):
    before = files(table.path)
    table.merge_keep(spark.createDataFrame([(3, "new", None), (1000, "more", 1.0)], SCHEMA))
    after = files(table.path)
    assert all(after.get(f) == t for f, t in before.items()) and len(after) == len(before) + 1
    assert table.read().where("k = 3").first().name == "n3" and table.read().count() == 201


def test_merges_may_be_run_again(spark, table):
    source = spark.createDataFrame([(5, "five", 0.5), (777, "x", 7.0)], SCHEMA)
    for _ in range(2):
        table.merge_replace(source)
        table.merge_keep(source)
    assert table.read().count() == 201 and table.read().where("k = 5").first().name == "five"


def test_only_touched_folders_are_read(spark, table):
    only = table.touched(spark.createDataFrame([(5, "", 0.0)], SCHEMA))
    plan = table.read(only)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan or "PartitionFilters: [_bucket" in plan or f"= {only[0]})" in plan
    shown = table.read(only).select(F.input_file_name().alias("f")).distinct().collect()
    assert all(f"_bucket={only[0]}/" in r.f for r in shown)


def test_missing_and_unknown_columns(spark, table):
    table.merge_replace(spark.createDataFrame([(5, 9.0)], "k long, v double"))
    assert tuple(table.read().where("k = 5").first()) == (5, None, 9.0)
    with pytest.raises(ValueError):
        table.merge_replace(spark.createDataFrame([(5, 1)], "k int, other int"))
    with pytest.raises(ValueError):
        Bucketed(spark, "x", T.StructType.fromDDL("_bucket int"), ["_bucket"])


def test_repeated_keys_fail(spark, table, tmp_path):
    twice = spark.createDataFrame([(5, "a", 0.0), (5, "b", 0.0)], SCHEMA)
    with pytest.raises(Exception, match="repeated merge key"):
        table.merge_replace(twice)
    with pytest.raises(Exception, match="repeated merge key"):
        Bucketed(spark, str(tmp_path / "u"), SCHEMA, ["k"], 4).create(twice)


def test_empty_table_and_source(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    table = Bucketed(spark, str(tmp_path / "t"), SCHEMA, ["k"], 4).create(empty)
    assert table.merge_replace(empty) == [] and table.read().count() == 0
    table.merge_keep(spark.createDataFrame([(1, "a", 1.0), (None, "null key", 2.0)], SCHEMA))
    assert table.read().count() == 2


KEYS = T.StructType().add("make", "string").add("year", "integer")


def test_ids_survive_later_loads(spark, tmp_path):
    ids = KeyDictionary(spark, str(tmp_path), KEYS, buckets=8).create()
    first = spark.createDataFrame([("b", 1, "x"), ("a", 1, "y"), (None, 2, "z"), ("b", 1, "again")], "make string, year int, rest string")
    got = {(r.make, r.year): r.id for r in ids.assign(first).collect()}
    assert got == {(None, 2): 1, ("a", 1): 2, ("b", 1): 3}
    second = spark.createDataFrame([("a", 1, "p"), ("0", 5, "q"), (None, 2, "r"), (None, None, "s")], "make string, year int, rest string")
    again = {(r.make, r.year): r.id for r in ids.assign(second).collect()}
    assert again == {("a", 1): 2, (None, 2): 1, (None, None): 4, ("0", 5): 5}
    assert ids.learn(first) == 0 and ids.highest() == 5
    assert ids.assign(first).count() == 4
    assert rows_of(ids.table.read().select("id")) == [(i,) for i in range(1, 6)]


def test_broken_load_never_gives_an_id_twice(spark, tmp_path):
    ids = KeyDictionary(spark, str(tmp_path), KEYS, buckets=4).create()
    ids.learn(spark.createDataFrame([("a", 1)], KEYS))
    ids._reserve(10)  # a load took 2 to 10 and was lost
    ids.learn(spark.createDataFrame([("a", 1), ("b", 1)], KEYS))
    assert rows_of(ids.table.read()) == [("a", 1, 1), ("b", 1, 11)]


def test_only_new_keys_are_numbered(spark, tmp_path, monkeypatch):
    from ampertide.operators import keys as module

    ids = KeyDictionary(spark, str(tmp_path), KEYS, buckets=4).create()
    ids.learn(spark.range(100).select(F.col("id").cast("string").alias("make"), F.lit(1).alias("year")))
    seen = []
    real = module.number_rows
    monkeypatch.setattr(module, "number_rows", lambda df, *a, **b: seen.append(df.count()) or real(df, *a, **b))
    ids.learn(spark.range(103).select(F.col("id").cast("string").alias("make"), F.lit(1).alias("year")))
    assert seen == [3]


GROUP = T.StructType().add("g", "string")
FACTS = "g string, price double, weight int"


def sums(spark, path, buckets):
    return KeptSums(spark, str(path), GROUP, {"price": (F.col("price"), 2), "weight": (F.col("weight"), 0)}, buckets)


def facts(spark, folder, rows):
    spark.createDataFrame(rows, FACTS).write.mode("overwrite").parquet(folder)
    return spark.read.schema(FACTS).parquet(folder)


def test_two_changes_equal_a_rebuild_without_the_base(spark, tmp_path):
    base = [("a", 1.1, 1), ("a", 2.2, None), ("b", 0.1, 5), ("c", 9.0, 9), (None, 4.0, 4)]
    added = [("a", 3.3, 3), ("d", 7.7, 7), (None, 5.0, None)]
    removed = [("c", 9.0, 9), ("a", 1.1, 1)]
    kept = sums(spark, tmp_path / "state", 4).build(facts(spark, str(tmp_path / "base"), base))
    shutil.rmtree(tmp_path / "base")
    kept.apply(1, added=facts(spark, str(tmp_path / "d1"), added))
    for _ in range(2):  # the second time does nothing
        kept.apply(2, removed=facts(spark, str(tmp_path / "d2"), removed), added=facts(spark, str(tmp_path / "d3"), [("b", 0.2, None)]))
    final = [r for r in base + added + [("b", 0.2, None)] if r not in removed]
    whole = sums(spark, tmp_path / "whole", 4).build(facts(spark, str(tmp_path / "all"), final))
    assert rows_of(kept.read()) == rows_of(whole.read())
    assert {r.g for r in kept.read().collect()} == {"a", "b", "d", None}


def test_changes_rewrite_touched_folders_only(spark, tmp_path):
    rows = [(f"g{i}", float(i), i) for i in range(100)]
    kept = sums(spark, tmp_path / "state", 16).build(spark.createDataFrame(rows, FACTS))
    before = files(kept.table.path)
    only = kept.apply(1, added=spark.createDataFrame([("g7", 1.0, 1)], FACTS))
    after = files(kept.table.path)
    assert len(only) == 1
    assert all(after.get(f) == t for f, t in before.items() if f"_bucket={only[0]}/" not in f)
    assert kept.apply(2) == []
