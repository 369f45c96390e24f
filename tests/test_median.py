"""Medians by narrowing against Python's, for values of every kind."""

from __future__ import annotations

import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ampertide.operators.aggregates import grouped_median
from ampertide.operators.reshaping import years_ahead


def medians(df, most, keys=("g",)):
    return {r[0] if keys else None: r["median"] for r in grouped_median(df, list(keys), "v", most=most).collect()}


def wanted(rows):
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    return {g: statistics.median(vs) for g, vs in groups.items()}


def shapes():
    rng = random.Random(3)
    yield "even", [rng.uniform(-5, 5) for _ in range(3000)]
    yield "far apart", [rng.choice([1, -1]) * 10.0 ** rng.randint(-300, 300) for _ in range(2001)]
    yield "one value", [7.5] * 2500
    yield "half one value", [1.0] * 1000 + [rng.uniform(1, 2) for _ in range(1000)]
    yield "block before the middle", [rng.uniform(0, 1) for _ in range(10)] + [2.0] * 1500 + [rng.uniform(3, 4) for _ in range(1511)]
    yield "two blocks", [1.0] * 1000 + [2.0] * 1000
    yield "few", [3.0, 1.0, 2.0, 9.0]


@pytest.mark.parametrize("most", [1, 1_000_000])
def test_shapes_of_groups(spark, most):
    rows = [(name, v) for name, vs in shapes() for v in vs] + [(None, 1.0), (None, 2.0), ("nulls", None), ("few", None)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    assert medians(df, most) == wanted(rows)
    if most == 1:
        assert medians(df.where("g = 'even'"), most, ()) == {None: wanted(rows)["even"]}


def test_whole_numbers_beyond_doubles(spark):
    big = 2**53
    rows = [("odd", big + 1)] * 3 + [("odd", big), ("odd", big + 2)] + [("even", big + k) for k in range(1000)] + [("signs", -(2**63)), ("signs", 2**63 - 1)]
    df = spark.createDataFrame(rows, "g string, v long")
    for most in (3, 1_000_000):
        found = medians(df, most)
        assert found["odd"] == big + 1
        assert found["even"] == Decimal(2 * big + 999) / 2
        assert found["signs"] == Decimal("-0.5")


def test_decimals(spark):
    rows = [("a", Decimal("0.01")), ("a", Decimal("0.02")), ("b", Decimal("99999999999999999999999999.99"))]
    found = medians(spark.createDataFrame(rows, "g string, v decimal(28,2)"), 1)
    assert found == {"a": Decimal("0.015"), "b": Decimal("99999999999999999999999999.990")}


def test_rows_are_never_stored(spark, monkeypatch):
    from ampertide.operators import aggregates

    stored = []
    real = aggregates.materialise
    monkeypatch.setattr(aggregates, "materialise", lambda df, label: stored.append(df.count()) or real(df, label))
    df = spark.range(50_000).select((F.col("id") % 3).alias("g"), F.xxhash64("id").cast("double").alias("v"))
    grouped_median(df, ["g"], "v", most=1_000).collect()
    assert stored and max(stored) == 3


def test_years_ahead(spark):
    one = spark.createDataFrame([("x",)], "k string")
    assert [r.year for r in years_ahead(one, 3).collect()] == [1, 2, 3]
    assert years_ahead(one, 0).collect() == []
    assert years_ahead(one, 0).schema["year"].dataType.simpleString() == "int"
    with pytest.raises(ValueError):
        years_ahead(one, -1)
