"""Names under a collation: folded texts against Spark's own comparison, and operators on them."""

from __future__ import annotations

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from ampertide.functions.collation import NAMES, collated, fold
from ampertide.operators.aggregates import grouped_by_name
from ampertide.operators.joining import on_key
from ampertide.plans.relational import integrate_vehicles

LETTERS = [chr(p) for p in (*range(0x20, 0x7F), *range(0xA0, 0x250), *range(0x386, 0x3CF), *range(0x400, 0x482), *range(0x1E00, 0x2000)) if p < 0x7F or unicodedata.category(chr(p))[0] in "LN"]
MARKS = "̧́̈̌"
EQUAL = [
    ("Citroën", "CITROEN"), ("Škoda", "skoda  "), ("Straße", "STRASSE"), ("Ångström", "angstrom"), ("Peugeot", "Peugéot "), ("Østby", "ostby"),
    ("Łódź", "lodz"), ("été", "été"), ("ΆΛΦΑ", "αλφα"), ("σας", "ΣΑΣ"), ("Ёлка", "елка"), ("soft­hyphen", "SoftHyphen"), ("", "   "),
    ("cœur", "COEUR"), ("Æsir", "aesir"), ("ﬁat", "FIAT"), ("đ", "D"), ("Ħ", "h"), ("Ґ", "г"), ("STRAẞE", "strasse"), ("ĳs", "IJS"), ("ǉ", "lj"),
]
DIFFERENT = [("Citroen", "Citroen C4"), (" a", "a"), ("a b", "ab"), ("й", "и"), ("a-b", "ab"), ("ı", "i"), ("o", "0")]


def compared(spark, pairs):
    rows = spark.createDataFrame(pairs, "x string, y string")
    own = (F.collate("x", NAMES) == F.collate("y", NAMES)).alias("own")
    folded = (fold(F.col("x")) == fold(F.col("y"))).alias("folded")
    return [(r.x, r.y, r.own, r.folded) for r in rows.select("x", "y", own, folded).collect()]


def test_known_names(spark):
    for x, y, own, folded in compared(spark, EQUAL):
        assert own and folded, (x, y, own, folded)
    for x, y, own, folded in compared(spark, DIFFERENT):
        assert not own and not folded, (x, y, own, folded)


def test_single_letters_as_the_collation(spark):
    """All letters beside each other: the classes of folded texts are the classes of the collation."""
    rows = spark.createDataFrame([(f"x{c}x",) for c in LETTERS], "t string")
    apart = rows.groupBy(F.collate("t", NAMES)).agg(F.count_distinct(fold(F.col("t"))).alias("n"), F.collect_list("t").alias("ts")).where("n > 1").collect()
    merged = rows.groupBy(fold(F.col("t")).alias("k")).agg(F.collect_list("t").alias("ts")).collect()
    classes = {t: i for i, r in enumerate(rows.groupBy(F.collate("t", NAMES)).agg(F.collect_list("t").alias("ts")).collect()) for t in r.ts}
    wrong = [r.ts for r in apart] + [r.ts for r in merged if len({classes[t] for t in r.ts}) > 1]
    assert not wrong


def test_random_names_as_the_collation(spark):
    rng = random.Random(1)
    alphabet = "aAeEoOsSéÉèêëöÖøØßçÇñÑüÜæœ łŁ-'12 "
    near = lambda w: "".join(rng.choice([c, c.upper() if len(c.upper()) == 1 else c, c.lower(), c + rng.choice(MARKS) if c.isalpha() else c]) for c in w) + rng.choice(["", " "])
    words = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 8))) for _ in range(400)]
    pairs = [(w, near(w)) for w in words] + [(rng.choice(words), rng.choice(words)) for _ in range(400)]
    for x, y, own, folded in compared(spark, pairs):
        assert own == folded, (x, y, own, folded)


@pytest.mark.parametrize("collation", [None, NAMES, "UNICODE_CI"])
def test_null_stays_null(spark, collation):
    row = spark.createDataFrame([(None,)], "x string").select(collated(F.col("x"), collation).isNull().alias("n")).first()
    assert row.n


def test_hot_name_is_joined_as_plain_text(spark):
    """Folded keys leave the join to hashes: no comparison under a collation, and a hot key may be split."""
    many = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "Citroën").otherwise(F.concat(F.lit("c"), F.col("id").cast("string"))).alias("name"))
    few = spark.createDataFrame([("CITROEN ", 1), ("C1", 2)], "other string, v int")
    joined = on_key(many, F.col("name"), few, F.col("other"), collation=NAMES)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "collate" not in plan
    shuffled = on_key(many, F.col("name"), few.hint("shuffle_hash"), F.col("other"), collation=NAMES)
    assert "ShuffledHashJoin" in shuffled._jdf.queryExecution().executedPlan().toString()
    assert joined.groupBy("v").count().orderBy("v").collect() == [(1, 334), (2, 1)]
    grouped = grouped_by_name(many, ["name"], F.count(F.lit(1)).alias("n"))
    assert "collate" not in grouped._jdf.queryExecution().executedPlan().toString()
    assert grouped.where("name = 'Citroën'").first().n == 334


def test_skewed_name_is_split(spark):
    settings = {"autoBroadcastJoinThreshold": "-1", "adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k", "adaptive.advisoryPartitionSizeInBytes": "5k", "adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(f"spark.sql.{k}", None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(f"spark.sql.{k}", v)
    try:
        rows = spark.range(0, 60_000, 1, 16).select("id", F.when(F.col("id") % 3 == 0, "Škoda").otherwise(F.concat(F.lit("s"), F.col("id").cast("string"))).alias("name"))
        other = spark.range(0, 60_000, 2, 16).select(F.when(F.col("id") == 0, "SKODA").otherwise(F.concat(F.lit("S"), F.col("id").cast("string"))).alias("other"))
        joined = on_key(rows, F.col("name"), other, F.col("other"), collation=NAMES).select("id")
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(f"spark.sql.{k}") if v is None else spark.conf.set(f"spark.sql.{k}", v)


def test_integration_joins_accented_names(spark):
    catalogue = spark.createDataFrame([("Citroën", "C4", "Petrol", "$10", "1 hp", "5"), ("Škoda", "Enyaq", "Electric", "$20", "2 hp", "5")], "company_name string, car_name string, fuel_type string, price string, horsepower string, seats string")
    registry = spark.createDataFrame([("CITROEN", "C4", "Compact", "1.2", "4", "M", "X", "7.0", "5.0", "6.0", "140")], "make string, model string, vehicle_class string, engine_size_l string, cylinders string, transmission string, fuel_type string, fuel_city string, fuel_hwy string, fuel_comb string, co2_gkm string")
    specs = spark.createDataFrame([("Skoda Enyaq", "77", "500", "100", "11", "2022"), ("SKODA Enyaq ", "80", "520", "100", "11", "2023")], "car_model string, battery_capacity_kwh string, autonomy_wltp_km string, dc_charge_power_kw string, ac_charge_power string, release_year string")
    tables = integrate_vehicles(catalogue, registry, specs)
    vehicles = {r.vehicle_id: r for r in tables["vehicle"].collect()}
    assert len(vehicles) == 3
    citroen = next(r for r in vehicles.values() if r.make == "Citroën")
    assert citroen.vehicle_class == "Compact"
    spec = tables["ev_spec"].collect()
    assert len(spec) == 1 and vehicles[spec[0].vehicle_id].make == "Škoda"
