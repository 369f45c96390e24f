"""Operators against brute force on small frames."""

from __future__ import annotations

import os
import random
import statistics

import pytest
from pyspark.sql import functions as F

from ampertide.functions import numbers, parse, text
from ampertide.operators import merging, quality
from ampertide.operators.aggregates import grouped_median, mean_over_join, row_counts
from ampertide.operators.joining import attach_matches, best_match, left_rows, rank_aligned, with_scalars, without_match
from ampertide.operators.numbering import ascending, first_per_key, number_in_groups, number_rows, running_total
from ampertide.operators.reshaping import nest, only, pair_rows, sum_entries, unnest
from ampertide.operators.slicing import last_rows, optional_filter
from ampertide.sources import readers, sinks
from ampertide.session import fresh_path, materialise, scratch, with_row_tie


DOMAIN = [None, *range(20)]


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """300 rows, most of them in one group; some keys and values NULL."""
    rng = random.Random(7)
    rows = []
    for i in range(300):
        group = "hot" if i % 10 < 7 else rng.choice(["a", "b", None])
        rows.append((i, group, rng.choice([None, *range(20)]), round(rng.uniform(0, 50), 2)))
    return spark.createDataFrame(rows, "id int, g string, v int, x double").repartition(5).cache()


def expected_ranks(rows):
    out, groups = [], {}
    for row in rows:
        groups.setdefault(row["g"], []).append(row)
    for members in groups.values():
        members.sort(key=lambda r: (r["v"] is not None, r["v"] or 0, r["id"]))
        out += [(r["id"], n) for n, r in enumerate(members, 1)]
    return sorted(out)


@pytest.mark.parametrize("unique", [False, True])
def test_number_in_groups(skewed, unique):
    got = number_in_groups(skewed, ["g"], ascending("v", "id"), unique=unique)
    assert got.schema["rn"].dataType.simpleString() == "bigint"
    assert got.columns == [*skewed.columns, "rn"]
    assert values(got.select("id", "rn")) == sorted(expected_ranks(skewed.collect()), key=repr)


def test_number_rows_is_dense_and_ordered(skewed):
    got = number_rows(skewed, ascending("g", "v", "id")).collect()
    order = sorted(got, key=lambda r: (r["g"] is not None, r["g"] or "", r["v"] is not None, r["v"] or 0, r["id"]))
    assert [r["rn"] for r in order] == list(range(1, 301))


def test_number_rows_continues_and_takes_empty_input(spark, skewed):
    after = spark.range(1).select(F.lit(1000).alias("top"))
    assert min(r["rn"] for r in number_rows(skewed, ascending("id"), after=after).collect()) == 1001
    assert number_rows(skewed.where("id < 0"), ascending("id")).count() == 0


def test_first_per_key_drops_rows_before_the_shuffle(skewed):
    first = first_per_key(skewed, ["g"], ascending("v", "id"))
    wanted = sorted((i for i, n in expected_ranks(skewed.collect()) if n == 1))
    assert sorted(r["id"] for r in first.collect()) == wanted
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("hashpartitioning") < plan.index("Partial")


def test_running_total(skewed):
    got = {r["id"]: r["s"] for r in running_total(skewed, ["g"], ascending("v", "id"), F.col("id"), "s").collect()}
    groups = {}
    for r in sorted(skewed.collect(), key=lambda r: (r["v"] is not None, r["v"] or 0, r["id"])):
        groups[r["g"]] = groups.get(r["g"], 0) + r["id"]
        assert got[r["id"]] == groups[r["g"]]


def test_rank_aligned(spark, skewed):
    left = skewed.where("g IS NOT NULL").select("g", F.col("id").alias("l"))
    right = skewed.where("g IS NOT NULL AND x > 20").select("g", F.col("id").alias("r"))
    plain = rank_aligned(left, right, ["g"], ascending("l"), ascending("r"))
    sides = [{}, {}]
    for side, df, column in zip(sides, (left, right), "lr"):
        for r in sorted(df.collect(), key=lambda r: r[column]):
            side.setdefault(r["g"], []).append(r[column])
    wanted = [(g, n, l, r) for g in sides[1] for n, (l, r) in enumerate(zip(sides[0][g], sides[1][g]), 1)]
    assert values(plain.select("g", "rn", "l", "r")) == sorted(wanted, key=repr)


def test_grouped_median(spark, skewed):
    groups = {}
    for r in skewed.collect():
        groups.setdefault(r["g"], []).append(r["x"])
    got = {r["g"]: r["m"] for r in grouped_median(skewed, ["g"], "x", "m").collect()}
    assert got == {g: pytest.approx(statistics.median(xs)) for g, xs in groups.items()}


def test_median_without_keys(skewed):
    one = grouped_median(skewed, [], "x", "m")
    assert one.first()[0] == pytest.approx(statistics.median(r["x"] for r in skewed.collect()))
    assert "Cartesian" not in one._jdf.queryExecution().executedPlan().toString()
    assert grouped_median(skewed.where("id < 0"), [], "x", "m").collect() in ([], [(None,)])


def test_grouped_median_with_repeated_values(skewed):
    groups = {}
    for r in skewed.where("v IS NOT NULL").collect():
        groups.setdefault(r["g"], []).append(r["v"])
    got = {r["g"]: r["median"] for r in grouped_median(skewed, ["g"], "v").collect()}
    assert got == {g: statistics.median(vs) for g, vs in groups.items()}


def test_mean_over_join_equals_plain_join(spark, skewed):
    members = spark.createDataFrame([("hot", "p"), ("hot", "q"), ("a", "p"), ("c", "r")], "g string, m string")
    got = mean_over_join(skewed, members, "g", {"mean": (F.col("x"), 2)}, ["m"], {"n": F.lit(True), "high": F.col("x") > 25})
    plain = skewed.join(members, "g").groupBy("m").agg(F.avg("x"), F.count(F.lit(1)), F.count_if(F.col("x") > 25))
    for a, b in zip(values(got), values(plain)):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1]) and a[2:] == b[2:]
    empty = mean_over_join(skewed.where("id < 0"), members, "g", {"mean": (F.col("x"), 2)}, counts={"n": F.lit(True)})
    assert values(empty) == [(None, 0)]


def test_exact_mean_does_not_depend_on_order(skewed):
    means = {skewed.repartition(n).agg(numbers.exact_mean(F.col("x"))).first()[0] for n in (1, 3, 7, 11)}
    assert len(means) == 1


def test_exact_mean_rounds_nothing_away(spark):
    df = spark.createDataFrame([(10.125,), (None,), (-3.5,)], "x double")
    assert df.agg(numbers.exact_mean(F.col("x"), 3)).first()[0] == 3.3125
    with pytest.raises(Exception, match="more than 2 decimals"):
        df.agg(numbers.exact_mean(F.col("x"), 2)).collect()


def test_nest_unnest_and_sum_entries(skewed):
    nested = nest(skewed, ["g"], ["v"], {"n": F.count(F.lit(1)), "total": F.sum("x")}, "items", DOMAIN)
    back = unnest(nested, "items")
    plain = skewed.groupBy("g", "v").agg(F.count(F.lit(1)), F.sum("x"))
    assert [(a[0], a[1], a[2]) for a in values(back)] == [(b[0], b[1], b[2]) for b in values(plain)]
    three = nested.select("g", sum_entries(F.col("items"), "n", {"v": 3}).alias("n"))
    wanted = skewed.groupBy("g").agg(F.sum(F.when(F.col("v") == 3, 1.0).otherwise(0.0)))
    assert values(three) == values(wanted)


def test_attach_matches_keeps_rows_without_matches(spark, skewed):
    left = spark.createDataFrame([("hot",), ("zzz",)], "g string")
    got = {r["g"]: r["matches"] for r in attach_matches(left, skewed, ["g"], ["v"], {"n": F.count(F.lit(1))}, DOMAIN).collect()}
    assert got["zzz"] == [] and sum(m["n"] for m in got["hot"]) == 210


def test_pair_rows_equals_self_join(spark):
    rows = spark.createDataFrame([(1, "TWh", 5.0), (1, "%", 50.0), (2, "TWh", 7.0), (3, "TWh", None), (3, "%", 1.0), (1, "TWh", 6.0)], "k int, unit string, v double")
    got = pair_rows(rows, ["k"], "unit", "v", {"twh": "TWh", "pct": "%"})
    assert values(got) == [(1, 5.0, 50.0), (1, 6.0, 50.0), (3, None, 1.0)]


def test_merges(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    source = spark.createDataFrame([(2, "B", 1), (3, "C", 2)], "k int, v string, w int")
    assert values(merging.merge_keep(target, source, ["k"])) == sorted([(1, "a", None), (2, "b", None), (None, "n", None), (3, "C", 2)], key=repr)
    assert values(merging.merge_replace(target, source, ["k"])) == sorted([(1, "a", None), (None, "n", None), (2, "B", 1), (3, "C", 2)], key=repr)


def test_backfill_fills_only_nulls(spark):
    target = spark.createDataFrame([(" x", None), ("X", "own"), ("y", None)], "k string, c string")
    source = spark.createDataFrame([("x", "b"), ("X ", "a"), ("z", "c")], "k string, c string")
    key = F.upper(F.trim(F.col("k")))
    assert values(merging.backfill(target, key, "c", source, key, F.col("c"))) == sorted([(" x", "a"), ("X", "own"), ("y", None)], key=repr)


def test_without_match_and_best_match(spark):
    left = spark.createDataFrame([("Ab C",), ("d",), (None,)], "t string")
    right = spark.createDataFrame([("A", "bc", 9), ("a", "B C", 4), ("E", None, 1)], "m string, n string, i int")
    l_key, r_key = text.match_key(F.col("t")), text.match_key(F.col("m"), F.col("n"))
    assert values(without_match(left, l_key, right, r_key)) == sorted([("d",), (None,)], key=repr)
    assert values(best_match(left, l_key, right, r_key, ascending("i")).select("t", "i")) == [("Ab C", 4)]


def test_profiles(spark):
    df = spark.createDataFrame([("1", "x", None), ("2.5", "", "7"), ("2.5", "NA", "-4"), (None, "x", "12")], "f string, t string, i string")
    got = {r["column_name"]: r for r in quality.profile(df).collect()}
    assert [got[c]["type_class"] for c in "fti"] == ["FLOAT", "TEXT", "INTEGER"]
    assert [got[c]["n_nulls"] for c in "fti"] == [1, 1, 1] and got["f"]["n_distinct"] == 2 and got["t"]["null_pct"] == 25.0
    assert got["i"]["least_values"] == "-4|12|7"
    quick = {r["column_name"]: r for r in quality.quick_profile(df).collect()}
    assert [quick[c]["type_class"] for c in "fti"] == ["FLOAT", "TEXT", "INTEGER"] and quick["i"]["least_value"] == "-4"
    assert values(quality.cast_failures(df, {"f": "int", "t": "int", "i": "int"})) == [("f", 2), ("i", 0), ("t", 3)]


def test_checks(spark):
    df = spark.createDataFrame([(1, "CH", None), (2, "CHE", 1), (2, None, None), (None, "XX", None), (None, "XX", None)], "k int, c string, h int")
    rules = quality.conformance_rules(df, ["k", "c", "gone"], {"c": 2})
    assert values(quality.violations(df.where("k = 2"), ["k"], rules)) == [(2, "length:c"), (2, "required:c"), (2, "required:gone"), (2, "required:gone")]
    assert values(quality.duplicates(df, ["k"])) == [(2, 2)]
    assert quality.duplicates(df, ["k", "h"]).count() == 0
    parents = spark.createDataFrame([("CH",)], "code string")
    assert quality.orphans(df, "c", parents, "code").count() == 3
    assert quality.type_mismatches(df, {"k": "int", "c": "int", "z": "int"}) == [("c", "int", "string"), ("z", "int", "absent")]


def test_reconcile(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None), (4, 4.0)], "k int, v double")
    b = spark.createDataFrame([(1, 1.00001), (2, 2.1), (3, 3.0), (5, 5.0)], "k int, v double")
    assert sorted(r["k"] for r in quality.reconcile(a, b, ["k"], ["v"], 1e-4).collect()) == [2, 3, 4, 5]


def test_row_counts(spark):
    got = row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert values(got) == [("a", 3), ("b", 0), ("total", 3)]


def test_sinks(spark):
    path = fresh_path(spark, "sink")
    df = spark.range(4).selectExpr("id", "id % 2 AS p")
    assert sinks.overwrite(df, path).count() == 4
    assert sinks.append(df, path).count() == 8
    assert sinks.overwrite(df, path).count() == 4
    assert sinks.truncate(df, path).count() == 0
    assert sinks.truncate(df, path).columns == ["id", "p"]


def test_slices(spark):
    df = spark.range(30)
    assert [r[0] for r in last_rows(df, 3, "id").collect()] == [27, 28, 29]
    assert optional_filter(df, "id", None) is df and optional_filter(df, "id", 3).count() == 1


@pytest.mark.parametrize(
    "price, lower, first_part",
    [("$1,100,000 ", 1100000, 1100000), ("$12,000-$15,000", 12000, None), ("$10,000 - $12,000", 10000, 10000), ("n/a", None, None), (None, None, 0)],
)
def test_price_parsers(spark, price, lower, first_part):
    row = spark.createDataFrame([(price,)], "p string").select(parse.price_lower_bound(F.col("p")), parse.price_first_part(F.col("p"))).first()
    assert tuple(row) == (lower, first_part)


@pytest.mark.parametrize("word, tri, strict", [("True", True, True), (" YES", True, False), ("n", False, False), ("maybe", None, False), (None, None, False)])
def test_flags(spark, word, tri, strict):
    row = spark.createDataFrame([(word,)], "w string").select(parse.flag_or_null(F.col("w")), parse.flag_is_true(F.col("w"))).first()
    assert tuple(row) == (tri, strict)


def test_model_split(spark):
    df = spark.createDataFrame([("Citroen C  Zero",), ("Renault ZOE ",), ("A  B",), ("Solo",)], "m string")
    got = df.select(text.split_first(F.col("m")), text.rejoin_rest(F.col("m")), text.first_word(F.col("m")), text.after_first_word(F.col("m")))
    assert [tuple(r) for r in got.collect()] == [
        ("Citroen", "C  Zero", "Citroen", "C  Zero"), ("Renault", "ZOE ", "Renault", "ZOE"), ("A", "B", "A", "B"), ("Solo", "", "Solo", "")]


def test_nest_names_undeclared_elements(skewed):
    with pytest.raises(Exception, match="not declared for items: 7"):
        nest(skewed.where("v = 7"), ["g"], ["v"], {"n": F.count(F.lit(1))}, "items", [1, 2]).collect()


def test_only_refuses_a_second_row(spark):
    rows = spark.createDataFrame([(1, 2.0), (1, 3.0), (2, 4.0)], "k int, v double")
    assert rows.where("k = 2").groupBy("k").agg(only(F.col("v"))).collect() == [(2, 4.0)]
    with pytest.raises(Exception, match="more than one row"):
        rows.groupBy("k").agg(only(F.col("v"))).collect()


def test_left_rows_equals_left_join(spark, skewed):
    left = spark.createDataFrame([("hot", 1), ("zzz", 2), (None, 3), ("a", 4), ("a", 5)], "g string, l int")
    right = skewed.select("g", "id")
    assert values(left_rows(left, right, ["g"])) == values(left.join(right, ["g"], "left"))


def test_merges_refuse_repeated_source_keys(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(2, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, v string")
    for merge in (merging.merge_keep, merging.merge_replace):
        with pytest.raises(Exception, match="repeated merge key: 2"):
            merge(target, source, ["k"]).collect()
        assert merge(target, source.where("v <> 'c'"), ["k"]).count() == 4


def test_csv_of_other_writers(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,name,v\n1,"Café ""Sud"", Lyon",5\n2,"two\nlines",6\n3, blanks ,7\n4,"",8\n')
    rows = readers.read_csv(spark, str(tmp_path), "id int, name string, v int", multi_line=True)
    assert values(rows) == [(1, 'Café "Sud", Lyon', 5), (2, "two\nlines", 6), (3, " blanks ", 7), (4, "", 8)]


def test_malformed_csv_rows(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id,name,v\n1,a,5\n2,b,6,7\n3,c\nx,d,9\n")
    schema = "id int, name string, v int"
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        readers.read_csv(spark, str(tmp_path), schema).collect()
    good, bad = readers.read_csv_checked(spark, str(tmp_path), schema)
    assert values(good) == [(1, "a", 5)] and sorted(r["_malformed"] for r in bad.collect()) == ["2,b,6,7", "3,c", "x,d,9"]


def test_scratch_tables_can_be_dropped_early(spark):
    with scratch(spark):
        kept = materialise(spark.range(3), "scratch")
        path = kept.inputFiles()[0]
        assert kept.count() == 3 and os.path.exists(path.removeprefix("file://"))
    assert not os.path.exists(path.removeprefix("file://"))


def test_clustered_can_be_rebuilt(spark):
    path = fresh_path(spark, "rebuilt")
    rows = spark.range(10).selectExpr("id", "id % 2 AS p")
    sinks.clustered(rows, path, ["p"], ["id"])
    assert sinks.clustered(rows.where("id < 4"), path, ["p"], ["id"]).count() == 4


def test_scalars_need_one_row(spark):
    df = spark.range(3)
    assert with_scalars(df, spark.range(1).selectExpr("7 AS a", "8 AS b")).where("a = 7 AND b = 8").count() == 3
    assert with_scalars(df, spark.range(0).selectExpr("id AS a")).count() == 0
    with pytest.raises(Exception, match="more than one row|SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        with_scalars(df, spark.range(2).selectExpr("id AS a")).collect()


def test_copies_are_spread_over_partitions(spark):
    copies = materialise(spark.range(20_000).select(F.when(F.col("id") < 15_000, 1).otherwise(F.col("id")).alias("k")), "copies")
    ties = with_row_tie(copies)
    assert ties.select("_tie").distinct().count() == 20_000
    placed = ties.repartitionByRange(4, "k", "_tie").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in placed) < 9_000
    numbers = number_rows(copies, ascending("k"))
    assert numbers.agg(F.countDistinct("rn"), F.max("rn")).first()[:] == (20_000, 20_000)
    assert numbers.where("k = 1").agg(F.max("rn")).first()[0] == 15_000


def test_row_tie_on_frames_that_are_no_scan(spark):
    stored = materialise(spark.range(100).selectExpr("id", "id % 7 AS g"), "plain")
    for df in (stored.groupBy("g").count(), stored.join(stored.select("id"), "id"), stored.union(stored), spark.range(5)):
        tied = with_row_tie(df)
        assert tied.columns == [*df.columns, "_tie"]
        assert tied.select("_tie").distinct().count() == df.count()
