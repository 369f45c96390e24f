"""CSV files that cannot lie: malformed rows whatever is asked for, records over many lines and tasks."""

from __future__ import annotations

import csv
import random

import pytest
from pyspark.sql import functions as F

from ampertide.sources.readers import MALFORMED, read_csv, read_csv_checked

SCHEMA = "a int, b string, c int"
BAD = "a,b,c\n1,x,2\n2,y\n3,z,4,5\n7,q,oops\n"


def file(folder, text, name="f.csv"):
    (folder / name).write_bytes(text.encode())
    return str(folder)


@pytest.mark.parametrize("multi_line", [False, True])
@pytest.mark.parametrize("ask", [lambda d: d.select("a").collect(), lambda d: d.select("b").collect(), lambda d: d.count(), lambda d: d.collect(), lambda d: d.agg(F.max("c")).collect()])
def test_malformed_rows_fail_whatever_is_asked_for(spark, tmp_path, multi_line, ask):
    with pytest.raises(Exception, match="Malformed row"):
        ask(read_csv(spark, file(tmp_path, BAD), SCHEMA, multi_line))
    for line in ("2,y", "3,z,4,5", "7,q,oops"):
        (tmp_path / "one").mkdir(exist_ok=True)
        with pytest.raises(Exception, match="Malformed row"):
            ask(read_csv(spark, file(tmp_path / "one", f"a,b,c\n1,x,2\n{line}\n"), SCHEMA, multi_line))


@pytest.mark.parametrize("multi_line", [False, True])
def test_checked_frames_alone(spark, tmp_path, multi_line):
    path = file(tmp_path, BAD)
    good, bad = read_csv_checked(spark, path, SCHEMA, multi_line)
    assert good.count() == 1 and bad.count() == 3
    assert [tuple(r) for r in good.collect()] == [(1, "x", 2)]
    assert [r.a for r in good.select("a").collect()] == [1]
    assert sorted(r[0] for r in bad.select(MALFORMED).collect()) == ["2,y", "3,z,4,5", "7,q,oops"]
    assert sorted(r.a for r in bad.select("a").collect()) == [2, 3, 7]


def one_task(spark, path, schema):
    reader = spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True)
    return reader.option("ignoreTrailingWhiteSpace", False).option("nullValue", "\u0001").option("emptyValue", "").csv(path)


def test_records_over_many_lines_and_tasks(spark, tmp_path):
    rng = random.Random(4)
    pieces = ['plain', 'a "quoted" word', 'line\nbreak', '\n\n"', ',', '""', 'end"', ' blanks ', 'é', 'x' * 50]
    for k in range(3):
        with open(tmp_path / f"{k}.csv", "w", newline="", encoding="utf-8") as out:
            writer = csv.writer(out, lineterminator="\n")
            writer.writerow(["a", "b", "c"])
            for i in range(400):
                writer.writerow([i, "".join(rng.choices(pieces, k=rng.randint(1, 4))), k])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        split = sorted(map(tuple, read_csv(spark, str(tmp_path), SCHEMA, multi_line=True).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert split == sorted(map(tuple, one_task(spark, str(tmp_path), SCHEMA).collect())) and len(split) == 1200


def test_open_quote_and_wrong_header_fail(spark, tmp_path):
    with pytest.raises(ValueError, match="not closed"):
        read_csv(spark, file(tmp_path, 'a,b,c\n1,"x,2\n3,y,4\n'), SCHEMA, multi_line=True)
    (tmp_path / "h").mkdir()
    with pytest.raises(ValueError, match="header"):
        read_csv(spark, file(tmp_path / "h", "a,c,b\n1,2,3\n"), SCHEMA, multi_line=True)


def test_empty_files(spark, tmp_path):
    assert read_csv(spark, file(tmp_path, "a,b,c\n"), SCHEMA, multi_line=True).collect() == []
    assert read_csv(spark, file(tmp_path, "a,b,c\n"), SCHEMA).collect() == []
