"""Compare Spark results with DuckDB results of the registered SQL."""

from __future__ import annotations

import glob
import os
import time
from decimal import Decimal

import duckdb

FAMILY = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def _plain(value):
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def differences(df, sql: str, con: duckdb.DuckDBPyConnection) -> tuple[list[str], int]:
    """Differences in columns, types or rows, and the row count."""
    problems = []
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]).upper() for d in result.description}
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} vs {sorted(names)}"], -1
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        wanted = FAMILY.get(kind, kind.upper())
        if types[field.name].replace(" ", "") != wanted:
            problems.append(f"type of {field.name}: {kind} vs {types[field.name]}")
    order = sorted(names)
    actual = [tuple(_plain(r[c]) for c in order) for r in df.collect()]
    index = [names.index(c) for c in order]
    wanted_rows = [tuple(_plain(r[i]) for i in index) for r in expected]
    if len(actual) != len(wanted_rows):
        problems.append(f"rows {len(actual)} vs {len(wanted_rows)}")
    else:
        for a, b in zip(sorted(actual, key=_key), sorted(wanted_rows, key=_key)):
            if a != b:
                problems.append(f"row {a} vs {b}")
                break
    return problems, len(actual)


if __name__ == "__main__":
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tests.conftest import make_session

    folder = sys.argv[1]
    only = sys.argv[2:]
    spark = make_session()
    con = connection(folder)
    oracles = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problems, n = differences(query(spark, folder), oracles[name], con)
        except Exception as error:  # noqa: BLE001
            problems, n = [f"{type(error).__name__}: {str(error)[:600]}"], -1
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} rows={n} {time.time() - start:.2f}s", *problems, flush=True)
    print("failed:", bad)
