"""Run checked queries on Spark and their SQL on DuckDB, and compare the rows exactly.

    python -m checks.compare [--sf DIR] [query ...]
"""

from __future__ import annotations

import argparse
import glob
import math
import os
import time
from collections import Counter

import duckdb

TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "date": "DATE"}


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return value + 0.0  # -0.0 and 0.0 are one value
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, query, sql: str | None, sf_dir: str) -> tuple[bool, str]:
    started = time.time()
    df = query(spark, sf_dir)
    rows = df.collect()
    spent = f"{time.time() - started:6.2f}s {len(rows):7d} rows"
    if sql is None:
        return len(rows) > 0, f"{spent} (rows only)"
    result = con.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    expected = rows_of(list(types), result.fetchall())
    if set(df.columns) != set(types):
        return False, f"columns differ: {sorted(df.columns)} / {sorted(types)}"
    wrong = [f"{c}: {t} / {types[c]}" for c, t in df.dtypes if TYPES.get(t) != types[c]]
    got = rows_of(df.columns, rows)
    if wrong:
        return False, f"types differ: {wrong}"
    if got != expected:
        ours, theirs = got - expected, expected - got
        return False, (f"{spent}: {sum(ours.values())} rows only here {list(ours)[:2]}, "
                       f"{sum(theirs.values())} only in SQL {list(theirs)[:2]}")
    return True, spent


def main() -> int:
    from checks import ORACLES, QUERIES
    from riskspark import get_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("queries", nargs="*")
    args = parser.parse_args()
    spark = get_session("checks", "local[8]", {"spark.sql.shuffle.partitions": "8",
                                               "spark.driver.memory": "12g",
                                               "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(args.sf)
    failed = []
    for name in args.queries or QUERIES:
        try:
            good, note = compare(spark, con, name, QUERIES[name], ORACLES.get(name), args.sf)
        except Exception as error:  # report and go on with the next query
            good, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        if not good:
            failed.append(name)
        print(f"{'ok  ' if good else 'FAIL'} {name:32s} {note}", flush=True)
    print(f"{len(failed)} failed: {failed}")
    return bool(failed)


if __name__ == "__main__":
    raise SystemExit(main())
