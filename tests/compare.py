"""Run registered queries on Spark and their SQL on DuckDB and compare the results.

    python -m tests.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of_spark(df):
    order = sorted(df.columns)
    return order, [tuple(_plain(r[c]) for c in order) for r in df.collect()]


def rows_of_duck(con, statement):
    cur = con.execute(statement)
    names = [d[0] for d in cur.description]
    order = sorted(names)
    index = [names.index(c) for c in order]
    return order, [tuple(_plain(r[i]) for i in index) for r in cur.fetchall()]


def _sort_key(row):
    return tuple((v is None, type(v).__name__, str(v)) for v in row)


def difference(spark_result, duck_result) -> str | None:
    """None when equal, else what differs (values and Python types)."""
    (names_a, a), (names_b, b) = spark_result, duck_result
    if names_a != names_b:
        return f"columns {names_a} != {names_b}"
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    for x, y in zip(sorted(a, key=_sort_key), sorted(b, key=_sort_key), strict=True):
        if x != y or [type(v) for v in x] != [type(v) for v in y]:
            return f"{names_a}: {x} != {y}"
    return None


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from pricelake.session import build

    sf_dir, names = argv[0], argv[1:]
    spark = build(
        "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                       "spark.ui.showConsoleProgress": "false",
                       "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, statements, bad = duck(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        began = time.perf_counter()
        try:
            got = rows_of_spark(run(spark, sf_dir))
            took = time.perf_counter() - began
            if name in statements:
                verdict = difference(got, rows_of_duck(con, statements[name])) or "equal"
            else:
                verdict = "no sql"
        except Exception as err:
            took = time.perf_counter() - began
            got, verdict = ([], []), f"{type(err).__name__}: {str(err)[:600]}"
        bad += verdict not in ("equal", "no sql")
        print(f"{name:28} {took:6.2f}s {len(got[1]):8} rows  {verdict}", flush=True)
    print(f"{bad} different")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
