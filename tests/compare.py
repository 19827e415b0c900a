"""Run registered queries and their oracles side by side.

``python tests/compare.py [scale] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import duckdb  # noqa: E402

import fixtures  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in fixtures.TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_plain(v) for v in value) + "]"
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql) -> str | None:
    """None if both sides hold the same rows, else a short description."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(ours) != len(theirs):
        return f"{len(ours)} rows, oracle has {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if not bad:
        return None
    ordered = sorted(names)
    a, b = bad[0]
    cells = [(c, x, y) for c, x, y in zip(ordered, a, b) if x != y]
    return f"{len(bad)} rows differ, first: {cells[:6]}"


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    scale, *wanted = sys.argv[1:] or ["0.01"]
    sf_dir = f"/root/testdata/sf{scale}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    sqls = contract.oracle_sql()
    for name, build in contract.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            if name in sqls:
                problem = difference(df, con, sqls[name])
                note = f"ok, {df.count()} rows" if problem is None else f"DIFFERS: {problem}"
            else:
                problem, note = None, f"no oracle, {df.count()} rows"
        except Exception as error:  # report and go on with the next query
            problem = note = f"ERROR: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - start:6.1f}s {note}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
