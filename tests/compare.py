"""Run a registered query and its SQL side by side and compare all rows.

    python -m tests.compare [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

ROOT = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
KIND = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "float": "FLOAT", "smallint": "SMALLINT",
}


def spark_session(cpus: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9) + 0.0
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(df, con, sql) -> list[str]:
    problems = []
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    dtypes = {d[0]: str(d[1]) for d in res.description}
    drows = res.fetchall()
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    if sorted(scols) != sorted(dcols):
        return [f"columns {sorted(scols)} vs {sorted(dcols)}"]
    for name, kind in df.dtypes:
        if KIND.get(kind, kind) != dtypes[name]:
            problems.append(f"type of {name}: {kind} vs {dtypes[name]}")
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    if len(a) != len(b):
        problems.append(f"rows {len(a)} vs {len(b)}")
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        problems.append(f"{len(diff)} rows differ, first {diff[0]}")
    if not a:
        problems.append("no rows")
    return problems


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    spark, sf_dir = spark_session(), f"{ROOT}/sf{args.sf}"
    con = duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args.names or queries:
        t = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                problems = compare(df, con, oracles[name])
            else:
                problems = [] if df.count() else ["no rows"]
        except Exception as e:  # noqa: BLE001
            problems = [f"{type(e).__name__}: {str(e)[:1500]}"]
        bad += bool(problems)
        note = "; ".join(problems) or ("ok" if name in oracles else "ok (no SQL)")
        print(f"{name:28s} {time.time() - t:6.2f}s  {note}", flush=True)
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
