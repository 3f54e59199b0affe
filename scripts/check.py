"""Run analyses on Spark and their SQL on DuckDB, and compare the results.

    python scripts/check.py [--folder DIR] [--plan] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from momentloom.catalog import REGISTRY  # noqa: E402
from momentloom.session import local_session  # noqa: E402


def canonical(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float):
        return (0, "") if math.isnan(value) else (2, repr(value))
    if isinstance(value, (list, tuple)):
        return (3, tuple(canonical(v) for v in value))
    return (1, str(value))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp", "FLOAT": "float", "DOUBLE[]": "array<double>", "INTEGER[]": "array<int>", "FLOAT[]": "array<float>",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def compare(spark, con, analysis, folder: str, plan: bool = False) -> str:
    begin = time.perf_counter()
    df = analysis.run(spark, folder)
    if plan:
        df.explain("formatted")
    rows = [tuple(r) for r in df.collect()]
    took = time.perf_counter() - begin
    note = f"{took:6.2f}s {len(rows):7d} rows"
    if analysis.sql is None:
        return f"rows {note}"
    begin = time.perf_counter()
    cur = con.execute(analysis.sql)
    names = [d[0] for d in cur.description]
    kinds = [KINDS.get(str(d[1]), str(d[1])) for d in cur.description]
    want = cur.fetchall()
    note += f" sql {time.perf_counter() - begin:5.2f}s"
    if sorted(df.columns) != sorted(names):
        return f"FAIL {note} columns {sorted(df.columns)} != {sorted(names)}"
    mine = dict(df.dtypes)
    wrong = {n: (mine[n], k) for n, k in zip(names, kinds) if mine[n] != k}
    if wrong:
        return f"FAIL {note} types {wrong}"
    a, b = rows_of(df.columns, rows), rows_of(names, want)
    if a != b:
        extra, missing = [r for r in a if r not in set(b)], [r for r in b if r not in set(a)]
        show = lambda rs: [tuple(c[1] for c in r) for r in rs[:2]]
        return f"FAIL {note} vs {len(b)}: {len(extra)} differ {sorted(names)} spark {show(extra)} sql {show(missing)}"
    return f"ok   {note}"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--folder", default="/root/testdata/sf0.01")
    parser.add_argument("--plan", action="store_true")
    parser.add_argument("--module", default=None)
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.folder)
    failed = 0
    for name, a in REGISTRY.items():
        if args.names and name not in args.names:
            continue
        if args.module and not a.run.__module__.endswith("." + args.module):
            continue
        try:
            outcome = compare(spark, con, a, args.folder, args.plan)
        except Exception as error:  # report and go on with the next analysis
            outcome = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        failed += not outcome.startswith(("ok", "rows"))
        print(f"{name:34s} {outcome}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
