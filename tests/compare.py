"""Run registered queries beside their SQL and compare the rows.

    python tests/compare.py [--sf sf0.01] [--only prefix,prefix] [--times]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if hasattr(value, "tolist"):
        return tuple(value.tolist())
    if isinstance(value, (list, tuple)):
        return tuple(_cell(v) for v in value)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if type(value).__name__ == "Decimal":
        return float(value)
    return value


def _close(a, b) -> bool:
    if isinstance(a, float) or isinstance(b, float):
        if isinstance(a, (int, float)) and isinstance(b, (int, float)):
            return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def _sort_key(row):
    return tuple((v is None, str(type(v).__name__ in ("int", "float")),
                  f"{v:.6e}" if isinstance(v, float) else str(v)) for v in row)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(_cell(r[i]) for i in order) for r in rows]


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, 'inexact' when equal only up to 1e-9, else a message."""
    names, got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    o_names, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if names != o_names:
        return f"columns {names} vs {o_names}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    if sorted(map(repr, got)) == sorted(map(repr, want)):
        return None
    for a, b in zip(sorted(got, key=_sort_key), sorted(want, key=_sort_key)):
        for n, x, y in zip(names, a, b):
            if not _close(x, y):
                return f"{n}: {x!r} vs {y!r} in {a} vs {b}"[:600]
    return "inexact"


def main() -> int:
    import __spark_entry__ as entry_point
    from patrona.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="sf0.01")
    parser.add_argument("--only", default="")
    parser.add_argument("--times", action="store_true")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/{args.sf}"
    spark = build_session("compare", "local[8]", 8, **{"spark.ui.enabled": "false", "spark.driver.memory": "12g",
                                                       "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry_point.queries(), entry_point.oracle_sql()
    wanted = [w for w in args.only.split(",") if w]
    bad, total = 0, 0.0
    for name, fn in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                verdict = compare(df, con, oracles[name]) or "ok"
            else:
                verdict = f"rows {len(df.collect())}"
        except Exception as exc:  # report every query, then fail
            verdict = f"ERROR {type(exc).__name__}: {str(exc)[:700]}"
        took = time.time() - start
        total += took
        if not (verdict == "ok" or verdict.startswith("rows")):
            bad += 1
        if args.times or not verdict == "ok":
            print(f"{took:6.2f}s {name}: {verdict}", flush=True)
    print(f"{bad} not equal, {total:.1f}s")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
