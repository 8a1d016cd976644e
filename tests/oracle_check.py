"""Run registered queries on Spark and their SQL on DuckDB and compare the results.

python tests/oracle_check.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    rows = [
        tuple("<null>" if v is None or v is pd.NA or v is pd.NaT or v != v else repr(v) if isinstance(v, float) else str(v)
              for v in row)
        for row in df.astype(object).itertuples(index=False, name=None)
    ]
    return sorted(rows)


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(set(got.columns) ^ set(want.columns))}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    kinds = [
        f"{c}: {got[c].dtype} vs {want[c].dtype}"
        for c in sorted(got.columns)
        if got[c].dtype != want[c].dtype and len(got)
        and not {str(got[c].dtype), str(want[c].dtype)} <= {"object", "str", "string"}
    ]
    a, b = canonical(got), canonical(want)
    if a != b:
        for x, y in zip(a, b):
            if x != y:
                cols = sorted(got.columns)
                diff = [(c, p, q) for c, p, q in zip(cols, x, y) if p != q]
                return f"values {diff[:4]} key={x[:2]} dtypes={kinds}"
    return f"dtypes {kinds}" if kinds else ""


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    prefixes = argv[1:]
    import __spark_entry__ as entry
    from adperf.session import local_session

    spark = local_session("8")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            got = fn(spark, sf_dir).toPandas()
            spent = time.time() - start
            if name in oracles:
                want = con.execute(oracles[name]).df()
                problem = compare(got, want)
            else:
                problem = "" if len(got) else "no rows"
        except Exception as e:  # noqa: BLE001 - the report shows what failed
            spent, got = time.time() - start, pd.DataFrame()
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        bad += bool(problem)
        kind = "sql " if name in oracles else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name:40s} {len(got):7d} {spent:6.2f}s {problem}",
              flush=True)
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
