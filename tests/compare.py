"""Runs a query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import glob
import os
import sys
import tempfile
import time
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from tidemark.session import build_session  # noqa: E402

DATA = "/root/testdata"


def session(cpus: int = 8):
    spark = build_session(
        "tidemark-tests",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].map(lambda v: None if v is None or v is pd.NaT or v != v else v).astype(object)
    df = df.map(lambda v: "<null>" if v is None else repr(float(v)) if isinstance(v, float) else str(v))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def difference(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    a, b = canonical(spark_rows), canonical(sql_rows)
    if list(a.columns) != list(b.columns):
        return f"columns {list(a.columns)} against {list(b.columns)}"
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}"
    if not len(a):
        return None
    unequal = (a != b).any(axis=1)
    if unequal.any():
        i = unequal.idxmax()
        return f"{int(unequal.sum())} rows differ, first:\n{a.loc[i].to_dict()}\n{b.loc[i].to_dict()}"
    return None


def main(names: list[str]) -> None:
    from __spark_entry__ import oracle_sql, queries as all_queries

    sf = os.environ.get("SF_DIR", f"{DATA}/sf0.01")
    queries, oracle = all_queries(), oracle_sql()
    spark, con = session(), database(sf)
    bad = 0
    for name in names or list(queries):
        started = time.time()
        try:
            rows = queries[name](spark, sf).toPandas()
            took = time.time() - started
            problem = difference(rows, con.execute(oracle[name]).df()) if name in oracle else None
            kinds = {c: str(t) for c, t in rows.dtypes.items()}
            if name in oracle:
                other = {c: str(t) for c, t in con.execute(oracle[name]).df().dtypes.items()}
                odd = {c: (kinds[c], other[c]) for c in kinds if c in other and other[c] != kinds[c]}
                if odd and not problem:
                    print("   types", odd)
        except Exception as e:  # noqa: BLE001
            problem, took, rows = f"{type(e).__name__}: {str(e)[:1200]}", time.time() - started, []
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:28} {len(rows):8} rows {took:6.2f} s {problem or ''}", flush=True)
    print("failed:", bad)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
