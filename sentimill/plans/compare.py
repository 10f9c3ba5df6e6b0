"""Run a registered query in Spark and its SQL in DuckDB, and compare the results.

Used by the tests and by hand (``python -m sentimill.plans.compare sf_dir [names]``).
Comparison is order-insensitive on rows, by column name, exact on values.
"""

from __future__ import annotations

import sys
import time

import pandas as pd

from . import catalog, oracle
from .. import session as session_mod


def duckdb_frame(sql: str, sf_dir: str) -> pd.DataFrame:
    import duckdb

    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con.execute(sql).df()


def _normalise(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime64"):
            df[c] = pd.to_datetime(df[c]).astype("datetime64[us]").astype(str)
        df[c] = df[c].map(lambda v: None if v is None or (isinstance(v, float) and v != v) else
                          (repr(float(v)) if isinstance(v, float) else str(v)))
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


SPARK_TO_DUCKDB = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def duckdb_types(sql: str, sf_dir: str) -> dict[str, str]:
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "labels", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    rows = con.execute("DESCRIBE " + sql).fetchall()
    return {r[0]: r[1] for r in rows}


def compare(spark, name: str, sf_dir: str) -> tuple[bool, str]:
    t0 = time.time()
    df = catalog.QUERIES[name](spark, sf_dir)
    left = df.toPandas()
    t1 = time.time()
    right = duckdb_frame(oracle.SQL[name], sf_dir)
    if sorted(left.columns) != sorted(right.columns):
        return False, f"columns {sorted(left.columns)} != {sorted(right.columns)}"
    want = duckdb_types(oracle.SQL[name], sf_dir)
    got = {c: SPARK_TO_DUCKDB.get(t, t) for c, t in df.dtypes}
    if got != want:
        return False, f"types {got} != {want}"
    if len(left) != len(right):
        return False, f"rows {len(left)} != {len(right)}"
    a, b = _normalise(left), _normalise(right)
    diff = (a != b) & ~(a.isna() & b.isna())
    if diff.any().any():
        i = int(diff.any(axis=1).to_numpy().nonzero()[0][0])
        return False, f"first difference at row {i}: spark={a.iloc[i].to_dict()} duckdb={b.iloc[i].to_dict()}"
    return True, f"{len(left)} rows, spark {t1 - t0:.2f}s"


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or [n for n in catalog.QUERIES if n in oracle.SQL]
    spark = session_mod.build_session()
    bad = 0
    for n in names:
        try:
            ok, msg = compare(spark, n, sf_dir)
        except Exception as e:  # report and go on
            ok, msg = False, f"error {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {n}: {msg}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
