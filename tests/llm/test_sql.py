"""Every operator with SQL equals DuckDB, types included."""

import pytest

from sentimill.llm import queries
from sentimill.plans import compare

SF = "/root/testdata/sf0.01"


def types(sql):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    return {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_duckdb(spark, name):
    df = queries.QUERIES[name](spark, SF)
    left, right = df.toPandas(), compare.duckdb_frame(queries.SQL[name], SF)
    assert {c: compare.SPARK_TO_DUCKDB[t] for c, t in df.dtypes} == types(queries.SQL[name])
    assert len(left) == len(right) > 0
    a, b = compare._normalise(left), compare._normalise(right)
    assert a.equals(b)
