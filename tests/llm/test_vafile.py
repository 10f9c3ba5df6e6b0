import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sentimill.llm import vafile as v

SCHEMA = "vec_id long, embedding array<float>, label int, vec string, dim string, score string"


def brute(rows, k=5, every=50):
    seen = sorted({(r[0], tuple(math.floor(256 * float(x)) for x in r[1])) for r in rows
                   if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])})
    out = set()
    for q, qv in seen:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(qv, c)), i) for i, c in seen if i != q and len(c) == len(qv))
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])}
    return out


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, e, 1, "a", "b", "c") for i, e in rows], SCHEMA)
    got = [tuple(r) for r in v.top_k(df, **options).collect()]
    assert len(got) == len(set(got))
    return set(got)


def vectors(n, dim, seed=0, scale=0.2):
    rng = np.random.default_rng(seed)
    return [(i, [float(np.float32(x)) for x in rng.normal(0, scale, dim)]) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"cells": 2, "block": 64, "queries": 2, "sample": 20}], ids=["default", "coarse cells"])
def test_equals_brute_force(spark, options):
    rows = vectors(400, 6)
    assert run(spark, rows, **options) == brute(rows)


def test_a_null_id_costs_no_row(spark):
    rows = vectors(200, 4)
    assert run(spark, [*rows[:99], (None, rows[0][1]), *rows[99:]]) == brute(rows)


def test_ties_repeats_and_a_hot_vector(spark):
    rows = vectors(120, 3, scale=0.01)                     # few different integers: many ties
    rows += [(1000 + i, [0.25, 0.25, 0.25]) for i in range(300)] + rows[:7] + [(2000, [1e6, -1e6, 0.0])]
    assert run(spark, rows, block=50) == brute(rows)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (50, [0.5, -0.5]),
            (100, [1.0, 1.0, 1.0]), (150, []), (5, [-1.0, 0.0]), (None, [9.0, 9.0]), (200, []), (None, None)]
    assert run(spark, rows) == brute([r for r in rows if r[0] is not None and r[1] != []])
    assert run(spark, []) == set() and run(spark, rows[1:5]) == set()
    assert run(spark, rows[:1]) == set()                   # a query without candidates


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 1 << 30))
def test_bounds_hold(seed):
    rng = np.random.default_rng(seed)
    rows = rng.integers(-300, 300, (30, 4))
    low = np.sort(rng.integers(-300, 300, (4, 5)), axis=1)
    low[:, 0] = rows.min(axis=0)
    low = np.clip(np.maximum.accumulate(low, axis=1), rows.min(axis=0)[:, None], rows.max(axis=0)[:, None])
    high = np.concatenate([np.maximum(low[:, 1:] - 1, low[:, :-1]), rows.max(axis=0)[:, None]], axis=1)
    code, dims = v.quantise(rows, low), np.arange(4)
    assert (low[dims, code] <= rows).all() and (rows <= high[dims, code]).all()
    queries = rng.integers(-300, 300, (7, 4)).astype(float)
    least, most = v.bounds(queries, low[dims, code].astype(float), high[dims, code].astype(float))
    product = queries @ rows.T
    assert (least <= product).all() and (product <= most).all()


def test_few_exact_vectors_are_read(spark):
    """The cells rule out nearly all vectors."""
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    exact = v.integers(table)
    cut = v.cut_cells(exact)
    blocks = v._blocks(exact.coalesce(1), v.BLOCK, cut)
    asked = v._blocks(exact.filter("vec_id % 50 = 0").coalesce(1), v.QUERIES, None).withColumn("group", F.lit(0).cast("long"))
    per = v._candidates(blocks, asked, 1, cut, 5).groupBy("query_id").count().agg(F.avg("count")).first()[0]
    assert 5 <= per < 40


def test_what_is_passed_on_grows_with_queries_not_with_blocks(spark):
    """However many blocks there are, the candidates of a query stay those that reach the k-th bound over all."""
    exact = v.integers(spark.createDataFrame([(i, e, 1, "a", "b", "c") for i, e in vectors(3000, 8)], SCHEMA))
    cut = v.cut_cells(exact)
    asked = v._blocks(exact.filter("vec_id % 50 = 0").coalesce(1), v.QUERIES, None).withColumn("group", F.lit(0).cast("long"))
    counts = [v._candidates(v._blocks(exact.coalesce(1), size, cut), asked, 1, cut, 5).count() for size in (3000, 100)]
    assert counts[0] == counts[1] < 60 * 40
