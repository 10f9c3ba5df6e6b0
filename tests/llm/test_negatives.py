import itertools
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sentimill.llm import negatives as n

SCHEMA = "vec_id long, embedding array<float>, label int, vec string, dim string, cell string, score string, slot string"


def brute(rows, positives=5, negatives=3, every=50):
    fine = {(i, lab, tuple(math.floor(256 * float(x)) for x in e)) for i, e, lab in rows
            if i is not None and lab is not None and e and all(x is not None and math.isfinite(x) for x in e)}
    out = set()
    for i, lab, e in fine:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(e, v)), j, own) for j, own, v in fine if j != i and len(v) == len(e))
        for s, j, _ in [x for x in scored if x[2] == lab][:positives]:
            inside = [x for x in scored if x[2] != lab and 50 * -s <= 100 * -x[0] <= 95 * -s]
            out |= {(i, j, k + 1, m, -s, -t) for k, (t, m, _) in enumerate(inside[:negatives])}
    return out


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in n.hard_negatives(df, **options).collect()]
    assert len(got) == len(set(got))
    return set(got)


def vectors(count, dim, seed=0, scale=0.3, labels=3, spread=6):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, scale, (spread, dim))
    return [(i, [float(np.float32(x)) for x in middle[i % spread] + rng.normal(0, scale, dim)], int(rng.integers(labels))) for i in range(count)]


@pytest.mark.parametrize("options", [{}, {"cell_rows": 8, "first_cells": 1, "block": 16, "pack": 2, "sample": 60}],
                         ids=["default", "many small cells"])
def test_equals_brute_force(spark, options):
    rows = vectors(600, 7)
    want = brute(rows)
    assert want and run(spark, rows, **options) == want


def test_ties_repeats_and_a_hot_vector(spark):
    rows = vectors(150, 3, scale=0.02)                     # few different integers: many ties
    rows += [(1000 + i, [0.25, 0.25, 0.25], i % 2) for i in range(300)] + rows[:7] + [(2000, [900.0, -900.0, 0.0], 1), (2050, [0.2, 0.2, 0.2], 0)]
    want = brute(rows)
    assert want and run(spark, rows, cell_rows=16, block=32) == want


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0], 0), (1, None, 0), (2, [1.0, None], 0), (3, [float("nan"), 1.0], 1), (4, [float("inf"), 1.0], 1),
            (5, [1.0, 1.0], None), (None, [1.0, 1.0], 0), (6, [1.0, 1.5], 0), (7, [0.9, 1.2], 1), (8, [0.8, 1.1], 1), (9, [1.0, 1.0, 1.0], 1),
            (50, [2.0], 1), (51, [2.5], 1), (52, [2.2], 0), (100, [-1.0, -1.0], 2), (101, [1.0, 1.0], 2), (150, [0.0, 0.0], 3),
            (151, [5.0, 1.0], 3), (200, [], 0), (201, [], 0), (202, [], 1), (0, [1.0, 1.0], 1)]
    want = brute(rows)
    assert {r[0] for r in want} >= {0, 50, 150} and run(spark, rows) == want
    assert run(spark, []) == set() and run(spark, rows[1:5]) == set() and run(spark, rows[:1]) == set()


def test_large_components_are_exact(spark):
    rows = [(i, [float(np.float32(x * 4e5)) for x in e], lab) for i, e, lab in vectors(120, 4)]
    assert run(spark, rows) == brute(rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.floats(-9, 9), min_size=1, max_size=7), st.lists(st.floats(-9, 9), min_size=1, max_size=7))
def test_multi_sequence_is_in_order_and_complete(a, b):
    found = list(n.multi_sequence(np.array(a), np.array(b)))
    assert {(i, j) for _, i, j in found} == set(itertools.product(range(len(a)), range(len(b))))
    assert all(x[0] >= y[0] for x, y in zip(found, found[1:]))
    assert all(abs(s - a[i] - b[j]) < 1e-9 for s, i, j in found)


def test_bounds_hold_for_every_cell(spark):
    """No vector of a cell scores above the cell's bound, and the cells left unvisited lie under the next bound."""
    rows = vectors(400, 6, seed=3)
    exact = n.integers(spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], SCHEMA))
    books = n.codebooks(exact, cell_rows=10)
    celled = n.assign(exact, books, "int32").cache()
    book = n.with_radii(celled, books)[6]
    assert book.cells.sum() == 400
    own = celled.collect()
    for query in own[:20]:
        q = np.frombuffer(query.body, np.int32).astype(float)
        score = {}
        for r in own:
            score.setdefault(r.cell, []).append(float(np.frombuffer(r.body, np.int32) @ q))
        visited, bound = n.cells_of(q, book, 0, 10, np.inf)
        assert all(max(s) <= bound for c, s in score.items() if c not in visited) and len(visited) == 10
        low = sorted(x for s in score.values() for x in s)[100]
        kept, _ = n.cells_of(q, book, 0, 10 ** 6, low)
        assert all(min(s) > low for c, s in score.items() if c not in kept)
    celled.unpersist()


def test_far_cells_are_not_visited(spark):
    """In clustered data most cells are ruled out by their bounds."""
    rng = np.random.default_rng(1)
    middle = rng.normal(0, 1, (20, 16))
    rows = [(i, [float(np.float32(x)) for x in middle[i % 20] + rng.normal(0, 0.02, 16)], int(rng.integers(3))) for i in range(2000)]
    exact = n.integers(spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], SCHEMA))
    books = n.codebooks(exact, cell_rows=10)
    celled = n.assign(exact, books, "int32").cache()
    book = n.with_radii(celled, books)[16]
    asks = celled.filter("vec_id = 50").collect()
    q = np.frombuffer(asks[0].body, np.int32).astype(float)
    _, bound = n.cells_of(q, book, 0, 8, np.inf)
    best = sorted((float(np.frombuffer(r.body, np.int32) @ q) for r in celled.filter(f"label = {asks[0].label}").collect()), reverse=True)
    assert bound < best[5]                                 # the first round is certain
    celled.unpersist()
