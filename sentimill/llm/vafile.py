"""Exact top-k search by inner product with a vector-approximation file.

Vectors become integers (floor(256 x) per component).  Each dimension is cut into cells
at quantiles of a bounded sample; the outer cells reach to the exact least and greatest
value.  The approximation file, in the shared folder, holds one byte per dimension for
every vector, in blocks.  Query blocks scan it: the cell a component lies in gives
a lower and an upper bound of its part of the product, so four matrix products give
both bounds for a block.  A first pass finds each query's k-th greatest lower bound over all
blocks, of which only k numbers a query and block are passed on; a second pass returns the vectors whose upper bound
reaches it.  Their exact vectors are read in the order of their
bounds, in growing rounds, until a query's k-th score is above every bound unread.

Of equal vectors only the k + 1 with the smallest ids can be among a query's k best
(ties go to the smaller id, and the query itself may be one of them), so a vector
that many rows share is scanned k + 1 times, whatever their number.

Rows with a null vec_id take no part, and neither do vectors that are null or empty or hold a null or non-finite
component; vectors of different lengths don't meet.  Rows repeated as a whole count once.  A query
with fewer than k candidates gets them all; without any, no row.  Components are
exact up to 2^31 / 256 and scores as long as they fit a long; bounds are widened by the
rounding of doubles.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SCALE = 256
K = 5
QUERY_EVERY = 50
CELLS = 64               # per dimension
SAMPLE = 4_000           # rows whose quantiles cut the cells
BLOCK = 8192             # vectors in a row of the approximation file
QUERIES = 4096           # queries that scan together
CHUNK = 1024             # vectors of a block that are bounded together
TOGETHER = 256           # queries whose bounds are held at a time
FIRST_READ = 4           # the first round reads so many times k exact vectors per query; each next one four times as many


def integers(table: DataFrame) -> DataFrame:
    """(vec_id, vec, dim, vkey) of the rows that take part, repeated rows once."""
    fine = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    vec = F.transform("embedding", lambda x: F.floor(SCALE * x.cast("double")).cast("long"))
    return (table.filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & fine).select("vec_id", vec.alias("vec")).distinct()
            .withColumn("dim", F.size("vec")).withColumn("vkey", F.xxhash64("vec")))


def cut_cells(vectors: DataFrame, cells: int = CELLS, sample: int = SAMPLE) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By dimension: least and greatest value of each cell, both (dim, cells)."""
    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows in by_dim(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim], pa.int32()), pa.array([rows.min(axis=0).tolist()], pa.list_(pa.int64())),
                     pa.array([rows.max(axis=0).tolist()], pa.list_(pa.int64()))], names=["dim", "least", "most"])

    parts = vectors.filter("dim > 0").select("dim", "vec").mapInArrow(extremes, "dim int, least array<long>, most array<long>")
    ends = (parts.select("dim", F.posexplode(F.arrays_zip("least", "most")))
            .groupBy("dim", "pos").agg(F.min("col.least").alias("least"), F.max("col.most").alias("most")).collect())
    drawn = vectors.filter("dim > 0").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("dim", "vec").collect()
    out = {}
    for dim in {r["dim"] for r in ends}:
        own = sorted((r for r in ends if r["dim"] == dim), key=lambda r: r["pos"])
        least, most = (np.array([r[c] for r in own], np.int64) for c in ("least", "most"))
        some = np.array([r["vec"] for r in drawn if r["dim"] == dim], np.int64).reshape(-1, dim)
        if not len(some):                                  # a length that the sample missed
            some = np.stack([least, most])
        inner = np.quantile(some, np.arange(1, cells) / cells, axis=0, method="lower").astype(np.int64).T
        low = np.concatenate([least[:, None], inner], axis=1)
        low = np.clip(np.maximum.accumulate(low, axis=1), least[:, None], most[:, None])
        high = np.concatenate([np.maximum(low[:, 1:] - 1, low[:, :-1]), most[:, None]], axis=1)
        out[dim] = low, high
    return out


def by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(dim, vectors) of a batch with columns dim and vec; rows in order, one group per run of equal dims."""
    dims = batch.column("dim").to_numpy(zero_copy_only=False)
    if not len(dims):
        return
    cuts = np.flatnonzero(np.diff(dims)) + 1
    for a, b in zip(np.append(0, cuts), np.append(cuts, len(dims))):
        flat = batch.column("vec").slice(a, b - a).flatten().to_numpy(zero_copy_only=False)
        yield int(dims[a]), flat.reshape(b - a, int(dims[a]))


def quantise(rows: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Cell of each component: the last one that does not start above it."""
    out = np.empty(rows.shape, np.uint8)
    for d in range(rows.shape[1]):
        out[:, d] = np.searchsorted(low[d], rows[:, d], "right") - 1
    return out


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the inner product of each query with vectors between ``low`` and ``high`` (n, dim)."""
    plus, minus = np.maximum(queries, 0.0), np.minimum(queries, 0.0)
    least = plus @ low.T + minus @ high.T
    most = plus @ high.T + minus @ low.T
    slack = 1e-12 * (np.abs(queries) @ np.maximum(np.abs(low), np.abs(high)).T)
    return least - slack, most + slack


def _bounded(ids: np.ndarray, queries: np.ndarray, own: np.ndarray, codes: np.ndarray, low: np.ndarray,
             high: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first vector, least, most) of CHUNK vectors at a time; -inf for a query's own row."""
    dims = np.arange(codes.shape[1])
    for at in range(0, len(codes), CHUNK):
        code = codes[at:at + CHUNK]
        least, most = bounds(queries, low[dims, code].astype(float), high[dims, code].astype(float))
        self_ = own[:, None] == ids[None, at:at + CHUNK]
        least[self_] = most[self_] = -np.inf
        yield at, least, most


def greatest(best: np.ndarray, more: np.ndarray) -> np.ndarray:
    """The greatest numbers of each row of both, as many as ``best`` has."""
    both = np.concatenate([best, more], axis=1)
    return -np.partition(-both, best.shape[1] - 1, axis=1)[:, :best.shape[1]]


def lower_bounds(ids: np.ndarray, queries: np.ndarray, own: np.ndarray, codes: np.ndarray, low: np.ndarray, high: np.ndarray,
                 k: int) -> np.ndarray:
    """The k greatest lower bounds of each query in a block."""
    best = np.full((len(queries), k), -np.inf)
    for _, least, _ in _bounded(ids, queries, own, codes, low, high):
        best = greatest(best, least)
    return best


def reaching(ids: np.ndarray, queries: np.ndarray, own: np.ndarray, codes: np.ndarray, low: np.ndarray, high: np.ndarray,
             kth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, upper bound) of the vectors whose upper bound reaches the query's ``kth``."""
    found = []
    for at, _, most in _bounded(ids, queries, own, codes, low, high):
        q, v = np.nonzero((most >= kth[:, None]) & (most > -np.inf))
        found.append((q, v + at, most[q, v]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _blocks(rows: DataFrame, size: int, cells: dict | None) -> DataFrame:
    """Rows packed in blocks: (block, dim, ids, vkeys, body); body: codes (a byte each) or 64-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

        def pack(dim: int) -> pa.RecordBatch:
            ids, keys, body = (np.concatenate(x) for x in zip(*held.pop(dim)))
            made = []
            for a in range(0, len(ids), size):
                made.append((dim, ids[a:a + size].tobytes(), keys[a:a + size].tobytes(), body[a:a + size].tobytes()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*made), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names=["dim", "ids", "vkeys", "body"])

        for batch in batches:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            keys = batch.column("vkey").to_numpy(zero_copy_only=False)
            at = 0
            for dim, vec in by_dim(batch):
                body = vec if cells is None else quantise(vec, cells[dim][0])
                held.setdefault(dim, []).append((ids[at:at + len(vec)], keys[at:at + len(vec)], body))
                at += len(vec)
                if sum(len(x[0]) for x in held[dim]) >= size:
                    yield pack(dim)
        for dim in list(held):
            yield pack(dim)

    return (rows.filter("dim > 0").select("vec_id", "vkey", "dim", "vec")
            .mapInArrow(run, "dim int, ids binary, vkeys binary, body binary"))


def top_k(table: DataFrame, k: int = K, query_every: int = QUERY_EVERY, cells: int = CELLS, sample: int = SAMPLE,
          block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of every row whose vec_id is divisible by ``query_every``."""
    exact = written(integers(table), "vectors")
    first = Window.partitionBy("vec").orderBy("vec_id")
    rows = written(exact.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= k + 1).drop("nth"), "different")
    asked = written(exact.filter(F.pmod("vec_id", F.lit(query_every)) == 0), "queries")
    cut = cut_cells(rows, cells, sample)
    parts = max(1, -(-rows.count() // block))
    approximations = written(_blocks(rows.repartition(parts, "vec_id", "vkey"), block, cut), "approximations")
    groups = max(1, -(-asked.count() // queries))
    asking = (_blocks(asked.repartition(groups, "vec_id", "vkey"), queries, None)
              .withColumn("group", F.pmod(F.xxhash64("ids"), F.lit(groups))))
    candidates = written(_candidates(approximations, asking, groups, cut, k), "candidates")
    best = _read_exact(candidates, exact, asked, k)
    return best.select(F.col("query_id").cast("long").alias("query_id"), "rank", "vec_id", "score")


def _candidates(approximations: DataFrame, asking: DataFrame, groups: int, cut: dict, k: int) -> DataFrame:
    """Every block of vectors meets every block of queries of its length, twice; what can't be ruled out remains."""
    def arrays(row: tuple) -> tuple:
        dim, ids, codes, own, body = row
        return (np.frombuffer(ids, np.int64), np.frombuffer(codes, np.uint8).reshape(-1, dim), np.frombuffer(own, np.int64),
                np.frombuffer(body, np.int64).reshape(-1, dim).astype(float), *cut[dim])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own_no, *row in zip(*(c.to_pylist() for c in batch.columns)):
                ids, codes, own, vectors, low, high = arrays(row)
                best = [lower_bounds(ids, vectors[a:a + TOGETHER], own[a:a + TOGETHER], codes, low, high, k) for a in range(0, len(own), TOGETHER)]
                yield pa.RecordBatch.from_arrays([pa.array([own_no], pa.int64()), pa.array([np.concatenate(best).tobytes()], pa.binary())],
                                                 names=["own_no", "best"])

    def kth_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = None, None                          # rows of a block of queries follow one another

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([held.min(axis=1).tobytes()], pa.binary())],
                                              names=["own_no", "kth"])

        for batch in batches:
            for own_no, best in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(best).reshape(-1, k)
                if own_no == number:
                    held = greatest(held, own)
                    continue
                if held is not None:
                    yield row()
                held, number = own, own_no
        if held is not None:
            yield row()

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, own_keys, kth, *row in zip(*(c.to_pylist() for c in batch.columns)):
                ids, codes, own, vectors, low, high = arrays(row)
                keys, own_keys, kth = np.frombuffer(keys, np.int64), np.frombuffer(own_keys, np.int64), np.frombuffer(kth)
                for a in range(0, len(own), TOGETHER):     # so many queries' bounds at a time
                    q, v, most = reaching(ids, vectors[a:a + TOGETHER], own[a:a + TOGETHER], codes, low, high, kth[a:a + TOGETHER])
                    q += a
                    yield pa.RecordBatch.from_arrays([pa.array(own[q]), pa.array(own_keys[q]), pa.array(ids[v]), pa.array(keys[v]), pa.array(most)],
                                                     names=["query_id", "query_key", "vec_id", "vkey", "most"])

    asking = written(asking.withColumn("own_no", F.monotonically_increasing_id()), "query-blocks")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
    left = approximations.select("dim", "ids", "vkeys", "body", every.alias("group"))
    right = asking.select("dim", "group", "own_no", F.col("ids").alias("own"), F.col("vkeys").alias("own_keys"), F.col("body").alias("vectors"))
    met = left.join(right, ["dim", "group"]).repartition(F.xxhash64("ids", "own_no"))
    best = met.select("own_no", "dim", "ids", "body", "own", "vectors").mapInArrow(first, "own_no long, best binary")
    kth = written(best.repartition("own_no").sortWithinPartitions("own_no").mapInArrow(kth_of, "own_no long, kth binary"), "kth")
    met = left.join(right.join(kth, "own_no"), ["dim", "group"]).repartition(F.xxhash64("ids", "own_no"))
    found = (met.select("vkeys", "own_keys", "kth", "dim", "ids", "body", "own", "vectors")
             .mapInArrow(second, "query_id long, query_key long, vec_id long, vkey long, most double"))
    by_most = Window.partitionBy("query_id", "query_key").orderBy(F.desc("most"), "vec_id")
    return found.withColumn("place", F.row_number().over(by_most))


def _read_exact(candidates: DataFrame, exact: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Exact scores in the order of the bounds, until no unread bound reaches a query's k-th score."""
    asked = asked.select(F.col("vec_id").alias("query_id"), F.col("vkey").alias("query_key"), F.col("vec").alias("query"))
    score = F.aggregate(F.zip_with("query", "vec", lambda a, b: a * b), F.lit(0).cast("long"), lambda a, b: a + b)
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    done, best, start, size = [], None, 0, FIRST_READ * k
    open_ = candidates
    while True:
        some = open_.filter((F.col("place") > start) & (F.col("place") <= start + size))
        scored = (some.join(exact.select("vec_id", "vkey", "vec"), ["vec_id", "vkey"]).join(asked, ["query_id", "query_key"])
                  .select("query_id", "query_key", "vec_id", score.alias("score")))
        seen = scored if best is None else best.select("query_id", "query_key", "vec_id", "score").unionByName(scored)
        best = written(seen.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), "best")
        start += size
        size *= 4
        unread = (open_.filter(F.col("place") > start).groupBy("query_id", "query_key").agg(F.max("most").alias("next")))
        kth = best.groupBy("query_id", "query_key").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n"))
        again = written(unread.join(kth, ["query_id", "query_key"]).filter((F.col("next") >= F.col("kth")) | (F.col("n") < k))
                        .select("query_id", "query_key"), "open")
        if again.isEmpty():
            return reduce(DataFrame.unionByName, [*done, best])
        done.append(best.join(again, ["query_id", "query_key"], "left_anti"))
        best = best.join(again, ["query_id", "query_key"], "left_semi")
        open_ = open_.join(again, ["query_id", "query_key"], "left_semi")
