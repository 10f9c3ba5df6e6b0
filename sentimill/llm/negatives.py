"""Hard-negative mining over an inverted multi-index.

Vectors become integers (floor(256 x) per component) and are cut in two halves.  Each half has a
codebook, fitted on a bounded sample; the nearest codeword of either half names a vector's cell, and the
index lists every vector under its cell, in blocks.  A codeword's radius is the exact greatest distance of its
members, so for an anchor with halves p and q no vector of cell (a, b) scores above

    p·a + |p| radius(a)  +  q·b + |q| radius(b).

A multi-sequence heap visits the cells of an anchor in the order of these sums: the two lists of half-score bounds are
sorted, and a pair is pushed once both pairs before it are out.  The vectors of visited cells are scored
exactly, in matrix products of blocks with packs of anchors, until the next cell's bound is certain:

* positives: under the score of the last of the anchor's ``positives`` best rows of its label
* negatives: for every window low..high that a positive opens, under low, or under the last of the ``negatives``
  best rows of other labels in the window; cells that lie above all windows are passed over

Rounds visit 8, 32, 128 ... cells of the anchors still open; nothing is dropped, as an anchor ends only by a certificate
or when no cell is left.

Of rows with equal vectors and labels only those with the smallest ids can be returned (one more than the longer of the two
lists, as the anchor itself may be among them), so a vector that many rows share is indexed so many times.  A cell with any
share of the rows is many blocks, dealt out one by one.  What the driver holds is the sample, the codebooks and the
number of rows of each cell (``MOST_CODES`` squared at most, for each length of vectors).

Rows with a null vec_id, label or vector, an empty vector, or a null or non-finite component take no part; vectors of
different lengths don't meet; a row never meets rows of its own vec_id.  Repeated rows count once.  An anchor without
positives, and a window without rows, give no row.  An empty table gives none.  Scores are exact as long as they fit a long.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, written

SCALE = 256
ANCHOR_EVERY = 50
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95       # per cent of the positive's score
SAMPLE = 4_096           # vectors that the codebooks are fitted on
CELL_ROWS = 512          # rows of a cell on average ...
LEAST_CODES, MOST_CODES = 4, 256     # ... within these numbers of codewords a half
STEPS = 8                # of the fit
BLOCK = 1024             # vectors in a row of the index
PACK = 1024              # anchors that are scored together
FIRST_CELLS = 8          # visited in the first round; four times as many in each next one
HELD = 1 << 19           # candidates that a task holds before it cuts them to the best
SLACK = 1e-9             # relative rounding of the bounds
NO_WINDOW = 1 << 62      # the low end of a window that holds nothing


class Codebook(NamedTuple):
    """Both halves of the vectors of one length."""
    codes: tuple[np.ndarray, np.ndarray]       # codewords
    radii: tuple[np.ndarray, np.ndarray]       # of each codeword; 0 where not yet known
    cells: np.ndarray                          # rows of each cell (first, second codeword)


def integers(table: DataFrame) -> DataFrame:
    """(vec_id, label, vec, dim) of the rows that take part, repeated rows once."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    vec = F.transform("embedding", lambda x: F.floor(SCALE * x.cast("double")).cast("long"))
    return (table.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & fine)
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), vec.alias("vec"))
            .distinct().withColumn("dim", F.size("vec")))


def halves(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = rows.shape[1] // 2
    return rows[:, :cut], rows[:, cut:]


def nearest(rows: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Index of the nearest codeword of each row."""
    return np.argmin((codes * codes).sum(axis=1)[None, :] - 2.0 * (rows @ codes.T), axis=1)


def fit(rows: np.ndarray, codes: int, steps: int = STEPS) -> np.ndarray:
    """``codes`` codewords at most: means of the rows nearest to them, from the first different rows on."""
    if not rows.shape[1]:
        return np.zeros((1, 0))
    _, first = np.unique(rows, axis=0, return_index=True)
    out = rows[np.sort(first)[:codes]].astype(float)
    for _ in range(steps):
        own = nearest(rows, out)
        sizes = np.bincount(own, minlength=len(out))
        sums = np.zeros_like(out)
        np.add.at(sums, own, rows)
        out = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], out)
    return out


def codebooks(rows: DataFrame, sample: int = SAMPLE, cell_rows: int = CELL_ROWS) -> dict[int, Codebook]:
    """By length of the vectors; without radii."""
    sizes = {r[0]: r[1] for r in rows.groupBy("dim").count().collect()}
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "label").limit(sample).select("dim", "vec").collect()
    out = {}
    for dim, n in sizes.items():
        some = np.array([r["vec"] for r in drawn if r["dim"] == dim] or [[0] * dim], float)     # a length that the sample missed
        wanted = min(MOST_CODES, max(LEAST_CODES, round((n / cell_rows) ** 0.5)))
        codes = tuple(fit(half, wanted) for half in halves(some))
        shape = tuple(map(len, codes))
        out[dim] = Codebook(codes, (np.zeros(shape[0]), np.zeros(shape[1])), np.zeros(shape, np.int64))
    return out


def vectors(batch: pa.RecordBatch, column: str = "vec") -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, rows of the batch, their vectors) for each length in the batch."""
    dims = batch.column("dim").to_numpy(zero_copy_only=False)
    for dim in np.unique(dims):
        rows = np.flatnonzero(dims == dim)
        flat = batch.column(column).take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        yield int(dim), rows, flat.reshape(len(rows), int(dim))


CELLED = "vec_id long, label long, dim int, cell int, far_a double, far_b double, body binary"


def assign(rows: DataFrame, books: dict[int, Codebook], kind: str) -> DataFrame:
    """Cell of every row, its distances from both codewords, and its vector as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, vec in vectors(batch):
                far, own = [], []
                for half, codes in zip(halves(vec.astype(float)), books[dim].codes):
                    own.append(nearest(half, codes))
                    far.append(np.sqrt(((half - codes[own[-1]]) ** 2).sum(axis=1)) * (1 + SLACK))
                cell = own[0] * len(books[dim].codes[1]) + own[1]
                body = [v.tobytes() for v in vec.astype(kind)]
                take = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(take), batch.column("label").take(take), pa.array(np.full(len(at), dim, np.int32)),
                     pa.array(cell.astype(np.int32)), pa.array(far[0]), pa.array(far[1]), pa.array(body, pa.binary())],
                    names=[c.split()[0] for c in CELLED.split(", ")])

    return rows.select("vec_id", "label", "dim", "vec").mapInArrow(run, CELLED)


def with_radii(celled: DataFrame, books: dict[int, Codebook]) -> dict[int, Codebook]:
    """The codebooks with radii and rows of each cell, over all rows."""
    for r in (celled.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("far_a").alias("far_a"), F.max("far_b").alias("far_b"))
              .toLocalIterator()):
        book = books[r["dim"]]
        a, b = divmod(r["cell"], len(book.codes[1]))
        book.cells[a, b] = r["n"]
        book.radii[0][a] = max(book.radii[0][a], r["far_a"])
        book.radii[1][b] = max(book.radii[1][b], r["far_b"])
    return books


def packed(rows: DataFrame, keys: tuple[str, ...], columns: dict[str, str], most: int) -> DataFrame:
    """Rows sorted by ``keys`` as one row per ``most`` of them with equal keys; ``columns`` (longs, or binaries that are
    strung together) become binaries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in columns]
        key = None

        def made() -> pa.RecordBatch:
            body = [b"".join(x) if kind == "binary" else np.array(x, np.int64).tobytes() for x, kind in zip(held, columns.values())]
            for x in held:
                x.clear()
            return pa.RecordBatch.from_arrays([*(pa.array([k], pa.int32()) for k in key), *(pa.array([x], pa.binary()) for x in body)],
                                              names=[*keys, *columns])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held[0] and (row[:len(keys)] != key or len(held[0]) == most):
                    yield made()
                key = row[:len(keys)]
                for x, value in zip(held, row[len(keys):]):
                    x.append(value)
        if held[0]:
            yield made()

    schema = ", ".join([*(f"{k} int" for k in keys), *(f"{c} binary" for c in columns)])
    return rows.select(*(F.col(k).cast("int").alias(k) for k in keys), *columns).mapInArrow(run, schema)


def build_index(celled: DataFrame, books: dict[int, Codebook], block: int = BLOCK) -> DataFrame:
    """Blocks of the cells: dim, cell, share, ids, labels, body; each in ascending order of ids."""
    spark = celled.sparkSession
    shares = [(dim, c, -(-int(n) // block)) for dim, book in books.items() for c, n in enumerate(book.cells.ravel()) if n]
    known = F.broadcast(spark.createDataFrame(shares, "dim int, cell int, shares int"))
    tasks = max(1, sum(s for _, _, s in shares) // 8)
    rows = (celled.join(known, ["dim", "cell"]).withColumn("share", F.pmod(F.xxhash64("vec_id"), "shares").cast("int"))
            .repartition(tasks, "dim", "cell", "share").sortWithinPartitions("dim", "cell", "share", "vec_id"))
    return packed(rows.select("dim", "cell", "share", F.col("vec_id").alias("ids"), F.col("label").alias("labels"), "body"),
                  ("dim", "cell", "share"), {"ids": "long", "labels": "long", "body": "binary"}, 2 * block)


# ---- visiting cells ------------------------------------------------------------

def multi_sequence(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """Pairs (sum, i, j) of two lists in descending order of first[i] + second[j]."""
    order = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    one, two = first[order[0]].tolist(), second[order[1]].tolist()
    places = order[0].tolist(), order[1].tolist()
    heap, out = [(-(one[0] + two[0]), 0, 0)], set()
    while heap:
        total, i, j = heapq.heappop(heap)
        yield -total, places[0][i], places[1][j]
        out.add((i, j))
        if i + 1 < len(one) and (j == 0 or (i + 1, j - 1) in out):
            heapq.heappush(heap, (-(one[i + 1] + two[j]), i + 1, j))
        if j + 1 < len(two) and (i == 0 or (i - 1, j + 1) in out):
            heapq.heappush(heap, (-(one[i] + two[j + 1]), i, j + 1))


def cells_of(query: np.ndarray, book: Codebook, start: int, size: int, above: float) -> tuple[list[int], float]:
    """Filled cells start .. start + size of the anchor's order, without those that lie above ``above`` as a whole;
    and the bound of the next one (-inf: there is none)."""
    upper, lower = [], []
    for half, codes, radii in zip(halves(query[None, :]), book.codes, book.radii):
        middle = (codes @ half[0]) if half.shape[1] else np.zeros(len(codes))
        reach = np.sqrt((half * half).sum()) * radii
        slack = SLACK * (np.abs(codes) @ np.abs(half[0]) + reach)
        upper.append(middle + reach + slack)
        lower.append(middle - reach - slack)
    out, met = [], 0
    for bound, a, b in multi_sequence(*upper):
        if not book.cells[a, b]:
            continue
        if met >= start + size:
            return out, bound
        if met >= start and lower[0][a] + lower[1][b] <= above:
            out.append(a * len(book.codes[1]) + b)
        met += 1
    return out, -np.inf


VISITS = "anchor_id long, label long, akey long, dim int, cell int, next double, body binary, low binary, high binary"


def visits(asks: DataFrame, books: dict[int, Codebook], kind: str, start: int, size: int) -> DataFrame:
    """A row for each anchor and cell of its next round, and one with cell -1 for the bound of what is then left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for anchor, label, akey, dim, body, low, high in zip(*(c.to_pylist() for c in batch.columns)):
                above = max(high) if high else np.inf
                cells, bound = cells_of(np.frombuffer(body, kind).astype(float), books[dim], start, size, above)
                low, high = np.array(low, np.int64).tobytes(), np.array(high, np.int64).tobytes()
                made.append((anchor, label, akey, dim, -1, bound, None, None, None))
                made += [(anchor, label, akey, dim, cell, None, body, low, high) for cell in cells]
                if len(made) >= 1 << 14:
                    yield rows(made)
                    made = []
            yield rows(made)

    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.binary(), pa.binary(), pa.binary())

    def rows(made: list[tuple]) -> pa.RecordBatch:
        columns = zip(*made) if made else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          names=[c.split()[0] for c in VISITS.split(", ")])

    return asks.select("anchor_id", "label", "akey", "dim", "body", "low", "high").mapInArrow(run, VISITS)


# ---- scoring -------------------------------------------------------------------

def cut(anchor: np.ndarray, akey: np.ndarray, slot: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best of each anchor and slot: higher scores first, ties by smaller ids."""
    order = np.lexsort((ids, -score, slot, akey, anchor))
    columns = [x[order] for x in (anchor, akey, slot, ids, score)]
    new = np.ones(len(order), bool)
    new[1:] = reduce(np.logical_or, [x[1:] != x[:-1] for x in columns[:3]])
    first = np.flatnonzero(new)
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return tuple(x[rank < k] for x in columns)


def best_of(score: np.ndarray, fits: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of what can be among the k best of each row: ties of the last are all kept."""
    if score.shape[1] > k:
        least = np.iinfo(score.dtype).min if score.dtype.kind == "i" else -np.inf
        masked = np.where(fits, score, least)
        kth = np.partition(masked, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
        fits = fits & (masked >= kth[:, None])
    return np.nonzero(fits)


FOUND = "anchor_id long, akey long, slot int, vec_id long, score long"


def scores(met: DataFrame, kind: str, k: int, exact: bool) -> DataFrame:
    """``FOUND``: the best of the blocks met in a task, for each anchor and slot.

    Without windows there is one slot, for the rows of the anchor's label; with windows one for each,
    for rows of other labels.  ``exact``: products are exact in doubles.
    """
    def pair(ids, labels, body, anchors, own_labels, keys, queries, low, high, dim) -> tuple[np.ndarray, ...]:
        ids, labels, anchors, own_labels, keys, low, high = (np.frombuffer(x, np.int64) for x in (ids, labels, anchors, own_labels, keys, low, high))
        work = float if exact else np.int64
        rows = np.frombuffer(body, kind).reshape(len(ids), dim).astype(work)
        asked = np.frombuffer(queries, kind).reshape(len(anchors), dim).astype(work)
        score = asked @ rows.T
        same = own_labels[:, None] == labels[None, :]
        other = anchors[:, None] != ids[None, :]
        windows = len(low) // len(anchors)
        found = []
        for slot in range(max(windows, 1)):
            if windows:
                lows, highs = (x.reshape(len(anchors), windows)[:, slot, None] for x in (low, high))
                fits = ~same & other & (score >= lows) & (score <= highs)
            else:
                fits = same & other
            q, v = best_of(score, fits, ids, k)
            found.append((anchors[q], keys[q], np.full(len(q), slot, np.int32), ids[v], score[q, v].astype(np.int64)))
        return tuple(np.concatenate(x) for x in zip(*found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def best() -> tuple[np.ndarray, ...]:
            return cut(*(np.concatenate(x) for x in zip(*held)), k)

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], names=[c.split()[0] for c in FOUND.split(", ")])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                own = cut(*pair(*row), k)
                held.append(own)
                size += len(own[0])
                if size > HELD:
                    held = [best()]
                    size = len(held[0][0])
                    if 2 * size > HELD:                    # so many anchors: what is held goes out
                        yield rows()
                        held, size = [], 0
        if held:
            held = [best()]
            yield rows()

    return met.select("ids", "labels", "body", "anchors", "own_labels", "keys", "queries", "low", "high", "dim").mapInArrow(run, FOUND)


class Index(NamedTuple):
    blocks: DataFrame
    books: dict[int, Codebook]
    kind: str                # of the stored components
    exact: bool              # products are exact in doubles


def search(asks: DataFrame, index: Index, k: int, first_cells: int = FIRST_CELLS, pack: int = PACK) -> DataFrame:
    """(anchor_id, akey, slot, vec_id, score, rank): the k best of each slot of ``asks``, by certificate.

    ``asks``: anchor_id, label, akey, dim, body, low, high (arrays: a window a slot; both empty: rows of the anchor's label).
    """
    spark = asks.sparkSession
    shares = index.blocks.select("dim", "cell", "share")
    packs = max(1, -(-asks.count() // pack))
    slot_order = Window.partitionBy("anchor_id", "akey", "slot").orderBy(F.desc("score"), "vec_id")
    one = ["anchor_id", "akey"]
    done: list[DataFrame] = []
    best = spark.createDataFrame([], FOUND)
    start, size = 0, first_cells
    while True:
        seen = written(visits(asks, index.books, index.kind, start, size), "visits")
        named = seen.filter("cell >= 0").withColumn("pack", F.pmod(F.xxhash64("anchor_id"), F.lit(packs)).cast("int"))
        ordered = named.repartition(2 * packs, "dim", "cell", "pack").sortWithinPartitions("dim", "cell", "pack", "anchor_id")
        sent = packed(ordered.select("dim", "cell", "pack", F.col("anchor_id").alias("anchors"), F.col("label").alias("own_labels"),
                                     F.col("akey").alias("keys"), F.col("body").alias("queries"), "low", "high"),
                      ("dim", "cell", "pack"), {"anchors": "long", "own_labels": "long", "keys": "long", "queries": "binary",
                                                "low": "binary", "high": "binary"}, 2 * pack)
        met = sent.join(shares, ["dim", "cell"]).join(index.blocks, ["dim", "cell", "share"])
        found = best.unionByName(scores(met, index.kind, k, index.exact))
        best = written(found.withColumn("rank", F.row_number().over(slot_order)).filter(F.col("rank") <= k), "best")
        kth = best.groupBy(*one, "slot").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n"))
        bound = seen.filter("cell = -1").select(*one, "next")
        slots = asks.select(*one, F.posexplode_outer("low").alias("slot", "least")).select(*one, F.coalesce("slot", F.lit(0)).alias("slot"), "least")
        unsure = ((F.col("next") > F.lit(float("-inf"))) & (F.col("least").isNull() | (F.col("next") >= F.col("least")))
                  & ((F.coalesce("n", F.lit(0)) < k) | (F.col("next") >= F.col("kth"))))
        again = written(slots.join(bound, one).join(kth, [*one, "slot"], "left").filter(unsure).select(*one).distinct(), "open")
        forget(seen)
        if again.isEmpty():
            return reduce(DataFrame.unionByName, [*done, best])
        done.append(best.join(again, one, "left_anti"))
        best = best.join(again, one, "left_semi").drop("rank")
        asks = asks.join(again, one, "left_semi")
        start, size = start + size, size * 4


def hard_negatives(table: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, anchor_every: int = ANCHOR_EVERY,
                   low: int = LOW, high: int = HIGH, sample: int = SAMPLE, cell_rows: int = CELL_ROWS, block: int = BLOCK,
                   first_cells: int = FIRST_CELLS, pack: int = PACK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``table`` (vec_id, embedding, label).

    Anchors are the rows whose vec_id is divisible by ``anchor_every``; a window reaches from ``low`` to ``high``
    per cent of the positive's score.
    """
    exact = written(integers(table), "vectors")
    most = exact.select(F.max(F.aggregate("vec", F.lit(0).cast("long"), lambda a, x: F.greatest(a, F.abs(x)))).alias("most"),
                        F.max("dim").alias("dim")).first()
    kind = next(k for k, bits in (("int16", 15), ("int32", 31), ("int64", 64)) if (most["most"] or 0) < 1 << bits)
    first = Window.partitionBy("vec", "label").orderBy("vec_id")
    rows = exact.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= max(positives, negatives) + 1).drop("nth")
    rows = written(rows, "different")
    books = codebooks(rows, sample, cell_rows)
    celled = written(assign(rows, books, kind), "celled")
    books = with_radii(celled, books)
    index = Index(written(build_index(celled, books, block), "index"), books, kind,
                  (most["dim"] or 0) * (most["most"] or 0) ** 2 < 1 << 53)
    body = assign(exact.filter(F.pmod("vec_id", F.lit(anchor_every)) == 0), books, kind)
    none = F.array().cast("array<bigint>")
    anchors = written(body.select(F.col("vec_id").alias("anchor_id"), "label", F.xxhash64("label", "body").alias("akey"), "dim", "body"), "anchors")
    found = search(anchors.withColumn("low", none).withColumn("high", none), index, positives, first_cells, pack)
    # a row with score s is in the window of score p if low p <= 100 s <= high p
    least = F.expr(f"(score * {low} + 99 - pmod(score * {low} + 99, 100)) div 100")
    most_ = F.expr(f"(score * {high} - pmod(score * {high}, 100)) div 100")
    found = written(found.select("anchor_id", "akey", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"),
                                 F.col("score").alias("positive_score"), least.alias("least"), most_.alias("most")), "positives")

    def windows(column: str, absent: int):
        return F.array(*[F.coalesce(F.max(F.when((F.col("slot") == n) & (F.col("least") <= F.col("most")), F.col(column))), F.lit(absent).cast("long"))
                         for n in range(positives)])

    open_ = (found.groupBy("anchor_id", "akey").agg(windows("least", NO_WINDOW).alias("low"), windows("most", -1).alias("high"))
             .filter(F.exists("high", lambda x: x >= 0)))
    wanted = search(written(anchors.join(open_, ["anchor_id", "akey"]), "windows"), index, negatives, first_cells, pack)
    return (wanted.join(found, ["anchor_id", "akey", "slot"])
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))
