"""Mixing sources to target weights, in fixed-length blocks of words.

The words of a source, document after document in an order drawn by hash, form
one stream that is packed into blocks of equal length: ``block_words`` words, or fewer in a source that would
have under ``LEAST_BLOCKS`` blocks of its size or target, so that whole blocks can meet the target of any source.  The output has
``shards`` shards; each shard draws from a multinomial how many of its slots go to
each source, over what the sources have still to give, so that all shards together
give each source the slots of its target.  A source's slots are numbered through;
slot j takes block p(j mod n) of its n blocks, where p is a pseudorandom permutation
of the indices (one for each pass over the source), computed and never stored.
Slots and pieces of documents are then joined by block index.

No source has more slots than three times its blocks, so no document is taken
more than three times.  All draws come from ``seed``: reruns agree, whatever the
partitioning.

Nulls: a null text has no words, a null source is a source of its own (the last).
Documents without words are taken 0 times.  Rows repeated as a whole follow one
another in the stream, each with its own place.  An empty table gives none.
The driver holds one row per source.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import seen_in, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)         # of the sources in code point order, repeating
MOST_TIMES = 3              # a target stops at so many times the source's size
BLOCK_WORDS = 64
LEAST_BLOCKS = 256          # that a source's size and target make, if they have so many words
SHARDS = 64
SEED = 20240101
CHUNK_ROWS = 8_192          # rows of a source numbered in one task
RANGE_SLOTS = 1 << 18       # slots mapped to blocks in one go
TASK_SLOTS = 1 << 17        # slots made by one task, about


class Source(NamedTuple):
    source: str | None
    source_no: int
    source_size: int
    target: float
    block_words: int
    blocks: int
    slots: int


def targets(sizes: list[int], weights: list[int], most: int = MOST_TIMES) -> list[float]:
    """Shares of the sum of ``sizes`` by weight; what exceeds ``most`` times a size is shared anew."""
    out = [0.0] * len(sizes)
    open_, left = set(range(len(sizes))), sum(sizes)
    while open_:
        weight = sum(weights[i] for i in open_)
        above = [i for i in open_ if left * weights[i] > most * sizes[i] * weight]
        if not above:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in above:
            out[i] = float(most * sizes[i])
            left -= most * sizes[i]
            open_.remove(i)
    return out


def plan_sources(sizes: list[tuple[str | None, int]], block_words: int = BLOCK_WORDS) -> list[Source]:
    ordered = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(ordered))]
    out = []
    for no, ((name, size), target) in enumerate(zip(ordered, targets([n for _, n in ordered], weights))):
        own = max(1, min(block_words, int(min(size, target)) // LEAST_BLOCKS))
        blocks = -(-size // own)
        out.append(Source(name, no, size, target, own, blocks, round(target * blocks / size) if size else 0))
    return out


def draw_shards(slots: list[int], shards: int = SHARDS, seed: int = SEED) -> np.ndarray:
    """(shard, source): slots of each source in each shard; columns add up to ``slots``."""
    rng, left = np.random.default_rng(seed), np.array(slots, np.int64)
    out = np.zeros((shards, len(slots)), np.int64)
    for shard in range(shards):
        room = int(left.sum()) // (shards - shard)
        while room:
            drawn = np.minimum(rng.multinomial(room, left / left.sum()), left)
            out[shard] += drawn
            left -= drawn
            room -= int(drawn.sum())
    return out


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Image of each index under a pseudorandom permutation of range(n): a Feistel network on
    the next power of 4, walked until the image is in range."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & low
        for turn in range(6):
            x = right + np.uint64((key * 6 + turn) * 0x9E3779B97F4A7C15 % (1 << 64))
            x ^= x >> np.uint64(30)                            # a 64-bit finaliser as round function
            x *= np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(27)
            x *= np.uint64(0x94D049BB133111EB)
            x ^= x >> np.uint64(31)
            left, right = right, left ^ (x & low)
        out[todo] = left << np.uint64(half) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


class Mix(NamedTuple):
    rows: DataFrame      # source_no, at (first word in the source's stream), doc_id, size, text_key, copy, times
    sources: DataFrame   # Source's fields
    slots: DataFrame     # source_no, shard, slot, block
    pieces: DataFrame    # source_no, at, first, end (words of the document), taken


def _numbered(docs: DataFrame, block_words: int) -> tuple[DataFrame, list[Source], DataFrame]:
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    rows = written(docs.select("doc_id", "source", size.alias("size"), text_key().alias("text_key"))
                   .groupBy("doc_id", "source", "size", "text_key").agg(F.count(F.lit(1)).alias("times")), "sizes")
    sums = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("size")).collect()
    plan = plan_sources([(r["source"], r["size"]) for r in sums], block_words)
    spark = docs.sparkSession
    sources = spark.createDataFrame(
        plan, "source string, source_no int, source_size long, target double, block_words int, blocks long, slots long")
    chunks = max(1, -(-rows.count() // CHUNK_ROWS))
    known = F.broadcast(sources.select(F.col("source").alias("name"), "source_no", "block_words"))      # one row per source
    rows = (rows.join(known, F.col("source").eqNullSafe(F.col("name"))).drop("name")
            .withColumn("draw", F.xxhash64("doc_id", "text_key"))
            .withColumn("chunk", F.pmod("draw", F.lit(chunks))))
    words = F.col("size") * F.col("times")
    before = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy("source_no", "chunk").agg(F.sum(words).alias("words"))       # a row per source and chunk
              .select("source_no", "chunk", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start")))
    within = (Window.partitionBy("source_no", "chunk").orderBy("draw", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = (rows.withColumn("past", F.coalesce(F.sum(words).over(within), F.lit(0)))
            .join(starts, ["source_no", "chunk"])
            .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
            .select("source_no", (F.col("start") + F.col("past") + F.col("copy") * F.col("size")).alias("at"),
                    "doc_id", "size", "text_key", "copy", "times", "block_words"))
    return rows, plan, sources


def text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _slots(spark, plan: list[Source], shards: int, seed: int) -> DataFrame:
    drawn = draw_shards([s.slots for s in plan], shards, seed)
    ranges, first = [], [0] * len(plan)
    for shard, counts in enumerate(drawn.tolist()):
        for s, n in zip(plan, counts):
            for at in range(0, n, RANGE_SLOTS):
                ranges.append((s.source_no, shard, first[s.source_no] + at, min(RANGE_SLOTS, n - at), s.blocks))
            first[s.source_no] += n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for no, shard, at, n, blocks in zip(*(c.to_pylist() for c in batch.columns)):
                slot = np.arange(at, at + n)
                block = np.empty(n, np.int64)
                for turn in np.unique(slot // blocks):
                    own = slot // blocks == turn
                    block[own] = permuted(slot[own] % blocks, blocks, seed + 1000 * no + int(turn))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, no, np.int32)), pa.array(np.full(n, shard, np.int32)), pa.array(slot), pa.array(block)],
                    names=["source_no", "shard", "slot", "block"])

    made = spark.createDataFrame(ranges, "source_no int, shard int, at long, n long, blocks long")
    tasks = max(1, sum(s.slots for s in plan) // TASK_SLOTS)     # the ranges themselves are too small to tell
    return (made.repartition(tasks, "source_no", "shard", "at")
            .mapInArrow(run, "source_no int, shard int, slot long, block long"))


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED) -> Mix:
    """The mix of ``docs`` (doc_id, text, source): which words are taken how often, and by which slots."""
    rows, plan, sources = _numbered(docs, block_words)
    rows = written(rows, "rows")
    slots = _slots(docs.sparkSession, plan, shards, seed)
    taken = slots.groupBy("source_no", "block").agg(F.count(F.lit(1)).alias("taken"))
    words = F.col("block_words")
    block = F.explode(F.sequence(F.expr("at div block_words"), F.expr("(at + size - 1) div block_words")))
    pieces = (rows.filter("size > 0").select("source_no", "at", "size", "block_words", block.alias("block"))
              .join(taken, ["source_no", "block"])
              .select("source_no", "at",
                      F.greatest(F.col("block") * words - F.col("at"), F.lit(0)).alias("first"),
                      F.least((F.col("block") + 1) * words - F.col("at"), F.col("size")).alias("end"), "taken"))
    return Mix(rows, sources, slots, pieces)


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document row: doc_id, size, source_size, target, taken (words the mix takes)."""
    m = mix(docs, **options)
    words = m.pieces.groupBy("source_no", "at").agg(F.sum((F.col("end") - F.col("first")) * F.col("taken")).alias("words"))
    filled = m.rows.filter("size > 0").join(words, ["source_no", "at"], "left")
    empty = m.rows.filter("size = 0").withColumn("words", F.lit(0).cast("long"))
    return (filled.unionByName(empty).join(F.broadcast(m.sources.select("source_no", "source_size", "target")), "source_no")
            .select("doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).alias("taken")))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: a document taken k times gives k rows,
    the j-th with its words that are taken at least j times (whole if that is all of them).

    A column n_chars gets the length of the new text.
    """
    m = mix(docs.select("doc_id", "text", "source"), **options)
    parts = (m.pieces.groupBy("source_no", "at").agg(F.collect_list(F.struct("first", "end", "taken")).alias("parts"))
             .join(m.rows.filter("size > 0").select("source_no", "at", "doc_id", "size", "text_key", "copy", "times"),
                   ["source_no", "at"])
             .join(F.broadcast(m.sources.select("source_no", "source")), "source_no"))
    # of rows repeated as a whole, one brings the text for all of them
    parts = written(parts.select(_row_key("text_key").alias("__sm_key"), "size", "copy", "times", "parts"), "parts")
    keyed = docs.withColumn("__sm_key", _row_key(text_key()))
    repeated = parts.filter("times > 1").select(F.col("__sm_key").alias("key")).distinct()
    if not repeated.isEmpty():
        marked = seen_in(keyed, F.col("__sm_key"), written(repeated, "repeated"))
        keyed = (marked.filter("not __sm_seen").unionByName(marked.filter("__sm_seen").dropDuplicates(["__sm_key"]))
                 .drop("__sm_seen"))
    own = parts.select("__sm_key", F.col("size").alias("__sm_size"), F.col("parts").alias("__sm_parts"))
    joined = keyed.join(own, "__sm_key").drop("__sm_key")
    texts = _taken_texts()(F.col("text"), F.col("__sm_size"), F.col("__sm_parts"))
    out = joined.withColumn("__sm_text", F.explode(texts)).withColumn("text", F.col("__sm_text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def _row_key(key: str | Column) -> Column:
    return F.xxhash64("doc_id", "source", key)


def taken_texts(text: str, size: int, parts: list[dict]) -> list[str]:
    """Texts of the rows that a document gives: the j-th has the words taken at least j times."""
    out, spans = [], None
    for j in range(1, max(p["taken"] for p in parts) + 1):
        held = sorted((p["first"], p["end"]) for p in parts if p["taken"] >= j)
        if sum(b - a for a, b in held) == size:
            out.append(text)
            continue
        spans = spans or [m.span() for m in re.finditer(WORD, text)]
        runs: list[list[int]] = []
        for a, b in held:
            if runs and runs[-1][1] == a:
                runs[-1][1] = b
            else:
                runs.append([a, b])
        out.append(" ".join(text[spans[a][0]:spans[b - 1][1]] for a, b in runs))
    return out


def _taken_texts():
    @F.arrow_udf("array<string>")
    def run(texts: pa.Array, sizes: pa.Array, parts: pa.Array) -> pa.Array:
        rows = (taken_texts(t.as_py(), n.as_py(), p.as_py()) for t, n, p in zip(texts, sizes, parts))      # a row at a time
        return pa.array(rows, pa.list_(pa.string()))

    return run
