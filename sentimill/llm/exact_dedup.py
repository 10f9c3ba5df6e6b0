"""Exact deduplication over an extendible-hash index on shared files (DataFrame functions only).

Texts are hashed to 64-bit keys.  A directory maps the leading bits of a key to
a bucket; it doubles while a bucket holds too many keys, and only overfull
buckets split.  Texts whose key is shared are sent to their bucket: first each task's equal texts are made one row
(in ``SHARES`` shares, so that a text with any share of the rows is spread), then the directory routes these to the
bucket's owner task, which compares bytes (it groups by key *and* text), and chains the different texts of
one key in the order of their bytes.  The index is written to shared files bucket by bucket, and everything
that is returned is read from it: a document finds its entry by key and, in the key's chain, by its text's digest.

Nulls count as empty texts.  Repeated rows (same doc_id and text) are reported
row by row, and one of them stays.  A group whose doc_ids are all null has a
null keep_id, and one of its rows stays.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import HOT_SHARE, documents, join_spread, seen_in, without_rows, written

BUCKET_KEYS = 4_096      # keys a bucket may hold before it splits ...
SHARES = 8               # of a text's rows before they meet in their bucket
BUCKETS_A_TASK = 4       # that one owner task has, about
MOST_BUCKETS = 10_000    # ... or, beyond this many buckets, so many that the directory stays this small


class Directory(NamedTuple):
    bits: int           # leading bits of a key that name a cell
    rows: DataFrame     # cell, bucket, depth (the bucket's local depth)
    buckets: int


def directory(entries: DataFrame, bucket_keys: int = BUCKET_KEYS) -> Directory:
    """The directory over the leading bits of ``entries.key``.

    One aggregation counts the entries per cell (8 * MOST_BUCKETS cells at
    most); then the directory doubles, from one bucket on, until none is
    overfull or the cells can't be told apart any more.
    """
    total = entries.count()
    room = max(bucket_keys, -(-total // MOST_BUCKETS))
    bits = max(1, (4 * total // room).bit_length())
    cells = entries.groupBy(F.shiftrightunsigned("key", 64 - bits).alias("cell")).count()
    counts = {cell: n for cell, n in cells.toLocalIterator()}
    buckets, depth = {(0, 0): total}, 0      # (local depth, prefix): entries
    while depth < bits and any(n > room for (d, _), n in buckets.items() if d == depth):
        depth += 1                           # the directory doubles
        halves: dict[int, int] = {}
        for cell, n in counts.items():
            half = cell >> (bits - depth)
            halves[half] = halves.get(half, 0) + n
        for (d, prefix), n in list(buckets.items()):
            if n > room:                     # an overfull bucket splits in two
                del buckets[d, prefix]
                for half in (2 * prefix, 2 * prefix + 1):
                    buckets[depth, half] = halves.get(half, 0)
    rows = [(cell, no, d) for no, (d, prefix) in enumerate(sorted(buckets, key=lambda b: b[1] << (bits - b[0])))
            for cell in range(prefix << (bits - d), (prefix + 1) << (bits - d))]
    return Directory(bits, entries.sparkSession.createDataFrame(rows, "cell long, bucket int, depth int"),
                     len(buckets))


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def build_index(rows: DataFrame, own: DataFrame, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """The index on shared files: bucket, depth, key, link, sha, keep_id, group_size.

    ``rows``: doc_id, text, key; ``own``: what ``digests`` makes of them.  One entry
    for each different text; ``link`` numbers the entries chained under one key.
    A key that one row has needs no comparison (and has no digest here); only
    rows that may share their key are shuffled with their texts.
    """
    keys = written(own.groupBy("key").agg(F.sum("times").alias("rows"), F.max("doc_id").alias("keep_id")), "keys")
    table = directory(keys, bucket_keys)
    owners = max(1, table.buckets // BUCKETS_A_TASK)
    routes = F.broadcast(table.rows)                       # 8 * MOST_BUCKETS rows at most

    def routed(entries: DataFrame) -> DataFrame:
        cell = F.shiftrightunsigned("key", 64 - table.bits)
        return entries.withColumn("cell", cell).join(routes, "cell").drop("cell")

    shared = keys.filter("rows > 1").select("key")
    share = F.pmod(F.xxhash64("doc_id"), F.lit(SHARES))
    some = (seen_in(rows, F.col("key"), shared).filter("__sm_seen")
            .groupBy("key", "text", share.alias("share"))  # a partial step in every task
            .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    texts = (routed(some).repartition(owners, "bucket")
             .groupBy("bucket", "depth", "key", "text")    # the owner compares the bytes
             .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")))
    chain = Window.partitionBy("bucket", "key").orderBy("text")
    chained = (texts.withColumn("link", F.row_number().over(chain))
               .select("bucket", "depth", "key", "link", F.sha2("text", 256).alias("sha"), "keep_id", "group_size"))
    alone = routed(keys.filter("rows = 1")).select(
        "bucket", "depth", "key", F.lit(1).alias("link"), F.lit(None).cast("string").alias("sha"), "keep_id",
        F.col("rows").alias("group_size")).repartition(owners, "bucket")
    # (a bitmap may have seen texts whose key one row has: these are in ``alone``)
    return written(chained.join(shared, "key", "left_semi").select(*alone.columns).unionByName(alone), "index")


def digests(rows: DataFrame) -> DataFrame:
    """(doc_id, key, sha, times): repeated rows collapse to a count, so not even they can pile up."""
    return (rows.groupBy("doc_id", "key", F.sha2("text", 256).alias("sha"))
            .agg(F.count(F.lit(1)).alias("times")))


def exact_dedup(docs: DataFrame, key: Callable[[Column], Column] = text_key,
                bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """One row per document row: doc_id, keep_id, group_size, kept, text_sha256.

    ``key`` maps a text to a long.  A document finds its entry by key and, in
    the key's chain, by the digest of its text.
    """
    rows = documents(docs).withColumn("key", key(F.col("text")))
    own = written(digests(rows), "own")
    index = build_index(rows, own, bucket_keys)
    copies = index.filter("group_size > 1").select("key", "sha", "keep_id", "group_size")
    total = index.agg(F.sum("group_size")).first()[0] or 0
    hot = copies.filter(F.col("group_size") * HOT_SHARE > total).select("key", "sha")
    found = join_spread(own, copies, ["key", "sha"], hot)
    alone = F.col("group_size").isNull()
    return (found.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                         F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                         F.col("sha").alias("text_sha256"),
                         F.explode(F.sequence(F.lit(1), F.col("times"))).alias("nth"))
            .select("doc_id", "keep_id", "group_size",
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
                    "text_sha256"))


def keep_first_copies(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` drops, all columns as they are."""
    found = written(exact_dedup(docs, **options).select("doc_id", "keep_id", "kept", "text_sha256"), "found")
    row = F.xxhash64("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256))
    own = F.xxhash64("doc_id", "text_sha256")
    # a document goes if it isn't the one that stays; of one that is repeated as a whole, one row stays
    dropped = found.filter(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(own.alias("key")).distinct()
    repeated = found.filter(F.col("doc_id").eqNullSafe(F.col("keep_id")) & ~F.col("kept")).select(own.alias("key")).distinct()
    out = without_rows(docs, row, dropped)
    if repeated.isEmpty():
        return out
    single = seen_in(out, row, repeated).withColumn("__sm_key", row)
    again = single.filter("__sm_seen").dropDuplicates(["__sm_key"])
    return single.filter("not __sm_seen").unionByName(again).drop("__sm_seen", "__sm_key")
