"""Helpers shared by the operators: written tables, hot-key joins, components, worker cache."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import folder

HOT_SHARE = 1000     # a key with more than 1/HOT_SHARE of the rows is hot: at most HOT_SHARE keys are


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def documents(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text`` (null text: empty), so other columns can't clash."""
    return docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, for ``forget`` to delete: computed once, lineage cut."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._sentimill_path = path
    return out


def forget(df: DataFrame | None) -> None:
    """Delete a written table that nothing reads any more."""
    path = getattr(df, "_sentimill_path", None)
    if path:
        spark = df.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def hot_keys(df: DataFrame, *key: str) -> DataFrame:
    """The keys that hold over 1/HOT_SHARE of the rows of ``df``: HOT_SHARE of them at most."""
    sizes = written(df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")), "sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    return sizes.filter(F.col("n") * HOT_SHARE > total).select(*key)


def join_spread(left: DataFrame, right: DataFrame, key: str | list[str], hot: DataFrame) -> DataFrame:
    """Left join on ``key`` (unique in ``right``) in which no hot key piles up in one task.

    Rows of the ``hot`` keys meet their few right rows (HOT_SHARE at most) in a
    broadcast join; the others are shuffled.  Rows with a null key find nothing.
    """
    hot = F.broadcast(hot)
    cold = left.join(hot, key, "left_anti").join(right, key, "left")
    few = right.join(hot, key, "left_semi")
    return left.join(hot, key, "left_semi").join(F.broadcast(few), key, "left").unionByName(cold)


BITMAP_BITS = 32768      # bits in one row of a bitmap, as bitmap_construct_agg makes them
MOST_BITS = 1 << 27      # bits of a whole bitmap: 16 MB


def seen_in(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """``df`` with ``__sm_seen``: false where ``key`` (a long) surely is not in ``keys.key``.

    The test is a bitmap of the keys, of 16 bits per key and MOST_BITS at most,
    so its broadcast is bounded whatever the number of keys; with more keys
    more rows are seen in vain.  Meant to spare a shuffle of wide rows: what is seen
    goes on to an exact join.
    """
    n = max(1, keys.count())
    bits = min(MOST_BITS, max(BITMAP_BITS, 1 << (16 * n).bit_length()))
    slot = F.pmod(F.coalesce(F.col("key"), F.lit(0)), F.lit(bits))
    rows = (keys.select(slot.alias("slot"))
            .groupBy(F.floor(F.col("slot") / BITMAP_BITS).cast("int").alias("__sm_row"))
            .agg(F.bitmap_construct_agg(F.col("slot") % BITMAP_BITS).alias("__sm_bits")))
    rows = written(rows, "bitmap")
    at = F.pmod(F.coalesce(key, F.lit(0)), F.lit(bits))
    put = df.withColumn("__sm_at", at).withColumn("__sm_row", F.floor(F.col("__sm_at") / BITMAP_BITS).cast("int"))
    byte = "conv(hex(substring(__sm_bits, cast(__sm_at % 32768 div 8 as int) + 1, 1)), 16, 10)"
    seen = F.expr(f"coalesce(shiftright(cast({byte} as int), cast(__sm_at % 8 as int)) & 1 = 1, false)")
    return (put.join(F.broadcast(rows), "__sm_row", "left").withColumn("__sm_seen", seen)
            .drop("__sm_row", "__sm_at", "__sm_bits"))


def without_rows(df: DataFrame, key: Column, dropped: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` (a long) is not in ``dropped.key``: only rows that a bitmap
    of the dropped keys can't clear are shuffled."""
    marked = seen_in(df, key, dropped).withColumn("__sm_key", key)
    gone = dropped.select(F.col("key").alias("__sm_key")).distinct()
    maybe = marked.filter("__sm_seen").join(gone, "__sm_key", "left_anti")
    return marked.filter("not __sm_seen").unionByName(maybe).drop("__sm_seen", "__sm_key")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Smallest ``label`` reachable from each node: (node, label).

    ``nodes``: (node, label), unique nodes; ``links``: (root, member).
    Each round lowers the label of every root to the least of its members and
    of every member to the least of its roots, then replaces each label by that
    label's own label (which halves long chains), until no label changes.
    Links of a hot root are joined by broadcast.  Only counts reach the driver.
    """
    links = written(links.filter("root <> member").distinct(), "links")
    hot = hot_keys(links, "root")
    linked = links.select(F.col("root").alias("node")).union(links.select("member")).distinct()
    labels = written(nodes.join(linked, "node", "left_semi").select("node", F.col("label").alias("own"), "label"),
                     "labels")
    while True:
        up = (links.join(labels.select(F.col("node").alias("member"), "label"), "member")
              .groupBy("root").agg(F.min("label").alias("up")))
        roots = written(up.join(labels.select(F.col("node").alias("root"), "label"), "root")
                        .select("root", F.least("up", "label").alias("down")), "roots")
        least = (join_spread(links, roots, "root", hot).select(F.col("member").alias("node"), "down")
                 .union(roots.select(F.col("root").alias("node"), "down"))
                 .groupBy("node").agg(F.min("down").alias("down")))
        lower = written(labels.join(least, "node", "left")
                        .select("node", "own", F.col("label").alias("was"), F.least("label", "down").alias("label")),
                        "lower")
        jump = lower.groupBy(F.col("own").alias("label")).agg(F.min("label").alias("next"))
        new = written(join_spread(lower, jump, "label", hot_keys(lower, "label"))
                      .select("node", "own", "was", F.least("label", "next").alias("label")), "labels")
        changed = new.filter("not (label <=> was)").limit(1).count()
        for done in (roots, lower, labels):
            forget(done)
        labels = new
        if not changed:
            break
    rest = nodes.join(linked, "node", "left_anti").select("node", "label")
    return labels.select("node", "label").union(rest)


def process_cache() -> dict:
    """A dict that lives as long as the Python worker: for tokenizers and the like."""
    return sys.modules.setdefault("_sentimill_worker", types.ModuleType("_sentimill_worker")).__dict__


def release_memory() -> None:
    """Give back to the system what a task has freed: a worker is used again and would hold it meanwhile."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # of glibc
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of ``column`` (one longer row: alone)."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if i > start and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if len(sizes) > start:
            yield batch.slice(start)


def word_sections(text: str | None, most: int = 1 << 20, lower: bool = False) -> Iterator[list[bytes]]:
    """The words (without ASCII white space) of ``text`` in UTF-8, of about ``most`` characters at a time.

    What a caller holds is then bounded however long the text is.  A word that goes
    on past a section's end comes whole in a later one.  ``lower``: A-Z in lower case.
    """
    text = text or ""
    open_word: list[bytes] = []
    for at in range(0, max(1, len(text)), most):
        part = text[at:at + most].encode("utf-8", "surrogatepass")
        words = (part.lower() if lower else part).split()
        ends = part[-1:].isspace() or at + most >= len(text)
        if open_word:
            if words and not part[:1].isspace():
                open_word.append(words.pop(0))
                if not words and not ends:               # the word goes on
                    continue
            words.insert(0, b"".join(open_word))
            open_word = []
        if words and not ends:
            open_word = [words.pop()]
        yield words


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (a null id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts))
