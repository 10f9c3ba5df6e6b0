"""Reading the driver's tables and the tweet view over ``documents``.

The tweet view maps the reference's record onto ``documents``: arrival order is
``doc_id``, the author is ``source``, tweets arrive every 50 ms from
2024-01-01, and a 1-second micro-batch is ``doc_id div 20``.  Timestamps are
``timestamp_ntz`` built by interval arithmetic, so no session time zone enters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import text_or_empty
from ..session import SCAN_PARTITIONS

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# --- Fixed values of the stand-in stream (see FIXTURES.md). -------------------
STREAM_ORIGIN = "2024-01-01 00:00:00"
MILLIS_PER_TWEET = 50
TWEETS_PER_BATCH = 20          # 1-second batches at 20 tweets a second
ENGLISH = "en"
# ------------------------------------------------------------------------------


# Unique row ids of the tables: hashing on them spreads rows evenly.
UNIQUE_KEYS = {"documents": "doc_id", "labels": "doc_id", "events": "event_id"}


def read_table(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool = True) -> DataFrame:
    """A driver table; ``spread_rows=False`` when the next step shuffles the rows anyway."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    partitions = spark.conf.get(SCAN_PARTITIONS, None)
    return spread(df, int(partitions), UNIQUE_KEYS.get(name)) if spread_rows and partitions else df


def spread(df: DataFrame, partitions: int, key: str | None = None) -> DataFrame:
    """Spread the rows over ``partitions`` when the caller knows the scan to be too coarse.

    A file with one row group gives one scan task; the per-row work (regexes,
    tokenising) then runs on one core.  With a unique ``key`` the rows are
    hash-partitioned on it: even, retry-safe without the sort a round-robin needs, and
    later per-key aggregates reuse it.  Filters and column pruning still reach the scan.
    """
    return df.repartition(partitions, key) if key else df.repartition(partitions)


def origin() -> Column:
    return F.to_timestamp_ntz(F.lit(STREAM_ORIGIN))


def plus_millis(ts: Column, millis: Column) -> Column:
    return ts + F.make_dt_interval(secs=(millis / 1000).cast("decimal(18,6)"))


def batch_start(batch_id: Column | str) -> Column:
    col = F.col(batch_id) if isinstance(batch_id, str) else batch_id
    return plus_millis(origin(), col * (MILLIS_PER_TWEET * TWEETS_PER_BATCH))


def tweet_view(docs: DataFrame) -> DataFrame:
    """documents → (doc_id, batch_id, created_at, lang, author, text)."""
    return docs.select(
        "doc_id",
        F.expr(f"doc_id div {TWEETS_PER_BATCH}").alias("batch_id"),
        plus_millis(origin(), F.col("doc_id") * MILLIS_PER_TWEET).alias("created_at"),
        "lang",
        F.col("source").alias("author"),
        "text",
    )


def keep_english(df: DataFrame, lang: str = ENGLISH) -> DataFrame:
    """Language filter, then non-empty text; a missing field fails the test."""
    return df.filter((F.col("lang") == lang) & (text_or_empty("text") != ""))


def labelled_texts(spark: SparkSession, sf_dir: str, lang: str = ENGLISH) -> DataFrame:
    """Stand-in for the labelled CSV: (doc_id, sentiment, text) of rated documents."""
    docs = read_table(spark, sf_dir, "documents").filter(F.col("lang") == lang)
    labels = read_table(spark, sf_dir, "labels")
    return (labels.select("doc_id", F.col("quality").alias("sentiment"))
            .join(docs.select("doc_id", "text"), "doc_id"))
