"""Per-batch history tables and the "last N batches" read path.

History tables are long and keyed by ``batch_id`` / ``batch_start`` (a real
timestamp, sorted explicitly, never a reversed text key).  "Last N" is an
ordered limit (TakeOrderedAndProject) on the batch-level table, which keeps
only N rows per task; per-word history is then cut with a semi join against
those N batch ids (N is a small parameter, so that side is broadcast).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import first_chars, to_twitter_date
from .sizing import bounded

SHORT_HISTORY = 15
LONG_HISTORY = 60
WORD_HISTORY = 5
RECENT_TEXTS = 5
RETAINED_BATCHES = 100


def prediction_counts(scored: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """(batch, label, n): predictions per label per batch."""
    return scored.groupBy(batch_col, "label").agg(F.count(F.lit(1)).alias("n"))


def sentiment_by_batch(scored: DataFrame, batch_cols: list[str] | tuple = ("batch_id",)) -> DataFrame:
    """(batch..., positive, negative, volume); a label missing in a batch counts 0.

    One aggregate pass instead of count-per-label then pivot.
    """
    return scored.groupBy(*batch_cols).agg(
        F.count_if(F.col("label") != 0).alias("positive"),
        F.count_if(F.col("label") == 0).alias("negative"),
        F.count(F.lit(1)).alias("volume"))


def newest(df: DataFrame, n: int, order_col: str = "batch_start") -> DataFrame:
    """The ``n`` newest rows (ordered limit, no global sort)."""
    return df.orderBy(F.desc(order_col)).limit(n)


def newest_batch_ids(df: DataFrame, n: int, batch_col: str = "batch_id",
                     order_col: str = "batch_start") -> DataFrame:
    """Ids of the ``n`` newest non-empty batches of a long table."""
    batches = df.select(batch_col, order_col).distinct()
    return bounded(newest(batches, n, order_col).select(batch_col))  # at most n rows


def newest_partitions(table: DataFrame, batches: DataFrame, n: int) -> DataFrame:
    """Rows of the n newest batches of a stored history, partitioned by batch_date and batch_id.

    ``batches`` is the index, one row per batch (batch_id, batch_start).  The n newest
    (a bounded list) are applied as literals, which Spark turns into static partition
    filters: only those partitions are read, the point get of a keyed table.
    """
    rows = newest(batches.select("batch_id", "batch_start"), n).collect()
    dates = sorted({r["batch_start"].date() for r in rows})
    return table.filter(F.col("batch_date").isin(dates) & F.col("batch_id").isin([r["batch_id"] for r in rows]))


def in_batches(df: DataFrame, batch_ids: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Rows of the given batches (a semi join; ``newest_batch_ids`` is broadcast)."""
    return df.join(batch_ids, batch_col, "left_semi").select(*df.columns)


def chronological(last: DataFrame, order_col: str = "batch_start", pos_col: str = "x") -> DataFrame:
    """Oldest first with positions 1..n.  The input is a bounded ``newest`` result."""
    return last.withColumn(pos_col, F.row_number().over(Window.orderBy(order_col)))


def history(by_batch: DataFrame, n: int) -> DataFrame:
    """(x, batch_id, batch_start, volume, positive, negative) for the n newest batches."""
    return chronological(newest(by_batch, n)).select(
        "x", "batch_id", "batch_start", "volume", "positive", "negative")


def totals(by_batch: DataFrame, n: int = LONG_HISTORY) -> DataFrame:
    """Sums of positive, negative and volume over the n newest batches."""
    return newest(by_batch, n).agg(
        F.sum("volume").alias("volume"),
        F.sum("positive").alias("positive"),
        F.sum("negative").alias("negative"),
        F.count(F.lit(1)).alias("batches"))


def ranges(by_batch: DataFrame, n: int = SHORT_HISTORY) -> DataFrame:
    """Axis ranges: volume min/max, and the min of mins / max of maxes of the two series."""
    last = newest(by_batch, n)
    return last.agg(
        F.min("volume").alias("volume_min"),
        F.max("volume").alias("volume_max"),
        F.least(F.min("negative"), F.min("positive")).alias("sentiment_min"),
        F.greatest(F.max("negative"), F.max("positive")).alias("sentiment_max"))


def long_term_words(top_by_batch: DataFrame, n: int = WORD_HISTORY,
                    word_col: str = "word") -> DataFrame:
    """(word, n): counts summed over the n newest batches of the top-words history."""
    last = newest_batch_ids(top_by_batch, n)
    return (in_batches(top_by_batch, last).groupBy(word_col)
            .agg(F.sum("n").alias("n")))


def latest(top_by_batch: DataFrame) -> DataFrame:
    """Rows of the newest batch: the ``latest`` row, without keeping a second copy."""
    return in_batches(top_by_batch, newest_batch_ids(top_by_batch, 1))


def retain_latest(df: DataFrame, n: int = RETAINED_BATCHES) -> DataFrame:
    """Retention: rows of the n newest batches."""
    return in_batches(df, newest_batch_ids(df, n))


def _names(seq_col: str | tuple) -> tuple:
    return (seq_col,) if isinstance(seq_col, str) else tuple(seq_col)


def newest_first(seq_col: str | tuple) -> list:
    """Arrival order, the last first; ``seq_col`` may be several columns, the row's key first."""
    return [F.desc(c) for c in (*_names(seq_col)[1:], *_names(seq_col)[:1])]


def recent_per_batch(texts: DataFrame, k: int = RECENT_TEXTS, batch_col: str = "batch_id",
                     seq_col: str | tuple = "doc_id") -> DataFrame:
    """The k last records of each batch, rank 1 = newest (partial limit before the shuffle)."""
    w = Window.partitionBy(batch_col).orderBy(*newest_first(seq_col))
    return texts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def last_per_batch(texts: DataFrame, batch_col: str = "batch_id", seq_col: str | tuple = "doc_id",
                   cols: tuple = ("created_at", "author", "text")) -> DataFrame:
    """The last record of each batch (what survives when five share one row key)."""
    last = Window.partitionBy(batch_col).orderBy(*newest_first(seq_col))
    return (texts.withColumn("_nth", F.row_number().over(last)).filter("_nth = 1")
            .select(batch_col, *_names(seq_col)[:1], *cols))


def recent_tweets(last: DataFrame, n: int = RECENT_TEXTS, order_col: str = "created_at") -> DataFrame:
    """Newest n texts for the table: Time (first 19 characters), Tweet, Author."""
    top = newest(last, n, order_col)
    return top.select(
        first_chars(to_twitter_date(order_col), 19).alias("Time"),
        F.col("text").alias("Tweet"),
        F.col("author").alias("Author"))
