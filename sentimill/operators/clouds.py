"""Word clouds: the numbers behind the short- and long-term word displays.

Both inputs are bounded by construction (one batch's top 100 words, or the
union of five such lists), so the unpartitioned window that spreads the
min/max onto every row works on at most a few hundred rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import shape

CLOUD_WORDS = 100


def drop_topic(counts: DataFrame, topic: str | None, word_col: str = "word") -> DataFrame:
    """Remove the topic word if present; a missing topic is not an error."""
    return counts if not topic else counts.filter(F.col(word_col) != topic)


def with_spread(counts: DataFrame) -> DataFrame:
    """Adds ``low`` = min(n) and ``spread`` = max(n) − min(n) + 1 over the whole (bounded) input."""
    everything = Window.partitionBy()
    return (counts.withColumn("low", F.min("n").over(everything))
            .withColumn("spread", F.max("n").over(everything) - F.col("low") + 1))


def short_cloud(latest: DataFrame, weights: DataFrame, topic: str | None) -> DataFrame:
    """(word, n, size, half_step, bucket): size 72..168 %, colour class from the word's weight."""
    base = with_spread(drop_topic(latest.select("word", "n"), topic))
    w = weights.select(F.col("term").alias("word"), "weight")
    out = base.join(w, "word", "left").withColumn(
        "weight", F.coalesce("weight", F.lit(0.0)))
    steps = shape.half_steps("weight")
    return out.select(
        "word", "n",
        shape.relative_size("n", "low", "spread").alias("size"),
        steps.alias("half_step"),
        shape.sentiment_bucket(steps / 2).alias("bucket"))


def long_cloud(long_term: DataFrame, topic: str | None, k: int = CLOUD_WORDS,
               by: str = "word") -> DataFrame:
    """(word, n, normalised, half_step, bucket, size) for 100 words.

    ``by="word"`` keeps the reference's choice: the last 100 words in
    alphabetical order.  ``by="count"`` takes the 100 most frequent instead.
    Min and spread come from all words, before the cut.
    """
    base = with_spread(drop_topic(long_term.select("word", "n"), topic))
    order = [F.desc("word")] if by == "word" else [F.desc("n"), F.asc("word")]
    picked = base.orderBy(*order).limit(k)
    steps = shape.normalised_half_steps("n", "low", "spread")
    return picked.select(
        "word", "n",
        shape.normalised_count("n", "low", "spread").alias("normalised"),
        steps.alias("half_step"),
        shape.sentiment_bucket(steps / 2).alias("bucket"),
        shape.relative_size("n", "low", "spread").alias("size"))
