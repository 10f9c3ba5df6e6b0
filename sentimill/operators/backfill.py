"""Backfill of a stored tweet file: 100 equal position windows, 10 s apart.

Each window holds ``n div 100`` consecutive records in arrival order (the
remainder is dropped; fewer than 100 records give no window).  Everything is
long form: a window's wide row is (window, slot, ...) rows, never one row
holding all its texts, so no window is ever gathered into a single value.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions.text import words
from .counts import TOP_WORDS, drop_words, top_words_per_group, word_counts
from .position import row_index

N_WINDOWS = 100
WINDOW_SECONDS = 10


class Cuts(NamedTuple):
    """Where the windows begin in the order of the keys."""

    order_cols: tuple
    n_windows: int
    size: int              # records of a window; 0: too few for any
    index: DataFrame       # order columns, idx
    starts: list           # keys of the first record of each window (n_windows rows at most)
    last: Row | None       # key of the last record that is in a window


def cut_windows(docs: DataFrame, order_cols=("doc_id",), n_windows: int = N_WINDOWS) -> Cuts:
    """Index the key columns and fetch the boundary keys; texts are not read."""
    cols = tuple(order_cols)
    index = row_index(docs, cols, "idx")
    size = index.count() // n_windows
    if not size:
        return Cuts(cols, n_windows, 0, index, [], None)
    end = size * n_windows
    rows = (index.filter((F.col("idx") < end) & ((F.col("idx") % size == 0) | (F.col("idx") == end - 1)))
            .orderBy("idx").collect())                     # n_windows + 1 rows at most
    return Cuts(cols, n_windows, size, index, [r for r in rows if r["idx"] % size == 0], rows[-1])


def windowed(docs: DataFrame, cuts: Cuts) -> DataFrame:
    """Adds window_id to every record in a window: a comparison with the boundary keys in the
    scan, so no text moves."""
    if not cuts.size:
        return docs.withColumn("window_id", F.lit(0)).limit(0)
    kinds = [docs.schema[c].dataType for c in cuts.order_cols]

    def at(row: Row) -> Column:
        return F.struct(*[F.lit(row[c]).cast(k).alias(c) for c, k in zip(cuts.order_cols, kinds)])

    key = F.struct(*cuts.order_cols)
    starts = F.array(*[at(r) for r in cuts.starts])
    return (docs.filter(key <= at(cuts.last))
            .withColumn("window_id", F.size(F.filter(starts, lambda s: s <= key)) - 1))


def positioned(docs: DataFrame, cuts: Cuts) -> DataFrame:
    """Adds window_id and pos (position inside the window): a join on the key with the index."""
    size = max(cuts.size, 1)
    places = (cuts.index.filter(F.col("idx") < cuts.size * cuts.n_windows)
              .select(*cuts.order_cols, F.expr(f"cast(idx div {size} as int)").alias("window_id"),
                      (F.col("idx") % size).cast("int").alias("pos")))
    return docs.join(places, list(cuts.order_cols)).select(*docs.columns, "window_id", "pos")


def window_time(window_id, t0) -> F.Column:
    wid = F.col(window_id) if isinstance(window_id, str) else window_id
    return t0 + F.make_dt_interval(secs=(wid * WINDOW_SECONDS).cast("decimal(18,6)"))


def windows(win: DataFrame, t0) -> DataFrame:
    """(window_id, window_time, n_texts)."""
    return (win.groupBy("window_id").agg(F.count(F.lit(1)).alias("n_texts"))
            .withColumn("window_time", window_time("window_id", t0))
            .select("window_id", "window_time", "n_texts"))


def window_pieces(win: DataFrame, text_col: str = "text") -> DataFrame:
    """The window text as ordered pieces ``' ' + lower(text)``; joined by pos they form it."""
    return win.select("window_id", "pos", F.concat(F.lit(" "), F.lower(text_col)).alias("piece"))


def window_word_counts(win: DataFrame, stop: DataFrame | None, k: int = TOP_WORDS,
                       text_col: str = "text") -> DataFrame:
    """Top-k words of each window's lower-cased text, stop words (and topic) removed.

    Words never span the separating space, so counting per record equals
    counting the concatenated window text.
    """
    exploded = win.select("window_id", F.explode(words(text_col)).alias("word"))
    counts = drop_words(word_counts(exploded, ["window_id"]), stop)
    return top_words_per_group(counts, ["window_id"], k)


def tweet_rows(win_scored: DataFrame) -> DataFrame:
    """(window_id, slot, text, score, label): the per-tweet cells of a window row."""
    return win_scored.select(
        "window_id",
        F.concat(F.lit("tweet_"), F.col("pos").cast("string")).alias("slot"),
        "text",
        F.col("sentiment").alias("score"),
        (F.col("sentiment") > 0).cast("int").alias("label"))


def window_cells(wins: DataFrame, word_rows: DataFrame, rows: DataFrame) -> DataFrame:
    """(row_key, qualifier, value) of the windows' wide rows: time, words and, for every tweet, text, score and label.

    ``wins``: ``windows``; ``word_rows``: ``window_word_counts``; ``rows``: ``tweet_rows``.
    """
    key = F.col("window_id").cast("string").alias("row_key")
    time = wins.select(key, F.lit("metadata:datetime").alias("qualifier"),
                       F.date_format("window_time", "yyyy-MM-dd HH:mm:ss").alias("value"))
    words_ = word_rows.select(key, F.concat(F.lit("word_count:"), "word").alias("qualifier"), F.col("n").cast("string").alias("value"))
    tweets = rows.select(key, F.explode(F.array(
        F.struct(F.concat(F.lit("tweet_text:"), "slot").alias("qualifier"), F.col("text").alias("value")),
        F.struct(F.concat(F.lit("predictions:"), "slot", F.lit("_score")).alias("qualifier"), F.col("score").cast("string").alias("value")),
        F.struct(F.concat(F.lit("predictions:"), "slot", F.lit("_label")).alias("qualifier"), F.col("label").cast("string").alias("value")),
    )).alias("cell")).select("row_key", "cell.qualifier", "cell.value")
    return time.unionByName(words_).unionByName(tweets)
