"""Word counting and top-k, globally and per group.

Counting is a hash aggregate with a map-side partial count, so a hot word or a
hot batch costs one row per map partition in the shuffle.  Top-k per group is
``row_number() <= k``: Spark turns that into a WindowGroupLimit on both sides
of the shuffle, so at most ``k`` rows per group leave each map partition.

Counts per small group (a batch of a few texts) hold nearly as many rows as there
are words, so a map-side count saves little and outgrows a task's memory:
``word_counts_by_group`` brings a group's texts together first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOP_WORDS = 100
TEXT_BYTES = 8 << 20         # text of a partition that is counted by group: some half million words at once
MOST_PARTITIONS = 20_000     # with more text than both allow, partitions grow (and their counts may spill)
HOT_SHARE = 1000             # a group is hot if it holds over 1/HOT_SHARE of the text and more than a partition


def explode_words(df: DataFrame, tokens: Column, keep: list[str] | tuple = (),
                  name: str = "word") -> DataFrame:
    """One row per token (duplicates kept), with the ``keep`` columns alongside."""
    return df.select(*keep, F.explode(tokens).alias(name))


def drop_words(words: DataFrame, stop: DataFrame | None, word_col: str = "word") -> DataFrame:
    """Anti join with a word list.

    The lists of ``sources.lexicon`` carry their broadcast hint (see
    ``operators.sizing``), so this is a map-side hash join with no shuffle.
    Removing a word commutes with counting by word, so it may go before or
    after the count; Catalyst pushes it below the partial aggregate either way.
    """
    if stop is None:
        return words
    stop = stop.select(F.col(stop.columns[0]).alias(word_col))
    return words.join(stop, word_col, "left_anti").select(*words.columns)


def keep_words(words: DataFrame, allowed: DataFrame, word_col: str = "word") -> DataFrame:
    """Semi join with a word list (set membership)."""
    allowed = allowed.select(F.col(allowed.columns[0]).alias(word_col))
    return words.join(allowed, word_col, "left_semi").select(*words.columns)


def word_counts(words: DataFrame, by: list[str] | tuple = (), word_col: str = "word") -> DataFrame:
    """(by..., word, n): occurrences per group and word."""
    return words.groupBy(*by, word_col).agg(F.count(F.lit(1)).alias("n"))


def word_counts_by_group(df: DataFrame, by: str, tokens: Column, stop: DataFrame | None = None,
                         text: str = "text", part_bytes: int = TEXT_BYTES) -> DataFrame:
    """(by, word, n) as ``word_counts`` of the exploded ``tokens``, without the words of ``stop``.

    The texts are shuffled by group, not the words: a partition gets whole groups with
    about ``part_bytes`` of text, so its counts fit a task's memory whatever the size of
    the input, and they are final.  Texts of hot groups (HOT_SHARE at most) stay where they are and
    their words are counted as elsewhere, so no group piles up in one task.  One
    pass over the lengths finds the number of partitions; a second finds the hot groups, if there are any.
    """
    def counted(some: DataFrame) -> DataFrame:
        return drop_words(word_counts(explode_words(some, tokens, [by]), [by]), stop)

    sizes = df.groupBy(by).agg(F.sum(F.octet_length(text)).alias("size"))
    total, largest = (x or 0 for x in sizes.agg(F.sum("size"), F.max("size")).first())
    most = max(part_bytes, total // HOT_SHARE)
    partitions = min(MOST_PARTITIONS, -(-total // part_bytes) or 1)
    if largest <= most:
        return counted(df.repartition(partitions, by))
    hot = [r[0] for r in sizes.filter(F.col("size") > most).select(by).collect()]
    is_hot = F.when(F.col(by).isNull(), F.lit(None in hot)).otherwise(F.col(by).isin([x for x in hot if x is not None]))
    return counted(df.filter(~is_hot).repartition(partitions, by)).unionByName(counted(df.filter(is_hot)))


def top_words(counts: DataFrame, k: int = TOP_WORDS, word_col: str = "word") -> DataFrame:
    """Global top-k by count, ties by word (TakeOrderedAndProject, no full sort)."""
    return counts.orderBy(F.desc("n"), F.asc(word_col)).limit(k)


def top_words_per_group(counts: DataFrame, by: list[str] | tuple, k: int = TOP_WORDS,
                        word_col: str = "word", rank_col: str = "rank") -> DataFrame:
    """Top-k per group with its rank 1..k; ties by word."""
    w = Window.partitionBy(*by).orderBy(F.desc("n"), F.asc(word_col))
    return (counts.withColumn(rank_col, F.row_number().over(w))
            .filter(F.col(rank_col) <= k))


def word_map(top: DataFrame, by: list[str] | tuple, word_col: str = "word") -> DataFrame:
    """Wide form: one row per group, ``map<word, n>`` (bounded: the input is a top-k)."""
    return top.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(word_col), F.col("n")))).alias("words"))


def cells(wide: DataFrame, key: str, family: str = "word_count", map_col: str = "words") -> DataFrame:
    """Wide rows as (row key, column qualifier, value) cells, e.g. ``word_count:<word>``."""
    return wide.select(key, F.explode(map_col).alias("word", "n")).select(
        key,
        F.concat(F.lit(family + ":"), F.col("word")).alias("qualifier"),
        F.col("n").cast("string").alias("value"))
