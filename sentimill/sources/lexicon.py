"""Word lists: stop words, kept words, common words and the vocabulary index.

Constants and a top-k are bounded by construction and carry a broadcast hint;
lists from files carry none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.text import PLACEHOLDERS
from ..operators.position import row_index
from ..operators.sizing import bounded

# --- Fixed values. ---------------------------------------------------------------
# The common English stop-word list (the 179 words of the widely used NLTK
# "english" corpus), in its natural order.
ENGLISH_STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're",
    "you've", "you'll", "you'd", "your", "yours", "yourself", "yourselves", "he",
    "him", "his", "himself", "she", "she's", "her", "hers", "herself", "it", "it's",
    "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "that'll", "these", "those", "am", "is", "are",
    "was", "were", "be", "been", "being", "have", "has", "had", "having", "do",
    "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because",
    "as", "until", "while", "of", "at", "by", "for", "with", "about", "against",
    "between", "into", "through", "during", "before", "after", "above", "below",
    "to", "from", "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no",
    "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t",
    "can", "will", "just", "don", "don't", "should", "should've", "now", "d", "ll",
    "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't",
    "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't",
    "haven", "haven't", "isn", "isn't", "ma", "mightn", "mightn't", "mustn",
    "mustn't", "needn", "needn't", "shan", "shan't", "shouldn", "shouldn't",
    "wasn", "wasn't", "weren", "weren't", "won", "won't", "wouldn", "wouldn't",
)
# Words that carry sentiment and are taken back out of the stop list.
KEPT_WORDS = ("no", "not", "up", "off", "down", "yes")
# ----------------------------------------------------------------------------------

def word_table(spark: SparkSession, words, column: str = "word") -> DataFrame:
    """A one-column table of distinct words from a (small, fixed) list.

    Built as an inline array in the JVM: no Python worker, no shuffle.
    """
    distinct = list(dict.fromkeys(words))
    arr = F.array(*[F.lit(w) for w in distinct]) if distinct else F.array().cast("array<string>")
    return bounded(spark.range(1).select(F.explode(arr).alias(column)))


def stop_words(spark: SparkSession, words=ENGLISH_STOP_WORDS, topic: str | None = None,
               path: str | None = None) -> DataFrame:
    """Stop list for word counts: a file (stripped lines) or the constant, plus the topic word."""
    if path is not None:
        from .files import read_word_list
        base = read_word_list(spark, path)
        base = base.union(word_table(spark, [topic])).distinct() if topic else base
        return base
    return word_table(spark, list(words) + ([topic] if topic else []))


def stop_words_kept(spark: SparkSession, words=ENGLISH_STOP_WORDS,
                    kept=KEPT_WORDS, path: str | None = None) -> DataFrame:
    """Stop list for the model: the list minus the words that carry sentiment."""
    if path is not None:
        from .files import read_word_list
        return read_word_list(spark, path).subtract(word_table(spark, kept))
    return word_table(spark, [w for w in words if w not in set(kept)])


def common_words_from_tokens(tokens: DataFrame, k: int, token_col: str = "token") -> DataFrame:
    """The ``k`` most frequent tokens, ties by word: a global top-k (TakeOrderedAndProject)."""
    return bounded(tokens.groupBy(F.col(token_col).alias("term")).count()
                   .orderBy(F.desc("count"), F.asc("term")).limit(k).select("term"))


def read_common_words(spark: SparkSession, path: str) -> DataFrame:
    from .files import read_word_list
    return read_word_list(spark, path, column="term")


def with_placeholders(common: DataFrame) -> DataFrame:
    """Common words plus the three placeholder words (set union).

    ``common`` is referenced once: a second reference would recompute the
    top-k from the raw text.  The DISTINCT shuffles at most k + 3 rows.
    """
    spark = common.sparkSession
    return common.select("term").union(word_table(spark, PLACEHOLDERS, "term")).distinct()


def vocabulary(common: DataFrame, stop: DataFrame, few: bool = False) -> DataFrame:
    """(term, idx): common words + placeholders − stop words, indexed in term order.

    ``few``: the caller knows the list to be bounded (a top-k), so one ordered window
    numbers it and it may be broadcast.  Otherwise, as for a list from a file, the terms
    are range-partitioned and numbered without a single task, and Spark picks the joins.
    """
    terms = with_placeholders(common).join(
        stop.select(F.col(stop.columns[0]).alias("term")), "term", "left_anti").select("term")
    if few:
        return bounded(terms.select("term", (F.row_number().over(Window.orderBy("term")) - 1).alias("idx")))
    return row_index(terms, ["term"], "idx")


def fixture_weights(vocab: DataFrame) -> DataFrame:
    """Stand-in model weights by term: ``(idx % 3) - 1`` (FIXTURES.md)."""
    return vocab.select("term", "idx", ((F.col("idx") % 3) - 1).cast("double").alias("weight"))
