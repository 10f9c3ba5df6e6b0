"""Every registered query, built on the driver's tables.

``Views`` holds the shared building blocks for one (session, table folder).  Most
queries are one Catalyst plan from the Parquet scan to its result; the row index, the
newest batches with a counted word and the trained model run jobs while the query is
built.  ``QUERIES`` maps a query name to ``fn(spark, sf_dir)``.
"""

from __future__ import annotations

import math
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import shape
from ..functions.text import WORD_PATTERN, clean_text, tweet_tokens, words
from ..operators import backfill, clouds, counts, history, model, sizing, wide
from ..session import folder
from ..session import written as stored
from ..sources import lexicon, messages, tables

# --- Parameters of the registered queries (stand-ins, see FIXTURES.md). -------
TOPIC = "the"                 # word dropped from the clouds, added to the backfill stop list
TRACK_SUBJECTS = "worthless,excellent,good,bad"
TRACK_TERM_SETS = "the excellent,is worthless, Good  And ,awful,of not and"
CAPTURE_N = 100
EVENT_WINDOW = "1 second"     # the reference's micro-batch length
COMMON_WORDS = 500            # stand-in for the common-word file: the most frequent tokens
LONG_HISTORY = 30             # batches of the long history and the totals (the job's own default is 60)
RETAINED = 20                 # batches that retention keeps (the job's own default is 100)
TRAIN_ROWS = 100_000          # labelled rows of a partition in training: each iteration is a task over each partition
WORD_CHAR = WORD_PATTERN.replace("+", "")   # one word character: the text has a word
# ------------------------------------------------------------------------------


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str, spread_rows: bool = True) -> DataFrame:
        return tables.read_table(self.spark, self.sf_dir, name, spread_rows)

    @cached_property
    def tweets(self) -> DataFrame:
        return tables.tweet_view(self.table("documents"))

    @cached_property
    def english(self) -> DataFrame:
        return tables.keep_english(self.tweets)

    # lexicons -------------------------------------------------------------------
    @cached_property
    def stop(self) -> DataFrame:
        return lexicon.stop_words(self.spark)

    @cached_property
    def stop_kept(self) -> DataFrame:
        return lexicon.stop_words_kept(self.spark)

    @cached_property
    def common(self) -> DataFrame:
        toks = self.english.select(F.explode(tweet_tokens("text")).alias("token"))
        return lexicon.common_words_from_tokens(toks, COMMON_WORDS)

    @cached_property
    def allowed(self) -> DataFrame:
        return lexicon.with_placeholders(self.common)

    @cached_property
    def vocab(self) -> DataFrame:
        return lexicon.vocabulary(self.common, self.stop_kept, few=True)     # a top-k and three words

    @cached_property
    def weights(self) -> DataFrame:
        return sizing.bounded(lexicon.fixture_weights(self.vocab))

    # scoring --------------------------------------------------------------------
    @cached_property
    def scored(self) -> DataFrame:
        """English tweets: (doc_id, batch_id, score, n_tokens, label)."""
        return model.score(self.english, ["doc_id", "batch_id"], self.weights)

    @cached_property
    def by_batch(self) -> DataFrame:
        out = history.sentiment_by_batch(self.scored)
        return out.select("batch_id", tables.batch_start("batch_id").alias("batch_start"),
                          "positive", "negative", "volume")

    # word counts per batch --------------------------------------------------------
    def batch_words(self, stop: DataFrame | None) -> DataFrame:
        english = tables.keep_english(tables.tweet_view(self.table("documents", spread_rows=False)))
        return counts.word_counts_by_group(english, "batch_id", words("text"), stop)

    def top_by_batch(self, stop: DataFrame | None) -> DataFrame:
        top = counts.top_words_per_group(self.batch_words(stop), ["batch_id"])
        return top.select("batch_id", tables.batch_start("batch_id").alias("batch_start"),
                          "word", "n", "rank")

    def newest_ids(self, n: int, words_only: bool = False) -> list[int]:
        """Ids of the n newest batches with an English text (holding a word character if asked).

        Batches follow doc_id, so the newest are looked for among the highest doc_ids first: the
        scan reads the row groups of that tail only (a pushed filter), without tokenising.  While it
        holds fewer than n and the table goes on, a tail four times as long is read.
        """
        docs = self.table("documents", spread_rows=False)
        last, first = docs.agg(F.max("doc_id"), F.min("doc_id")).first()
        if last is None:
            return []
        span = 2 * n * tables.TWEETS_PER_BATCH
        while True:
            plain = tables.keep_english(tables.tweet_view(docs.filter(F.col("doc_id") > last - span)))
            if words_only:
                plain = plain.filter(F.col("text").rlike(WORD_CHAR))
            ids = [r[0] for r in plain.select("batch_id").distinct().orderBy(F.desc("batch_id")).limit(n).collect()]
            if len(ids) >= n or last - span < first:
                # the lowest may be cut by the tail's start, but it is in the tail: its rows are read whole below
                return ids
            span *= 4

    def of_batches(self, ids: list[int]) -> DataFrame:
        """English tweets of some batches: the ids are literals, so only their row groups are read."""
        low = min(ids, default=0) * tables.TWEETS_PER_BATCH
        tail = self.table("documents", spread_rows=False).filter(F.col("doc_id") >= low)
        return tables.keep_english(tables.tweet_view(tail)).filter(F.col("batch_id").isin(ids))

    def recent_by_batch(self, n: int) -> DataFrame:
        """Sentiment counts of the n newest batches; only their texts are scored.

        Every English text is scored (a text without vocabulary words scores 0),
        so the newest batches of the history are exactly the newest batches
        with an English text.
        """
        some = self.of_batches(self.newest_ids(n))
        out = history.sentiment_by_batch(model.score(some, ["doc_id", "batch_id"], self.weights))
        return out.select("batch_id", tables.batch_start("batch_id").alias("batch_start"),
                          "positive", "negative", "volume")

    def recent_top(self, stop: DataFrame | None, n: int) -> DataFrame:
        """Top-words history that holds the ``n`` newest batches with a counted word.

        Only some newest batches are read and tokenised.  A text has a word iff it matches one
        word character, so without a stop list the candidates are exact; with one,
        batches of stop words only don't count, so twice as many candidates are taken until
        n of them do or there are no more.
        """
        m = n
        while True:
            ids = self.newest_ids(m, words_only=True)
            exploded = counts.explode_words(self.of_batches(ids), words("text"), ["batch_id"])
            top = counts.top_words_per_group(counts.drop_words(counts.word_counts(exploded, ["batch_id"]), stop),
                                             ["batch_id"])
            top = top.select("batch_id", tables.batch_start("batch_id").alias("batch_start"), "word", "n", "rank")
            if stop is None:
                return top
            top = written(top)           # its batches are counted, then their rows read
            if top.select("batch_id").distinct().count() >= n or len(ids) < m:
                return top
            m *= 2

    # backfill ---------------------------------------------------------------------
    @cached_property
    def keyed(self) -> DataFrame:
        return self.table("documents").select("doc_id", "text")

    @cached_property
    def cuts(self) -> backfill.Cuts:
        return backfill.cut_windows(self.table("documents", spread_rows=False))


def written(df: DataFrame) -> DataFrame:
    """Store ``df`` in the shared folder and cut its lineage."""
    return stored(df, "table")


def _v(spark, sf_dir) -> Views:
    return Views(spark, sf_dir)


# ---- stream ingest, filters, text ---------------------------------------------------

def q_english_texts(spark, sf_dir):
    return _v(spark, sf_dir).english.select("doc_id", "batch_id", "created_at", "author", "text")


def q_clean_text(spark, sf_dir):
    return _v(spark, sf_dir).english.select("doc_id", clean_text("text").alias("clean"))


def q_tokenize(spark, sf_dir):
    toks = model.doc_tokens(_v(spark, sf_dir).english, ["doc_id"])
    return toks.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))


def q_vocab_tokens(spark, sf_dir):
    v = _v(spark, sf_dir)
    toks = model.vocab_tokens(v.english, ["doc_id"], v.allowed)
    return toks.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))


def _list_hits(tokens: DataFrame, word_list: DataFrame) -> DataFrame:
    """(word, n) for every word of a bounded list, with its occurrences (0 if none)."""
    hits = counts.word_counts(counts.keep_words(tokens, word_list))  # at most one row per listed word
    lst = word_list.select(F.col(word_list.columns[0]).alias("word"))
    return (lst.join(sizing.bounded(hits), "word", "left")
            .select("word", F.coalesce("n", F.lit(0)).alias("n")))


def q_stop_words(spark, sf_dir):
    v = _v(spark, sf_dir)
    stop = lexicon.stop_words(spark, topic=TOPIC)
    toks = counts.explode_words(v.english, words("text"))
    return _list_hits(toks, stop)


def q_stop_words_kept(spark, sf_dir):
    v = _v(spark, sf_dir)
    toks = counts.explode_words(v.english, tweet_tokens("text"))
    return _list_hits(toks, v.stop_kept)


def q_vocabulary(spark, sf_dir):
    return _v(spark, sf_dir).vocab


def q_track_subjects(spark, sf_dir):
    v = _v(spark, sf_dir)
    with_tokens = v.english.select("doc_id", "batch_id", "author", tweet_tokens("text").alias("tokens"))
    return messages.track(with_tokens, TRACK_SUBJECTS).select("doc_id", "batch_id", "author")


def q_track_term_sets(spark, sf_dir):
    """Subjects of several words: which English tweet has all words of which subject."""
    v = _v(spark, sf_dir)
    docs = v.english.select("doc_id", tweet_tokens("text").alias("tokens"))
    return messages.track_subjects(docs, messages.split_subjects(spark, TRACK_TERM_SETS))


def q_capture_first_n(spark, sf_dir):
    v = _v(spark, sf_dir)
    return messages.encode_messages(messages.capture_first_n(v.tweets, CAPTURE_N))


def q_encode_messages(spark, sf_dir):
    return messages.encode_messages(_v(spark, sf_dir).tweets)


def q_decode_messages(spark, sf_dir):
    encoded = messages.encode_messages(_v(spark, sf_dir).tweets)
    decoded = messages.decode_messages(encoded)
    return decoded.select(
        F.col("key").alias("doc_id"), "created_at", "lang", "text", "author",
        F.col(messages.CORRUPT_COLUMN).isNotNull().alias("corrupt"))


# ---- word counts ---------------------------------------------------------------------

def q_word_count(spark, sf_dir):
    v = _v(spark, sf_dir)
    exploded = counts.explode_words(v.english, words("text"))
    return counts.top_words(counts.drop_words(counts.word_counts(exploded), v.stop))


def q_word_count_by_batch(spark, sf_dir):
    v = _v(spark, sf_dir)
    return v.batch_words(v.stop)


def q_top_words_by_batch(spark, sf_dir):
    v = _v(spark, sf_dir)
    return v.top_by_batch(v.stop)


def q_wide_word_rows(spark, sf_dir):
    v = _v(spark, sf_dir)
    wide = counts.word_map(v.top_by_batch(v.stop), ["batch_id"])
    return counts.cells(wide, "batch_id")


def q_stored_word_rows(spark, sf_dir):
    """Top words of every batch put as stored wide rows, read back as cells."""
    v = _v(spark, sf_dir)
    top = v.top_by_batch(v.stop)
    path = folder(spark, "wide-words")
    wide.put(top.select(F.col("batch_id").cast("string").alias("row_key"), F.concat(F.lit("word_count:"), "word").alias("qualifier"),
                        F.col("n").cast("string").alias("value")), path)
    return wide.read_cells(wide.read_table(spark, path))


def q_latest_word_count(spark, sf_dir):
    v = _v(spark, sf_dir)
    return history.latest(v.recent_top(v.stop, 1)).select("batch_id", "word", "n", "rank")


def q_long_term_word_count(spark, sf_dir):
    v = _v(spark, sf_dir)
    return history.long_term_words(v.recent_top(v.stop, history.WORD_HISTORY))


def q_retain_latest(spark, sf_dir):
    v = _v(spark, sf_dir)
    return history.retain_latest(v.recent_top(v.stop, RETAINED), RETAINED).select("batch_id", "word", "n", "rank")


# ---- model ---------------------------------------------------------------------------------

def q_term_frequency(spark, sf_dir):
    v = _v(spark, sf_dir)
    return model.term_frequency(v.english, ["doc_id"], v.vocab)


def q_training_rows(spark, sf_dir):
    rows = model.training_rows(tables.labelled_texts(spark, sf_dir))
    return (rows.select("doc_id", "label", F.explode("tokens").alias("token"))
            .groupBy("doc_id", "label", "token").agg(F.count(F.lit(1)).alias("n")))


def q_predict(spark, sf_dir):
    return _v(spark, sf_dir).scored.select("doc_id", "batch_id", "score", "n_tokens", "label")


def q_prediction_counts(spark, sf_dir):
    return history.prediction_counts(_v(spark, sf_dir).scored)


def q_sentiment_by_batch(spark, sf_dir):
    return _v(spark, sf_dir).by_batch


def q_train_sentiment(spark, sf_dir):
    """Terms and indices of the fitted model, and whether its loss is below the zero model's."""
    v = _v(spark, sf_dir)
    labelled = tables.labelled_texts(spark, sf_dir)
    partitions = math.ceil(v.table("labels", spread_rows=False).count() / TRAIN_ROWS) or 1    # counted in the files' footers
    weights, _ = model.fit_logistic(model.training_rows(labelled), written(v.vocab), partitions=partitions)
    margin = model.score(labelled.withColumn("target", model.label_from_rating("sentiment")), ["target"], weights)
    sign = F.when(F.col("target") == 1, F.col("score")).otherwise(-F.col("score"))
    loss = margin.agg(F.avg(F.log1p(F.exp(-sign)))).first()[0]
    return weights.select("term", "idx", F.lit(loss < math.log(2)).alias("better_than_zero"))


# ---- history read path -----------------------------------------------------------

def q_history_short(spark, sf_dir):
    n = history.SHORT_HISTORY
    return history.history(_v(spark, sf_dir).recent_by_batch(n), n)


def q_history_long(spark, sf_dir):
    n = LONG_HISTORY
    return history.history(_v(spark, sf_dir).recent_by_batch(n), n)


def q_sentiment_totals(spark, sf_dir):
    n = LONG_HISTORY
    return history.totals(_v(spark, sf_dir).recent_by_batch(n), n)


def q_history_ranges(spark, sf_dir):
    n = history.SHORT_HISTORY
    return history.ranges(_v(spark, sf_dir).recent_by_batch(n), n)


def q_recent_per_batch(spark, sf_dir):
    v = _v(spark, sf_dir)
    return history.recent_per_batch(v.english).select(
        "batch_id", "rank", "doc_id", "created_at", "author", "text")


def q_last_per_batch(spark, sf_dir):
    return history.last_per_batch(_v(spark, sf_dir).english)


def q_recent_tweets(spark, sf_dir):
    v = _v(spark, sf_dir)
    n = history.RECENT_TEXTS
    some = v.of_batches(v.newest_ids(n))   # only the n newest batches
    return history.recent_tweets(history.last_per_batch(some), n)


# ---- dashboard numbers -------------------------------------------------------------

def _doc_sentiment(spark, sf_dir):
    return model.with_sentiment(_v(spark, sf_dir).scored)


def q_polarity_class(spark, sf_dir):
    s = _doc_sentiment(spark, sf_dir)
    return s.select("doc_id", "sentiment", shape.polarity_class("sentiment").alias("polarity"))


def q_sentiment_bucket(spark, sf_dir):
    s = _doc_sentiment(spark, sf_dir)
    steps = shape.half_steps("sentiment")
    return s.select("doc_id", steps.alias("half_step"),
                    shape.sentiment_bucket(steps / 2).alias("bucket"))


def q_half_step_label(spark, sf_dir):
    s = _doc_sentiment(spark, sf_dir)
    steps = shape.half_steps("sentiment")
    return s.select("doc_id", steps.alias("half_step"),
                    shape.half_step_label(steps).alias("label_name"))


def q_word_cloud_short(spark, sf_dir):
    v = _v(spark, sf_dir)
    return clouds.short_cloud(v.recent_top(None, 1), v.weights, TOPIC)


def q_word_cloud_long(spark, sf_dir):
    v = _v(spark, sf_dir)
    return clouds.long_cloud(history.long_term_words(v.recent_top(None, history.WORD_HISTORY)), TOPIC)


def q_word_cloud_long_by_count(spark, sf_dir):
    v = _v(spark, sf_dir)
    words_ = history.long_term_words(v.recent_top(None, history.WORD_HISTORY))
    return clouds.long_cloud(words_, TOPIC, by="count")


# ---- backfill ------------------------------------------------------------------------------

def q_backfill_windows(spark, sf_dir):
    v = _v(spark, sf_dir)
    return backfill.windows(backfill.windowed(v.keyed.select("doc_id"), v.cuts), tables.origin())


def q_backfill_word_counts(spark, sf_dir):
    v = _v(spark, sf_dir)
    stop = lexicon.stop_words(spark, topic=TOPIC)
    win = backfill.windowed(v.keyed, v.cuts)
    return backfill.window_word_counts(win, stop).select("window_id", "word", "n", "rank")


def q_backfill_tweet_rows(spark, sf_dir):
    v = _v(spark, sf_dir)
    # score on small keys only, then bring the text back with one join on doc_id
    scores = model.with_sentiment(model.score(v.table("documents"), ["doc_id"], v.weights))
    return backfill.tweet_rows(backfill.positioned(v.keyed, v.cuts).join(scores.select("doc_id", "sentiment"), "doc_id"))


def q_window_text(spark, sf_dir):
    v = _v(spark, sf_dir)
    return backfill.window_pieces(backfill.positioned(v.keyed, v.cuts))


def q_backfill_wide_rows(spark, sf_dir):
    """The windows' wide rows (time, words, text and label of every tweet), stored in shards and read back as cells."""
    v = _v(spark, sf_dir)
    stop = lexicon.stop_words(spark, topic=TOPIC)
    win = backfill.windowed(v.keyed, v.cuts)
    cells = backfill.window_cells(backfill.windows(win, tables.origin()), backfill.window_word_counts(win, stop),
                                  q_backfill_tweet_rows(spark, sf_dir))
    path = folder(spark, "wide-windows")
    wide.put(cells, path)
    found = wide.read_cells(wide.read_table(spark, path))
    # doubles print unlike elsewhere (backfill_tweet_rows has them as numbers)
    return found.filter(~(F.startswith("qualifier", F.lit("predictions:")) & F.endswith("qualifier", F.lit("_score"))))


# ---- event-time batches --------------------------------------------------------------

def q_events_tumbling(spark, sf_dir):
    ev = tables.read_table(spark, sf_dir, "events")
    return (ev.groupBy(F.window("ts", EVENT_WINDOW).start.alias("window_start"), "event_type")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,6)")).cast("double").alias("value_sum")))


QUERIES = {
    "english_texts": q_english_texts,
    "clean_text": q_clean_text,
    "tokenize": q_tokenize,
    "vocab_tokens": q_vocab_tokens,
    "stop_words": q_stop_words,
    "stop_words_kept": q_stop_words_kept,
    "vocabulary": q_vocabulary,
    "word_count": q_word_count,
    "word_count_by_batch": q_word_count_by_batch,
    "top_words_by_batch": q_top_words_by_batch,
    "wide_word_rows": q_wide_word_rows,
    "stored_word_rows": q_stored_word_rows,
    "backfill_wide_rows": q_backfill_wide_rows,
    "track_term_sets": q_track_term_sets,
    "latest_word_count": q_latest_word_count,
    "long_term_word_count": q_long_term_word_count,
    "retain_latest": q_retain_latest,
    "term_frequency": q_term_frequency,
    "training_rows": q_training_rows,
    "predict": q_predict,
    "prediction_counts": q_prediction_counts,
    "sentiment_by_batch": q_sentiment_by_batch,
    "history_short": q_history_short,
    "history_long": q_history_long,
    "sentiment_totals": q_sentiment_totals,
    "history_ranges": q_history_ranges,
    "recent_per_batch": q_recent_per_batch,
    "last_per_batch": q_last_per_batch,
    "recent_tweets": q_recent_tweets,
    "polarity_class": q_polarity_class,
    "sentiment_bucket": q_sentiment_bucket,
    "half_step_label": q_half_step_label,
    "word_cloud_short": q_word_cloud_short,
    "word_cloud_long": q_word_cloud_long,
    "word_cloud_long_by_count": q_word_cloud_long_by_count,
    "backfill_windows": q_backfill_windows,
    "backfill_word_counts": q_backfill_word_counts,
    "backfill_tweet_rows": q_backfill_tweet_rows,
    "window_text": q_window_text,
    "track_subjects": q_track_subjects,
    "capture_first_n": q_capture_first_n,
    "encode_messages": q_encode_messages,
    "decode_messages": q_decode_messages,
    "events_tumbling": q_events_tumbling,
    "train_sentiment": q_train_sentiment,
}
