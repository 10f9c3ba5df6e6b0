"""The live scorer as a Structured Streaming job.

One streaming query: message values → decode → English, non-empty texts →
``foreachBatch``.  Each micro-batch is persisted once and written three ways
(top words, recent texts, sentiment counts) with the same batch functions the
batch queries use, under one batch id and one batch time for all three
tables.  Each table gets the micro-batch as a folder of its own, and when all are written
one record in the commit log (``commits``) makes them visible together.  A micro-batch replayed
after that record is left alone; one replayed before it writes new folders.

``start_event_time_words`` and ``event_time_counts`` are the event-time twins:
tumbling windows with a watermark, whose closed windows equal the batch answer
for any split of the input into micro-batches.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import parse_twitter_date, words
from ..operators import counts, history, model
from ..sources import messages, tables
from .commits import CommitLog

BATCH_SECONDS = 1
MESSAGE_SCHEMA = T.StructType([
    T.StructField("key", T.LongType(), True),
    T.StructField("value", T.StringType(), True),
])

WORDS_TABLE = "word_count"
TEXTS_TABLE = "recent_texts"
LAST_TABLE = "last_text"
SENTIMENT_TABLE = "sentiment"
BATCHES_TABLE = "batches"          # from the commit log: one row per batch
ARRIVAL = ("arrived", "part")      # what orders messages before their key, where the source has it


def replay_files(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Stored messages (JSON lines of key + value) replayed as a stream, n files per trigger."""
    return (spark.readStream.schema(MESSAGE_SCHEMA)
            .option("maxFilesPerTrigger", max_files_per_trigger).json(path))


def write_replay_files(encoded: DataFrame, path: str, group_col: str | None = None) -> None:
    """Store (key, value) messages as JSON lines; one folder per ``group_col`` value if given."""
    writer = encoded.write.mode("overwrite")
    if group_col:
        writer = writer.partitionBy(group_col)
    writer.json(path)


def incoming_tweets(values: DataFrame, seq_col: str = "key") -> DataFrame:
    """Decode, keep English non-empty texts, drop corrupt messages; ``seq`` = arrival order."""
    decoded = messages.decode_messages(values)
    good = decoded.filter(F.col(messages.CORRUPT_COLUMN).isNull())
    return tables.keep_english(good).select(
        F.col(seq_col).alias("doc_id"), *[c for c in ARRIVAL if c in values.columns],
        parse_twitter_date("created_at").alias("created_ts"),
        "created_at", "author", "text")


class HistorySink:
    """``foreachBatch`` function writing the three history tables of one micro-batch."""

    def __init__(self, out_dir: str, weights: DataFrame, stop: DataFrame | None,
                 top_k: int = counts.TOP_WORDS, recent: int = history.RECENT_TEXTS):
        self.out_dir = out_dir.rstrip("/")
        self.weights = weights
        self.stop = stop
        self.top_k = top_k
        self.recent = recent

    def _write(self, df: DataFrame, table: str, stamp: dt.datetime, epoch_id: int) -> tuple[str, int]:
        """(folder under the history, rows): counted while they are written."""
        path = f"{table}/batch_date={stamp.date()}/batch_id={epoch_id}-{uuid.uuid4().hex}"
        seen = Observation()
        (df.withColumn("batch_date", F.lit(stamp.date())).observe(seen, F.count(F.lit(1)).alias("n"))
         .write.parquet(f"{self.out_dir}/{path}"))
        return path, seen.get["n"]

    def outputs(self, batch: DataFrame) -> dict[str, DataFrame]:
        """The per-batch results; ``batch`` carries ``batch_id`` and ``batch_start`` columns."""
        keys = ["batch_id", "batch_start"]
        exploded = counts.explode_words(batch, words("text"), keys)
        wc = counts.drop_words(counts.word_counts(exploded, keys), self.stop)
        top = counts.top_words_per_group(wc, keys, self.top_k)
        order = ("doc_id", *[c for c in ARRIVAL if c in batch.columns])
        recent = history.recent_per_batch(batch, self.recent, seq_col=order)
        last = history.last_per_batch(batch, seq_col=order, cols=("batch_start", "created_at", "author", "text"))
        scored = model.score(batch, keys, self.weights)
        senti = history.sentiment_by_batch(scored, keys)
        return {WORDS_TABLE: top, TEXTS_TABLE: recent, LAST_TABLE: last, SENTIMENT_TABLE: senti}

    def __call__(self, batch_df: DataFrame, epoch_id: int) -> None:
        spark = batch_df.sparkSession
        log = CommitLog(spark, self.out_dir)
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if log.committed(epoch_id, query):                             # replayed after its commit
            return
        batch_df.persist()
        try:
            if batch_df.isEmpty():       # an empty micro-batch writes no rows
                return
            stamp = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)     # one time for all tables
            batch = (batch_df.withColumn("batch_id", F.lit(epoch_id).cast("bigint"))
                     .withColumn("batch_start", F.lit(stamp).cast("timestamp_ntz")))
            parts = {table: self._write(df, table, stamp, epoch_id) for table, df in self.outputs(batch).items()}
            for path, rows in parts.values():
                if not rows:
                    log.delete(f"{self.out_dir}/{path}")
            log.commit(epoch_id, stamp, {t: p for t, p in parts.items() if p[1]}, query)
        finally:
            batch_df.unpersist()


def start_scorer(values: DataFrame, out_dir: str, weights: DataFrame, stop: DataFrame | None,
                 checkpoint: str | None = None, trigger: dict | None = None,
                 seq_col: str = "key") -> StreamingQuery:
    """Start the scorer; ``trigger`` defaults to 1-second micro-batches.

    Progress is kept beside the output (``<out>/_checkpoint``) unless told otherwise, so
    every output has its own and a restart goes on where it stopped.
    """
    ckpt = checkpoint or f"{out_dir.rstrip('/')}/_checkpoint"
    sink = HistorySink(out_dir, weights, stop)
    writer = (incoming_tweets(values, seq_col).writeStream
              .foreachBatch(sink).option("checkpointLocation", ckpt))
    writer = writer.trigger(**(trigger or {"processingTime": f"{BATCH_SECONDS} second"}))
    return writer.start()


HISTORY_SCHEMAS = {
    WORDS_TABLE: "batch_start timestamp_ntz, word string, n bigint, rank int, batch_date date, batch_id bigint",
    TEXTS_TABLE: "doc_id bigint, created_ts timestamp, created_at string, author string, text string, "
                 "batch_start timestamp_ntz, rank int, batch_date date, batch_id bigint",
    LAST_TABLE: "doc_id bigint, batch_start timestamp_ntz, created_at string, author string, text string, "
                "batch_date date, batch_id bigint",
    SENTIMENT_TABLE: "batch_start timestamp_ntz, positive bigint, negative bigint, volume bigint, "
                     "batch_date date, batch_id bigint",
}


def reset_history(spark: SparkSession, out_dir: str) -> None:
    """Drop and re-create the history: no batch is visible, then the tables' files go."""
    log = CommitLog(spark, out_dir)
    log.drop()
    for table in HISTORY_SCHEMAS:
        log.delete(f"{log.out_dir}/{table}")


def read_history(spark: SparkSession, out_dir: str, table: str, newest: int | None = None) -> DataFrame:
    """The committed rows of a history table, with its fixed schema (so an empty table reads too).

    ``newest``: of the newest so many batches that have rows in this table; only their folders are read.
    """
    log = CommitLog(spark, out_dir)
    if table == BATCHES_TABLE:
        return log.batches()
    return log.read(table, HISTORY_SCHEMAS[table], None if newest is None else log.newest(table, newest))


def compact_history(spark: SparkSession, out_dir: str) -> int:
    """Merge the batches written since the last time into one file set per table and day."""
    return CommitLog(spark, out_dir).compact(HISTORY_SCHEMAS)


def retain(spark: SparkSession, out_dir: str, table: str, n: int = history.RETAINED_BATCHES) -> None:
    """Retention in place: the newest n batches of a table stay; older ones are hidden at once, and their
    files go with the next retention, compaction or vacuum."""
    CommitLog(spark, out_dir).retain(table, n)


def console_predictions(values: DataFrame, weights: DataFrame, checkpoint: str, seq_col: str = "key",
                        trigger: dict | None = None) -> StreamingQuery:
    """Print how many texts of each micro-batch got which label (debug view)."""
    def show(batch: DataFrame, epoch_id: int) -> None:
        scored = model.score(batch.withColumn("batch_id", F.lit(epoch_id)), ["batch_id"], weights)
        history.prediction_counts(scored).orderBy("label").show()

    return (incoming_tweets(values, seq_col).writeStream.foreachBatch(show)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": f"{BATCH_SECONDS} second"})).start())


class WindowTopWords:
    """``foreachBatch`` function: top-k words of each closed event-time window.

    The streaming aggregation upstream emits a window's counts once, when the
    watermark passes its end (append mode), so ranking inside the micro-batch
    sees whole windows.  One folder per epoch, overwritten on replay.
    """

    def __init__(self, out_dir: str, top_k: int = counts.TOP_WORDS):
        self.out_dir = out_dir.rstrip("/")
        self.top_k = top_k

    def __call__(self, closed: DataFrame, epoch_id: int) -> None:
        top = counts.top_words_per_group(closed, ["window_start"], self.top_k)
        top.write.mode("overwrite").parquet(f"{self.out_dir}/epoch={epoch_id}")


def event_time_word_counts(tweets: DataFrame, stop: DataFrame | None,
                           window: str = f"{BATCH_SECONDS} second",
                           watermark: str = "2 seconds") -> DataFrame:
    """(window_start, word, n) per event-time window; state is dropped behind the watermark."""
    timed = tweets.withWatermark("created_ts", watermark)
    exploded = timed.select(F.window("created_ts", window).alias("w"), F.explode(words("text")).alias("word"))
    kept = counts.drop_words(exploded, stop)  # stream-static anti join, before the stateful step
    return (kept.groupBy("w", "word").agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), "word", "n"))


def start_event_time_words(values: DataFrame, out_dir: str, stop: DataFrame | None,
                           checkpoint: str | None = None, trigger: dict | None = None,
                           watermark: str = "2 seconds", seq_col: str = "key") -> StreamingQuery:
    """Top words per 1-second event-time window, whatever the micro-batch boundaries."""
    ckpt = checkpoint or f"{out_dir.rstrip('/')}/_checkpoint"
    agg = event_time_word_counts(incoming_tweets(values, seq_col), stop, watermark=watermark)
    writer = (agg.writeStream.outputMode("append").foreachBatch(WindowTopWords(out_dir))
              .option("checkpointLocation", ckpt))
    writer = writer.trigger(**(trigger or {"processingTime": f"{BATCH_SECONDS} second"}))
    return writer.start()


def event_time_counts(events: DataFrame, ts_col: str = "ts", keys: tuple = ("event_type",),
                      window: str = f"{BATCH_SECONDS} second", watermark: str = "10 seconds") -> DataFrame:
    """Tumbling event-time counts with a watermark (append mode emits closed windows only)."""
    ts = F.col(ts_col).cast("timestamp")
    return (events.withColumn(ts_col, ts).withWatermark(ts_col, watermark)
            .groupBy(F.window(ts_col, window), *keys)
            .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value_sum"))
            .select(F.col("window.start").alias("window_start"), *keys, "n", "value_sum"))
