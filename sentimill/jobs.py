"""The four programs as Spark jobs: train, score (stream), backfill, read; capture and maintain.

    spark-submit -m sentimill.jobs train    --labels sample.csv --vocab words.txt --out model/
    spark-submit -m sentimill.jobs score    --messages dir/ --model model/ --out history/
    spark-submit -m sentimill.jobs capture  --messages dir/ --subjects "one,two words" --count 100 --out captured/
    spark-submit -m sentimill.jobs backfill --tweets tweets.json --model model/ --out backfill/
    spark-submit -m sentimill.jobs read     --history history/ --out report/
    spark-submit -m sentimill.jobs maintain --history history/ --retain 100

Every job reads and writes through Spark (files in, Parquet out); nothing but
bounded lists passes through the driver.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import backfill, history, model
from .session import checkpoint_dir, written
from .sources import files, lexicon, messages, tables
from .streaming import replay, scorer


def _stop(spark: SparkSession, path: str | None, topic: str | None = None) -> DataFrame:
    return lexicon.stop_words(spark, path=path, topic=topic)


def train_job(spark: SparkSession, labels_csv: str, vocab_path: str, out: str,
              stop_path: str | None = None, max_iter: int = 100, json_out: str | None = None,
              partitions: int | None = None) -> DataFrame:
    """Labelled CSV + common-word list → model (weights by term, intercept) in ``out``, and as JSON if asked.

    ``partitions``: spread the rows anew for training (else they stay as the files give them).
    """
    labelled = files.read_labelled_csv(spark, labels_csv).withColumn(
        "doc_id", F.monotonically_increasing_id())   # row key only; never used for order
    common = lexicon.read_common_words(spark, vocab_path)
    vocab = lexicon.vocabulary(common, lexicon.stop_words_kept(spark, path=stop_path))
    weights, intercept = model.fit_logistic(model.training_rows(labelled), vocab, max_iter=max_iter, partitions=partitions)
    model.save_model(weights, intercept, out)
    if json_out:
        model.save_json_model(weights, intercept, json_out)
    return weights


def load_any_model(spark: SparkSession, model_path: str, vocab_path: str | None = None, stop_path: str | None = None) -> DataFrame:
    """Weights by term of a stored model; with a vocabulary file, of one in JSON, whose weights follow the vocabulary."""
    if vocab_path is None:
        return model.load_model(spark, model_path)[0]
    common = lexicon.read_common_words(spark, vocab_path)
    vocab = lexicon.vocabulary(common, lexicon.stop_words_kept(spark, path=stop_path))
    return model.load_json_model(spark, model_path, vocab)[0]


def capture_job(spark: SparkSession, out: str, n: int, messages_path: str | None = None, kafka: str | None = None,
                topic: str | None = None, subjects: str | None = None, once: bool = False) -> int:
    """Capture the first n messages (about any of the comma-separated subjects, all words of one), then stop."""
    if kafka:
        values = messages.kafka_values(messages.kafka_stream(spark, kafka, topic or "tweets"))
    else:
        values = scorer.replay_files(spark, messages_path)
    if subjects:
        values = messages.about(values, subjects)
    return replay.capture(values, out, n, trigger={"availableNow": True} if once else None)


def score_job(spark: SparkSession, messages_path: str, model_dir: str, out: str,
              stop_path: str | None = None, kafka: str | None = None, topic: str | None = None,
              once: bool = False, checkpoint: str | None = None, vocab_path: str | None = None):
    """Start the live scorer on a Kafka topic or on a folder of message files."""
    weights = load_any_model(spark, model_dir, vocab_path, stop_path)
    if kafka:
        values = messages.kafka_values(messages.kafka_stream(spark, kafka, topic or "tweets"))
    else:
        values = scorer.replay_files(spark, messages_path)
    trigger = {"availableNow": True} if once else None
    return scorer.start_scorer(values, out, weights, _stop(spark, stop_path), checkpoint=checkpoint, trigger=trigger)


def backfill_job(spark: SparkSession, tweets_path: str, model_dir: str, out: str,
                 stop_path: str | None = None, topic: str | None = None,
                 n_windows: int = backfill.N_WINDOWS, multiline: bool = True) -> None:
    """Stored tweet file → per-window tables: windows, top words, per-tweet cells.

    Arrival order is the order of the file names, and within a file the order of its
    records.  The file is read once: with that order it is landed as a table, and
    everything else reads the table.
    """
    reader = files.read_tweet_file if multiline else files.read_tweet_lines
    tweets = written(reader(spark, tweets_path).select(*files.arrival_order(), "text"), "tweets")
    cuts = backfill.cut_windows(tweets, files.ARRIVAL_ORDER, n_windows)
    win = backfill.windowed(tweets, cuts)
    weights, _ = model.load_model(spark, model_dir)
    placed = backfill.positioned(tweets, cuts)
    # scored on small keys; the text comes back with one join, so it travels once
    scores = model.with_sentiment(model.score(placed, ["window_id", "pos"], weights))
    scores = placed.select("window_id", "pos", "text").join(scores.select("window_id", "pos", "sentiment"), ["window_id", "pos"])
    backfill.windows(win, tables.origin()).write.mode("overwrite").parquet(f"{out}/windows")
    backfill.window_word_counts(win, _stop(spark, stop_path, topic)) \
        .write.mode("overwrite").parquet(f"{out}/word_count")
    backfill.tweet_rows(scores).write.mode("overwrite").parquet(f"{out}/tweets")


def read_job(spark: SparkSession, history_dir: str, out: str | None = None,
             topic: str | None = None) -> dict[str, DataFrame]:
    """The dashboard's read path over the stored history tables: of each the newest batches that have rows in it."""
    short, long_ = history.SHORT_HISTORY, history.LONG_HISTORY

    def part(table: str, n: int) -> DataFrame:
        return scorer.read_history(spark, history_dir, table, newest=n)

    words, senti, last = scorer.WORDS_TABLE, scorer.SENTIMENT_TABLE, scorer.LAST_TABLE
    report = {
        "latest_words": part(words, 1).select("word", "n"),
        "long_term_words": history.long_term_words(part(words, history.WORD_HISTORY)),
        "history_short": history.history(part(senti, short), short),
        "history_long": history.history(part(senti, long_), long_),
        "totals": history.totals(part(senti, long_), long_),
        "ranges": history.ranges(part(senti, short), short),
        "recent_tweets": history.newest(part(last, history.RECENT_TEXTS),
                                        history.RECENT_TEXTS, "batch_start").select(
            F.substring("created_at", 1, 19).alias("Time"), F.col("text").alias("Tweet"),
            F.col("author").alias("Author")),
    }
    if topic:
        report["latest_words"] = report["latest_words"].filter(F.col("word") != topic)
    if out:
        for name, df in report.items():
            df.write.mode("overwrite").parquet(f"{out}/{name}")
    return report


def maintain_job(spark: SparkSession, history_dir: str, retained: int | None = None) -> None:
    """Retention in place, then compaction of what was written since the last time."""
    if retained:
        for table in scorer.HISTORY_SCHEMAS:
            scorer.retain(spark, history_dir, table, retained)
    scorer.compact_history(spark, history_dir)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="sentimill.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    t = sub.add_parser("train")
    t.add_argument("--labels", required=True)
    t.add_argument("--vocab", required=True)
    t.add_argument("--stop")
    t.add_argument("--out", required=True)
    t.add_argument("--json", help="also write the model as JSON here")
    t.add_argument("--partitions", type=int, help="partitions of the training rows (the files' own, if not given)")
    s = sub.add_parser("score")
    s.add_argument("--messages")
    s.add_argument("--kafka")
    s.add_argument("--topic")
    s.add_argument("--model", required=True)
    s.add_argument("--stop")
    s.add_argument("--out", required=True)
    s.add_argument("--once", action="store_true")
    s.add_argument("--checkpoint")
    s.add_argument("--vocab", help="the model is JSON, with weights in the order of this vocabulary")
    c = sub.add_parser("capture")
    c.add_argument("--messages")
    c.add_argument("--kafka")
    c.add_argument("--topic")
    c.add_argument("--subjects")
    c.add_argument("--count", type=int, default=100)
    c.add_argument("--out", required=True)
    c.add_argument("--once", action="store_true")
    b = sub.add_parser("backfill")
    b.add_argument("--tweets", required=True)
    b.add_argument("--model", required=True)
    b.add_argument("--stop")
    b.add_argument("--topic")
    b.add_argument("--out", required=True)
    m = sub.add_parser("maintain")
    m.add_argument("--history", required=True)
    m.add_argument("--retain", type=int, help="batches of each table that stay")
    r = sub.add_parser("read")
    r.add_argument("--history", required=True)
    r.add_argument("--topic")
    r.add_argument("--out", required=True)
    a = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"sentimill-{a.job}").getOrCreate()
    checkpoint_dir(spark)
    if a.job == "train":
        train_job(spark, a.labels, a.vocab, a.out, a.stop, json_out=a.json, partitions=a.partitions)
    elif a.job == "score":
        q = score_job(spark, a.messages, a.model, a.out, a.stop, a.kafka, a.topic, a.once, a.checkpoint, a.vocab)
        q.awaitTermination()
    elif a.job == "capture":
        capture_job(spark, a.out, a.count, a.messages, a.kafka, a.topic, a.subjects, a.once)
    elif a.job == "backfill":
        backfill_job(spark, a.tweets, a.model, a.out, a.stop, a.topic)
    elif a.job == "maintain":
        maintain_job(spark, a.history, a.retain)
    else:
        read_job(spark, a.history, a.out, a.topic)
    return 0


if __name__ == "__main__":
    sys.exit(main())
