"""Stream = batch: replaying stored messages through the scorer gives the batch answers."""

import glob
import os

from pyspark.sql import functions as F

from sentimill.plans import catalog
from sentimill.sources import messages, tables
from sentimill.streaming import scorer

from tables_of_tests import SF_SMALL


def _order_files(root: str, pattern: str, key) -> None:
    """Give replay files increasing modification times so they are read in batch order."""
    files = sorted(glob.glob(os.path.join(root, pattern)), key=key)
    for i, f in enumerate(files):
        os.utime(f, (1_000_000 + i, 1_000_000 + i))


def test_scorer_stream_equals_batch_queries(spark, scratch):
    v = catalog.Views(spark, SF_SMALL)
    encoded = messages.encode_messages(v.tweets).join(
        v.tweets.select(F.col("doc_id").alias("key"), "batch_id"), "key")
    src = f"{scratch}/messages"
    # one file per 1-second batch, so one trigger = one batch of the tweet view
    encoded.repartition("batch_id").write.partitionBy("batch_id").json(src)
    _order_files(src, "batch_id=*/*.json", key=lambda p: int(p.split("batch_id=")[1].split("/")[0]))
    flat = f"{scratch}/flat"
    os.makedirs(flat)
    for f in glob.glob(os.path.join(src, "batch_id=*/*.json")):
        b = int(f.split("batch_id=")[1].split("/")[0])
        if os.path.getsize(f) > 0:
            os.rename(f, os.path.join(flat, f"part-{b:05d}.json"))
    _order_files(flat, "*.json", key=lambda p: p)

    weights = catalog.written(v.weights)
    out = f"{scratch}/history"
    q = scorer.start_scorer(scorer.replay_files(spark, flat, 1), out, weights, v.stop,
                            checkpoint=f"{scratch}/ckpt", trigger={"availableNow": True})
    q.awaitTermination()

    # epoch i processed the i-th batch that has messages; map epochs back to batch ids
    batches = [r[0] for r in v.tweets.select("batch_id").distinct().orderBy("batch_id").collect()]
    epoch_to_batch = spark.createDataFrame(list(enumerate(batches)), "batch_id long, real long")

    def relabel(df):
        return df.join(epoch_to_batch, "batch_id").drop("batch_id").withColumnRenamed("real", "batch_id")

    got_words = relabel(scorer.read_history(spark, out, scorer.WORDS_TABLE)).select(
        "batch_id", "word", "n", "rank")
    want_words = catalog.q_top_words_by_batch(spark, SF_SMALL).select("batch_id", "word", "n", "rank")
    assert got_words.exceptAll(want_words).count() == 0
    assert want_words.exceptAll(got_words).count() == 0

    got_senti = relabel(scorer.read_history(spark, out, scorer.SENTIMENT_TABLE)).select(
        "batch_id", "positive", "negative", "volume")
    want_senti = catalog.q_sentiment_by_batch(spark, SF_SMALL).select(
        "batch_id", "positive", "negative", "volume")
    assert got_senti.exceptAll(want_senti).count() == 0
    assert want_senti.exceptAll(got_senti).count() == 0

    got_last = relabel(scorer.read_history(spark, out, scorer.LAST_TABLE)).select("batch_id", "doc_id")
    want_last = catalog.q_last_per_batch(spark, SF_SMALL).select("batch_id", "doc_id")
    assert got_last.exceptAll(want_last).count() == 0 and want_last.exceptAll(got_last).count() == 0

    recent = scorer.read_history(spark, out, scorer.TEXTS_TABLE)
    assert recent.groupBy("batch_id").count().filter("count > 5").count() == 0

    # one batch time shared by the three tables of an epoch
    stamps = (scorer.read_history(spark, out, scorer.WORDS_TABLE).select("batch_id", "batch_start").distinct()
              .join(scorer.read_history(spark, out, scorer.SENTIMENT_TABLE).select("batch_id", "batch_start"),
                    ["batch_id", "batch_start"], "left_anti"))
    assert stamps.count() == 0


def test_replayed_epoch_is_not_doubled(spark, scratch):
    v = catalog.Views(spark, SF_SMALL)
    sink = scorer.HistorySink(f"{scratch}/h", catalog.written(v.weights), v.stop)
    batch = scorer.incoming_tweets(messages.encode_messages(v.tweets.filter("batch_id = 3")))
    sink(batch, 0)
    sink(batch, 0)  # the same epoch again, as after a restart
    senti = scorer.read_history(spark, f"{scratch}/h", scorer.SENTIMENT_TABLE).collect()
    assert len(senti) == 1


def test_event_time_windows_equal_batch_on_closed_windows(spark, scratch):
    ev = tables.read_table(spark, SF_SMALL, "events")
    src = f"{scratch}/events"
    ev.withColumn("day", F.to_date("ts")).repartition("day").write.partitionBy("day").parquet(src)
    flat = f"{scratch}/events_flat"
    os.makedirs(flat)
    for f in glob.glob(os.path.join(src, "day=*/*.parquet")):
        day = f.split("day=")[1].split("/")[0]
        os.rename(f, os.path.join(flat, f"{day}-{os.path.basename(f)}"))
    _order_files(flat, "*.parquet", key=lambda p: p)

    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 3).parquet(flat)
    q = (scorer.event_time_counts(stream).writeStream.outputMode("append").format("memory")
         .queryName("ev_windows").option("checkpointLocation", f"{scratch}/ev_ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("ev_windows").select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n",
        F.round("value_sum", 6).alias("value_sum"))
    want = catalog.q_events_tumbling(spark, SF_SMALL)
    assert got.exceptAll(want).count() == 0          # nothing wrong, nothing extra
    last = ev.agg(F.max("ts")).first()[0]
    closed = want.filter(F.col("window_start") < F.lit(last) - F.expr("INTERVAL 1 DAY"))
    assert closed.exceptAll(got).count() == 0       # every window closed by the watermark arrived


def test_reset_and_retention(spark, scratch):
    v = catalog.Views(spark, SF_SMALL)
    out = f"{scratch}/h"
    scorer.reset_history(spark, out)
    for table in scorer.HISTORY_SCHEMAS:
        assert scorer.read_history(spark, out, table).count() == 0
    sink = scorer.HistorySink(out, catalog.written(v.weights), v.stop)
    for epoch, b in enumerate([1, 2, 3, 4]):
        sink(scorer.incoming_tweets(messages.encode_messages(v.tweets.filter(F.col("batch_id") == b))), epoch)
    scorer.retain(spark, out, scorer.SENTIMENT_TABLE, n=2)
    kept = scorer.read_history(spark, out, scorer.SENTIMENT_TABLE)
    assert sorted(r[0] for r in kept.select("batch_id").collect()) == [2, 3]
    words = scorer.read_history(spark, out, scorer.WORDS_TABLE)
    assert set(words.columns) == {"batch_start", "word", "n", "rank", "batch_date", "batch_id"}


def test_console_view_prints_label_counts(spark, scratch, capfd):
    v = catalog.Views(spark, SF_SMALL)
    src = f"{scratch}/m"
    scorer.write_replay_files(messages.encode_messages(v.tweets.filter("batch_id < 2")).coalesce(1), src)
    q = scorer.console_predictions(scorer.replay_files(spark, src), catalog.written(v.weights), f"{scratch}/c",
                                   trigger={"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None
    printed = capfd.readouterr().out
    want = catalog.q_prediction_counts(spark, SF_SMALL).filter("batch_id < 2").groupBy("label").agg(F.sum("n")).collect()
    for label, n in want:
        assert f"{label}|" in printed.replace(" ", "") and f"|{n}|" in printed.replace(" ", "")


def _value(text, created="Mon Jan 01 00:00:01 +0000 2024"):
    import json
    return json.dumps({"created_at": created, "lang": "en", "text": text, "user": {"screen_name": "u"}})


def test_nothing_is_merged_or_lost(spark, scratch):
    """Equal offsets of two partitions, null keys and an odd date: every message counts."""
    weights = spark.createDataFrame([("good", 0, 1.0), ("bad", 1, -1.0)], "term string, idx int, weight double")
    values = spark.createDataFrame([(5, _value("good"), 0), (5, _value("bad bad"), 1), (None, _value("good"), 0),
                                    (None, _value("good"), 0), (6, _value("good", "some day"), 0)],
                                   "key long, value string, part int")
    out = f"{scratch}/h"
    scorer.HistorySink(out, weights, None)(scorer.incoming_tweets(values), 0)
    row = scorer.read_history(spark, out, scorer.SENTIMENT_TABLE).first()
    assert (row["volume"], row["positive"], row["negative"]) == (5, 4, 1)
    texts = scorer.read_history(spark, out, scorer.TEXTS_TABLE).collect()
    assert len(texts) == 5 and sum(r["created_ts"] is None for r in texts) == 1


def test_published_files_are_replayed(spark, scratch):
    v = catalog.Views(spark, SF_SMALL)
    sent = messages.encode_messages(v.tweets.filter("batch_id < 3"))
    messages.write_json_lines(sent, f"{scratch}/m")
    q = (scorer.replay_files(spark, f"{scratch}/m", 100).writeStream.format("memory").queryName("replayed")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("replayed")
    assert got.exceptAll(sent).isEmpty() and sent.exceptAll(got).isEmpty()


def test_a_replayed_epoch_keeps_its_time(spark, scratch):
    v = catalog.Views(spark, SF_SMALL)
    sink = scorer.HistorySink(f"{scratch}/h", catalog.written(v.weights), v.stop)
    batch = scorer.incoming_tweets(messages.encode_messages(v.tweets.filter("batch_id = 3")))
    sink(batch, 0)
    first = scorer.read_history(spark, f"{scratch}/h", scorer.BATCHES_TABLE).collect()
    sink(batch, 0)
    assert scorer.read_history(spark, f"{scratch}/h", scorer.BATCHES_TABLE).collect() == first


def test_event_time_top_words_equal_batch_for_any_split(spark, scratch):
    v = catalog.Views(spark, SF_SMALL)
    src = f"{scratch}/m"
    enc = messages.encode_messages(v.tweets)
    # 4 files of uneven size, so micro-batches cut through the 1-second batches
    enc.repartitionByRange(4, "key").write.json(src)
    _order_files(src, "*.json", key=lambda p: p)
    out = f"{scratch}/et"
    q = scorer.start_event_time_words(scorer.replay_files(spark, src, 1), out, v.stop,
                                      checkpoint=f"{scratch}/ck", trigger={"availableNow": True})
    q.awaitTermination()
    got = spark.read.parquet(out).select(
        F.col("window_start").cast("timestamp_ntz").alias("batch_start"), "word", "n", "rank")
    want = catalog.q_top_words_by_batch(spark, SF_SMALL).select("batch_start", "word", "n", "rank")
    assert got.exceptAll(want).count() == 0                      # every emitted window is exact
    last = want.agg(F.max("batch_start")).first()[0]
    closed = want.filter(F.col("batch_start") < F.lit(last) - F.expr("INTERVAL 3 SECONDS"))
    assert closed.exceptAll(got).count() == 0                    # and every closed window is there
