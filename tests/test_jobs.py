"""The four programs as jobs, on fixtures written from the driver's tables."""

from pyspark.sql import functions as F

from sentimill import jobs
from sentimill.operators import model
from sentimill.plans import catalog
from sentimill.sources import messages
from sentimill.streaming import scorer

from tables_of_tests import SF_SMALL


def _fixtures(spark, scratch):
    v = catalog.Views(spark, SF_SMALL)
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    csv = f"{scratch}/sample.csv"
    (labels.join(docs.filter("lang = 'en'"), "doc_id").select(F.col("quality").alias("sentiment"), "text")
     .coalesce(1).write.option("header", True).csv(csv))
    vocab = f"{scratch}/words.txt"
    v.common.coalesce(1).write.text(vocab)
    return v, csv, vocab


def test_train_then_backfill_then_read(spark, scratch):
    v, csv, vocab = _fixtures(spark, scratch)
    weights = jobs.train_job(spark, csv, vocab, f"{scratch}/model", max_iter=20)
    assert weights.count() == v.vocab.count()
    w2, b = model.load_model(spark, f"{scratch}/model")
    assert b == 0.0 and w2.count() == weights.count()

    tweets = f"{scratch}/tweets"
    messages.tweet_struct(v.tweets).orderBy("doc_id").select("tweet.*").coalesce(1).write.json(tweets)
    jobs.backfill_job(spark, tweets, f"{scratch}/model", f"{scratch}/bf", topic=catalog.TOPIC,
                      multiline=False)
    got = spark.read.parquet(f"{scratch}/bf/word_count").select("window_id", "word", "n", "rank")
    want = catalog.q_backfill_word_counts(spark, SF_SMALL)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    wins = spark.read.parquet(f"{scratch}/bf/windows")
    assert wins.exceptAll(catalog.q_backfill_windows(spark, SF_SMALL)).count() == 0
    rows = spark.read.parquet(f"{scratch}/bf/tweets")
    assert rows.count() == catalog.q_backfill_tweet_rows(spark, SF_SMALL).count()

    hist = f"{scratch}/history"
    sink = scorer.HistorySink(hist, w2, v.stop)
    for epoch, b in enumerate(range(6)):
        sink(scorer.incoming_tweets(messages.encode_messages(v.tweets.filter(F.col("batch_id") == b))), epoch)
    report = jobs.read_job(spark, hist, f"{scratch}/report", topic=catalog.TOPIC)
    assert report["history_short"].count() == 6
    assert report["totals"].first()["batches"] == 6
    assert 0 < report["recent_tweets"].count() <= 5
    assert report["latest_words"].count() <= 100
    assert spark.read.parquet(f"{scratch}/report/long_term_words").count() > 0


def test_job_cli_parses(spark, scratch):
    import pytest
    with pytest.raises(SystemExit):
        jobs.main(["nonsense"])


def test_history_point_get_reads_its_folder_only(spark, scratch):
    from sentimill.operators import history
    v = catalog.Views(spark, SF_SMALL)
    hist = f"{scratch}/h"
    sink = scorer.HistorySink(hist, catalog.written(v.weights), v.stop)
    for epoch, b in enumerate(range(4)):
        sink(scorer.incoming_tweets(messages.encode_messages(v.tweets.filter(F.col("batch_id") == b))), epoch)
    words = scorer.read_history(spark, hist, scorer.WORDS_TABLE)
    got = scorer.read_history(spark, hist, scorer.WORDS_TABLE, newest=1)
    assert len({f.rsplit("/", 1)[0] for f in words.inputFiles()}) == 4
    assert all("/batch_id=3-" in f for f in got.inputFiles())
    want = history.latest(words)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_newest_partitions_prunes(spark, scratch):
    """The same on any table partitioned by date and batch."""
    import re
    from sentimill.operators import history
    rows = spark.sql("SELECT id AS n, id div 3 AS batch_id, date'2024-01-01' AS batch_date FROM range(12)")
    rows.write.partitionBy("batch_date", "batch_id").parquet(f"{scratch}/t")
    table = spark.read.parquet(f"{scratch}/t")
    index = spark.sql("SELECT id AS batch_id, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS batch_start FROM range(4)")
    got = history.newest_partitions(table, index, 1)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = got._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert filters and re.search(r"batch_date#\d+ = 2.*batch_id#\d+ = 3\)", filters[0]), filters
    assert sorted(r["n"] for r in got.collect()) == [9, 10, 11]


def _messages(spark, path, first, last):
    v = catalog.Views(spark, SF_SMALL)
    scorer.write_replay_files(messages.encode_messages(v.tweets.filter(f"batch_id between {first} and {last}")).coalesce(1), path)
    return v


def test_score_cli_two_outputs_and_a_restart(spark, scratch):
    v = _messages(spark, f"{scratch}/m", 0, 1)
    model.save_model(catalog.written(v.weights), 0.0, f"{scratch}/model")

    def score(out, *more):
        assert jobs.main(["score", "--messages", f"{scratch}/m", "--model", f"{scratch}/model", "--out", out, "--once", *more]) == 0
        rows = scorer.read_history(spark, out, scorer.SENTIMENT_TABLE).orderBy("batch_id").collect()
        return [(r["batch_id"], r["volume"]) for r in rows]

    volume = v.english.filter("batch_id < 2").count()
    assert score(f"{scratch}/a") == score(f"{scratch}/b") == [(0, volume)]        # each output has its own progress
    assert score(f"{scratch}/c", "--checkpoint", f"{scratch}/ck") == [(0, volume)]
    more = messages.encode_messages(v.tweets.filter("batch_id = 2")).coalesce(1)
    messages.write_json_lines(more, f"{scratch}/m")
    assert score(f"{scratch}/a") == [(0, volume), (1, v.english.filter("batch_id = 2").count())]


def test_backfill_of_two_files_is_in_file_order(spark, scratch):
    import json
    import os
    os.makedirs(f"{scratch}/t")
    for name, texts in (("part-0", ["a"]), ("part-1", [f"b{i} " * 50 for i in range(3)])):       # the second is larger
        with open(f"{scratch}/t/{name}.json", "w") as f:
            json.dump([{"text": t} for t in texts], f)
    model.save_model(spark.createDataFrame([("a", 0, 1.0)], "term string, idx int, weight double"), 0.0, f"{scratch}/model")
    jobs.backfill_job(spark, f"{scratch}/t", f"{scratch}/model", f"{scratch}/out", n_windows=4)
    rows = spark.read.parquet(f"{scratch}/out/tweets").orderBy("window_id").collect()
    assert [r["text"].split()[0] for r in rows] == ["a", "b0", "b1", "b2"]
    words = spark.read.parquet(f"{scratch}/out/word_count").orderBy("window_id").collect()
    assert [(r["window_id"], r["word"], r["n"]) for r in words] == [(1, "b0", 50), (2, "b1", 50), (3, "b2", 50)]


def test_read_cli_end_to_end(spark, scratch):
    v = catalog.Views(spark, SF_SMALL)
    hist = f"{scratch}/h"
    sink = scorer.HistorySink(hist, catalog.written(v.weights), v.stop)
    for epoch, b in enumerate(range(3)):
        sink(scorer.incoming_tweets(messages.encode_messages(v.tweets.filter(F.col("batch_id") == b))), epoch)
    assert jobs.main(["read", "--history", hist, "--out", f"{scratch}/r", "--topic", "the"]) == 0
    assert spark.read.parquet(f"{scratch}/r/history_short").count() == 3
    assert spark.read.parquet(f"{scratch}/r/latest_words").filter("word = 'the'").count() == 0


def test_capture_and_json_model_cli(spark, scratch):
    v, csv, vocab = _fixtures(spark, scratch)
    assert jobs.main(["train", "--labels", csv, "--vocab", vocab, "--out", f"{scratch}/model", "--json", f"{scratch}/model.json"]) == 0
    want = model.load_model(spark, f"{scratch}/model")[0].select("term", "weight")
    got = jobs.load_any_model(spark, f"{scratch}/model.json", vocab).select("term", "weight")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    _messages(spark, f"{scratch}/m", 0, 9)
    word = v.common.first()["term"]
    assert jobs.main(["capture", "--messages", f"{scratch}/m", "--subjects", f"{word},no such words", "--count", "3", "--once",
                      "--out", f"{scratch}/c"]) == 0
    from sentimill.streaming import replay
    rows = replay.read_capture(spark, f"{scratch}/c").collect()
    assert len(rows) == 3 and all(word in r["value"].lower() for r in rows)
