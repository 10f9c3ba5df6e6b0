"""File sources and sinks: JSON-array tweet files, word lists, overwrite of a partitioned table."""

import json

from pyspark.sql import functions as F

from sentimill.sources import files, lexicon
from sentimill.streaming import scorer


def test_tweet_json_array_file(spark, scratch):
    path = f"{scratch}/tweets.json"
    tweets = [{"created_at": "Mon Apr 01 12:34:56 +0000 2019", "lang": "en", "text": "hi @bob",
               "user": {"screen_name": "a"}, "extra": 1},
              {"created_at": "Mon Apr 01 12:34:57 +0000 2019", "lang": "fr", "text": "salut",
               "user": {"screen_name": "b"}}]
    with open(path, "w") as f:
        json.dump(tweets, f)
    df = files.read_tweet_file(spark, path)
    assert df.columns == ["created_at", "lang", "text", "user"]
    rows = df.select("text", "user.screen_name").collect()
    assert [tuple(r) for r in rows] == [("hi @bob", "a"), ("salut", "b")]


def test_word_lists(spark, scratch):
    path = f"{scratch}/stop.txt"
    with open(path, "w") as f:
        f.write("the\n  and \nthe\n\nno\n")
    stop = lexicon.stop_words(spark, path=path, topic="storm")
    assert sorted(r[0] for r in stop.collect()) == ["and", "no", "storm", "the"]
    kept = lexicon.stop_words_kept(spark, path=path)
    assert sorted(r[0] for r in kept.collect()) == ["and", "the"]
    common = lexicon.read_common_words(spark, path)
    vocab = lexicon.vocabulary(common, lexicon.word_table(spark, ["and"]))
    got = [(r["term"], r["idx"]) for r in vocab.orderBy("idx").collect()]
    assert got == [("linkwebsitereplacement", 0), ("no", 1), ("pseudotwitterreplacement", 2),
                   ("retweetreplacement", 3), ("the", 4)]


def test_overwrite_table_keeps_schema(spark, scratch):
    path = f"{scratch}/t"
    df = spark.range(4).select(F.col("id").alias("batch_id"), (F.col("id") * 2).alias("n"))
    df.write.mode("overwrite").partitionBy("batch_id").parquet(path)
    df.filter("batch_id < 2").write.mode("overwrite").partitionBy("batch_id").parquet(path)
    assert spark.read.parquet(path).count() == 2


def test_replay_reader_schema(spark, scratch):
    stream = scorer.replay_files(spark, scratch)
    assert stream.isStreaming and stream.columns == ["key", "value"]


def test_kafka_needs_its_connector(spark):
    import pytest
    from pyspark.errors import AnalysisException
    from sentimill.sources import messages

    with pytest.raises(AnalysisException, match="(?i)kafka"):     # the connector jar is not part of plain PySpark
        messages.kafka_stream(spark, "localhost:1", "tweets")
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        messages.write_kafka(spark.createDataFrame([(1, "{}")], "key long, value string"), "localhost:1", "tweets")


def test_kafka_messages_are_named_by_partition_and_offset(spark):
    import datetime as dt

    from sentimill.sources import messages

    at = dt.datetime(2024, 1, 1)
    raw = spark.createDataFrame([(b"k", b'{"text": "a"}', "t", 0, 5, at), (None, None, "t", 1, 5, at)],
                                "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    rows = messages.kafka_values(raw).collect()
    assert [(r["key"], r["part"], r["value"]) for r in rows] == [(5, 0, '{"text": "a"}'), (5, 1, None)]
