"""Golden rows for cleaning, tokenising, decoding, labels, dates and rounding (FIXTURES.md)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from sentimill.functions import shape
from sentimill.functions.text import (clean_text, first_chars, parse_twitter_date, to_twitter_date,
                                      tweet_tokens, words)
from sentimill.operators.model import label_from_rating
from sentimill.sources import messages
from sentimill.sources.files import read_labelled_csv

TOKENS = [
    ("RT @bob: START http://t.co/a-b/c?x=1 now",
     ["retweetreplacement", "pseudotwitterreplacement", "staretweetreplacement",
      "linkwebsitereplacement", "x", "1", "now"]),
    ("mail a@b.com", ["mail", "apseudotwitterreplacement", "com"]),
    ("@ alone", ["pseudotwitterreplacement", "alone"]),
    ("https://x.y/z_q end", ["linkwebsitereplacement_q", "end"]),
    ("http://h/@u/k", ["linkwebsitereplacement"]),
    ("Ça va été ²", ["ça", "va", "été", "²"]),
    ("", []),
    ("no tokens: !!!", ["no", "tokens"]),
]


def test_tweet_tokens_golden(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TOKENS)], "i int, text string")
    got = {r["i"]: r["toks"] for r in df.select("i", tweet_tokens("text").alias("toks")).collect()}
    for i, (_, expected) in enumerate(TOKENS):
        assert got[i] == expected, TOKENS[i][0]


def test_null_text_has_no_tokens(spark):
    df = spark.createDataFrame([(None,)], "text string")
    row = df.select(tweet_tokens("text").alias("a"), words("text").alias("b"),
                    clean_text("text").alias("c")).first()
    assert row["a"] == [] and row["b"] == [] and row["c"] == ""


def test_raw_words_do_not_clean(spark):
    df = spark.createDataFrame([("RT @bob START",)], "text string")
    assert df.select(words("text")).first()[0] == ["rt", "bob", "start"]


def test_decode_golden(spark):
    rows = [
        ('{"lang":"en","text":"hi","user":{"screen_name":"a"}}', "kept"),
        ('{"lang":"en"}', "filtered"),
        ('{"lang":null,"text":null}', "filtered"),
        ("not json", "corrupt"),
        ("{'lang': 'en', 'text': 'hi', 'user': {'screen_name': 'a'}}", "corrupt"),
    ]
    df = spark.createDataFrame(rows, "value string, expect string")
    out = messages.decode_messages(df).collect()
    for r in out:
        corrupt = r[messages.CORRUPT_COLUMN] is not None
        assert corrupt == (r["expect"] == "corrupt"), r
        kept = (not corrupt) and r["lang"] == "en" and (r["text"] or "") != ""
        assert kept == (r["expect"] == "kept"), r
    first = [r for r in out if r["expect"] == "kept"][0]
    assert first["author"] == "a" and first["text"] == "hi"


def test_encode_decode_round_trip(spark):
    df = spark.createDataFrame(
        [(7, dt.datetime(2019, 4, 1, 12, 34, 56), "en", "a", 'say "hi"\n/ é')],
        "doc_id long, created_at timestamp_ntz, lang string, author string, text string")
    enc = messages.encode_messages(df)
    value = enc.first()["value"]
    assert json.loads(value) == {"created_at": "Mon Apr 01 12:34:56 +0000 2019", "lang": "en",
                                 "text": 'say "hi"\n/ é', "user": {"screen_name": "a"}}
    dec = messages.decode_messages(enc).first()
    assert (dec["key"], dec["text"], dec["author"], dec["lang"]) == (7, 'say "hi"\n/ é', "a", "en")


def test_csv_and_labels(spark, scratch):
    path = f"{scratch}/sample.csv"
    with open(path, "w") as f:
        f.write('sentiment,text\n0,"bad, day"\n4,good\n,none\nx,odd\n1,\n')
    df = read_labelled_csv(spark, path).withColumn("label", label_from_rating("sentiment"))
    got = [(r["sentiment"], r["text"], r["label"]) for r in df.collect()]
    assert got == [(0, "bad, day", 0), (4, "good", 1), (None, "none", 1), (None, "odd", 1), (1, None, 1)]
    assert df.select(tweet_tokens("text")).collect()[-1][0] == []


def test_twitter_dates(spark):
    df = spark.createDataFrame([("Mon Apr 01 12:34:56 +0000 2019",)], "s string")
    row = df.select(parse_twitter_date("s").alias("t"), first_chars("s").alias("p")).first()
    assert row["p"] == "Mon Apr 01 12:34:56"
    assert row["t"] == dt.datetime(2019, 4, 1, 12, 34, 56)  # session zone is UTC
    ts = spark.createDataFrame([(dt.datetime(2019, 4, 1, 12, 34, 56),)], "t timestamp_ntz")
    assert ts.select(to_twitter_date("t")).first()[0] == "Mon Apr 01 12:34:56 +0000 2019"


@pytest.mark.parametrize("x,steps", [(0.25, 0), (0.75, 2), (1.25, 2), (-0.25, 0), (-0.75, -2)])
def test_half_steps_half_even(spark, x, steps):
    # round(x * 2): 0.5 -> 0, 1.5 -> 2, 2.5 -> 2, -0.5 -> 0, -1.5 -> -2
    assert spark.range(1).select(shape.half_steps(F.lit(x))).first()[0] == steps


def test_two_place_rounding(spark):
    got = spark.range(1).select(*[F.bround(F.lit(v), 2) for v in (0.125, 0.375, -0.625)]).first()
    assert [float(v) for v in got] == [0.12, 0.38, -0.62]


def test_exact_ratio_rounding(spark):
    cases = [(1, 2, 0), (3, 2, 2), (5, 2, 2), (-1, 2, 0), (-3, 2, -2), (7, 3, 2), (-7, 3, -2), (31, 200, 0)]
    df = spark.createDataFrame(cases, "num long, den long, want long")
    got = shape.round_ratio_half_even(F.col("num"), F.col("den")).alias("got")
    for r in df.select("want", got).collect():
        assert r["got"] == r["want"]


def test_classes_and_buckets(spark):
    vals = [-1.5, -1.0, -0.5, -0.1, -0.05, 0.0, 0.05, 0.1, 0.5, 1.0]
    df = spark.createDataFrame([(v,) for v in vals], "s double")
    out = df.select("s", shape.polarity_class("s").alias("p"), shape.sentiment_bucket("s").alias("b"),
                    shape.half_step_label(shape.half_steps("s")).alias("l")).collect()
    got = {r["s"]: (r["p"], r["b"], r["l"]) for r in out}
    assert got[-1.5] == ("negative", 0, None)
    assert got[-1.0] == ("negative", 1, "very_negative")
    assert got[-0.1] == ("negative", 2, "neutral")
    assert got[-0.05] == ("neutral", 2, "neutral")
    assert got[0.05] == ("neutral", 3, "neutral")
    assert got[0.1] == ("positive", 3, "neutral")
    assert got[0.5] == ("positive", 4, "positive")
    assert got[1.0] == ("positive", 4, "very_positive")


def test_relative_size_range(spark):
    df = spark.createDataFrame([(n,) for n in (3, 5, 10)], "n long")
    out = df.select("n", shape.relative_size("n", F.lit(3), F.lit(8)).alias("size")).collect()
    sizes = {r["n"]: r["size"] for r in out}
    assert sizes[3] == pytest.approx(72.0) and sizes[10] == pytest.approx(156.0)
    assert all(72.0 <= s <= 168.0 for s in sizes.values())
