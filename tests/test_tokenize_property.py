"""Tokenising in Spark equals the plain-Python definition on random texts (brute-force oracle)."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from sentimill.functions.text import (LINK_PATTERN, LINK_PLACEHOLDER, MENTION_PATTERN,
                                      MENTION_PLACEHOLDER, RETWEET_MARKER, RETWEET_PLACEHOLDER,
                                      tweet_tokens, words)
from sentimill.functions import shape

ALPHABET = list("abcXYZ019_ @:/.-?!,'\"\n\t#RTrthps") + list("éÇàüß²½ЖжΩ中文🙂")
PIECES = ["RT", "@bob", "@", "http://t.co/a-b", "https://x.y/z_q", "www.", " ", "Été", "ça"]


def python_tokens(text: str) -> list[str]:
    t = re.sub(MENTION_PATTERN, MENTION_PLACEHOLDER, text)
    t = re.sub(LINK_PATTERN, LINK_PLACEHOLDER, t)
    t = t.replace(RETWEET_MARKER, RETWEET_PLACEHOLDER)
    return re.findall(r"\w+", t.lower())


texts = st.lists(st.one_of(st.sampled_from(PIECES), st.text(alphabet=ALPHABET, max_size=12)),
                 max_size=12).map("".join)


@settings(max_examples=25, deadline=None)
@given(st.lists(texts, min_size=1, max_size=20))
def test_tokens_match_python(spark, batch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(batch)], "i int, text string")
    got = {r["i"]: (r["a"], r["b"]) for r in
           df.select("i", tweet_tokens("text").alias("a"), words("text").alias("b")).collect()}
    for i, t in enumerate(batch):
        assert got[i][0] == python_tokens(t), t
        assert got[i][1] == re.findall(r"\w+", t.lower()), t


def test_title_case(spark):
    df = spark.createDataFrame([("time",), ("tweet author",)], "s string")
    assert [r[0] for r in df.select(shape.title_case("s")).collect()] == ["Time", "Tweet Author"]
