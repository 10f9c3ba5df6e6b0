"""Column functions for cleaning and tokenising short texts.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen and never start a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: they must equal the reference's for equal tokens. ---------
# Mentions, links and the retweet marker are replaced, in this order, by
# placeholder words before tokenising.
MENTION_PATTERN = r"@[a-zA-Z0-9_]*"
LINK_PATTERN = r"http(s)?://[a-zA-Z0-9./\-]*"
RETWEET_MARKER = "RT"
MENTION_PLACEHOLDER = "pseudotwitterreplacement"
LINK_PLACEHOLDER = "linkwebsitereplacement"
RETWEET_PLACEHOLDER = "retweetreplacement"
PLACEHOLDERS = (MENTION_PLACEHOLDER, LINK_PLACEHOLDER, RETWEET_PLACEHOLDER)
# ------------------------------------------------------------------------------

# A word is a run of Unicode letters, digits and underscores: the meaning of
# Python's ``\w``.  Java's ``\w`` is ASCII only, so spell the classes out.
WORD_PATTERN = r"([\p{L}\p{N}_]+)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def text_or_empty(col: Column | str) -> Column:
    """A missing text reads as the empty string."""
    return F.coalesce(_c(col), F.lit(""))


def clean_text(col: Column | str) -> Column:
    """Replace mentions, then links, then every ``RT`` (even inside a word)."""
    out = F.regexp_replace(text_or_empty(col), MENTION_PATTERN, MENTION_PLACEHOLDER)
    out = F.regexp_replace(out, LINK_PATTERN, LINK_PLACEHOLDER)
    return F.replace(out, F.lit(RETWEET_MARKER), F.lit(RETWEET_PLACEHOLDER))


def words(col: Column | str) -> Column:
    """Lower-case, then all words in order, duplicates kept (array<string>)."""
    return F.regexp_extract_all(F.lower(text_or_empty(col)), F.lit(WORD_PATTERN), 1)


def tweet_tokens(col: Column | str) -> Column:
    """Tokens of the scoring branch: clean first, then split into words."""
    return words(clean_text(col))


def first_chars(col: Column | str, n: int = 19) -> Column:
    """The first ``n`` characters, e.g. the date part of a tweet's timestamp."""
    return F.substring(_c(col), 1, n)


TWITTER_DATE_FORMAT = "EEE MMM dd HH:mm:ss '+0000' yyyy"


def to_twitter_date(ts: Column | str) -> Column:
    """Timestamp to the tweet's ``created_at`` text, e.g. ``Mon Apr 01 12:34:56 +0000 2019``."""
    return F.date_format(_c(ts), TWITTER_DATE_FORMAT)


def parse_twitter_date(col: Column | str) -> Column:
    """Parse ``created_at`` text; what is no such date is null.

    Spark's parser refuses the day name, so the first word is dropped.
    """
    return F.try_to_timestamp(F.regexp_replace(_c(col), r"^\w+ ", ""), F.lit("MMM dd HH:mm:ss Z yyyy"))
