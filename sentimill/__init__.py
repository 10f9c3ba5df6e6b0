"""sentimill: analytics on streams of short texts, on Spark DataFrames.

The most used pieces, importable from the package root; see the README for the rest.
"""

from .functions.text import clean_text, tweet_tokens, words
from .operators.counts import drop_words, top_words, top_words_per_group, word_counts
from .operators.history import (history, last_per_batch, long_term_words, newest, newest_partitions,
                                recent_per_batch, sentiment_by_batch)
from .operators.model import fit_logistic, load_model, save_model, score, term_frequency
from .operators.position import with_row_index
from .sources.lexicon import stop_words, stop_words_kept, vocabulary
from .sources.messages import decode_messages, encode_messages
from .streaming.scorer import start_event_time_words, start_scorer

__all__ = [
    "clean_text", "tweet_tokens", "words",
    "drop_words", "top_words", "top_words_per_group", "word_counts",
    "history", "last_per_batch", "long_term_words", "newest", "newest_partitions",
    "recent_per_batch", "sentiment_by_batch",
    "fit_logistic", "load_model", "save_model", "score", "term_frequency",
    "with_row_index",
    "stop_words", "stop_words_kept", "vocabulary",
    "decode_messages", "encode_messages",
    "start_event_time_words", "start_scorer",
]
