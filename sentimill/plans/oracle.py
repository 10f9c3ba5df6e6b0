"""Equivalent DuckDB SQL for every registered query with a SQL form.

Each query is a ``WITH`` block of the named CTEs it needs plus a final
``SELECT``.  The text is built by concatenation because ``{L}`` in the word
pattern would break ``str.format``.
"""

from __future__ import annotations


from ..functions import shape
from ..functions.text import (LINK_PATTERN, MENTION_PATTERN, MENTION_PLACEHOLDER,
                              LINK_PLACEHOLDER, PLACEHOLDERS, RETWEET_MARKER,
                              RETWEET_PLACEHOLDER)
from ..operators import backfill, counts, history
from ..sources import lexicon, tables
from . import catalog

WORD_RE = r"[\p{L}\p{N}_]+"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(words, column: str) -> str:
    rows = ", ".join("(" + _q(w) + ")" for w in words)
    return "(SELECT * FROM (VALUES " + rows + ") v(" + column + "))"


def _clean(expr: str) -> str:
    out = "regexp_replace(coalesce(" + expr + ", ''), " + _q(MENTION_PATTERN) + ", " \
        + _q(MENTION_PLACEHOLDER) + ", 'g')"
    out = "regexp_replace(" + out + ", " + _q(LINK_PATTERN) + ", " + _q(LINK_PLACEHOLDER) + ", 'g')"
    return "replace(" + out + ", " + _q(RETWEET_MARKER) + ", " + _q(RETWEET_PLACEHOLDER) + ")"


def _words(expr: str) -> str:
    return "regexp_extract_all(lower(coalesce(" + expr + ", '')), " + _q(WORD_RE) + ")"


ORIGIN = "TIMESTAMP " + _q(tables.STREAM_ORIGIN)
PER_BATCH = tables.TWEETS_PER_BATCH
BATCH_START = ORIGIN + " + to_milliseconds(batch_id * " + str(tables.MILLIS_PER_TWEET * PER_BATCH) + ")"
TWITTER_FMT = "'%a %b %d %H:%M:%S +0000 %Y'"
STOP = _values(lexicon.ENGLISH_STOP_WORDS, "word")
STOP_TOPIC = "(SELECT word FROM " + STOP + " UNION SELECT " + _q(catalog.TOPIC) + ")"
KEPT = _values(lexicon.KEPT_WORDS, "word")

# name -> (sql, dependencies)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "tw": ("SELECT doc_id, doc_id // " + str(PER_BATCH) + " AS batch_id, " + ORIGIN
           + " + to_milliseconds(doc_id * " + str(tables.MILLIS_PER_TWEET) + ") AS created_at, "
           "lang, source AS author, text FROM documents", ()),
    "en": ("SELECT * FROM tw WHERE lang = 'en' AND coalesce(text, '') <> ''", ("tw",)),
    "ctok": ("SELECT doc_id, batch_id, unnest(" + _words(_clean("text")) + ") AS token FROM en", ("en",)),
    "rtok": ("SELECT doc_id, batch_id, unnest(" + _words("text") + ") AS word FROM en", ("en",)),
    "stopkept": ("SELECT word FROM " + STOP + " EXCEPT SELECT word FROM " + KEPT, ()),
    "common": ("SELECT token AS term FROM ctok GROUP BY token ORDER BY count(*) DESC, token LIMIT "
               + str(catalog.COMMON_WORDS), ("ctok",)),
    "allowed": ("SELECT term FROM common UNION SELECT term FROM " + _values(PLACEHOLDERS, "term"),
                ("common",)),
    "vocab": ("SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx FROM "
              "(SELECT term FROM allowed EXCEPT SELECT word FROM stopkept)", ("allowed", "stopkept")),
    "weights": ("SELECT term, idx, CAST((idx % 3) - 1 AS DOUBLE) AS weight FROM vocab", ("vocab",)),
    "tokw": ("SELECT t.doc_id, w.weight FROM ctok t JOIN weights w ON t.token = w.term",
             ("ctok", "weights")),
    "scored": ("SELECT e.doc_id, e.batch_id, coalesce(sum(k.weight), 0.0) AS score, "
               "count(k.weight) AS n_tokens, CAST(coalesce(sum(k.weight), 0.0) > 0 AS INTEGER) AS label "
               "FROM en e LEFT JOIN tokw k ON e.doc_id = k.doc_id GROUP BY e.doc_id, e.batch_id",
               ("en", "tokw")),
    "senti": ("SELECT doc_id, CASE WHEN n_tokens > 0 THEN score / n_tokens ELSE 0.0 END AS sentiment "
              "FROM scored", ("scored",)),
    "by_batch": ("SELECT batch_id, " + BATCH_START + " AS batch_start, "
                 "count(*) FILTER (WHERE label <> 0) AS positive, "
                 "count(*) FILTER (WHERE label = 0) AS negative, count(*) AS volume "
                 "FROM scored GROUP BY batch_id", ("scored",)),
    "bw": ("SELECT batch_id, word, count(*) AS n FROM rtok WHERE word NOT IN (SELECT word FROM "
           + STOP + ") GROUP BY batch_id, word", ("rtok",)),
    "bw_all": ("SELECT batch_id, word, count(*) AS n FROM rtok GROUP BY batch_id, word", ("rtok",)),
    "top": ("SELECT batch_id, " + BATCH_START + " AS batch_start, word, n, rank FROM ("
            "SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY n DESC, word) AS rank FROM bw"
            ") WHERE rank <= " + str(counts.TOP_WORDS), ("bw",)),
    "top_all": ("SELECT batch_id, " + BATCH_START + " AS batch_start, word, n, rank FROM ("
                "SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY n DESC, word) AS rank "
                "FROM bw_all) WHERE rank <= " + str(counts.TOP_WORDS), ("bw_all",)),
    "long_top": ("SELECT word, CAST(sum(n) AS BIGINT) AS n FROM top "
                 "WHERE batch_id IN (SELECT batch_id FROM top "
                 "GROUP BY batch_id ORDER BY max(batch_start) DESC LIMIT " + str(history.WORD_HISTORY)
                 + ") GROUP BY word", ("top",)),
    "long_all": ("SELECT word, CAST(sum(n) AS BIGINT) AS n FROM top_all "
                 "WHERE batch_id IN (SELECT batch_id FROM top_all "
                 "GROUP BY batch_id ORDER BY max(batch_start) DESC LIMIT " + str(history.WORD_HISTORY)
                 + ") GROUP BY word", ("top_all",)),
    "wdocs": ("SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS idx, "
              "(SELECT count(*) FROM documents) // " + str(backfill.N_WINDOWS) + " AS size FROM documents",
              ()),
    "win": ("SELECT doc_id, text, CAST(idx // size AS INTEGER) AS window_id, "
            "CAST(idx - (idx // size) * size AS INTEGER) AS pos FROM wdocs "
            "WHERE size > 0 AND idx // size < " + str(backfill.N_WINDOWS), ("wdocs",)),
    "alltok": ("SELECT doc_id, unnest(" + _words(_clean("text")) + ") AS token FROM documents", ()),
    "allscore": ("SELECT d.doc_id, coalesce(sum(w.weight), 0.0) AS score, count(w.weight) AS n_tokens "
                 "FROM documents d LEFT JOIN (SELECT t.doc_id, w.weight FROM alltok t JOIN weights w "
                 "ON t.token = w.term) w ON d.doc_id = w.doc_id GROUP BY d.doc_id",
                 ("alltok", "weights")),
}


def _with(final: str, needs: tuple[str, ...]) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][1]:
            visit(dep)
        order.append(name)

    for n in needs:
        visit(n)
    if not order:
        return final
    return "WITH " + ",\n".join(n + " AS (" + CTES[n][0] + ")" for n in order) + "\n" + final


# Exact half-to-even of integer num/den (den > 0), as in functions.shape.
def _round_ratio(num: str, den: str) -> str:
    r = "((((" + num + ") % (" + den + ")) + (" + den + ")) % (" + den + "))"
    q = "((" + num + ") - " + r + ") // (" + den + ")"
    return ("(" + q + " + CASE WHEN 2 * " + r + " > (" + den + ") THEN 1 WHEN 2 * " + r + " = ("
            + den + ") THEN ((" + q + ") % 2 + 2) % 2 ELSE 0 END)")


def _bucket(x: str) -> str:
    cuts = shape.BUCKET_CUTS
    parts = ["WHEN " + x + " IS NULL THEN NULL"]
    for i, c in enumerate(cuts):
        parts.append("WHEN " + x + " < " + repr(c) + " THEN " + str(i))
    return "CASE " + " ".join(parts) + " ELSE " + str(len(cuts)) + " END"


def _size(n: str, low: str, spread: str) -> str:
    hund = _round_ratio("(" + n + " - " + low + ") * 200 - " + spread + " * 100", spread)
    return ("((" + hund + ") / 100 * " + repr(shape.MAX_SIZE_CHANGE) + " + 1) * "
            + str(shape.BASE_SIZE_PERCENT))


def _cloud_long(order: str) -> str:
    d = "(spread - low)"
    sign = "(CASE WHEN " + d + " < 0 THEN -1 ELSE 1 END)"
    num = "(((n - low) * 100 - " + d + " * 49) * " + sign + ")"
    den = "(" + d + " * 50 * " + sign + ")"
    steps = "CASE WHEN " + d + " <> 0 THEN CAST(" + _round_ratio(num, den) + " AS INTEGER) END"
    return ("SELECT word, n, CASE WHEN " + d + " <> 0 THEN (n - low) / " + d + " - "
            + repr(shape.NORMALISED_SHIFT) + " END AS normalised, "
            + steps + " AS half_step, " + _bucket("(" + steps + ") / 2") + " AS bucket, "
            + _size("n", "low", "spread") + " AS size FROM ("
            "SELECT word, n, min(n) OVER () AS low, max(n) OVER () - min(n) OVER () + 1 AS spread "
            "FROM long_all WHERE word <> " + _q(catalog.TOPIC) + ") ORDER BY " + order + " LIMIT 100")


def _cloud_short() -> str:
    steps = "CAST(round_even(weight * 2, 0) AS INTEGER)"
    return ("SELECT word, n, " + _size("n", "low", "spread") + " AS size, " + steps + " AS half_step, "
            + _bucket(steps + " / 2") + " AS bucket FROM ("
            "SELECT t.word, t.n, coalesce(w.weight, 0.0) AS weight, min(t.n) OVER () AS low, "
            "max(t.n) OVER () - min(t.n) OVER () + 1 AS spread FROM top_all t "
            "LEFT JOIN weights w ON t.word = w.term "
            "WHERE t.batch_id = (SELECT max(batch_id) FROM top_all) AND t.word <> "
            + _q(catalog.TOPIC) + ")")


def _labels_map(x: str) -> str:
    return "CASE " + " ".join("WHEN " + x + " = " + str(k) + " THEN " + _q(v)
                              for k, v in shape.HALF_STEP_LABELS.items()) + " END"


def _hist(n: int) -> str:
    return ("SELECT CAST(row_number() OVER (ORDER BY batch_start) AS INTEGER) AS x, batch_id, "
            "batch_start, volume, positive, negative FROM (SELECT * FROM by_batch "
            "ORDER BY batch_start DESC LIMIT " + str(n) + ")")


def _tweet_json(src: str) -> str:
    return ("CAST(to_json({'created_at': strftime(created_at, " + TWITTER_FMT + "), 'lang': lang, "
            "'text': text, 'user': {'screen_name': author}}) AS VARCHAR)")


SQL: dict[str, str] = {
    "english_texts": _with("SELECT doc_id, batch_id, created_at, author, text FROM en", ("en",)),
    "clean_text": _with("SELECT doc_id, " + _clean("text") + " AS clean FROM en", ("en",)),
    "tokenize": _with("SELECT doc_id, token, count(*) AS n FROM ctok GROUP BY doc_id, token", ("ctok",)),
    "vocab_tokens": _with("SELECT doc_id, token, count(*) AS n FROM ctok WHERE token IN "
                          "(SELECT term FROM allowed) GROUP BY doc_id, token", ("ctok", "allowed")),
    "stop_words": _with("SELECT s.word, coalesce(h.n, 0) AS n FROM " + STOP_TOPIC + " s LEFT JOIN "
                        "(SELECT word, count(*) AS n FROM rtok GROUP BY word) h ON s.word = h.word",
                        ("rtok",)),
    "stop_words_kept": _with("SELECT s.word, coalesce(h.n, 0) AS n FROM stopkept s LEFT JOIN "
                             "(SELECT token AS word, count(*) AS n FROM ctok GROUP BY token) h "
                             "ON s.word = h.word", ("ctok", "stopkept")),
    "vocabulary": _with("SELECT term, idx FROM vocab", ("vocab",)),
    "word_count": _with("SELECT word, count(*) AS n FROM rtok WHERE word NOT IN (SELECT word FROM "
                        + STOP + ") GROUP BY word ORDER BY n DESC, word LIMIT " + str(counts.TOP_WORDS),
                        ("rtok",)),
    "word_count_by_batch": _with("SELECT batch_id, word, n FROM bw", ("bw",)),
    "top_words_by_batch": _with("SELECT batch_id, batch_start, word, n, CAST(rank AS INTEGER) AS rank "
                                "FROM top", ("top",)),
    "wide_word_rows": _with("SELECT batch_id, 'word_count:' || word AS qualifier, CAST(n AS VARCHAR) "
                            "AS value FROM top", ("top",)),
    "stored_word_rows": _with("SELECT CAST(batch_id AS VARCHAR) AS row_key, 'word_count:' || word AS qualifier, "
                              "CAST(n AS VARCHAR) AS value FROM top", ("top",)),
    "latest_word_count": _with("SELECT batch_id, word, n, CAST(rank AS INTEGER) AS rank FROM top "
                               "WHERE batch_id = (SELECT max(batch_id) FROM top)", ("top",)),
    "long_term_word_count": _with("SELECT word, n FROM long_top", ("long_top",)),
    "retain_latest": _with("SELECT batch_id, word, n, CAST(rank AS INTEGER) AS rank FROM top WHERE "
                           "batch_id IN (SELECT DISTINCT batch_id FROM top ORDER BY batch_id DESC LIMIT "
                           + str(catalog.RETAINED) + ")", ("top",)),
    "term_frequency": _with("SELECT t.doc_id, v.term, v.idx, count(*) AS tf FROM ctok t JOIN vocab v "
                            "ON t.token = v.term GROUP BY t.doc_id, v.term, v.idx", ("ctok", "vocab")),
    "training_rows": _with(
        "SELECT doc_id, label, token, count(*) AS n FROM (SELECT l.doc_id, CASE WHEN l.quality = 0 THEN 0 ELSE 1 END "
        "AS label, unnest(" + _words(_clean("d.text")) + ") AS token FROM labels l JOIN documents d "
        "ON l.doc_id = d.doc_id AND d.lang = 'en') GROUP BY doc_id, label, token", ()),
    "predict": _with("SELECT doc_id, batch_id, score, n_tokens, label FROM scored", ("scored",)),
    "prediction_counts": _with("SELECT batch_id, label, count(*) AS n FROM scored GROUP BY batch_id, label",
                               ("scored",)),
    "sentiment_by_batch": _with("SELECT * FROM by_batch", ("by_batch",)),
    "history_short": _with(_hist(history.SHORT_HISTORY), ("by_batch",)),
    "history_long": _with(_hist(catalog.LONG_HISTORY), ("by_batch",)),
    "sentiment_totals": _with("SELECT CAST(sum(volume) AS BIGINT) AS volume, "
                              "CAST(sum(positive) AS BIGINT) AS positive, "
                              "CAST(sum(negative) AS BIGINT) AS negative, count(*) AS batches "
                              "FROM (SELECT * FROM by_batch "
                              "ORDER BY batch_start DESC LIMIT " + str(catalog.LONG_HISTORY) + ")",
                              ("by_batch",)),
    "history_ranges": _with("SELECT min(volume) AS volume_min, max(volume) AS volume_max, "
                            "least(min(negative), min(positive)) AS sentiment_min, "
                            "greatest(max(negative), max(positive)) AS sentiment_max FROM (SELECT * FROM "
                            "by_batch ORDER BY batch_start DESC LIMIT " + str(history.SHORT_HISTORY) + ")",
                            ("by_batch",)),
    "recent_per_batch": _with("SELECT batch_id, CAST(rank AS INTEGER) AS rank, doc_id, created_at, author, "
                              "text FROM (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY doc_id "
                              "DESC) AS rank FROM en) WHERE rank <= " + str(history.RECENT_TEXTS), ("en",)),
    "last_per_batch": _with("SELECT batch_id, arg_max(doc_id, doc_id) AS doc_id, arg_max(created_at, doc_id) "
                            "AS created_at, arg_max(author, doc_id) AS author, arg_max(text, doc_id) AS text "
                            "FROM en GROUP BY batch_id", ("en",)),
    "recent_tweets": _with("SELECT left(strftime(created_at, " + TWITTER_FMT + "), 19) AS \"Time\", "
                           "text AS \"Tweet\", author AS \"Author\" FROM (SELECT arg_max(created_at, doc_id) "
                           "AS created_at, arg_max(author, doc_id) AS author, arg_max(text, doc_id) AS text "
                           "FROM en GROUP BY batch_id) ORDER BY created_at DESC LIMIT "
                           + str(history.RECENT_TEXTS), ("en",)),
    "polarity_class": _with("SELECT doc_id, sentiment, CASE WHEN sentiment >= "
                            + repr(shape.POLARITY_THRESHOLD) + " THEN 'positive' WHEN sentiment <= -"
                            + repr(shape.POLARITY_THRESHOLD) + " THEN 'negative' ELSE 'neutral' END "
                            "AS polarity FROM senti", ("senti",)),
    "sentiment_bucket": _with("SELECT doc_id, CAST(round_even(sentiment * 2, 0) AS INTEGER) AS half_step, "
                              + _bucket("CAST(round_even(sentiment * 2, 0) AS INTEGER) / 2")
                              + " AS bucket FROM senti", ("senti",)),
    "half_step_label": _with("SELECT doc_id, CAST(round_even(sentiment * 2, 0) AS INTEGER) AS half_step, "
                             + _labels_map("CAST(round_even(sentiment * 2, 0) AS INTEGER)")
                             + " AS label_name FROM senti", ("senti",)),
    "word_cloud_short": _with(_cloud_short(), ("top_all", "weights")),
    "word_cloud_long": _with(_cloud_long("word DESC"), ("long_all",)),
    "word_cloud_long_by_count": _with(_cloud_long("n DESC, word"), ("long_all",)),
    "train_sentiment": _with("SELECT term, idx, true AS better_than_zero FROM vocab", ("vocab",)),
    "backfill_windows": _with("SELECT window_id, " + ORIGIN + " + to_seconds(window_id * "
                              + str(backfill.WINDOW_SECONDS) + ") AS window_time, count(*) AS n_texts "
                              "FROM win GROUP BY window_id", ("win",)),
    "backfill_word_counts": _with(
        "SELECT window_id, word, n, CAST(rank AS INTEGER) AS rank FROM (SELECT window_id, word, n, "
        "row_number() OVER (PARTITION BY window_id ORDER BY n DESC, word) AS rank FROM ("
        "SELECT window_id, word, count(*) AS n FROM (SELECT window_id, unnest(" + _words("text")
        + ") AS word FROM win) WHERE word NOT IN " + STOP_TOPIC + " GROUP BY window_id, word)) "
        "WHERE rank <= " + str(counts.TOP_WORDS), ("win",)),
    "backfill_tweet_rows": _with(
        "SELECT w.window_id, 'tweet_' || CAST(w.pos AS VARCHAR) AS slot, w.text, "
        "CASE WHEN s.n_tokens > 0 THEN s.score / s.n_tokens ELSE 0.0 END AS score, "
        "CAST(CASE WHEN s.n_tokens > 0 THEN s.score / s.n_tokens ELSE 0.0 END > 0 AS INTEGER) AS label "
        "FROM win w JOIN allscore s ON w.doc_id = s.doc_id", ("win", "allscore")),
    "backfill_wide_rows": _with(
        "SELECT CAST(window_id AS VARCHAR) AS row_key, qualifier, value FROM ("
        "SELECT DISTINCT window_id, 'metadata:datetime' AS qualifier, strftime(" + ORIGIN + " + to_seconds(window_id * "
        + str(backfill.WINDOW_SECONDS) + "), '%Y-%m-%d %H:%M:%S') AS value FROM win "
        "UNION ALL SELECT window_id, 'word_count:' || word, CAST(n AS VARCHAR) FROM (SELECT window_id, word, n, "
        "row_number() OVER (PARTITION BY window_id ORDER BY n DESC, word) AS rank FROM ("
        "SELECT window_id, word, count(*) AS n FROM (SELECT window_id, unnest(" + _words("text")
        + ") AS word FROM win) WHERE word NOT IN " + STOP_TOPIC + " GROUP BY window_id, word)) "
        "WHERE rank <= " + str(counts.TOP_WORDS)
        + " UNION ALL SELECT window_id, 'tweet_text:tweet_' || CAST(pos AS VARCHAR), text FROM win "
        "UNION ALL SELECT w.window_id, 'predictions:tweet_' || CAST(w.pos AS VARCHAR) || '_label', "
        "CAST(CAST(CASE WHEN s.n_tokens > 0 THEN s.score / s.n_tokens ELSE 0.0 END > 0 AS INTEGER) AS VARCHAR) "
        "FROM win w JOIN allscore s ON w.doc_id = s.doc_id)", ("win", "allscore")),
    "window_text": _with("SELECT window_id, pos, ' ' || lower(text) AS piece FROM win", ("win",)),
    "track_subjects": _with("SELECT doc_id, batch_id, author FROM en WHERE list_has_any("
                            + _words(_clean("text")) + ", string_split(lower(" + _q(catalog.TRACK_SUBJECTS)
                            + "), ','))", ("en",)),
    "track_term_sets": _with(
        "SELECT DISTINCT doc_id, subject FROM (SELECT doc_id, " + _words(_clean("text")) + " AS tokens FROM en) JOIN ("
        "SELECT lower(trim(unnest(string_split(" + _q(catalog.TRACK_TERM_SETS) + ", ',')))) AS subject) "
        "ON list_has_all(tokens, regexp_split_to_array(subject, '\\s+'))", ("en",)),
    "capture_first_n": _with("SELECT doc_id AS key, " + _tweet_json("tw") + " AS value FROM tw "
                             "ORDER BY doc_id LIMIT " + str(catalog.CAPTURE_N), ("tw",)),
    "encode_messages": _with("SELECT doc_id AS key, " + _tweet_json("tw") + " AS value FROM tw", ("tw",)),
    "decode_messages": _with("SELECT doc_id, strftime(created_at, " + TWITTER_FMT + ") AS created_at, "
                             "lang, text, author, false AS corrupt FROM tw", ("tw",)),
    "events_tumbling": ("SELECT time_bucket(INTERVAL '1 second', ts) AS window_start, event_type, "
                        "count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18, 6))) AS DOUBLE) AS value_sum FROM events "
                        "GROUP BY window_start, event_type"),
}
