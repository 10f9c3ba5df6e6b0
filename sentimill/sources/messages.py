"""Messages on a topic: encode records to JSON values, decode them back.

The Kafka connector is not part of plain PySpark; ``kafka_stream`` and
``write_kafka`` only name the options and fail with Spark's own error when the
connector jar is missing.  The same ``decode_messages`` runs on a file stream.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import to_twitter_date, tweet_tokens
from .files import TWEET_SCHEMA

CORRUPT_COLUMN = "_corrupt_record"
MESSAGE_FIELDS = ("key", "value")     # of a stored message


def tweet_struct(df: DataFrame) -> DataFrame:
    """Tweet view rows → the tweet object of the reference (nested user)."""
    return df.select(
        "doc_id",
        F.struct(
            to_twitter_date("created_at").alias("created_at"),
            F.col("lang"),
            F.col("text"),
            F.struct(F.col("author").alias("screen_name")).alias("user"),
        ).alias("tweet"),
    )


def encode_messages(df: DataFrame, key: str | None = "doc_id") -> DataFrame:
    """Tweet view rows → (key, value) with the JSON object as the value."""
    shaped = tweet_struct(df)
    cols = [F.to_json("tweet").alias("value")]
    if key:
        cols.insert(0, F.col(key).alias("key"))
    return shaped.select(*cols)


def decode_messages(values: DataFrame, value_col: str = "value",
                    schema: T.StructType = TWEET_SCHEMA) -> DataFrame:
    """JSON values → tweet columns; bad JSON lands in ``_corrupt_record``.

    PERMISSIVE keeps the batch alive on bad input; single quotes are refused so
    that only real JSON passes.
    """
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])
    parsed = F.from_json(
        F.col(value_col).cast("string"), with_corrupt,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN,
         "allowSingleQuotes": "false"})
    keep = [c for c in values.columns if c != value_col]
    return values.select(*keep, parsed.alias("m")).select(
        *keep,
        F.col("m.created_at").alias("created_at"),
        F.col("m.lang").alias("lang"),
        F.col("m.text").alias("text"),
        F.col("m.user.screen_name").alias("author"),
        F.col(f"m.{CORRUPT_COLUMN}").alias(CORRUPT_COLUMN),
    )


def capture_first_n(df: DataFrame, n: int, order_col: str = "doc_id") -> DataFrame:
    """Bounded capture: the first ``n`` messages in arrival order (a top-n, not a sample)."""
    return df.orderBy(order_col).limit(n)


def track(df: DataFrame, subjects: str, tokens_col: str = "tokens") -> DataFrame:
    """Keep records whose tokens contain any of a comma-separated list of subjects."""
    wanted = F.transform(F.split(F.lower(F.lit(subjects)), ","), F.trim)
    return df.filter(F.arrays_overlap(F.col(tokens_col), wanted))


def subject_terms(subjects: DataFrame, col: str = "subject") -> DataFrame:
    """(subject, term, n_terms) of subjects of one or more words: lower case, equal words once; blank ones go."""
    terms = F.array_distinct(F.filter(F.split(F.lower(F.trim(col)), r"\s+"), lambda t: t != ""))
    named = subjects.select(F.lower(F.trim(col)).alias("subject"), terms.alias("terms")).filter(F.size("terms") > 0).dropDuplicates(["subject"])
    return named.select("subject", F.explode("terms").alias("term"), F.size("terms").alias("n_terms"))


def split_subjects(spark: SparkSession, subjects: str) -> DataFrame:
    """A comma-separated list of subjects as a table."""
    return spark.range(1).select(F.explode(F.split(F.lit(subjects), ",")).alias("subject"))


def track_subjects(docs: DataFrame, subjects: DataFrame, key: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """(key, subject): the subjects all of whose words are among a record's tokens, in any order.

    ``key`` names a record.  Tokens meet subjects by one (term -> subject) join, whatever the number of subjects: each
    different token of a record once, those of no subject drop out there; then the terms met are counted
    per record and subject.  Spark broadcasts the terms if they are few and shuffles both sides if not.
    """
    terms = subject_terms(subjects)
    tokens = docs.select(F.col(key), F.explode(F.array_distinct(tokens_col)).alias("term")).filter("term is not null")
    return (tokens.join(terms, "term").groupBy(key, "subject", "n_terms").agg(F.count(F.lit(1)).alias("n"))
            .filter("n = n_terms").select(key, "subject"))


def about(values: DataFrame, subjects: str, value_col: str = "value") -> DataFrame:
    """Messages whose text has all words of any of a comma-separated list of subjects, on a stream as on a table.

    A list given by hand is a row condition; for a table of many subjects see ``track_subjects``.
    """
    sets = [sorted({w for w in s.lower().split()}) for s in subjects.split(",")]
    shape = T.StructType([f for f in TWEET_SCHEMA.fields if f.name == "text"])
    tokens = tweet_tokens(F.from_json(F.col(value_col).cast("string"), shape)["text"])
    found = [F.size(F.array_intersect(tokens, F.array(*[F.lit(w) for w in words]))) == len(words) for words in sets if words]
    return values.filter(reduce(lambda a, b: a | b, found)) if found else values.limit(0)


def kafka_values(raw: DataFrame) -> DataFrame:
    """Kafka records → (key, value, part, arrived): a message is named by its partition and offset."""
    return raw.select(F.col("offset").alias("key"), F.col("value").cast("string").alias("value"),
                      F.col("partition").alias("part"), F.col("timestamp").alias("arrived"))


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    (messages.select(F.col("key").cast("string"), "value").write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def write_json_lines(messages: DataFrame, path: str, mode: str = "append") -> None:
    """The file twin of publishing: one message per line, as the replay reads them."""
    messages.select(*MESSAGE_FIELDS).write.mode(mode).json(path)
