"""File sources of the reference: labelled CSV, tweet JSON files, word lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABELLED_SCHEMA = T.StructType([
    T.StructField("sentiment", T.IntegerType(), True),
    T.StructField("text", T.StringType(), True),
])

USER_SCHEMA = T.StructType([T.StructField("screen_name", T.StringType(), True)])

TWEET_SCHEMA = T.StructType([
    T.StructField("created_at", T.StringType(), True),
    T.StructField("lang", T.StringType(), True),
    T.StructField("text", T.StringType(), True),
    T.StructField("user", USER_SCHEMA, True),
])


def read_labelled_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and a fixed schema; unparsable ratings read as NULL."""
    return spark.read.csv(path, schema=LABELLED_SCHEMA, header=True, mode="PERMISSIVE")


def read_tweet_file(spark: SparkSession, path: str, schema: T.StructType = TWEET_SCHEMA) -> DataFrame:
    """A file holding one JSON array of tweet objects (or JSON lines when not multi-line)."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_tweet_lines(spark: SparkSession, path: str, schema: T.StructType = TWEET_SCHEMA) -> DataFrame:
    """JSON lines, one tweet per line: splittable, so it scales past one file per task."""
    return spark.read.schema(schema).json(path)


ARRIVAL_ORDER = ("file", "block", "nth")


def arrival_order() -> list[Column]:
    """Columns that order the records of a file read: file name, place of the block, record in it."""
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("nth")]


def read_word_list(spark: SparkSession, path: str, column: str = "word") -> DataFrame:
    """One word per line, stripped; blank lines and duplicates dropped."""
    return (spark.read.text(path)
            .select(F.trim("value").alias(column))
            .filter(F.col(column) != "")
            .distinct())
