"""Bounded capture of a live stream, and paced replay of a stored file.

``start_capture`` keeps exactly the first n messages of a stream, over micro-batches and restarts, and
``capture`` stops the query then.  ``replay_array`` lets the records of a stored file arrive at a
rate: record k in second k div rate.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.position import row_index
from ..session import folder
from ..sources import files

POLL_SECONDS = 0.2
ARRAY_ROWS = 1 << 16          # rows of a file of a stored array, sorted by place


class Counts:
    """Numbers by epoch, one small file each, renamed into place."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.root = spark, path.rstrip("/")

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def all(self) -> dict[int, int]:
        """By epoch.  The name holds the number, so this is a listing."""
        fs, root = self._fs(), self._path(self.root)
        names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        return {int(e): int(n) for e, n in (name.split(".") for name in names if name[0].isdigit())}

    def put(self, epoch: int, n: int) -> None:
        fs, aside = self._fs(), self._path(f"{self.root}/_aside-{uuid.uuid4().hex}")
        fs.create(aside).close()
        fs.rename(aside, self._path(f"{self.root}/{epoch}.{n}"))


class CaptureSink:
    """``foreachBatch`` function: the messages of a micro-batch that are still wanted, in order of arrival.

    What is wanted follows from the counts of earlier epochs, so an epoch replayed after a failure writes
    the same messages over its own folder.
    """

    def __init__(self, out_dir: str, n: int, order_cols: tuple = ("key",)):
        self.out_dir, self.n, self.order = out_dir.rstrip("/"), n, order_cols

    def taken(self, spark: SparkSession, before: int | None = None) -> int:
        return sum(n for e, n in Counts(spark, f"{self.out_dir}/_counts").all().items() if before is None or e < before)

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        left = self.n - self.taken(spark, epoch)
        counts = Counts(spark, f"{self.out_dir}/_counts")
        if left <= 0 or epoch in counts.all():
            return
        path = f"{self.out_dir}/messages/epoch={epoch}"
        batch.orderBy(*self.order).limit(left).write.mode("overwrite").json(path)      # an ordered limit of n rows at most
        counts.put(epoch, spark.read.schema(batch.schema).json(path).count())


def start_capture(values: DataFrame, out_dir: str, n: int, order_cols: tuple = ("key",), checkpoint: str | None = None,
                  trigger: dict | None = None) -> StreamingQuery:
    """A query that writes the first n messages to ``<out_dir>/messages`` and then nothing more."""
    writer = values.writeStream.foreachBatch(CaptureSink(out_dir, n, order_cols)).option(
        "checkpointLocation", checkpoint or f"{out_dir.rstrip('/')}/_checkpoint")
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()


def capture(values: DataFrame, out_dir: str, n: int, **options) -> int:
    """Capture until n messages are stored or the stream ends by itself; how many there are.

    Started again after a stop it goes on where it was, and does nothing where n are there already.
    """
    spark, sink = values.sparkSession, CaptureSink(out_dir, n)
    if sink.taken(spark) < n:
        query = start_capture(values, out_dir, n, **options)
        while query.isActive and sink.taken(spark) < n:
            time.sleep(POLL_SECONDS)
        if query.isActive:
            query.stop()
        if query.exception() is not None:
            raise query.exception()
    return sink.taken(spark)


def read_capture(spark: SparkSession, out_dir: str, schema: str = "key bigint, value string") -> DataFrame:
    """The captured messages: only epochs whose count is stored (others are being written)."""
    epochs = sorted(Counts(spark, f"{out_dir.rstrip('/')}/_counts").all())
    paths = [f"{out_dir.rstrip('/')}/messages/epoch={e}" for e in epochs]
    return spark.read.schema(schema).json(paths) if paths else spark.createDataFrame([], schema)


def store_array(spark: SparkSession, tweets_path: str, multiline: bool = True) -> str:
    """A stored file of records as (idx, value) in order of arrival, sorted, in the shared folder; its path.

    The place of a record comes from file name, block and record; values are messages as a topic has them.
    """
    reader = files.read_tweet_file if multiline else files.read_tweet_lines
    rows = reader(spark, tweets_path)
    named = rows.select(*files.arrival_order(), F.to_json(F.struct(*rows.columns)).alias("value"))
    landed = folder(spark, "array-records")
    named.write.parquet(landed)                            # places are those of one read
    named = spark.read.schema(named.schema).parquet(landed)
    placed = named.join(row_index(named, files.ARRIVAL_ORDER, "idx"), list(files.ARRIVAL_ORDER)).select("idx", "value")
    path = folder(spark, "array")
    n = placed.count()
    placed.repartitionByRange(max(1, -(-n // ARRAY_ROWS)), "idx").sortWithinPartitions("idx").write.parquet(path)
    return path


def replay_array(spark: SparkSession, stored: str, sink: Callable[[DataFrame, int], None], rate: int, checkpoint: str,
                 trigger: dict | None = None, start_millis: int = 0) -> StreamingQuery:
    """Feed a stored array to a ``foreachBatch`` function, ``rate`` records a second, as (key, value, arrived).

    The rate source counts rows and time in step: micro-batch k holds numbers k * rate .. (k + 1) * rate - 1 and
    their second, however late it runs.  The records of these numbers are looked up by literal bounds on the sorted
    table, so each second reads the row groups that hold it and nothing else.
    """
    ticks = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rate).option("numPartitions", 1)
             .option("startTimestamp", start_millis).option("advanceMillisPerBatch", 1000).load())

    def tick(batch: DataFrame, epoch: int) -> None:
        first, last, second = batch.agg(F.min("value"), F.max("value"), F.min(F.unix_millis("timestamp"))).first()
        if first is None:
            return
        rows = batch.sparkSession.read.schema("idx bigint, value string").parquet(stored)
        rows = rows.filter((F.col("idx") >= first) & (F.col("idx") <= last))
        sink(rows.select(F.col("idx").alias("key"), "value", F.timestamp_millis(F.lit(second)).alias("arrived")), epoch)

    return (ticks.writeStream.foreachBatch(tick).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 second"})).start())


def replay_to_end(spark: SparkSession, stored: str, sink: Callable[[DataFrame, int], None], rate: int, checkpoint: str,
                  **options) -> None:
    """``replay_array``, stopped when every record has arrived."""
    total = spark.read.parquet(stored).count()
    done = []

    def counted(batch: DataFrame, epoch: int) -> None:
        sink(batch, epoch)
        done.append((epoch + 1) * rate)

    query = replay_array(spark, stored, counted, rate, checkpoint, **options)
    while query.isActive and (not done or done[-1] < total):
        time.sleep(POLL_SECONDS)
    if query.isActive:
        query.stop()
    if query.exception() is not None:
        raise query.exception()
