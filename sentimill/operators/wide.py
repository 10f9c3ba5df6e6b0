"""Stored wide rows: a row key with qualifiers that the data name, as maps in shards of bounded size.

``cells`` (row_key, qualifier, value) become rows (row_key, version, shard, cells), a map of about
``SHARD_CELLS`` qualifiers each, so a row of any width is stored and written by many tasks, and no
cell list of a row is ever gathered whole.  Cells are dealt to shards by the hash of the qualifier.  A put
adds a version; where versions name the same qualifier the later one holds, as in a wide-column store.

Reading gives cells again (``read_cells``), or whole rows where the caller knows them to be
narrow (``read_rows``, ``get``): there the shards are merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SHARD_CELLS = 1000
WIDE_SCHEMA = "row_key string, version bigint, shard int, cells map<string, string>"


def sharded(cells: DataFrame, version: int = 0, shard_cells: int = SHARD_CELLS) -> DataFrame:
    """``WIDE_SCHEMA`` of (row_key, qualifier, value); of equal qualifiers of a row the greatest value holds.

    A row's number of shards follows from its number of cells (counted with a partial step).
    """
    one = cells.groupBy("row_key", "qualifier").agg(F.max("value").alias("value"))
    shards = (cells.groupBy("row_key").agg(F.count(F.lit(1)).alias("n"))
              .select("row_key", F.ceil(F.col("n") / shard_cells).alias("shards")))
    dealt = one.join(shards, "row_key").withColumn("shard", F.pmod(F.xxhash64("qualifier"), "shards").cast("int"))
    return (dealt.groupBy("row_key", "shard")
            .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("qualifier", "value")))).alias("cells"))
            .select("row_key", F.lit(version).cast("bigint").alias("version"), "shard", "cells"))


def put(cells: DataFrame, path: str, version: int = 0, shard_cells: int = SHARD_CELLS) -> None:
    """Add a version: rows sorted by key within files, so that a get reads few row groups."""
    rows = sharded(cells, version, shard_cells)
    rows.sortWithinPartitions("row_key", "shard").write.mode("append").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(WIDE_SCHEMA).parquet(path)


def read_cells(table: DataFrame, family: str | None = None) -> DataFrame:
    """(row_key, qualifier, value): the newest version of every cell; ``family``: of qualifiers ``family:...`` only."""
    cells = table.select("row_key", "version", F.explode("cells").alias("qualifier", "value"))
    if family:
        cells = cells.filter(F.startswith("qualifier", F.lit(family + ":")))
    return (cells.groupBy("row_key", "qualifier").agg(F.max_by("value", "version").alias("value")))


def read_rows(table: DataFrame) -> DataFrame:
    """(row_key, cells): shards and versions merged into one map a row (for rows that fit one value)."""
    later = Window.partitionBy("row_key").orderBy("version", "shard").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    maps = table.withColumn("maps", F.collect_list("cells").over(later)).dropDuplicates(["row_key"])
    merged = F.aggregate("maps", F.create_map().cast("map<string,string>"),
                         lambda a, x: F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(x, k)), x))
    return maps.select("row_key", merged.alias("cells"))


def get(table: DataFrame, row_key: str) -> DataFrame:
    """The row of one key, merged: a pushed filter, so only row groups with the key are read."""
    return read_rows(table.filter(F.col("row_key") == row_key))
