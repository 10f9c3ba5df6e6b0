"""Exact global row index without a one-partition sort, over the key columns only.

``row_number().over(Window.orderBy(k))`` sends every row to one task.  Instead the
key columns alone are range-partitioned (Spark samples the bounds) and sorted
within partitions, and written once to the shared folder with partition and place,
so that a lost executor can't number them anew.  Then the rows per partition are
counted, their running sum (a row per partition) gives offsets, and index = offset +
place.  All order columns take part in the ranges, so a hot value of the first is
split by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

_PART, _PLACE, _BEFORE = "_pos_part", "_pos_place", "_pos_before"
PLACE_BITS = (1 << 33) - 1      # of monotonically_increasing_id: the place within the partition


def row_index(df: DataFrame, order_cols: list[str] | tuple, index_col: str = "idx") -> DataFrame:
    """(order columns, ``index_col``): 0-based position in the order of the columns, unique per row."""
    cols = list(order_cols)
    placed = (df.select(*cols).repartitionByRange(*cols).sortWithinPartitions(*cols)
              .select(*cols, F.spark_partition_id().alias(_PART),
                      F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE_BITS)).alias(_PLACE)))
    placed = written(placed, "row-index")
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    before = (placed.groupBy(_PART).agg(F.count(F.lit(1)).alias("n"))       # a row per partition
              .select(_PART, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(_BEFORE)))
    return (placed.join(F.broadcast(before), _PART)
            .select(*cols, (F.col(_BEFORE) + F.col(_PLACE)).alias(index_col)))


def with_row_index(df: DataFrame, order_cols: list[str] | tuple, index_col: str = "idx") -> DataFrame:
    """``df`` with its position: a join on the order columns, which must be unique per row and not null."""
    return df.join(row_index(df, order_cols, index_col), list(order_cols)).select(*df.columns, index_col)
