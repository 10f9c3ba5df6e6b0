"""Broadcast only what has a proven size bound.

Lists that are bounded by construction (constants, a top-k, the N newest batch
ids) carry a broadcast hint where they are built.  Anything read from outside has
none: Spark and AQE choose the join from its real size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded(df: DataFrame) -> DataFrame:
    """Mark a DataFrame whose size is bounded by construction for broadcasting."""
    return F.broadcast(df)
