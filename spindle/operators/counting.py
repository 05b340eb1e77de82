"""Counting family: in-degree (follower) counts and their maximum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def follower_count(edges: DataFrame, key: str = "dst", out: str = "cnt") -> DataFrame:
    """Rows per ``key`` (followers per followee).

    A plain ``groupBy().count()``: Spark plans a partial (map-side) hash
    aggregate before the shuffle, so a key holding a third of all edges
    still ships one partial row per map task, not its edges.
    """
    return edges.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(out))


def max_count(counts: DataFrame, col: str = "cnt", out: str = "max_cnt") -> DataFrame:
    """One-row maximum, computed (the reference hard-codes it)."""
    return counts.agg(F.max(col).alias(out))
