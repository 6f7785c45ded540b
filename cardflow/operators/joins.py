"""Joining rows back to statistics of their key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.session import checkpoint

# Keys with copies that are sent to the rows at most; of more, the rows are shuffled.
SENT_KEYS = 1_000_000


def repeated(df: DataFrame, key: Column) -> tuple[DataFrame, int]:
    """``_value, _rows`` of the keys of more than one row, and their number.

    They are counted when this is called and kept in the shared folder, so a plan that
    looks them up several times, as one over cleaned rows does, counts them once.
    """
    counted = df.groupBy(key.alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    found = checkpoint(counted.filter("_rows > 1"))
    return found, found.count()


def may_send(spark: SparkSession, keys: int) -> bool:
    """Whether so many keys go to the rows; never where the session forbids broadcasts."""
    allowed = spark.conf.get("spark.sql.autoBroadcastJoinThreshold") not in ("-1", "-1b")
    return allowed and keys <= SENT_KEYS


def join_back(df: DataFrame, stats: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Left join of rows to one row per key; ``keys`` maps columns of ``stats`` to keys.

    The adaptive skew join splits a hot key only where both sides are shuffled for
    the join itself. A grouped side would be joined in the partitions it was grouped
    in. Null-safe equality compares derived keys, so Spark shuffles that side, which
    is narrow, once more, and a key with a third of all rows can be split.
    """
    matches = [key.eqNullSafe(stats[name]) for name, key in keys.items()]
    return df.join(stats, reduce(lambda a, b: a & b, matches), "left").drop(*keys)
