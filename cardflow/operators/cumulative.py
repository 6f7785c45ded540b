"""Running totals over a sort order that may hold most rows in one group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardflow.session import checkpoint


def running_totals(df: DataFrame, group: str, order: str, sums: Sequence[str]) -> DataFrame:
    """Add ``upto_<sum>`` per group in the order of ``order``, ``total_<sum>`` of the
    group, and ``next_<order>``.

    A window per group would put a whole group into one task. Here Spark's range
    partitioning cuts the sorted rows into even blocks, the blocks are summed,
    and each block starts from the total of the blocks before it. The blocked rows
    are checkpointed, because the range bounds are sampled anew in each run.
    ``(group, order)`` must be unique.
    """
    blocked = checkpoint(
        df.repartitionByRange(group, order).withColumn("_block", F.spark_partition_id())
    )
    blocks = blocked.groupBy(group, "_block").agg(
        F.min(order).alias("_first"), *[F.sum(c).alias(f"_sum_{c}") for c in sums]
    )
    whole = Window.partitionBy(group)
    by_block = whole.orderBy("_block")
    before = by_block.rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        F.col(group).alias("_group"),
        F.col("_block").alias("_of_block"),
        F.lead("_first").over(by_block).alias("_next_first"),
        *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_start_{c}") for c in sums],
        *[F.sum(f"_sum_{c}").over(whole).alias(f"total_{c}") for c in sums],
    )
    inside = Window.partitionBy("_block", group).orderBy(order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    # Blocks follow the sort order, so there are at most as many (group, block) pairs
    # as partitions and groups together: ``starts`` is small whatever the input is.
    same = (F.col(group) == F.col("_group")) & (F.col("_block") == F.col("_of_block"))
    return (
        blocked.withColumns(
            {f"upto_{c}": F.sum(c).over(upto) for c in sums}
            | {f"next_{order}": F.lead(order).over(inside)}
        )
        .join(F.broadcast(starts), same)
        .withColumns(
            {f"upto_{c}": F.col(f"upto_{c}") + F.col(f"_start_{c}") for c in sums}
            | {f"next_{order}": F.coalesce(f"next_{order}", "_next_first")}
        )
        .drop("_block", "_group", "_of_block", "_next_first", *[f"_start_{c}" for c in sums])
    )
