"""What batches carry over: statistics per card, the last hour's counts, the scaler.

A batch reads the slot of the one before and writes the other slot, so a repeated batch
starts from the same state. The state grows with the number of cards, not with the age of
the system. A row that is more than an hour older than all rows of the batch before it may
miss counts that are no longer kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.operators.features import second_counts, trailing_counts
from cardflow.schema import CARD, HOUR_SECONDS
from cardflow.sources.readers import if_present, read_batch


def moments(df: DataFrame, key: Column, column: str = "amount") -> DataFrame:
    """Count, mean and sum of squared deviations per key, combined before the shuffle."""
    n = F.count(column)
    return df.groupBy(key.alias("_key")).agg(
        n.alias("n"), F.avg(column).alias("mean"), (F.var_pop(column) * n).alias("m2")
    )


def merge_moments(before: DataFrame, new: DataFrame) -> DataFrame:
    """Moments of both together, one row per key of either."""
    a, b = before.alias("a"), new.alias("b")
    n = F.col("a.n") + F.col("b.n")
    apart = F.col("b.mean") - F.col("a.mean")
    both = F.struct(
        n.alias("n"),
        (F.col("a.mean") + apart * F.col("b.n") / n).alias("mean"),
        (F.col("a.m2") + F.col("b.m2") + apart * apart * F.col("a.n") * F.col("b.n") / n).alias("m2"),
    )
    one = {side: F.struct(f"{side}.n", f"{side}.mean", f"{side}.m2") for side in "ab"}
    merged = (
        F.when(F.coalesce(F.col("b.n"), F.lit(0)) == 0, one["a"])
        .when(F.coalesce(F.col("a.n"), F.lit(0)) == 0, one["b"])
        .otherwise(both)
    )
    return a.join(b, F.col("a._key").eqNullSafe(F.col("b._key")), "full_outer").select(
        F.coalesce("a._key", "b._key").alias("_key"), merged.alias("_merged")
    ).select("_key", "_merged.*")


def statistics(state: DataFrame) -> DataFrame:
    """``_key, _mean, _std`` of moments, with the sample deviation."""
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    return state.select("_key", F.col("mean").alias("_mean"), deviation.alias("_std"))


class Carried:
    """The state of one batch under ``root``: reads that of the batch before, writes its own."""

    def __init__(self, spark: SparkSession, root: str, batch_id: str):
        self.spark, self.root, self.batch_id = spark, f"{root}/state", batch_id
        log = if_present(read_batch, spark, f"{self.root}/log")
        last = None if log is None else log.orderBy(F.col("seq").desc()).first()
        if last and batch_id < last["batch_id"]:
            raise ValueError(f"batch {batch_id} lies before {last['batch_id']}")
        self.known = bool(last) and last["batch_id"] == batch_id
        self.seq = 0 if last is None else last["seq"] + (not self.known)

    def _before(self, name: str) -> DataFrame | None:
        if self.seq == 0:
            return None
        return read_batch(self.spark, f"{self.root}/slot={(self.seq - 1) % 2}/{name}")

    def _put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/slot={self.seq % 2}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _merged(self, new: DataFrame, name: str) -> DataFrame:
        before = self._before(name)
        return statistics(self._put(new if before is None else merge_moments(before, new), name))

    def scaler(self, cleaned: DataFrame) -> DataFrame:
        """Mean and deviation of the amounts of all batches so far, one row."""
        return self._merged(moments(cleaned, F.lit(0)), "scaler")

    def cards(self, processed: DataFrame) -> DataFrame:
        """Mean and deviation per card over all batches so far."""
        return self._merged(moments(processed, F.col(CARD)), "cards")

    def trailing(self, processed: DataFrame) -> DataFrame:
        """Trailing counts per card and second; the last hour of earlier batches counts."""
        new, before = second_counts(processed, CARD), self._before("seconds")
        if before is not None:
            first = processed.agg(F.min(F.unix_timestamp("timestamp"))).scalar()
            # Without new rows all is kept.
            recent = F.coalesce(F.col("_second") >= first - HOUR_SECONDS, F.lit(True))
            both = before.filter(recent).unionByName(new)
            new = both.groupBy("_key", "_second").agg(F.sum("_n").alias("_n"))
        return trailing_counts(self._put(new, "seconds"))

    def commit(self) -> None:
        """Make the state the one that the next batch reads; after all sinks are written."""
        if not self.known:
            row = self.spark.range(1).select(
                F.lit(self.seq).alias("seq"), F.lit(self.batch_id).alias("batch_id")
            )
            row.write.mode("append").parquet(f"{self.root}/log")
