"""Deduplication, cleaning rules and standardisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardflow.functions.columns import centred, iso_second
from cardflow.operators.joins import may_send, repeated
from cardflow.schema import (
    CRITICAL_COLS,
    ID,
    LABEL,
    MAX_AMOUNT,
    MERCHANT_CATEGORIES,
    PROCESSED_COLS,
    TS,
)
from cardflow.session import checkpoint, stored


def present(df: DataFrame, name: str) -> Column:
    """True where a column holds a value; NaN counts as missing."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.expr(f"(`{name}` IS NOT NULL AND NOT isnan(`{name}`))")
    return F.expr(f"`{name}` IS NOT NULL")


def dedupe(
    df: DataFrame, keys: Sequence[str] = (ID,), order: Sequence[str] = (TS, "amount"), keep: bool = False
) -> DataFrame:
    """Keep the first row per key in ``order``.

    Only hashes of keys are shuffled to find those with copies, when this is called.
    Rows of all other keys stay where they are; rows that share a hash are ranked.
    With more such hashes than can be sent to the rows, all rows are ranked.

    ``keep`` ranks rows that share a hash when this is called and keeps the first of each key
    in the shared folder, for results that are read several times.
    """
    hashed = F.xxhash64(*keys)
    copies, n = repeated(df, hashed)
    if n == 0:
        return df
    if not may_send(df.sparkSession, n):
        return _first_rows(df, keys, order)
    sent = F.broadcast(copies.select("_value"))
    alone, several = (df.join(sent, hashed == sent["_value"], how) for how in ("left_anti", "left_semi"))
    first = _first_rows(several, keys, order)
    return alone.unionByName(stored(first) if keep else first)


def _first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key.

    ``row_number() = 1`` makes Spark keep one row per key in each map task before
    the shuffle (WindowGroupLimit), so a key with a third of all rows arrives as
    one row per task. Rows that tie on ``order`` are told apart by their content.
    """
    first = Window.partitionBy(*keys).orderBy(*order, "_content")
    return (
        df.withColumn("_content", F.xxhash64(*df.columns))
        .withColumn("_rank", F.row_number().over(first))
        .filter("_rank = 1")
        .drop("_rank", "_content")
    )


def drop_critical_nulls(df: DataFrame, columns: Sequence[str] = CRITICAL_COLS) -> DataFrame:
    return df.na.drop(subset=list(columns))


def fill_defaults(df: DataFrame) -> DataFrame:
    # Fixed values for missing attributes.
    return df.na.fill(
        {
            "merchant_id": "UNKNOWN",
            "merchant_category": "other",
            "is_international": False,
            "hour_of_day": -1,
        }
    )


def normalize_timestamp(df: DataFrame, column: str = TS) -> DataFrame:
    """Epoch nanoseconds, ISO text or a timestamp to a timestamp in whole seconds."""
    value = F.col(column)
    if isinstance(df.schema[column].dataType, (T.LongType, T.IntegerType)):
        value = F.expr(f"timestamp_micros(`{column}` div 1000)")
    return df.withColumn(column, F.date_trunc("second", value.cast("timestamp")))


def clamp_amount(df: DataFrame, column: str = "amount", high: float = MAX_AMOUNT) -> DataFrame:
    """Drop negative amounts and cut larger ones to ``high``."""
    capped = F.least(F.col(column).cast("double"), F.lit(high))
    return df.filter(F.col(column) >= 0).withColumn(column, capped)


def normalize_category(df: DataFrame, column: str = "merchant_category") -> DataFrame:
    known = F.when(F.col(column).isin(*MERCHANT_CATEGORIES), F.col(column))
    return df.withColumn(column, F.coalesce(known, F.lit("other")))


def fit_scaler(df: DataFrame, column: str = "amount") -> DataFrame:
    """One row ``amount_mean, amount_std``; a zero or missing deviation becomes 1.0."""
    return df.agg(
        F.avg(column).alias("amount_mean"), F.stddev_samp(column).alias("_std")
    ).select(
        "amount_mean",
        F.coalesce(F.when(F.col("_std") > 0, F.col("_std")), F.lit(1.0)).alias("amount_std"),
    )


def apply_scaler(
    df: DataFrame, stats: DataFrame, column: str = "amount", out: str = "amount_normalized"
) -> DataFrame:
    """Scale with fitted statistics, read as a scalar subquery of one row."""
    fitted = stats.select(F.struct("amount_mean", "amount_std")).scalar()
    value = (F.col(column) - F.col("_fitted.amount_mean")) / F.col("_fitted.amount_std")
    return df.withColumn("_fitted", fitted).withColumn(out, value).drop("_fitted")


def standardize(
    df: DataFrame,
    column: str = "amount",
    out: str = "amount_normalized",
    stats: DataFrame | None = None,
) -> DataFrame:
    """Centre and scale by the sample deviation of all rows; 0.0 where it is zero.

    ``stats`` gives the two in one row ``_mean, _std`` instead. Else they are found when
    this is called and kept in the shared folder: as a plan of its own they would be
    planned, and found, again for each rule and statistic that reads a scaled row.
    """
    if stats is None:
        stats = checkpoint(df.agg(F.avg(column).alias("_mean"), F.stddev_samp(column).alias("_std")))
    fitted = stats.agg(F.first(F.struct("_mean", "_std"))).scalar()
    value = centred(F.col(column), F.col("_stats._mean"), F.col("_stats._std"))
    return df.withColumn("_stats", fitted).withColumn(out, value).drop("_stats")


def clean_rows(df: DataFrame) -> DataFrame:
    """All cleaning rules except standardisation.

    Whether a row is complete is decided before the dedupe, so a later pass that
    needs only ``amount`` does not move the 28 components of rows with copies. Which copies
    stay is found once: their order asks for all columns, and cleaned rows are read several times.
    """
    complete = F.lit(True)
    for name in CRITICAL_COLS:
        complete = complete & present(df, name)
    survivors = dedupe(df.withColumn("_complete", complete), keep=True).filter("_complete")
    return (
        survivors.drop("_complete")
        .transform(clamp_amount)
        .transform(fill_defaults)
        .transform(normalize_category)
        .transform(normalize_timestamp)
        .withColumn("is_international", F.col("is_international").cast("int"))
        .withColumn(LABEL, F.col(LABEL).cast("int"))
    )


def clean_transactions(df: DataFrame) -> DataFrame:
    """Raw rows to processed rows with the standardised amount, in the fixed order."""
    return standardize(clean_rows(df)).select(*PROCESSED_COLS)


def select_processed(df: DataFrame) -> DataFrame:
    """The processed table as it is stored: fixed columns, ISO text time."""
    return df.select(*PROCESSED_COLS).withColumn(TS, iso_second(F.col(TS)))
