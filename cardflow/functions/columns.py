"""Row-level features, rules and keys as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from cardflow.schema import HIGH_AMOUNT, HOUR_SECONDS, NIGHT_HOURS


def moment(time: datetime, kind: str | DataType = "timestamp") -> Column:
    """A time without a zone as a literal of the session's zone, not of the driver's."""
    return F.lit(time.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(kind)


def moment_text(time: datetime | None) -> str | None:
    """A time as ISO text in whole seconds, as results carry it; None stays None."""
    return None if time is None else time.strftime("%Y-%m-%dT%H:%M:%S")


def is_night_hour(hour: Column) -> Column:
    return F.coalesce(hour.isin(*NIGHT_HOURS).cast("int"), F.lit(0))


def is_high_amount(amount: Column) -> Column:
    return F.coalesce((amount > HIGH_AMOUNT).cast("int"), F.lit(0))


def amount_log1p(amount: Column) -> Column:
    return F.log1p(amount)


def elapsed_time(seconds: Column, epoch: int) -> Column:
    """Time of a count of elapsed seconds; null where the count is missing or NaN."""
    return F.timestamp_seconds(F.when(~F.isnan(seconds), seconds) + F.lit(epoch))


def content_id(columns: Sequence[str], prefix: str) -> Column:
    """Id from a row's content: rows share it only where all columns are equal."""
    return F.concat(F.lit(prefix), F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})))


def hour_from_elapsed(seconds: Column) -> Column:
    """Hour of day of a count of elapsed seconds that starts at midnight."""
    return F.pmod(F.floor(seconds / HOUR_SECONDS), F.lit(24)).cast("int")


def ratio(numerator: Column, denominator: Column, default: float = 0.0) -> Column:
    """Quotient that is ``default`` where the denominator is zero or missing."""
    safe = F.when(denominator != 0, denominator.cast("double"))
    return F.coalesce(numerator / safe, F.lit(default))


def centred(value: Column, mean: Column, std: Column) -> Column:
    """``(value - mean) / std``, 0.0 where the deviation is zero or undefined."""
    return F.coalesce((value - mean) / F.when(std > 0, std), F.lit(0.0))


def iso_second(ts: Column) -> Column:
    """ISO text in whole seconds; the session zone must be UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def week_key(ts: Column) -> Column:
    """``week_YYYYMMDD`` of the Monday that starts the week."""
    return F.concat(F.lit("week_"), F.date_format(F.date_trunc("week", ts), "yyyyMMdd"))


def batch_id(ts: Column, minutes: int = 5) -> Column:
    """Start of the batch interval a time falls into, as ``yyyyMMdd_HHmmss``."""
    width = minutes * 60
    start = F.unix_timestamp(ts) - F.pmod(F.unix_timestamp(ts), F.lit(width))
    return F.date_format(F.timestamp_seconds(start), "yyyyMMdd_HHmmss")


def spread_key(key: Column, seed: int | None = None) -> Column:
    """Evenly spread 32-digit order key of an id, the same on every run."""
    text = key.cast("string")
    return F.md5(text if seed is None else F.concat(F.lit(f"{seed}|"), text))
