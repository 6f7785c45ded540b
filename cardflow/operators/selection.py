"""Ordering, top rows, time-ordered splits and stratified samples."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardflow.functions.columns import spread_key
from cardflow.schema import (
    ID,
    LABEL,
    SNAPSHOT_ROWS,
    SNAPSHOT_SEED,
    TRAIN_FRACTION,
    TS,
)


def order_by_time(df: DataFrame) -> DataFrame:
    """Sort by ``Time`` where the table has it, else by ``timestamp``; then by id if there is one."""
    return df.orderBy("Time" if "Time" in df.columns else TS, *[c for c in (ID,) if c in df.columns])


def pick_by_priority(
    df: DataFrame, column: str, ranking: Sequence[str], tiebreak: str, per: Sequence[str] = ()
) -> DataFrame:
    """Best row by the order of ``ranking``, then by the largest ``tiebreak``.

    Values outside ``ranking`` are not candidates. With ``per``, one row per group.
    """
    candidates = df.filter(F.col(column).isin(*ranking))
    rank = F.array_position(F.array(*[F.lit(v) for v in ranking]), F.col(column))
    if not per:
        return candidates.orderBy(rank, F.col(tiebreak).desc()).limit(1)
    best = Window.partitionBy(*per).orderBy(rank, F.col(tiebreak).desc())
    return candidates.withColumn("_rank", F.row_number().over(best)).filter("_rank = 1").drop("_rank")


# A percentile sketch errs by one of so many rows at most, and rows that are simply sorted.
ACCURACY = 10_000
SORTED_ROWS = 20_000


def _nth_row(rows: DataFrame, n: int, wanted: int) -> tuple | None:
    """Values of all columns, whole numbers, of the ``wanted``-th of ``n`` rows in their order."""
    return _nth_and_tie(rows, n, wanted)[0]


def _nth_and_tie(rows: DataFrame, n: int, wanted: int) -> tuple[tuple | None, bool]:
    """The ``wanted``-th row, and whether the row after it has the same values.

    A percentile sketch brackets the value of the first column in one pass, and exact counts
    around the bracket in a second one tell where the row is, so a sketch that errs costs a
    pass and no row. A bracket has some thousandth of the rows; a few rows left are sorted,
    and rows of one value are told apart by the next column. None when the table is smaller.
    """
    if wanted > n:
        return None, False
    found: list[int] = []
    for name in rows.columns:
        value = F.col(name)
        while n > SORTED_ROWS:
            around = [min(1.0, max(0.0, (wanted + step * n / ACCURACY) / n)) for step in (-2, 2)]
            low, high = rows.agg(F.percentile_approx(name, around, ACCURACY).alias("ends")).first()["ends"]
            below, at_low, between, at_high = rows.agg(
                F.count_if(value < low),
                F.count_if(value == low),
                F.count_if((value > low) & (value < high)),
                F.count_if((value == high) & (value > low)),
            ).first()
            parts = [
                (value < low, below),
                (value == low, at_low),
                ((value > low) & (value < high), between),
                (value == high, at_high),
                (value > high, n - below - at_low - between - at_high),
            ]
            for which, (condition, n) in enumerate(parts):  # noqa: B007
                if wanted <= n:
                    break
                wanted -= n
            rows = rows.filter(condition)
            if which in (1, 3):
                found.append(low if which == 1 else high)
                break
        if n <= SORTED_ROWS:
            two = rows.orderBy(*rows.columns).offset(wanted - 1).limit(2)
            ends = two.agg(F.sort_array(F.collect_list(F.struct(*rows.columns)))).first()[0]
            return tuple(ends[0]), len(ends) == 2 and ends[0] == ends[1]
    return tuple(found), wanted < n


def _up_to(levels: Sequence[Column], found: Sequence) -> Column:
    """Condition for the rows up to and including one with the values of ``_nth_row``."""
    condition: Column = F.lit(True)
    for level, value in reversed(list(zip(levels, found, strict=True))):
        condition = (level < F.lit(value)) | ((level == F.lit(value)) & condition)
    return condition


def _key_levels(key: Column) -> list[Column]:
    """A 32-digit hex key as three whole numbers."""
    return [F.conv(F.substring(key, at, length), 16, 10).cast("long") for at, length in ((1, 15), (16, 15), (31, 2))]


# Rows without a time come after all others.
NO_TIME = "9000-01-01 00:00:00"


def _time_or_last(ts: str) -> Column:
    return F.coalesce(F.col(ts).cast("timestamp"), F.lit(NO_TIME).cast("timestamp"))


def _row_key(row_id: str, seed: int | None = None) -> Column:
    """Spread key of an id; rows without an id share the first key."""
    return F.coalesce(spread_key(F.col(row_id), seed), F.lit("0" * 32))


def _content_key(df: DataFrame) -> Column:
    """A number of a row's content, which orders rows of one id or none."""
    return F.xxhash64(*df.columns)


def _named(levels: Sequence[Column]) -> list[Column]:
    return [level.alias(f"_level_{k}") for k, level in enumerate(levels)]


def _cut(
    df: DataFrame, own: Sequence[Column], keys: DataFrame, levels: Sequence[Column], n: int, wanted: int
) -> tuple[Column, tuple] | None:
    """Condition for the first ``wanted`` of ``n`` rows, and the levels of the last one.

    ``levels`` of ``keys``, which holds only what they are made of, are those that ``own`` makes
    of ``df``. The content of a row counts only among rows that share all levels with the
    last one, and is made of those alone: of all rows it would take every column, and
    so all work that went into them, to find a cut that times and ids tell.
    """
    found, tied = _nth_and_tie(keys.select(*_named(levels)), n, wanted)
    if found is None:
        return None
    if not tied:
        return _up_to(own, found), found
    before = _up_to(levels, found)
    same = reduce(lambda a, b: a & b, [level == F.lit(v) for level, v in zip(levels, found, strict=True)])
    below, equal = keys.agg(F.count_if(before & ~same), F.count_if(same)).first()
    alike = reduce(lambda a, b: a & b, [level == F.lit(v) for level, v in zip(own, found, strict=True)])
    content = df.filter(alike).select(_content_key(df).alias("_content"))
    last = _nth_row(content, equal, wanted - below)
    return _up_to([*own, _content_key(df)], [*found, *last]), found


def _time_cut(
    df: DataFrame, ts: str, row_id: str, fraction: float
) -> tuple[Column, int] | None:
    """Condition for the first ``int(n * fraction)`` rows, and the time of the cut in microseconds."""
    levels = lambda time, key: [F.unix_micros(time), *_key_levels(key)]
    keys = df.select(_time_or_last(ts).alias("_time"), F.col(row_id).alias("_id"))
    keys = keys.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = keys.count()
        wanted = int(n * fraction)
        if wanted == 0:
            return None
        # The key of an id is made where times tie, not for all rows.
        own = levels(_time_or_last(ts), _row_key(row_id))
        condition, found = _cut(df, own, keys, levels(F.col("_time"), _row_key("_id")), n, wanted)
    finally:
        keys.unpersist()
    return condition, found[0]


def mark_train(
    df: DataFrame, ts: str = TS, row_id: str = ID, fraction: float = TRAIN_FRACTION
) -> DataFrame:
    """Add ``is_train``: true for the first ``int(n * fraction)`` rows by time."""
    cut = _time_cut(df, ts, row_id, fraction)
    return df.withColumn("is_train", cut[0] if cut else F.lit(False))


def temporal_split(
    df: DataFrame, ts: str = TS, row_id: str = ID, fraction: float = TRAIN_FRACTION
) -> tuple[DataFrame, DataFrame]:
    """First ``int(n * fraction)`` rows by time, and the rest.

    Rows of one time follow the spread key of their id, then their content; rows
    without an id come first among them, rows without a time after all others. Only
    rows equal in every column stay together. Both sides are filters on
    the input. They also bound the time column by the day of the cut, which lets a
    file scan skip the other side.
    """
    cut = _time_cut(df, ts, row_id, fraction)
    if cut is None:
        return df.filter(F.lit(False)), df
    train, micros = cut
    kind = df.schema[ts].dataType
    day = F.date_trunc("day", F.timestamp_micros(F.lit(micros)))
    start, end = day.cast(kind), (day + F.expr("INTERVAL 1 DAY")).cast(kind)
    unknown = F.col(ts).isNull()
    return (
        df.filter(((F.col(ts) < end) | unknown) & train),
        df.filter(((F.col(ts) >= start) | unknown) & ~train),
    )


def stratified_snapshot(
    df: DataFrame,
    size: int = SNAPSHOT_ROWS,
    label: str = LABEL,
    row_id: str = ID,
    seed: int = SNAPSHOT_SEED,
) -> DataFrame:
    """Sample of ``size`` rows that keeps the share of positives.

    The whole table where it is not larger. Otherwise ``max(1, int(size * rate))``
    positives and the rest negatives, each limited by its stratum; other labels
    count in the rate but are not drawn. Drawn are the smallest spread keys; rows of
    one id, or without one, follow their content.
    """
    keys = df.select(F.col(label).alias("_label"), F.col(row_id).alias("_id"))
    keys = keys.persist(StorageLevel.MEMORY_AND_DISK)
    own = _key_levels(_row_key(row_id, seed))
    try:
        totals = keys.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("_label") == 1).alias("positives"),
            F.count_if(F.col("_label") == 0).alias("negatives"),
        ).first()
        if totals["rows"] <= size:
            return df
        positives = max(1, int(size * (totals["positives"] / totals["rows"])))
        drawn = F.lit(False)
        strata = ((1, positives, totals["positives"]), (0, size - positives, totals["negatives"]))
        for value, wanted, n in strata:
            part = F.col(label) == value
            if wanted:
                stratum = keys.filter(F.col("_label") == value)
                cut = _cut(df.filter(part), own, stratum, _key_levels(_row_key("_id", seed)), n, wanted)
                drawn = drawn | (part & cut[0] if cut else part)
        return df.filter(drawn)
    finally:
        keys.unpersist()
