"""Per-card and rolling features, and the schemas features are brought to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardflow.functions.columns import (
    amount_log1p,
    centred,
    content_id,
    elapsed_time,
    hour_from_elapsed,
    is_high_amount,
    is_night_hour,
    iso_second,
    spread_key,
)
from cardflow.operators.cleaning import standardize
from cardflow.operators.joins import join_back
from cardflow.schema import (
    BASELINE_EPOCH,
    CARD,
    FEATURE_TABLE_COLS,
    HOUR_SECONDS,
    ID,
    LABEL,
    MODEL_COLS,
    REQUEST_COLS,
    TS,
    V_COLS,
)

def key_statistics(df: DataFrame, key: str, column: str) -> DataFrame:
    """Mean and sample deviation per key, combined before the shuffle."""
    return df.groupBy(F.col(key).alias("_key")).agg(
        F.avg(column).alias("_mean"), F.stddev_samp(column).alias("_std")
    )


def second_counts(df: DataFrame, key: str, ts: str = TS) -> DataFrame:
    """Rows per key and second, combined before the shuffle."""
    return df.groupBy(F.col(key).alias("_key"), F.unix_timestamp(ts).alias("_second")).agg(
        F.count(F.lit(1)).alias("_n")
    )


def _trailing_sums(
    counts: DataFrame, keys: Sequence[str], at: str, seconds: int = HOUR_SECONDS
) -> DataFrame:
    """Add ``_trailing``: the sum of ``_n`` within ``[t - seconds, t]`` for each ``t`` in ``at``.

    ``(keys, at)`` must be unique. A count enters at ``t`` and leaves after
    ``t + seconds``, so the sum is a running total of entries and exits: a sliding
    frame would add its whole range up again for each row. Each count goes to its own
    time bucket and, with its exit, to the next one. A window over one bucket has at
    most three rows per time in it and the one before, however frequent a key is.
    """
    own = F.floor(F.col(at) / seconds)

    def entry(bucket: Column, when: Column, kind: int, delta: Column) -> Column:
        return F.struct(
            bucket.alias("_bucket"),
            when.alias("_when"),
            F.lit(kind).alias("_kind"),
            delta.alias("_delta"),
        )

    carried, entered, left = 0, 1, 2
    n, time = F.col("_n"), F.col(at)
    events = F.array(
        entry(own, time, entered, n),
        entry(own + 1, time, carried, n),
        entry(own + 1, time + seconds, left, -n),
    )
    # At the same time entries come before exits: the bound t - seconds is inside.
    running = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy("_when", "_kind")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        counts.select("*", F.inline(events))
        .withColumn("_trailing", F.sum("_delta").over(running))
        .filter(F.col("_kind") == entered)
        .drop("_bucket", "_when", "_kind", "_delta")
    )


def trailing_counts(counts: DataFrame, seconds: int = HOUR_SECONDS) -> DataFrame:
    """Rows of a key within ``[t - seconds, t]``, for each of its counted seconds ``t``."""
    return _trailing_sums(counts, ["_key"], "_second", seconds)


def zscore_by(
    df: DataFrame, key: str = CARD, column: str = "amount", out: str = "amount_zscore"
) -> DataFrame:
    """Score of a value among the rows of its key; 0.0 where that has no spread."""
    stats = key_statistics(df, key, column)
    return (
        join_back(df, stats, {"_key": F.col(key)})
        .withColumn(out, centred(F.col(column), F.col("_mean"), F.col("_std")))
        .drop("_mean", "_std")
    )


def trailing_count(
    df: DataFrame,
    key: str = CARD,
    ts: str = TS,
    seconds: int = HOUR_SECONDS,
    out: str = "tx_count_1h",
) -> DataFrame:
    """Rows of the same key in the trailing interval, all peers of a second included."""
    counts = trailing_counts(second_counts(df, key, ts), seconds).drop("_n")
    keys = {"_key": F.col(key), "_second": F.unix_timestamp(ts)}
    return (
        join_back(df, counts, keys)
        .withColumn(out, F.col("_trailing").cast("int"))
        .drop("_trailing")
    )


def trailing_count_global(
    df: DataFrame,
    elapsed: str,
    row_id: str,
    seconds: int = HOUR_SECONDS,
    out: str = "tx_count_1h",
) -> DataFrame:
    """Rows within ``[t - seconds, t]`` up to the own position in time order.

    Rows of one time are ordered by the first digits of the id's spread key, then
    by id, which must be unique. A time is ranked as up to 65,536 cells, one per
    prefix, and offsets are added from cell totals. A row without a time stays and
    has no count.
    """
    prefix = F.coalesce(F.substring(spread_key(F.col(row_id)), 1, 4), F.lit(""))
    ranked = df.withColumn("_t", F.col(elapsed)).withColumn("_cell", prefix)
    cells = ranked.filter("_t is not null").groupBy("_t", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    times = cells.groupBy("_t").agg(F.sum("_n").alias("_n"))
    base = _trailing_sums(times, [], "_t", seconds).select(
        "_t", (F.col("_trailing") - F.col("_n")).alias("_base")
    )
    before = Window.partitionBy("_t").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    base = offsets.join(base, "_t").select(
        "_t", "_cell", (F.col("_offset") + F.col("_base")).alias("_base")
    )
    position = F.row_number().over(Window.partitionBy("_t", "_cell").orderBy("_cell", row_id))
    return (
        ranked.withColumn("_position", position)
        .join(base, ["_t", "_cell"], "left")
        .withColumn(out, (F.col("_base") + F.col("_position")).cast("int"))
        .select(*df.columns, out)
    )


def add_row_features(df: DataFrame) -> DataFrame:
    """Features that need only the row itself."""
    return (
        df.withColumn("is_night_hour", is_night_hour(F.col("hour_of_day")))
        .withColumn("amount_log1p", amount_log1p(F.col("amount")))
        .withColumn("is_high_amount", is_high_amount(F.col("amount")))
    )


def add_features(df: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Processed rows to the feature table, in the fixed column order.

    ``history`` holds earlier processed rows: they count towards the per-card
    statistics and the trailing hour, but only rows of ``df`` are returned. The
    narrow statistics are joined first, so the wide rows are shuffled once.
    """
    narrow = [ID, CARD, TS, "amount"]
    seen = df.select(*narrow)
    recent = seen
    if history is not None:
        seen = seen.unionByName(history.select(*narrow))
        start = df.agg(F.min(TS)).scalar() - F.expr("INTERVAL 1 HOUR")
        recent = recent.unionByName(history.select(*narrow).filter(F.col(TS) >= start))
    per_card = key_statistics(seen, CARD, "amount")
    counts = trailing_counts(second_counts(recent, CARD))
    return attach_features(df, per_card, counts)


def attach_features(df: DataFrame, per_card: DataFrame, counts: DataFrame) -> DataFrame:
    """Processed rows with given statistics per card and trailing counts per card and second."""
    cards = per_card.select(F.col("_key").alias("_card"), "_mean", "_std")
    stats = join_back(counts.drop("_n"), cards, {"_card": F.col("_key")})
    keys = {"_key": F.col(CARD), "_second": F.unix_timestamp(TS)}
    return (
        join_back(add_row_features(df), stats, keys)
        .withColumn("amount_zscore", centred(F.col("amount"), F.col("_mean"), F.col("_std")))
        .withColumn("tx_count_1h", F.col("_trailing").cast("int"))
        .select(*FEATURE_TABLE_COLS)
    )


def select_features(df: DataFrame) -> DataFrame:
    """The feature table as it is stored: fixed columns, ISO text time."""
    return df.select(*FEATURE_TABLE_COLS).withColumn(TS, iso_second(F.col(TS)))


def select_available(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The listed columns that exist, in list order, and the names that do not."""
    found = [c for c in columns if c in df.columns]
    return df.select(*found), [c for c in columns if c not in df.columns]


def canonicalize_baseline(
    df: DataFrame, row_id: str | None = None, epoch: int = BASELINE_EPOCH
) -> DataFrame:
    """Baseline rows (``Time, V*, Amount, Class``) to model columns, label, id and time.

    ``Time`` counts seconds from ``epoch``, so baseline rows have a place in time among
    the rows of other sources; a row without it has no time. Without ``row_id`` the id
    is made from the content. Rows that share an id are then equal in every column, so
    it doesn't matter which of them the trailing count takes first.
    """
    if row_id is None:
        df = df.withColumn(ID, content_id(df.columns, "BASE_"))
        row_id = ID
    else:
        df = df.withColumn(ID, F.concat(F.lit("BASE_"), F.col(row_id)))
    named = df.withColumnRenamed("Amount", "amount").withColumns(
        {
            LABEL: F.col("Class").cast("int"),
            TS: elapsed_time(F.col("Time"), epoch),
            "hour_of_day": hour_from_elapsed(F.col("Time")),
            "is_international": F.lit(0),
        }
    )
    scaled = standardize(add_row_features(named)).withColumn(
        "amount_zscore", F.col("amount_normalized")
    )
    counted = trailing_count_global(scaled, "Time", row_id)
    keys = [c for c in (row_id,) if c != ID]
    return counted.select(*keys, "Time", *MODEL_COLS, LABEL, ID, TS)


def canonicalize_inference(df: DataFrame) -> DataFrame:
    """Logged rows to drift columns: model columns that exist and the prediction."""
    renamed = df.withColumnsRenamed(
        {"Amount": "amount", "Predicted_Class": "predicted_fraud"}
    )
    return select_available(renamed, [*MODEL_COLS, "predicted_fraud"])[0]


def to_request_rows(
    df: DataFrame, limit: int | None = None, order: Sequence[str] = (TS, ID)
) -> DataFrame:
    """Scoring request rows: hour as ``Time``, absent components as 0.0."""
    if limit is not None:
        df = df.orderBy(*order).limit(limit)
    hour = F.col("hour_of_day").cast("double") if "hour_of_day" in df.columns else F.lit(0.0)
    components = [
        (F.col(v).cast("double") if v in df.columns else F.lit(0.0)).alias(v) for v in V_COLS
    ]
    return df.select(
        hour.alias("Time"), F.col("amount").cast("double").alias("Amount"), *components
    ).select(*REQUEST_COLS)


def to_request_json(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Request rows as one JSON object per row."""
    rows = to_request_rows(df, limit)
    return rows.select(F.to_json(F.struct(*REQUEST_COLS)).alias("request"))
