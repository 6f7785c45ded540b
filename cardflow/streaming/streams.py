"""Micro-batch processing and event-time operators on streams.

The functions take batch DataFrames too where Spark has the same operator for both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cardflow.operators.features import trailing_counts
from cardflow.plans.preprocess import process_batch
from cardflow.schema import CARD, HOUR_SECONDS, ID, LABEL, TS

LATENESS = "10 minutes"


def start_batches(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    every: str | None = "5 minutes",
    dedupe_first: bool = False,
) -> StreamingQuery:
    """Validate, clean and route each micro-batch.

    Scaler, card statistics and hour counts go on from epoch to epoch (``plans/state.py``).
    The epoch names the batch folder, so a repeated epoch replaces its own output.
    The stream's checkpoint moves on only after all sinks of an epoch are written.
    """

    def run(batch: DataFrame, epoch: int) -> None:
        process_batch(batch, root, f"epoch_{epoch:012d}", dedupe_first=dedupe_first, carry=True)

    return _start(stream, run, checkpoint, every)


def event_time(df: DataFrame, ts: str = TS, lateness: str = LATENESS) -> DataFrame:
    """Rows with a watermark; the time column becomes a zoned timestamp first."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)


def stream_dedupe(stream: DataFrame, key: str = ID, lateness: str = LATENESS) -> DataFrame:
    """One row per id; ids are remembered for the lateness of the watermark."""
    return event_time(stream, lateness=lateness).dropDuplicatesWithinWatermark([key])


def tumbling_counts(df: DataFrame, width: str = "5 minutes", ts: str = TS) -> DataFrame:
    """Rows and positives per interval."""
    return (
        df.groupBy(F.window(F.col(ts).cast("timestamp") if not df.isStreaming else ts, width))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(F.col(LABEL) == 1).alias("fraud_count"),
        )
        .select(F.col("window.start").alias("window_start"), "row_count", "fraud_count")
    )


def sliding_counts(
    df: DataFrame,
    key: str = CARD,
    width: str = "1 hour",
    step: str = "5 minutes",
    ts: str = TS,
) -> DataFrame:
    """Rows per key in overlapping intervals.

    A table is counted per key and pane (the length of a step) first, and only these counts
    are spread over the intervals that hold the pane, where ``width`` is whole steps.
    """
    start = F.col("window.start").alias("window_start")
    if not df.isStreaming and (panes := _steps(df.sparkSession, width, step)):
        pane = F.window(F.col(ts).cast("timestamp"), step)
        counted = df.groupBy(pane, key).agg(F.count(F.lit(1)).alias("_n"))
        back = F.explode(F.sequence(F.lit(0), F.lit(panes - 1))).alias("_back")
        spread = counted.select(start, key, "_n", back)
        begin = F.col("window_start") - F.col("_back") * F.expr(f"INTERVAL {step}")
        return spread.groupBy(begin.alias("window_start"), key).agg(F.sum("_n").alias("row_count"))
    window = F.window(ts if df.isStreaming else F.col(ts).cast("timestamp"), width, step)
    counted = df.groupBy(window, key).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(start, key, "row_count")


def _steps(spark: SparkSession, width: str, step: str) -> int | None:
    """Whole steps in an interval, None where a rest is left."""
    seconds = [f"unix_micros(timestamp_seconds(0) + INTERVAL {x}) AS s{k}" for k, x in enumerate((width, step))]
    long, short = spark.range(1).selectExpr(*seconds).first()
    return long // short if long % short == 0 else None


def session_counts(
    df: DataFrame, key: str = CARD, gap: str = "30 minutes", ts: str = TS
) -> DataFrame:
    """Rows per key and session; a session ends when ``gap`` passes without a row.

    A table is counted per key and second first, so a busy key brings its seconds to
    the session window, not its rows.
    """
    if df.isStreaming:
        counted = df.groupBy(key, F.session_window(ts, gap)).agg(F.count(F.lit(1)).alias("row_count"))
    else:
        second = F.timestamp_seconds(F.unix_timestamp(F.col(ts).cast("timestamp")))
        seconds = df.groupBy(key, second.alias(ts)).agg(F.count(F.lit(1)).alias("_n"))
        counted = seconds.groupBy(key, F.session_window(ts, gap)).agg(
            F.sum("_n").alias("row_count")
        )
    return counted.select(
        key,
        F.col("session_window.start").alias("session_start"),
        F.col("session_window.end").alias("session_end"),
        "row_count",
    )


def stream_second_counts(stream: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Rows per card and second, each emitted once the watermark has passed it.

    Rows are combined before the shuffle, so a busy card is no hot key.
    """
    return (
        event_time(stream, lateness=lateness)
        .groupBy(F.window(TS, "1 second"), CARD)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            F.col(CARD).alias("_key"), F.unix_timestamp("window.start").alias("_second"), "_n"
        )
    )


def start_trailing_counts(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    every: str | None = "5 minutes",
    lateness: str = LATENESS,
) -> StreamingQuery:
    """Exact trailing-hour count per card and second, written to ``root/trailing``.

    An epoch brings the seconds that the watermark has closed, all later than those
    before. The state is the last hour of counts: a table that each epoch replaces
    in the slot that the next epoch reads, so a repeated epoch starts from the same
    state. The count is the batch operator over state and new seconds.
    """

    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        arrived = f"{root}/arrived/slot={epoch % 2}"
        batch.write.mode("overwrite").parquet(arrived)
        new = spark.read.schema(batch.schema).parquet(arrived)
        known = new
        if epoch > 0:
            before = spark.read.schema(batch.schema).parquet(f"{root}/state/slot={(epoch - 1) % 2}")
            known = before.unionByName(new)
        first, last = new.agg(F.min("_second")).scalar(), known.agg(F.max("_second")).scalar()
        counted = trailing_counts(known).filter(F.col("_second") >= first)
        counted.select(*_trailing_columns()).write.mode("overwrite").parquet(f"{root}/trailing/epoch={epoch}")
        known.filter(F.col("_second") >= last - HOUR_SECONDS).write.mode("overwrite").parquet(
            f"{root}/state/slot={epoch % 2}"
        )

    return _start(stream_second_counts(stream, lateness), run, checkpoint, every)


def open_state(spark: SparkSession, checkpoint: str, value: str) -> DataFrame:
    """Groups that a stopped stream's watermark has not passed: ``key``, and ``value`` as given.

    They are read from the state of the last finished micro-batch. An aggregate in append
    mode has emitted, and dropped, every other group, so emitted and open groups together
    are all rows that came in time.
    """
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key", F.col("value").cast(value).alias("value"))


def tumbling_with_open(emitted: DataFrame, checkpoint: str) -> DataFrame:
    """What ``tumbling_counts`` has emitted over a stream, with the intervals still open."""
    state = open_state(emitted.sparkSession, checkpoint, "struct<row_count: bigint, fraud_count: bigint>")
    still = state.select(F.col("key.window.start").alias("window_start"), "value.*")
    return emitted.select(*still.columns).unionByName(still)


def trailing_with_open(spark: SparkSession, root: str, checkpoint: str) -> DataFrame:
    """What ``start_trailing_counts`` has written, with the seconds still open.

    All open seconds are later than the emitted ones, whose last hour is all they need.
    """
    columns = [CARD, "second", "row_count", "tx_count_1h"]
    schema = f"{CARD} string, second bigint, row_count bigint, tx_count_1h bigint"
    emitted = spark.read.schema(f"{schema}, epoch int").parquet(f"{root}/trailing").select(*columns)
    state = open_state(spark, checkpoint, "struct<_n: bigint>")
    still = state.select(
        F.col(f"key.{CARD}").alias("_key"), F.unix_timestamp("key.window.start").alias("_second"), "value._n"
    )
    first = still.agg(F.min("_second")).scalar()
    closed = emitted.select(F.col(CARD).alias("_key"), F.col("second").alias("_second"), F.col("row_count").alias("_n"))
    needed = closed.filter(F.col("_second") >= first - HOUR_SECONDS).unionByName(still)
    counted = trailing_counts(needed).filter(F.col("_second") >= first)
    return emitted.unionByName(counted.select(*_trailing_columns()))


def _trailing_columns() -> list[Column]:
    return [
        F.col("_key").alias(CARD),
        F.col("_second").alias("second"),
        F.col("_n").alias("row_count"),
        F.col("_trailing").alias("tx_count_1h"),
    ]


def _start(
    stream: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str, every: str | None
) -> StreamingQuery:
    """Run each micro-batch; without ``every``, all that is there, then stop."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
