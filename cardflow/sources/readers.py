"""Incremental, batch, weekly and tolerant reads."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardflow.functions.columns import moment
from cardflow.operators.features import select_available
from cardflow.schema import BASELINE_SCHEMA, LABEL, MODEL_COLS, TS

BATCH_FORMAT = "%Y%m%d_%H%M%S"


def incremental_scan(
    df: DataFrame,
    batch_end: datetime,
    last: datetime | None = None,
    ts: str = TS,
    minutes: int = 5,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows with ``last < ts <= batch_end``; ``last`` defaults to one interval earlier.

    ``columns`` names what to read, such as ``RAW_COLS``; None reads all.

    The bounds take the column's own type, so the comparison reaches the file or
    JDBC scan without a cast around the column.
    """
    last = last or batch_end - timedelta(minutes=minutes)
    kind = df.schema[ts].dataType
    low, high = moment(last, kind), moment(batch_end, kind)
    rows = df.filter((F.col(ts) > low) & (F.col(ts) <= high))
    return rows if columns is None else rows.select(*columns)


def is_empty_batch(df: DataFrame) -> bool:
    return df.isEmpty()


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    bounds: tuple[datetime, datetime],
    partitions: int,
    ts: str = TS,
    **options: str,
) -> DataFrame:
    """A relational table over JDBC, read in parallel by ranges of its time column."""
    return spark.read.jdbc(
        url,
        table,
        column=ts,
        lowerBound=str(bounds[0]),
        upperBound=str(bounds[1]),
        numPartitions=partitions,
        properties=options,
    )


def read_batch(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_stage(spark: SparkSession, root: str, stage: str) -> DataFrame:
    """Rows of all batches of a stage that passed their checks, with ``batch_id``."""
    rows = spark.read.parquet(f"{root}/{stage}")
    return rows.filter("outcome = 'passed'").drop("outcome", "failed_rules")


def read_batches(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Rows of several batch paths or globs as one scan."""
    return spark.read.parquet(*paths)


def is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_baseline(spark: SparkSession, candidates: Sequence[str]) -> DataFrame:
    """The first candidate CSV that exists."""
    for path in candidates:
        try:
            return spark.read.schema(BASELINE_SCHEMA).option("enforceSchema", False).csv(
                path, header=True
            )
        except AnalysisException as error:
            if not is_missing(error):
                raise
    raise FileNotFoundError(f"no baseline among {list(candidates)}")


def if_present(read: Callable[..., DataFrame], *args) -> DataFrame | None:
    """What a reader returns, None where its path is absent."""
    try:
        return read(*args)
    except AnalysisException as error:
        if is_missing(error):
            return None
        raise


def read_published(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest published version of a snapshot, None before the first."""
    published = if_present(read_batch, spark, f"{root}/published")
    if published is None:
        return None
    return read_batch(spark, f"{root}/version={published.agg(F.max('version')).first()[0]}")


def read_reference(spark: SparkSession, root: str) -> DataFrame | None:
    """Reference snapshot in model columns and label, None where there is none yet."""
    snapshot = read_published(spark, root)
    return None if snapshot is None else select_available(snapshot, [*MODEL_COLS, LABEL])[0]


def select_batches(
    df: DataFrame, start: datetime, end: datetime, column: str = "batch_id"
) -> DataFrame:
    """Rows whose batch name encodes a time in ``[start, end)``.

    Names that are no time are left out. The text bounds prune partition folders.
    """
    name = F.col(column)
    time = F.try_to_timestamp(name, F.lit("yyyyMMdd_HHmmss"))
    pruned = df.filter(
        (name >= start.strftime(BATCH_FORMAT)) & (name <= end.strftime(BATCH_FORMAT))
    )
    return pruned.filter((time >= moment(start)) & (time < moment(end)))


def week_window(as_of: datetime, reason: str = "scheduled") -> tuple[datetime, datetime]:
    """Half-open time range a training run collects.

    A scheduled run takes the week before the one of ``as_of``, any other run the
    current week up to ``as_of``. Weeks start on Monday at midnight.
    """
    midnight = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    monday = midnight - timedelta(days=as_of.weekday())
    if reason == "scheduled":
        return monday - timedelta(weeks=1), monday
    return monday, as_of


def filter_week(
    df: DataFrame, as_of: datetime, reason: str = "scheduled", ts: str = TS
) -> DataFrame:
    start, end = week_window(as_of, reason)
    kind = df.schema[ts].dataType
    return df.filter((F.col(ts) >= moment(start, kind)) & (F.col(ts) < moment(end, kind)))


def read_weekly(spark: SparkSession, root: str) -> DataFrame:
    """All finished weeks; unfinished ones (``_temp``) are pruned as partitions."""
    return spark.read.parquet(root).filter(~F.col("week_key").endswith("_temp"))


def read_recent(
    spark: SparkSession,
    root: str,
    as_of: datetime,
    days: int,
    schema: StructType | None = None,
    tolerant: bool = False,
) -> DataFrame:
    """Rows of files modified within the last ``days`` before ``as_of``.

    A ``tolerant`` read leaves out what can't be read of a file.
    """
    since = (as_of - timedelta(days=days)).strftime("%Y-%m-%dT%H:%M:%S")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("ignoreCorruptFiles", tolerant).option("modifiedAfter", since).option("recursiveFileLookup", True).parquet(root)


# Outcomes of a file in a tolerant read.
READ, DAMAGED, UNREADABLE = "read", "damaged", "unreadable"


def read_tolerant(
    spark: SparkSession, root: str, schema: StructType
) -> tuple[DataFrame, DataFrame]:
    """Rows of all readable parts of files, and an account of every file.

    The account has path, expected (rows by the file's footer), decoded, lost, outcome. A
    file without a readable footer is ``unreadable``, with unknown expected rows. One whose
    pages fail is ``damaged``: rows before the failure are kept, the rest is ``lost``. An
    empty file is read. Counting expected rows reads footers only, as no column is asked
    for (``rows.count()`` does the same); counting decoded rows reads everything, so the
    account costs a second pass.
    """
    tolerant = (
        spark.read.option("ignoreCorruptFiles", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
    )
    rows = tolerant.schema(schema).parquet(root)
    path = _bare(F.col("_metadata.file_path")).alias("path")
    expected = rows.select(path).groupBy("path").agg(F.count(F.lit(1)).alias("expected"))
    # Two counts by a hash of all columns ask for every one of them; a plain count asks for none.
    every = F.xxhash64(*[F.col(f"`{c}`") for c in schema.names]).alias("hash")
    zero = F.lit(0).cast("long")
    decoded = rows.select(path, every).groupBy("path").agg(
        (F.count(F.nullif("hash", zero)) + F.count_if(F.col("hash") == zero)).alias("decoded")
    )
    # Listing reads names only: Spark prunes the content of ``binaryFile``.
    listed = _binary(spark).load(root).select(_bare(F.col("path")).alias("path"))
    found = listed.join(expected, "path", "left").join(decoded, "path", "left")
    silent = listed.join(expected, "path", "left_anti")
    found = found.join(_footers(spark, silent), "path", "left")
    rows_expected = F.coalesce("expected", "footer_rows")
    rows_decoded = F.coalesce("decoded", F.lit(0))
    outcome = (
        F.when(rows_expected.isNull(), UNREADABLE).when(rows_decoded < rows_expected, DAMAGED).otherwise(READ)
    )
    account = found.select(
        "path",
        rows_expected.alias("expected"),
        rows_decoded.alias("decoded"),
        (F.coalesce(rows_expected, rows_decoded) - rows_decoded).alias("lost"),
        outcome.alias("outcome"),
    )
    return rows, account


def _bare(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "/")


def _binary(spark: SparkSession) -> DataFrameReader:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
    )


def _footers(spark: SparkSession, silent: DataFrame) -> DataFrame:
    """path, footer_rows (null if the footer can't be read) of files that gave no row.

    Only the paths of such files come to the driver; they are read in tasks.
    """

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = []
            for content in batch.column(1):
                try:
                    counts.append(pq.read_metadata(pa.BufferReader(content.as_buffer())).num_rows)
                except (pa.ArrowException, OSError):
                    counts.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["path", "footer_rows"])

    paths = [row["path"] for row in silent.collect()]
    if not paths:
        return spark.createDataFrame([], "path string, footer_rows bigint")
    content = spark.read.format("binaryFile").load(paths).select(_bare(F.col("path")).alias("path"), "content")
    return content.mapInArrow(footers, "path string, footer_rows bigint")


def read_watermark(spark: SparkSession, path: str) -> datetime | None:
    """Largest committed batch end, None before the first commit."""
    try:
        return spark.read.parquet(path).agg(F.max("batch_end")).first()[0]
    except AnalysisException as error:
        if is_missing(error):
            return None
        raise
