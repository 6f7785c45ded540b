"""Transactions with planted defects, derived by formula from the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.functions.columns import batch_id
from cardflow.operators.cleaning import clean_transactions
from cardflow.operators.features import add_features, canonicalize_inference
from cardflow.schema import LABEL, TS, V_COLS

EPOCH = 1704067200  # 2024-01-01 00:00:00 UTC
HALF = datetime(2024, 1, 16)
# Ends of three arrivals; the last one takes the rest.
ARRIVALS = [datetime(2024, 1, 10), datetime(2024, 1, 20, 12), datetime(2030, 1, 1)]

_EVENT_CATEGORY = {
    "click": "online",
    "view": "grocery",
    "purchase": "electronics",
    "error": "atm",
    "signup": "signup",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def _null_when(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def _component(i: int) -> str:
    return f"((event_id * {7919 + 104729 * i}) % 2000003) / 2000003e0 * 6e0 - 3e0"


def tx_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions, one per event, with nulls, outliers, bad codes and copies."""
    events = table(spark, sf_dir, "events")
    user = F.lpad(F.col("user_id").cast("string"), 5, "0")
    merchant = F.lpad(F.get_json_object("props", "$.k"), 4, "0")
    category = F.lit(None).cast("string")
    for event, name in _EVENT_CATEGORY.items():
        category = F.when(F.col("event_type") == event, F.lit(name)).otherwise(category)
    value = F.col("value")
    amount = (
        F.when(_every(101), -value)
        .when(_every(71), value * 2000.0)
        .when(_every(13), value * 10.0)
        .otherwise(value)
    )
    hour = F.when(_every(73), F.lit(None)).when(_every(211), 24).otherwise(F.hour("ts"))
    fraud = ((F.col("event_type") == "error") & _every(10)).cast("int")
    components = {v: _component(i) for i, v in enumerate(V_COLS, start=1)}
    components["V3"] = f"CASE WHEN event_id % 307 = 0 THEN 60e0 ELSE {components['V3']} END"
    components["V7"] = f"CASE WHEN event_id % 103 != 0 THEN {components['V7']} END"
    # Every 53rd row comes twice: the copy a second later and half a unit dearer.
    copies = F.when(_every(53), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return events.withColumn("copy", F.explode(copies)).select(
        F.concat(F.lit("TX_"), F.col("event_id")).alias("transaction_id"),
        _null_when(_every(97), F.concat(F.lit("USER_"), user)).alias("user_id"),
        F.concat(F.lit("CARD_"), user).alias("card_id"),
        F.expr("CAST(ts AS TIMESTAMP) + make_dt_interval(0, 0, 0, copy)").alias("timestamp"),
        (amount + F.col("copy") * 0.5).alias("amount"),
        _null_when(_every(83), F.concat(F.lit("MER_"), merchant)).alias("merchant_id"),
        _null_when(_every(79), category).alias("merchant_category"),
        _null_when(_every(89), _every(20)).alias("is_international"),
        hour.cast("int").alias("hour_of_day"),
        *[F.expr(f"{c} AS {v}") for v, c in components.items()],
        F.when(_every(997), 2).otherwise(fraud).alias(LABEL),
    )


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_transactions(tx_raw(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_features(clean(spark, sf_dir))


def baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the baseline layout, with the event id as row id."""
    events = table(spark, sf_dir, "events")
    fraud = (F.col("event_type") == "error") & _every(10)
    return events.select(
        "event_id",
        (F.unix_timestamp("ts") - EPOCH).cast("double").alias("Time"),
        *[F.expr(f"{_component(i)} AS {v}") for i, v in enumerate(V_COLS, start=1)],
        F.col("value").alias("Amount"),
        fraud.cast("int").alias("Class"),
    )


def rule_prediction() -> Column:
    """A fixed rule in place of a trained model, so that results have an exact oracle."""
    return ((F.col("amount") > 100) & (F.col("V1") > 0)).cast("int")


def inference_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second half of the clean rows in the layout of the prediction log."""
    rows = clean(spark, sf_dir).filter(F.col(TS) >= F.lit(HALF))
    return rows.select(
        F.col("hour_of_day").cast("double").alias("Time"),
        F.col("amount").alias("Amount"),
        *V_COLS,
        rule_prediction().alias("Predicted_Class"),
    )


def drift_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """First half of the clean rows as reference, second half as current rows."""
    reference = clean(spark, sf_dir).filter(F.col(TS) < F.lit(HALF))
    return reference, canonicalize_inference(inference_log(spark, sf_dir))


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows with the name of their 5-minute batch; some names are malformed."""
    number = F.substring("transaction_id", 4, 20).cast("long")
    name = F.when(number % 1009 == 0, F.lit("broken_name")).otherwise(batch_id(F.col(TS)))
    return tx_raw(spark, sf_dir).withColumn("batch_id", name)


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model versions derived from orders."""
    status = F.col("o_orderstatus")
    stage = F.when(status == "F", "Production").when(status == "O", "Staging").otherwise("Archived")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("model_"), F.col("o_custkey")).alias("name"),
        F.col("o_orderkey").alias("version"),
        stage.alias("stage"),
    )


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def put_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """A file with the given content, wherever Spark can write."""
    files, place = _file_system(spark, path)
    out = files.create(place, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


# Rows of a file that is a single row group, of some 30 MB at most.
GROUP_ROWS = 100_000


def write_row_groups(df: DataFrame, path: str) -> str:
    """Files of one row group each, as many as the rows need."""
    df.write.option("maxRecordsPerFile", GROUP_ROWS).parquet(path)
    return path


def damage_pages(spark: SparkSession, folder: str, path: str) -> None:
    """The only Parquet file of ``folder`` at ``path``, with its first page overwritten.

    Its footer stays as it was.
    """
    damage_files(spark, folder, lambda name: path)


def damage_files(spark: SparkSession, folder: str, target: Callable[[str], str]) -> None:
    """Every Parquet file of ``folder`` that has rows, with its first page overwritten.

    ``target`` gives the new path of a file name. Bytes go a buffer at a time.
    """
    files, _ = _file_system(spark, folder)
    hadoop = spark._jvm.org.apache.hadoop
    names = spark.read.parquet(folder).select(F.col("_metadata.file_path").alias("path")).distinct()
    for row in names.collect():
        source = files.open(hadoop.fs.Path(row["path"]))
        out = files.create(hadoop.fs.Path(target(row["path"].rsplit("/", 1)[-1])), True)
        try:
            out.write(bytearray(b"PAR1" + b"\xff" * 40))
            source.seek(44)
            hadoop.io.IOUtils.copyBytes(source, out, 1 << 16, False)
        finally:
            out.close()
            source.close()
