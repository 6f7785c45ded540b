"""Rows without times or ids, drift by one rule for all sizes, other time zones, absent logs."""

from datetime import datetime, timedelta

import pytest
from cardflow.operators import drift, features, selection
from cardflow.plans import monitor
from cardflow.schema import LABEL
from cardflow.sources import readers
from pyspark.sql import functions as F


@pytest.mark.parametrize("nulls", [0, 30, 90, 100])
def test_split_keeps_rows_without_a_time(spark, nulls):
    start = datetime(2024, 1, 1)
    rows = [(f"T{n}", None if n < nulls else start + timedelta(hours=n)) for n in range(100)]
    df = spark.createDataFrame(rows, "transaction_id string, timestamp timestamp")
    train, test = selection.temporal_split(df)
    assert (train.count(), test.count()) == (80, 20)
    assert train.unionByName(test).distinct().count() == 100
    known = [r.timestamp for r in train.collect() if r.timestamp]
    later = [r.timestamp for r in test.collect() if r.timestamp]
    assert not known or not later or max(known) <= min(later)
    marked = selection.mark_train(df)
    assert marked.filter("is_train").count() == 80


@pytest.mark.parametrize("kind", ["null", "repeated"])
def test_snapshot_size_with_null_and_repeated_ids(spark, kind):
    rows = [((None if kind == "null" else "same") if n % 2 else f"T{n}", float(n), int(n % 50 == 0)) for n in range(2000)]
    df = spark.createDataFrame(rows, f"transaction_id string, amount double, {LABEL} int")
    drawn = selection.stratified_snapshot(df, size=100)
    assert drawn.count() == 100 and drawn.filter(f"{LABEL} = 1").count() == 2


def test_global_count_keeps_rows_without_a_time(spark):
    df = spark.createDataFrame([(1, 0.0), (2, None), (3, 5.0)], "id int, t double")
    got = {r.id: r.tx_count_1h for r in features.trailing_count_global(df, "t", "id").collect()}
    assert got == {1: 1, 2: None, 3: 2}


@pytest.mark.parametrize("size", [1000, 1001, 10_000])
def test_prediction_drift_has_one_rule_for_all_sizes(spark, size):
    reference = spark.range(size).select((F.col("id") % 600 == 0).cast("int").alias(LABEL))
    shifted = spark.range(size).select((F.col("id") % 33 == 0).cast("int").alias("predicted_fraud"))
    same = spark.range(size).select((F.col("id") % 600 == 0).cast("int").alias("predicted_fraud"))
    assert drift.prediction_drift(reference, shifted).first()["drifted"]
    assert not drift.prediction_drift(reference, same).first()["drifted"]
    with pytest.raises(ValueError):
        drift.prediction_drift(reference, same, method="size")


def test_bounds_do_not_depend_on_the_drivers_zone(spark, monkeypatch):
    import time

    hours = spark.range(48).select((F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_interval(hours=F.col("id").cast("int"))).alias("ts"))
    named = hours.select(F.date_format("ts", "yyyyMMdd_HHmmss").alias("batch_id"))
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        rows = readers.incremental_scan(hours, datetime(2024, 1, 1, 12), datetime(2024, 1, 1, 6), ts="ts")
        assert rows.count() == 6
        assert readers.select_batches(named, datetime(2024, 1, 1), datetime(2024, 1, 2)).count() == 24
        assert readers.filter_week(hours, datetime(2024, 1, 2), "drift", ts="ts").count() == 24
    finally:
        monkeypatch.undo()
        time.tzset()


def test_drift_run_without_reference_or_log(spark, tmp_path):
    from cardflow.schema import REQUEST_COLS
    from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

    fields = [StructField(c, DoubleType()) for c in REQUEST_COLS]
    schema = StructType([*fields, StructField("Predicted_Class", IntegerType())])
    row = monitor.run_drift(spark, f"{tmp_path}/none", f"{tmp_path}/no-log", schema, datetime(2024, 1, 8)).first()
    assert not row["overall_drift"] and row["data_drift_score"] == 0.0 and row["current_rows"] == 0
