"""The three runs end to end: increments, training, drift."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cardflow.operators import expectations
from cardflow.operators.assemble import dataset_metadata
from cardflow.plans import dataset, monitor, preprocess, training, training_run
from cardflow.schema import BASELINE_SCHEMA, FEATURE_TABLE_COLS, ID, LABEL, MODEL_COLS, PROCESSED_COLS, TS
from cardflow.sources import readers, writers
from checks import fixtures as X

SMALL = "/root/testdata/sf0.001"


def test_increments_cover_the_table_once(spark, tmp_path):
    raw = X.tx_raw(spark, SMALL)
    root = str(tmp_path)
    writers.commit_watermark(spark, f"{root}/watermark", datetime(2024, 1, 1))
    ends = [datetime(2024, 1, 10), datetime(2024, 1, 20), datetime(2024, 2, 2)]
    for end in ends:
        preprocess.run_increment(raw, root, end)
    assert preprocess.run_increment(raw, root, datetime(2024, 2, 3)) is None
    assert readers.read_watermark(spark, f"{root}/watermark") == datetime(2024, 2, 3)
    batches = spark.read.parquet(f"{root}/raw").groupBy("batch_id").count().collect()
    assert sorted(r["batch_id"] for r in batches) == [e.strftime("%Y%m%d_%H%M%S") for e in ends]
    assert sum(r["count"] for r in batches) == raw.count()


def test_training_run(spark, tmp_path):
    rows = X.features(spark, SMALL).filter(F.col(LABEL).isin(0, 1))
    path = writers.write_batch(rows, str(tmp_path), "features", "b")
    stored = readers.read_batch(spark, path)
    settings = [training.TreeParams(3, 0.1, 2, 10.0)]
    model, report, decision = training.train_candidate(stored, None, settings)
    assert decision.first()["promote"]
    assert {"accuracy", "macro avg", "weighted avg"} <= {r["class"] for r in report.collect()}
    root = f"{tmp_path}/reference"
    kept = stored.select(ID, *MODEL_COLS, LABEL)
    assert dataset.build_reference(root, "v1", True, kept)
    reference = readers.read_reference(spark, root)
    assert reference.count() == stored.count()

    scored = training.score(stored, model).select(*MODEL_COLS, "prediction")
    writers.write_predictions(scored, f"{tmp_path}/log", "20240131_000000")
    schema = spark.read.parquet(f"{tmp_path}/log").drop("run_ts").schema
    summary = monitor.run_drift(
        spark, root, f"{tmp_path}/log", schema, datetime.now(), 7, f"{tmp_path}/drift"
    )
    row = summary.first()
    assert row["n_total_features"] == len(MODEL_COLS) and not row["data_drift_detected"]
    size = dataset_metadata(stored, "2024-01-31")
    half = dataset_metadata(stored.filter(F.col(TS) < F.lit(datetime(2024, 1, 16))), "2024-01-16")
    assert monitor.retrain_needed(summary, size, half)
    without = monitor.run_drift(spark, f"{tmp_path}/none", f"{tmp_path}/log", schema, datetime.now()).first()
    assert not without["overall_drift"] and without["data_drift_score"] == 0.0


def _stored_features(spark, root):
    rows = X.features(spark, SMALL).filter(F.col(LABEL).isin(0, 1)).withColumn("outcome", F.lit("passed"))
    day = F.concat(F.date_format(TS, "yyyyMMdd"), F.lit("_000000"))
    rows.withColumn("batch_id", day).write.partitionBy("batch_id", "outcome").parquet(f"{root}/features")
    rows.drop("outcome").filter(F.col(TS) < F.lit(datetime(2024, 1, 8))).write.parquet(
        f"{root}/weekly/week_key=week_20240101"
    )


def test_composed_training_run(spark, tmp_path):
    """All sources, a scheduled run, then a drift run that has to beat the first model."""
    root, settings = str(tmp_path), [training.TreeParams(3, 0.1, 2, 10.0)]
    X.baseline(spark, SMALL).drop("event_id").select(*BASELINE_SCHEMA.names).write.csv(
        f"{root}/baseline", header=True
    )
    _stored_features(spark, root)
    as_of = datetime(2024, 1, 24, 9)
    first = training_run.run_training(spark, root, [f"{root}/baseline"], as_of, "scheduled", settings)
    assert first.promoted and first.week_path.endswith("week_key=week_20240115")
    stored = spark.read.parquet(f"{root}/datasets/version={first.version}")
    counts = {r["source"]: r["count"] for r in stored.groupBy("source").count().collect()}
    assert set(counts) == {"baseline", "weekly", "current"} and counts["baseline"] == 1000
    assert stored.filter(F.col(TS).isNull() | F.col(ID).isNull()).isEmpty()
    assert spark.read.parquet(first.week_path).count() == counts["current"]
    reference = readers.read_reference(spark, f"{root}/reference")
    assert reference.count() == sum(counts.values())
    model = training.load_model(spark, first.model_path)
    scaled = training.score(stored, model).agg(F.max(F.abs("amount_normalized"))).first()[0]
    row = model.scaler.first()
    want = stored.agg(F.max(F.abs(F.col("amount") - row["amount_mean"]) / row["amount_std"])).first()[0]
    assert abs(scaled - want) < 1e-9

    later = datetime(2024, 1, 25, 9)
    second = training_run.run_training(spark, root, [f"{root}/baseline"], later, "drift", settings)
    assert second.week_path is None
    decision = second.decision.first()
    assert decision["production_f1"] == first.decision.first()["candidate_f1"]
    assert second.promoted == decision["promote"] == (second.reference_path is not None)


def test_training_run_on_the_baseline_alone(spark, tmp_path):
    """Rows without a time or with a broken label are neither lost nor learnt from."""
    root = str(tmp_path)
    rows = X.baseline(spark, SMALL).withColumn("Time", F.when(F.col("event_id") % 3 > 0, F.col("Time")))
    rows = rows.withColumn("Class", F.when(F.col("event_id") % 10 > 0, F.col("Class")))
    rows.select(*BASELINE_SCHEMA.names).write.csv(f"{root}/baseline", header=True)
    settings = [training.TreeParams(2, 0.1, 1, 1.0)]
    done = training_run.run_training(
        spark, root, [f"{root}/baseline"], datetime(2024, 1, 24), "drift", settings
    )
    stored = spark.read.parquet(f"{root}/datasets/version={done.version}")
    dead = spark.read.parquet(f"{root}/dead-letter/step=training_labels").count()
    assert stored.count() == 1000 and dead == stored.filter(f"{LABEL} is null").count() > 0
    meta = spark.read.parquet(f"{root}/metadata/version={done.version}").first()
    assert meta["record_count"] == 1000 - dead


def test_a_repeated_batch_changes_no_state(spark, tmp_path):
    raw = X.tx_raw(spark, SMALL)
    parts = [raw.filter(F.col(TS) < F.lit(X.HALF)), raw.filter(F.col(TS) >= F.lit(X.HALF))]
    root = str(tmp_path)
    preprocess.process_batch(parts[0], root, "b1", carry=True)
    preprocess.process_batch(parts[1], root, "b2", carry=True)
    columns = [ID, "amount_normalized", "amount_zscore", "tx_count_1h"]
    stored = [r[:] for r in spark.read.parquet(f"{root}/features").select(*columns).orderBy(*columns).collect()]
    again = preprocess.process_batch(parts[1], root, "b2", carry=True)
    assert again.count() > 0
    repeated = spark.read.parquet(f"{root}/features").select(*columns).orderBy(*columns).collect()
    assert [r[:] for r in repeated] == stored
    with pytest.raises(ValueError):
        preprocess.process_batch(parts[0], root, "b1", carry=True)


@pytest.mark.parametrize("stage", ["raw", "processed", "features"])
def test_stored_suite_counts_the_tagged_rows(spark, tmp_path, plan_of, stage):
    """A stage's document, counted from failed rows, is what checking every row again gives."""
    raw = X.tx_raw(spark, SMALL)
    preprocess.process_batch(raw, str(tmp_path), "b")
    stored = spark.read.parquet(f"{tmp_path}/{stage}/batch_id=b")
    rows, failed = stored.drop("outcome", "failed_rules"), stored.filter("outcome = 'failed'")
    suites = {
        "raw": expectations.raw_suite(),
        "processed": expectations.processed_suite(PROCESSED_COLS),
        "features": expectations.feature_suite(FEATURE_TABLE_COLS),
    }
    want = expectations.run_suite(rows, suites[stage], stage)
    got = spark.read.parquet(f"{tmp_path}/validation/{stage}/batch_id=b")
    assert got.dtypes == want.dtypes
    assert sorted(got.collect(), key=lambda r: r["position"]) == want.collect()
    assert stage == "features" or want.filter("unexpected > 0").count() > 0
    counted = plan_of(expectations.run_suite(rows, suites[stage], stage, failed))
    # Unless a rule is on the table, no column of the passed rows is read.
    assert ("V1:double" in counted) == (stage == "features")
