"""Reads that tolerate gaps, writes that can be repeated, and state between runs."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cardflow.plans import dataset, preprocess, training
from cardflow.schema import BASELINE_SCHEMA, LABEL, V_COLS
from cardflow.sources import readers, writers
from checks import fixtures as X

SMALL = "/root/testdata/sf0.001"


def test_week_windows():
    as_of = datetime(2024, 1, 24, 9, 30)
    assert readers.week_window(as_of) == (datetime(2024, 1, 15), datetime(2024, 1, 22))
    assert readers.week_window(as_of, "drift") == (datetime(2024, 1, 22), as_of)
    monday = datetime(2024, 1, 22, 2)
    assert readers.week_window(monday) == (datetime(2024, 1, 15), datetime(2024, 1, 22))


def test_default_lower_bound_is_one_interval(spark):
    end = datetime(2024, 1, 1, 0, 10)
    rows = [(end - timedelta(minutes=m),) for m in (0, 4, 5, 6)]
    df = spark.createDataFrame(rows, "timestamp timestamp")
    assert readers.incremental_scan(df, end).count() == 2


def test_reference_is_optional(spark, tmp_path):
    assert readers.read_reference(spark, f"{tmp_path}/none") is None


def test_baseline_candidates(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_baseline(spark, [f"{tmp_path}/a.csv"])
    row = (0.0, *[0.0] * len(V_COLS), 9.5, 1)
    spark.createDataFrame([row], BASELINE_SCHEMA).write.csv(f"{tmp_path}/b", header=True)
    df = readers.read_baseline(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/b"])
    assert df.first()["Amount"] == 9.5 and df.schema == BASELINE_SCHEMA


def test_corrupt_file_is_skipped_and_reported(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/ok")
    spark.range(0).write.parquet(f"{tmp_path}/none")
    spark.range(7).coalesce(1).write.parquet(f"{tmp_path}/out/whole")
    Path(tmp_path, "ok", "broken.parquet").write_bytes(b"no parquet at all")
    X.damage_pages(spark, f"{tmp_path}/out/whole", f"{tmp_path}/none/damaged.parquet")
    schema = spark.range(1).schema
    for folder, n in (("ok", 10), ("none", 0)):
        assert len(readers.read_tolerant(spark, f"{tmp_path}/{folder}", schema)[0].collect()) == n
    files = [r for f in ("ok", "none") for r in readers.read_tolerant(spark, f"{tmp_path}/{f}", schema)[1].collect()]
    by_name = {r["path"].split("/")[-1]: r for r in files}
    assert by_name["broken.parquet"][1:5] == (None, 0, 0, "unreadable")
    assert by_name["damaged.parquet"][1:5] == (7, 0, 7, "damaged")
    whole = [r for r in files if r["outcome"] == "read"]
    assert sum(r["decoded"] for r in whole) == 10 and any(r["expected"] == 0 for r in whole)


def test_account_names_a_later_page_of_many(spark, tmp_path):
    """Rows before the damage are kept, and only the rest of the file is lost."""
    rows = spark.range(0, 200_000, 1, 1).select("id", (F.col("id") * 7).alias("b"))
    rows.write.option("compression", "none").parquet(f"{tmp_path}/whole")
    file = next(Path(tmp_path, "whole").glob("*.parquet"))
    content = bytearray(file.read_bytes())
    content[len(content) // 2 - 200_000 : len(content) // 2 + 200_000] = b"\xff" * 400_000
    Path(tmp_path, "in").mkdir()
    Path(tmp_path, "in", "a.parquet").write_bytes(content)
    read, files = readers.read_tolerant(spark, f"{tmp_path}/in", rows.schema)
    account = files.first()
    assert account["outcome"] == "damaged" and account["expected"] == 200_000
    assert account["decoded"] == read.agg(F.count("b")).first()[0] == 200_000 - account["lost"]


def test_old_files_are_not_read(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/log")
    schema = spark.range(1).schema
    later = datetime.now() + timedelta(days=30)
    assert readers.read_recent(spark, str(tmp_path), datetime.now(), 7, schema).count() == 3
    assert readers.read_recent(spark, str(tmp_path), later, 7, schema).count() == 0


def test_watermark_moves_with_commits(spark, tmp_path):
    path = f"{tmp_path}/watermark"
    assert readers.read_watermark(spark, path) is None
    for day in (3, 2):
        writers.commit_watermark(spark, path, datetime(2024, 1, day))
    assert readers.read_watermark(spark, path) == datetime(2024, 1, 3)


def test_batch_run_can_be_repeated(spark, tmp_path):
    raw = X.tx_raw(spark, SMALL)
    counts = [preprocess.process_batch(raw, str(tmp_path), "b1").count() for _ in range(2)]
    assert counts == [939, 939]
    dead = spark.read.parquet(f"{tmp_path}/dead-letter")
    by_step = {r["step"]: r["count"] for r in dead.groupBy("step").count().collect()}
    assert by_step["raw_validation"] == 71
    assert readers.read_stage(spark, str(tmp_path), "features").count() == 939
    documents = spark.read.parquet(f"{tmp_path}/validation/raw")
    assert documents.count() == 77


def test_dedupe_first_keeps_one_of_each_copy(spark):
    raw = X.tx_raw(spark, SMALL)
    kept = preprocess.valid_raw(raw, dedupe_first=True).count()
    assert kept > preprocess.valid_raw(raw).count()


def test_batch_whose_rows_all_fail(spark, tmp_path):
    raw = X.tx_raw(spark, SMALL).withColumn(LABEL, F.lit(5))
    assert preprocess.process_batch(raw, str(tmp_path), "b1").count() == 0
    assert preprocess.process_batch(raw.filter(F.lit(False)), str(tmp_path), "b2") is None


def test_sources_of_a_drift_run(spark):
    batches = spark.createDataFrame([("20240123_000000",), ("20240110_000000",), ("x",)], "batch_id string")
    weekly = spark.createDataFrame([("week_20240108",), ("week_20240115_temp",)], "week_key string")
    plan = dataset.plan_sources(batches, weekly, datetime(2024, 1, 24), "drift")
    assert sorted(tuple(r) for r in plan.collect()) == [
        ("baseline", "baseline"), ("batch", "20240123_000000"), ("weekly", "week_20240108"),
    ]


def test_no_snapshot_without_promotion(spark):
    assert dataset.build_reference("/nowhere", "v", False, None) is None


def test_search_space():
    settings = training.candidates(100.0)
    assert len(settings) == 15 and settings == training.candidates(100.0)
    for s in settings:
        assert 3 <= s.max_depth <= 9 and 0.01 <= s.learning_rate <= 0.2
        assert 50 <= s.trees <= 150 and 50 <= s.positive_weight <= 150


def test_trees_find_an_easy_rule(spark):
    rows = spark.range(600).select(
        (F.col("id") % 10).cast("double").alias("a"), F.rand(1).alias("b"),
        (F.col("id") % 10 == 3).cast("int").alias(LABEL),
    )
    model, _, trials = training.search(
        rows, rows, settings=[training.TreeParams(3, 0.1, 3, 9.0)], features=["a", "b"]
    )
    assert trials[0][1] == 1.0
    assert training.score(rows, model).filter(F.col("prediction") != F.col(LABEL)).isEmpty()


def test_missing_values_have_a_bin_of_their_own(spark):
    rows = spark.range(300).select(
        F.when(F.col("id") % 3 != 0, (F.col("id") % 7).cast("double")).alias("a"),
        F.when(F.col("id") % 5 == 0, float("nan")).otherwise(F.lit(float("inf"))).alias("b"),
        (F.col("id") % 3 == 0).cast("int").alias(LABEL),
    )
    model, best, trials = training.search(
        rows, rows, settings=[training.TreeParams(2, 0.1, 2, 1.0), training.TreeParams(3, 0.1, 2, 1.0)], features=["a", "b"]
    )
    assert [f1 for _, f1 in trials] == [1.0, 1.0] and best.max_depth == 2
    assert training.score(rows, model).columns == ["a", "b", LABEL, "prediction"]
    binned = training._binned(rows, training.bin_features(rows, ["a", "b"]), LABEL)
    assert binned.rdd.getNumPartitions() == 1 and binned.columns == ["_label", "_features"]


def test_damaged_input_grows_by_files(spark, tmp_path, monkeypatch):
    """The rows to lose are in as many files as they need, each damaged and lost as a whole."""
    monkeypatch.setattr(X, "GROUP_ROWS", 10)
    rows = spark.range(95).repartition(1)
    X.damage_files(spark, X.write_row_groups(rows, f"{tmp_path}/whole"), lambda name: f"{tmp_path}/in/{name}")
    _, files = readers.read_tolerant(spark, f"{tmp_path}/in", rows.schema)
    assert files.agg(F.count("path"), F.sum("expected"), F.sum("lost"), F.max("expected")).first()[:] == (10, 95, 95, 10)
