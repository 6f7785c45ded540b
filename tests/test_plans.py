"""What the physical plans must and must not contain."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cardflow.operators import cleaning, expectations, features
from cardflow.schema import CARD, ID, TS
from cardflow.sources import readers
from checks import fixtures as X
from checks.queries import queries

SMALL = "/root/testdata/sf0.001"


def test_time_bounds_reach_the_scan(spark, plan_of):
    events = X.table(spark, SMALL, "events")
    rows = readers.incremental_scan(events, datetime(2024, 1, 9), datetime(2024, 1, 3), ts="ts")
    plan = plan_of(rows.select("event_id", "ts"))
    assert "GreaterThan(ts" in plan and "LessThanOrEqual(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_dedupe_limits_each_key_before_the_shuffle(spark, plan_of):
    plan = plan_of(cleaning.dedupe(X.tx_raw(spark, SMALL)))
    limit = plan.index("Partial", plan.index("WindowGroupLimit"))
    assert limit > plan.index("Exchange hashpartitioning")


@pytest.mark.parametrize(
    "name", ["card_features", "trailing_global", "failed_rows", "clean_transactions", "drift_ks"]
)
def test_no_python_and_no_cross_join(spark, plan_of, name):
    plan = plan_of(queries()[name](spark, SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


@pytest.mark.parametrize("name", ["trailing_global", "failed_rows", "card_zscore", "dedupe_tx"])
def test_no_task_gets_all_rows(spark, plan_of, name):
    assert "SinglePartition" not in plan_of(queries()[name](spark, SMALL))


def test_hot_card_is_split_by_the_skew_join(spark, plan_of):
    """A third of the rows on one card and second: the join splits its partition."""
    rows = spark.range(60000).select(
        F.concat(F.lit("t"), "id").alias(ID),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), "id")).alias(CARD),
        F.when(F.col("id") % 3 == 0, F.lit(5000)).otherwise(F.col("id") % 9000).alias("s"),
        F.lit(1.0).alias("amount"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    ).withColumn(TS, F.timestamp_seconds(F.col("s") + 1704067200)).repartition(12)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "12",
    }
    saved = {k: spark.conf.get(k) for k in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        df = features.trailing_count(rows)
        assert "skew=true" in plan_of(df, run=True)
        assert df.filter(F.col(CARD) == "hot").agg(F.min("tx_count_1h"), F.count("*")).first()[:] == (
            20000, 20000,
        )
        copies = rows.withColumn(ID, F.when(F.col(CARD) == "hot", "same").otherwise(F.col(ID)))
        tagged = expectations.tag_failures(copies, [expectations.unique(ID)])
        assert "skew=true" in plan_of(tagged, run=True)
        assert "skew=true" in plan_of(features.zscore_by(rows), run=True)
        assert tagged.filter(F.size("failed_rules") > 0).count() == 20000
    finally:
        for key, value in saved.items():
            spark.conf.set(key, value)


def test_week_partition_is_pruned(spark, plan_of, tmp_path):
    for week in ("week_20240101", "week_20240108", "week_20240108_temp"):
        spark.range(3).write.parquet(f"{tmp_path}/week_key={week}")
    rows = readers.read_weekly(spark, str(tmp_path))
    assert rows.count() == 6
    assert "PartitionFilters: [isnotnull(week_key" in plan_of(rows)


def test_only_rows_with_copies_are_shuffled(spark, plan_of, monkeypatch):
    """Dedupe and the rule for copies send keys to the rows; the results are those of a shuffle."""
    alone = X.tx_raw(spark, SMALL).filter("substring(transaction_id, 4, 20) % 53 != 0")
    assert "Exchange" not in plan_of(cleaning.dedupe(alone).select(ID, "V1"))
    raw = X.tx_raw(spark, SMALL).withColumn(ID, F.expr("nullif(transaction_id, 'TX_7')"))
    raw = raw.unionByName(raw.filter("transaction_id is null"))

    def results():
        tagged = expectations.tag_failures(raw, [expectations.unique(ID)])
        return cleaning.dedupe(raw), tagged

    kept, tagged = results()
    assert "Exchange hashpartitioning" not in plan_of(tagged)
    monkeypatch.setattr("cardflow.operators.joins.SENT_KEYS", 0)
    for sent, shuffled in zip((kept, tagged), results(), strict=True):
        assert sent.exceptAll(shuffled).isEmpty() and shuffled.exceptAll(sent).isEmpty()
    assert kept.filter("transaction_id is null").count() == 1
