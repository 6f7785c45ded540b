"""Validate, clean and feature-engineer one batch, with dead letters per step."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from cardflow.operators.cleaning import clean_rows, clean_transactions, dedupe, standardize
from cardflow.operators.expectations import (
    Rule,
    broken_rules,
    feature_suite,
    only_table_level,
    processed_suite,
    raw_suite,
    run_suite,
    split_by_rules,
    tag_failures,
)
from cardflow.operators.features import add_features, attach_features
from cardflow.plans.state import Carried
from cardflow.schema import FEATURE_TABLE_COLS, PROCESSED_COLS, RAW_COLS
from cardflow.sources.readers import (
    BATCH_FORMAT,
    incremental_scan,
    is_empty_batch,
    read_watermark,
)
from cardflow.sources.writers import commit_watermark, write_checked, write_dead_letter


def valid_raw(df: DataFrame, dedupe_first: bool = False) -> DataFrame:
    """Raw rows that pass the raw suite.

    The suite rejects every copy of an id. ``dedupe_first`` keeps one instead.
    """
    return split_by_rules(dedupe(df) if dedupe_first else df, raw_suite())[0]


def valid_features(
    raw: DataFrame, history: DataFrame | None = None, dedupe_first: bool = False
) -> DataFrame:
    """Raw rows to valid feature rows without storing the stages in between.

    Only the ids with copies are looked up at once, per suite that asks for them.
    """
    cleaned = clean_transactions(valid_raw(raw, dedupe_first))
    processed = split_by_rules(cleaned, processed_suite(PROCESSED_COLS))[0]
    return split_by_rules(add_features(processed, history), feature_suite(FEATURE_TABLE_COLS))[0]


def _store(df: DataFrame, suite: list[Rule], root: str, stage: str, batch_id: str) -> DataFrame:
    """Check a stage's rows, write them once, and return those that go on.

    One pass writes passed and failed rows to separate folders. The suite's result
    and the dead letter are then read from what was written; rules on rows are counted
    from the failed ones, and only rules on the table read all rows again.
    """
    spark = df.sparkSession
    tagged = tag_failures(df, suite)
    path = write_checked(tagged, root, stage, batch_id)
    # The schema is given, because a batch may have lost all its rows by now.
    checked = spark.read.schema(f"{tagged.schema.toDDL()}, outcome STRING").parquet(path)
    document = f"{root}/validation/{stage}/batch_id={batch_id}"
    failed = checked.filter("outcome = 'failed'").drop("outcome")
    results = run_suite(checked.select(*df.columns), suite, stage, failed)
    results.write.mode("overwrite").parquet(document)
    results = spark.read.parquet(document)
    if only_table_level(results):
        failed = checked.drop("outcome").withColumn("failed_rules", broken_rules(results))
    write_dead_letter(failed, f"{root}/dead-letter", f"{stage}_validation", batch_id)
    return checked.filter("outcome = 'passed'").select(*df.columns)


def process_batch(
    raw: DataFrame,
    root: str,
    batch_id: str,
    history: DataFrame | None = None,
    dedupe_first: bool = False,
    carry: bool = False,
) -> DataFrame | None:
    """Run a batch through all stages under ``root``; None when it has no rows.

    The rows are landed first, so the source is read once and what is checked is what
    is stored. With ``carry``, scaler, card statistics and hour counts go on from the
    batches before, which must come in the order of their ids; uniqueness is a rule of
    the batch. Every write replaces the batch's own folder, so a repeated run changes
    nothing.
    """
    spark, landed = raw.sparkSession, f"{root}/landed/batch_id={batch_id}"
    raw.write.mode("overwrite").parquet(landed)
    raw = spark.read.schema(raw.schema).parquet(landed)
    if is_empty_batch(raw):
        return None
    state = Carried(spark, root, batch_id) if carry else None
    stored = _store(dedupe(raw) if dedupe_first else raw, raw_suite(), root, "raw", batch_id)
    cleaned = clean_rows(stored)
    scaled = standardize(cleaned, stats=state and state.scaler(cleaned)).select(*PROCESSED_COLS)
    processed = _store(scaled, processed_suite(PROCESSED_COLS), root, "processed", batch_id)
    if state:
        features = attach_features(processed, state.cards(processed), state.trailing(processed))
    else:
        features = add_features(processed, history)
    rows = _store(features, feature_suite(FEATURE_TABLE_COLS), root, "features", batch_id)
    if state:
        state.commit()
    return rows


def run_increment(
    table: DataFrame, root: str, batch_end: datetime, history: DataFrame | None = None
) -> DataFrame | None:
    """Process what has arrived since the last run, up to ``batch_end``.

    Statistics go on from the increments before, unless ``history`` gives earlier rows.
    The watermark moves after all sinks are written, and also for an empty batch. A
    run that fails before that is repeated over the same rows.
    """
    spark, state = table.sparkSession, f"{root}/watermark"
    last = read_watermark(spark, state)
    raw = incremental_scan(table, batch_end, last, columns=RAW_COLS)
    name = batch_end.strftime(BATCH_FORMAT)
    rows = process_batch(raw, root, name, history, carry=history is None)
    commit_watermark(spark, state, batch_end)
    return rows
