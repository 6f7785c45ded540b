"""Edge tables and brute-force comparisons."""

import math
import random
from bisect import bisect_left
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cardflow.functions import columns as C
from cardflow.functions.columns import spread_key
from cardflow.functions.pvalues import chi2_tail, kolmogorov_tail, normal_two_sided
from cardflow.operators import assemble, cleaning, drift, expectations, features, metrics, selection
from cardflow.schema import CARD, ID, LABEL, RAW_SCHEMA, TS
from checks import fixtures as X

SMALL = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1)


def _tx(spark, rows):
    """Rows of (id, card, seconds from the start, amount)."""
    data = [(i, c, START + timedelta(seconds=s), float(a)) for i, c, s, a in rows]
    return spark.createDataFrame(data, f"{ID} string, {CARD} string, {TS} timestamp, amount double")


def _hot_rows(n, seed):
    """A third of the rows on one card and second, the rest spread."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            rows.append((f"t{i}", "hot", 5000, draw.randint(1, 9)))
        else:
            rows.append((f"t{i}", f"c{draw.randint(1, 5)}", draw.randint(0, 20000), draw.randint(1, 900)))
    return rows


def test_empty_input(spark):
    empty = spark.createDataFrame([], RAW_SCHEMA)
    cleaned = cleaning.clean_transactions(empty)
    assert cleaned.count() == 0
    assert features.add_features(cleaned).count() == 0
    results = expectations.run_suite(empty, expectations.raw_suite(), "raw").collect()
    assert [r["expectation"] for r in results if not r["success"]] == ["row_count"]
    assert metrics.f1_binary(empty.withColumn("prediction", F.lit(1))).first()["f1"] == 0.0
    train, test = selection.temporal_split(empty)
    assert train.count() == 0 and test.count() == 0


def test_one_row_has_no_spread(spark):
    row = features.zscore_by(cleaning.standardize(_tx(spark, [("a", "c", 0, 5)]))).first()
    assert row["amount_normalized"] == 0.0 and row["amount_zscore"] == 0.0


def test_exactly_one_hour_apart(spark):
    df = _tx(spark, [("a", "c", 0, 1), ("b", "c", 3600, 1), ("d", "c", 7201, 1), ("e", "c", 7201, 1)])
    counts = {r[ID]: r["tx_count_1h"] for r in features.trailing_count(df).collect()}
    assert counts == {"a": 1, "b": 2, "d": 2, "e": 2}


@pytest.mark.parametrize("seed", [1, 2])
def test_trailing_count_equals_brute_force(spark, seed):
    rows = _hot_rows(900, seed)
    got = {r[ID]: r["tx_count_1h"] for r in features.trailing_count(_tx(spark, rows)).collect()}
    for i, card, second, _ in rows:
        want = sum(c == card and second - 3600 <= s <= second for _, c, s, _ in rows)
        assert got[i] == want


@pytest.mark.parametrize("seed", [3, 4])
def test_global_trailing_count_equals_brute_force(spark, seed):
    draw = random.Random(seed)
    data = [(i, float(4000 if i % 3 == 0 else draw.randint(0, 20000))) for i in range(900)]
    df = spark.createDataFrame(data, "id long, t double")
    keyed = df.withColumn("k", F.substring(spread_key(F.col("id")), 1, 4)).collect()
    order = sorted((r["t"], r["k"], r["id"]) for r in keyed)
    times = [t for t, _, _ in order]
    want = {i: p - bisect_left(times, t - 3600) + 1 for p, (t, _, i) in enumerate(order)}
    got = features.trailing_count_global(df, "t", "id").collect()
    assert {r["id"]: r["tx_count_1h"] for r in got} == want


def test_history_counts_but_is_not_returned(spark):
    clean = X.clean(spark, SMALL)
    cut = F.lit(datetime(2024, 1, 16))
    whole = features.add_features(clean).filter(F.col(TS) >= cut)
    parts = features.add_features(clean.filter(F.col(TS) >= cut), clean.filter(F.col(TS) < cut))
    pick = [ID, "tx_count_1h", F.round("amount_zscore", 6)]
    assert whole.select(*pick).exceptAll(parts.select(*pick)).isEmpty()
    assert whole.count() == parts.count()


def test_dedupe_is_stable_under_repartitioning(spark):
    raw = X.tx_raw(spark, SMALL)
    one = cleaning.dedupe(raw.repartition(1))
    many = cleaning.dedupe(raw.repartition(13, "amount"))
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def test_dedupe_of_copies_that_tie(spark):
    rows = [("a", "c", 0, 1), ("a", "d", 0, 1), ("a", "c", 0, 1)]
    first = cleaning.dedupe(_tx(spark, rows)).collect()
    again = cleaning.dedupe(_tx(spark, rows[::-1])).collect()
    assert len(first) == 1 and first == again


def test_epoch_nanoseconds_and_text(spark):
    df = spark.createDataFrame([(1704067201123456789, "2024-01-01T00:00:01Z")], "n long, s string")
    row = cleaning.normalize_timestamp(cleaning.normalize_timestamp(df, "n"), "s").select(
        C.iso_second(F.col("n")).alias("n"), C.iso_second(F.col("s")).alias("s")
    ).first()
    assert row["n"] == row["s"] == "2024-01-01T00:00:01Z"


def test_rules_on_missing_values_and_copies(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 0), ("a", -1.0, 1), (None, float("nan"), None), ("b", None, 7)],
        "id string, x double, label int",
    )
    rules = [
        expectations.exists("absent"),
        expectations.not_null("x"),
        expectations.unique("id"),
        expectations.between("x", low=0),
        expectations.in_set("label", [0, 1]),
        expectations.stdev_between("x", 0.0001),
    ]
    results = {r["expectation"]: r for r in expectations.run_suite(df, rules, "s").collect()}
    assert results["not_null"]["unexpected"] == 2
    assert results["unique"]["unexpected"] == 2
    assert results["between"]["unexpected"] == 1
    assert results["in_set"]["unexpected"] == 1
    assert results["stdev"]["success"] and not results["exists"]["success"]
    rows = expectations.tag_failures(df, rules).collect()
    tagged = {(r["id"], r["x"] == 1.0): r["failed_rules"] for r in rows}
    assert tagged[("a", True)] == ["unique:id"]
    assert tagged[("a", False)] == ["unique:id", "between:x"]
    passed, failed = expectations.split_by_rules(df, rules)
    assert passed.count() + failed.count() == df.count()


def test_constant_column_routes_the_whole_batch_both_ways(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    rules = [expectations.stdev_between("x", 0.0001)]
    passed, failed = expectations.route(df, rules, expectations.run_suite(df, rules, "s"))
    assert passed.count() == 2
    assert [r["failed_rules"] for r in failed.collect()] == [["stdev:x"]] * 2


def _keys(df, columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("fraction", [0.0, 0.33, 0.8, 1.0])
def test_temporal_split_equals_a_sort(spark, fraction):
    """Most rows share one second, so the cut falls between rows of equal time."""
    df = _tx(spark, _hot_rows(300, 5) + [(f"u{i}", "c", 5000, 1) for i in range(300)])
    rows = df.withColumn("k", spread_key(F.col(ID))).collect()
    order = [r[ID] for r in sorted(rows, key=lambda r: (r[TS], r["k"]))]
    wanted = int(len(order) * fraction)
    train, test = selection.temporal_split(df, fraction=fraction)
    assert sorted(r[ID] for r in train.collect()) == sorted(order[:wanted])
    assert sorted(r[ID] for r in test.collect()) == sorted(order[wanted:])
    marked = selection.mark_train(df, fraction=fraction).filter("is_train")
    assert marked.count() == wanted


def test_snapshot_sizes(spark):
    rows = spark.range(2000).select(
        F.concat(F.lit("t"), "id").alias(ID),
        F.when(F.col("id") % 50 == 0, 1).when(F.col("id") % 97 == 0, 2).otherwise(0).alias(LABEL),
    )
    sample = selection.stratified_snapshot(rows, size=100)
    counts = {r[LABEL]: r["count"] for r in sample.groupBy(LABEL).count().collect()}
    assert counts == {1: 2, 0: 98}
    assert selection.stratified_snapshot(rows, size=5000).count() == 2000
    none = rows.filter(F.col(LABEL) == 0)
    assert selection.stratified_snapshot(none, size=100).count() == 99
    again = selection.stratified_snapshot(rows.repartition(7), size=100)
    assert _keys(sample, [ID]) == _keys(again, [ID])


def test_insert_ignore_is_idempotent(spark):
    target = _tx(spark, [("a", "c", 0, 1)])
    incoming = _tx(spark, [("a", "c", 9, 9), ("b", "c", 1, 2), ("b", "c", 0, 3)])
    merged = assemble.merge_version(target, incoming)
    assert _keys(merged, [ID, "amount"]) == [("a", 1.0), ("b", 3.0)]
    assert assemble.insert_ignore(merged, incoming).isEmpty()


def test_priority_order(spark):
    df = spark.createDataFrame(
        [("m", 3, "Production"), ("m", 1, "Staging"), ("m", 2, "Staging"), ("m", 9, "None")],
        "name string, version int, stage string",
    )
    best = selection.pick_by_priority(df, "stage", ["Staging", "Production"], "version").first()
    assert best["version"] == 2


def test_promotion_needs_margin_or_no_production(spark):
    def f1(value):
        return spark.createDataFrame([(value,)], "f1 double")

    assert metrics.promotion_decision(f1(0.52), f1(0.5)).first()["promote"]
    assert not metrics.promotion_decision(f1(0.505), f1(0.5)).first()["promote"]
    assert metrics.promotion_decision(f1(0.0), None).first()["promote"]


def _erfc_tail(z):
    return math.erfc(abs(z) / math.sqrt(2))


def test_p_values(spark):
    row = spark.range(1).select(
        normal_two_sided(F.lit(1.959964)).alias("z"),
        chi2_tail(F.lit(3.841459), F.lit(1)).alias("c1"),
        chi2_tail(F.lit(5.991465), F.lit(2)).alias("c2"),
        chi2_tail(F.lit(11.070498), F.lit(5)).alias("c5"),
        chi2_tail(F.lit(18.307038), F.lit(10)).alias("c10"),
        kolmogorov_tail(F.lit(1.3581 / math.sqrt(50)), F.lit(100), F.lit(100)).alias("k"),
        kolmogorov_tail(F.lit(0.0), F.lit(100), F.lit(100)).alias("k0"),
    ).first()
    for name in ("z", "c1", "c2", "c5", "c10"):
        assert row[name] == pytest.approx(0.05, abs=1e-5), name
    assert row["k"] == pytest.approx(0.05, abs=1e-4)
    assert row["k0"] == 1.0


@pytest.mark.parametrize("seed", [7, 8])
def test_drift_statistics_equal_brute_force(spark, seed):
    """One value holds a third of all rows of a feature."""
    draw = random.Random(seed)
    ref = [0.0 if i % 3 == 0 else draw.gauss(0, 1) for i in range(400)]
    cur = [0.0 if i % 3 == 0 else draw.gauss(0.3, 2) for i in range(300)]
    make = lambda xs: spark.createDataFrame([(x,) for x in xs], "amount double")
    row = drift.column_statistics(make(ref), make(cur), ["amount"]).first()
    a, b = sorted(ref), sorted(cur)
    points = sorted(set(a + b))
    counts_a, counts_b = Counter(a), Counter(b)
    f = g = 0
    ks = w1 = 0.0
    for value, following in zip(points, points[1:] + points[-1:]):
        f += counts_a[value]
        g += counts_b[value]
        gap = abs(f / len(a) - g / len(b))
        ks, w1 = max(ks, gap), w1 + gap * (following - value)
    mean = sum(a) / len(a)
    std = math.sqrt(sum((x - mean) ** 2 for x in a) / len(a))
    assert row["ks"] == pytest.approx(ks)
    assert row["w1"] == pytest.approx(w1)
    assert row["w1_norm"] == pytest.approx(w1 / std)
    assert row["n_values"] == len(points)


def test_equal_sides_do_not_drift(spark):
    df = X.clean(spark, SMALL)
    current = df.withColumn("predicted_fraud", (F.col(LABEL) == 1).cast("int"))
    summary = drift.drift_summary(df, current, ["amount", "V1", "is_international"]).first()
    assert not summary["overall_drift"] and summary["n_total_features"] == 3


def test_shifted_side_drifts_under_both_methods(spark):
    df = X.clean(spark, SMALL)
    shifted = df.withColumn("V1", F.col("V1") + 3).withColumn("is_international", F.lit(1))
    for method in ("distance", "test"):
        rows = drift.column_drift(df, shifted, ["V1", "V2", "is_international"], method=method)
        verdicts = {r["feature"]: (r["method"], r["drifted"]) for r in rows.collect()}
        expected = ("wasserstein", "js") if method == "distance" else ("ks", "z")
        assert verdicts["V1"] == (expected[0], True)
        assert verdicts["V2"] == (expected[0], False)
        assert verdicts["is_international"] == (expected[1], True)


def test_a_drift_decision_reads_each_side_once(spark):
    df = X.clean(spark, SMALL).select("amount", "V1", "is_international", LABEL)
    read = [spark.sparkContext.accumulator(0) for _ in "rc"]

    def counted(rows, seen):
        def batches(source):
            for batch in source:
                seen.add(batch.num_rows)
                yield batch

        return rows.mapInArrow(batches, rows.schema)

    shifted = df.select(F.col("amount") * 2 + 50, "V1", "is_international", F.lit(1).alias("predicted_fraud")).toDF(
        "amount", "V1", "is_international", "predicted_fraud"
    )
    row = drift.drift_summary(counted(df, read[0]), counted(shifted, read[1])).first()
    assert row["reference_rows"] == row["current_rows"] == read[0].value == read[1].value == df.count()
    assert row["n_drifted_features"] == 1 and row["n_total_features"] == 3
    assert row["data_drift_detected"] and row["pred_drift_detected"] and row["overall_drift"]
    parts = drift.column_drift(df, shifted, ["amount", "V1", "is_international"]).filter("drifted")
    assert [r["feature"] for r in parts.collect()] == ["amount"]
    assert drift.prediction_drift(df, shifted).first()["drifted"]


def test_missing_sides_are_not_drifted(spark):
    df = X.clean(spark, SMALL)
    assert drift.drift_summary(None, None) is None
    timed = drift.drift_summary(df, None, lookback_days=3, evaluated_at=datetime(2024, 2, 3, 4, 5, 6)).first()
    assert (timed["lookback_days"], timed["evaluated_at"]) == (3, "2024-02-03T04:05:06")
    for sides in ((df, None), (None, df), (df, df.filter(F.lit(False)))):
        summary = drift.drift_summary(*sides).first()
        assert not summary["overall_drift"] and summary["data_drift_score"] == 0.0


def test_fixture_checkpoints(spark):
    """Quantities that the planted defects must produce."""
    raw, clean = X.tx_raw(spark, SMALL), X.clean(spark, SMALL)
    assert raw.count() == 1019
    assert clean.count() == 971
    assert clean.filter("abs(amount_normalized) > 10").count() == 6
    assert clean.filter("abs(V3) > 50").count() == 3
    row = features.add_features(clean).agg(
        F.sum("tx_count_1h"), F.sum("is_night_hour"), F.sum("is_high_amount"),
        F.round(F.sum(F.abs("amount_zscore")), 4),
    ).first()
    assert tuple(row) == (1066, 267, 38, 361.6046)


def test_nth_row_by_brackets_equals_a_sort(spark, monkeypatch):
    """Ties of a third of the rows, two values that halve the table, and few jobs."""
    monkeypatch.setattr(selection, "SORTED_ROWS", 20)
    monkeypatch.setattr(selection, "ACCURACY", 100)
    rng = random.Random(4)
    tables = [
        [(rng.randrange(10**12), k) for k in range(3000)],
        [(7 if k % 3 else rng.randrange(20), rng.randrange(900)) for k in range(2000)],
        [(k % 2, 5) for k in range(400)],
        [(-(2**62), 2**62)] * 100,
    ]
    for data in tables:
        rows = spark.createDataFrame(data, "a long, b long")
        for wanted in (1, 2, len(data) // 3, len(data) // 2, len(data) // 2 + 1, len(data)):
            assert selection._nth_row(rows, len(data), wanted) == sorted(data)[wanted - 1]
        assert selection._nth_row(rows, len(data), len(data) + 1) is None


def test_cuts_take_few_passes(spark, monkeypatch):
    passes = []
    kind = type(spark.range(1))
    first = kind.first
    monkeypatch.setattr(kind, "first", lambda df: passes.append(1) or first(df))
    rows = spark.range(60_000).select(
        F.col("id").cast("string").alias(ID), F.timestamp_seconds(F.col("id") * 7).alias(TS), (F.col("id") % 50 == 0).cast("int").alias(LABEL)
    )
    train, test = selection.temporal_split(rows)
    assert (train.count(), test.count(), len(passes)) == (48_000, 12_000, 3)
    passes.clear()
    assert selection.stratified_snapshot(rows, 1000).count() == 1000 and len(passes) <= 6


def test_cuts_read_no_other_column(spark, monkeypatch):
    """Times and ids tell the cut; content is asked only of rows that tie in both."""
    asked = []
    content = selection._content_key
    monkeypatch.setattr(selection, "_content_key", lambda df: asked.append(1) or content(df))
    rows = spark.range(5000).select(
        F.concat(F.lit("t"), "id").alias(ID),
        F.timestamp_seconds(F.floor(F.col("id") / 3)).alias(TS),
        (F.col("id") % 10 == 0).cast("int").alias(LABEL),
        F.col("id").cast("double").alias("V1"),
    )
    train, test = selection.temporal_split(rows)
    assert (train.count(), test.count()) == (4000, 1000)
    assert selection.stratified_snapshot(rows, size=100).count() == 100
    assert not asked

    # Most rows share time and id, so both cuts fall among them; content decides there.
    tied = rows.withColumn(ID, F.lit("same")).withColumn(TS, F.timestamp_seconds(F.lit(5)))
    tied = tied.unionByName(rows.filter("V1 < 40"))
    marked = selection.mark_train(tied, fraction=0.5).withColumn("c", content(tied))
    sides = marked.filter(F.col(ID) == "same").groupBy("is_train").agg(F.min("c"), F.max("c"), F.count("*"))
    found = {r[0]: r[1:] for r in sides.collect()}
    assert found[True][1] < found[False][0] and marked.filter("is_train").count() == 2520
    assert selection.stratified_snapshot(tied, size=100).count() == 100
    assert asked


def test_cleaning_ranks_copies_once(spark):
    """Which copies stay is stored, so what reads cleaned rows doesn't rank them again."""
    raw = X.tx_raw(spark, SMALL)
    kept = cleaning.dedupe(raw, keep=True)
    lazy = cleaning.dedupe(raw)
    assert kept.exceptAll(lazy).isEmpty() and lazy.exceptAll(kept).isEmpty()
    for rows in (kept, cleaning.clean_transactions(raw)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Exchange hashpartitioning" not in plan
