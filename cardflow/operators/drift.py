"""Distribution drift between a reference table and current rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardflow.functions.columns import moment_text, ratio
from cardflow.functions.pvalues import chi2_tail, kolmogorov_tail, normal_two_sided
from cardflow.operators.cumulative import running_totals
from cardflow.schema import (
    DRIFT_DISTANCE_THRESHOLD,
    DRIFT_P_THRESHOLD,
    DRIFT_SHARE_THRESHOLD,
    GROWTH_THRESHOLD,
    LABEL,
    MODEL_COLS,
)

# Columns that the whole decision counts beside the features: names that no feature has.
ROWS, PREDICTION = "#rows", "#prediction"
PREDICTED = "predicted_fraud"
BINS = 10
EMPTY_BIN_SHARE = 1e-4
FEW_VALUES = 5
MIN_STD = 0.001


def shared_columns(
    reference: DataFrame, current: DataFrame, columns: Sequence[str] = MODEL_COLS
) -> list[str]:
    return [c for c in columns if c in reference.columns and c in current.columns]


def _long(df: DataFrame, columns: Sequence[str], is_ref: int) -> DataFrame:
    """Present values with the position of their column: short keys to hash and sort."""
    doubles = df.select(*[F.expr(f"CAST(`{c}` AS DOUBLE) AS `{i}`") for i, c in enumerate(columns)])
    return (
        doubles.unpivot([], doubles.columns, "code", "value")
        .filter("value IS NOT NULL AND NOT isnan(value)")
        .select(F.col("code").cast("int").alias("code"), "value", F.lit(is_ref).alias("is_ref"))
    )


def _name(columns: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("code") + 1).alias("feature")


def _value_counts(reference: DataFrame, current: DataFrame, names: Sequence[str]) -> DataFrame:
    sides = _long(reference, names, 1).unionByName(_long(current, names, 0))
    return sides.groupBy("code", "value").agg(
        F.sum("is_ref").alias("n_ref"), F.sum(1 - F.col("is_ref")).alias("n_cur")
    )


def align(
    reference: DataFrame, current: DataFrame, columns: Sequence[str] = MODEL_COLS
) -> DataFrame:
    """Rows of both sides per feature and value: ``feature, value, n_ref, n_cur``.

    Counted before the shuffle, so a value that most rows share is no hot key.
    Missing values are left out.
    """
    names = shared_columns(reference, current, columns)
    counts = _value_counts(reference, current, names)
    return counts.select(_name(names), "value", "n_ref", "n_cur")


def value_distribution(counts: DataFrame) -> DataFrame:
    """Counts with running and whole totals per side, and the next larger value."""
    weighted = counts.withColumn("v_ref", F.col("n_ref") * F.col("value"))
    return running_totals(weighted, "code", "value", ["n_ref", "n_cur", "v_ref"])


def _js_terms(p: Column, q: Column) -> Column:
    """Terms of the Jensen-Shannon divergence, natural logarithm."""
    middle = (p + q) / 2
    left = F.when(p > 0, p * F.ln(p / middle)).otherwise(0.0)
    right = F.when(q > 0, q * F.ln(q / middle)).otherwise(0.0)
    return (left + right) / 2


def _chi2_terms() -> Column:
    both = F.col("n_ref") + F.col("n_cur")
    total = F.col("total_n_ref") + F.col("total_n_cur")
    terms = F.lit(0.0)
    for side in ("ref", "cur"):
        expected = both * F.col(f"total_n_{side}") / total.cast("double")
        miss = F.col(f"n_{side}") - expected
        terms = terms + F.when(expected > 0, miss * miss / expected).otherwise(0.0)
    return terms


def column_statistics(
    reference: DataFrame, current: DataFrame, columns: Sequence[str] = MODEL_COLS
) -> DataFrame:
    """One row per shared feature with every distance and test statistic.

    All of them come from one pass over the running totals. A value's bin is the
    tenth of the reference that ends below it, which needs no separate quantiles.
    """
    names = shared_columns(reference, current, columns)
    return _statistics(value_distribution(_value_counts(reference, current, names)), names)


def _statistics(values: DataFrame, names: Sequence[str]) -> DataFrame:
    """``column_statistics`` from the running totals of the values of columns."""
    share_ref = F.col("upto_n_ref") / F.col("total_n_ref").cast("double")
    share_cur = F.col("upto_n_cur") / F.col("total_n_cur").cast("double")
    gap = F.abs(share_ref - share_cur)
    width = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    p = F.col("n_ref") / F.col("total_n_ref").cast("double")
    q = F.col("n_cur") / F.col("total_n_cur").cast("double")
    below = F.col("upto_n_ref") - F.col("n_ref")
    miss = F.col("value") - F.col("total_v_ref") / F.col("total_n_ref").cast("double")
    # Shares of the least value, for the proportion test of two-valued features.
    is_least = (below == 0) & (F.col("upto_n_cur") == F.col("n_cur"))
    bin_of_value = F.least(
        F.floor(below * BINS / F.col("total_n_ref").cast("double")), F.lit(BINS - 1)
    )
    per_bin = (
        values.filter((F.col("total_n_ref") > 0) & (F.col("total_n_cur") > 0))
        .withColumn("bin", bin_of_value)
        .groupBy("code", "total_n_ref", "total_n_cur", "bin")
        .agg(
            F.count(F.lit(1)).alias("n_values"),
            F.max(gap).alias("ks"),
            F.sum(gap * width).alias("w1"),
            F.sum(_js_terms(p, q)).alias("js_values"),
            F.sum(_chi2_terms()).alias("chi2"),
            F.sum("n_ref").alias("n_ref"),
            F.sum("n_cur").alias("n_cur"),
            F.sum(F.col("n_ref") * miss * miss).alias("squares"),
            F.sum(F.when(is_least, p)).alias("least_ref"),
            F.sum(F.when(is_least, q)).alias("least_cur"),
        )
    )
    bin_ref = F.greatest(p, F.lit(EMPTY_BIN_SHARE))
    bin_cur = F.greatest(q, F.lit(EMPTY_BIN_SHARE))
    stats = per_bin.groupBy("code", "total_n_ref", "total_n_cur").agg(
        F.sum("n_values").alias("n_values"),
        F.max("ks").alias("ks"),
        F.sum("w1").alias("w1"),
        F.sum((bin_cur - bin_ref) * F.ln(bin_cur / bin_ref)).alias("psi"),
        F.sqrt(F.greatest(F.sum(_js_terms(p, q)), F.lit(0.0))).alias("js_bins"),
        F.sqrt(F.greatest(F.sum("js_values"), F.lit(0.0))).alias("js_values"),
        F.sum("chi2").alias("chi2"),
        F.sqrt(F.sum("squares") / F.col("total_n_ref")).alias("std_ref"),
        F.coalesce(F.sum("least_ref"), F.lit(0.0)).alias("share_ref"),
        F.coalesce(F.sum("least_cur"), F.lit(0.0)).alias("share_cur"),
    )
    few = F.col("n_values") <= FEW_VALUES
    return (
        stats.withColumn("w1_norm", F.col("w1") / F.greatest(F.col("std_ref"), F.lit(MIN_STD)))
        .withColumn("js", F.when(few, F.col("js_values")).otherwise(F.col("js_bins")))
        .withColumn("feature", _name(names))
        .drop("code", "js_values", "js_bins")
    )


def ks_two_sample(
    reference: DataFrame, current: DataFrame, columns: Sequence[str] = MODEL_COLS
) -> DataFrame:
    stats = column_statistics(reference, current, columns)
    p_value = kolmogorov_tail(F.col("ks"), F.col("total_n_ref"), F.col("total_n_cur"))
    return stats.select("feature", "ks", p_value.alias("p_value"))


def wasserstein_1d(
    reference: DataFrame, current: DataFrame, columns: Sequence[str] = MODEL_COLS
) -> DataFrame:
    """Earth mover's distance, plain and in units of the reference deviation."""
    return column_statistics(reference, current, columns).select("feature", "w1", "w1_norm")


def psi(
    reference: DataFrame, current: DataFrame, columns: Sequence[str] = MODEL_COLS
) -> DataFrame:
    """Population stability index over ten reference quantile bins."""
    return column_statistics(reference, current, columns).select("feature", "psi")


def js_divergence(
    reference: DataFrame, current: DataFrame, columns: Sequence[str] = MODEL_COLS
) -> DataFrame:
    """Jensen-Shannon distance: over values for few-valued features, else over bins."""
    return column_statistics(reference, current, columns).select("feature", "js")


def _category_counts(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of both sides per column and category, with the side totals."""

    def side(df: DataFrame, flag: int) -> DataFrame:
        texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        return (
            texts.unpivot([], list(columns), "feature", "value")
            .filter(F.col("value").isNotNull())
            .withColumn("is_ref", F.lit(flag))
        )

    counts = side(reference, 1).unionByName(side(current, 0)).groupBy("feature", "value").agg(
        F.sum("is_ref").alias("n_ref"), F.sum(1 - F.col("is_ref")).alias("n_cur")
    )
    totals = counts.groupBy(F.col("feature").alias("_feature")).agg(
        F.sum("n_ref").alias("total_n_ref"), F.sum("n_cur").alias("total_n_cur")
    )
    return counts.join(F.broadcast(totals), F.col("feature") == F.col("_feature")).drop("_feature")


def chi2_two_sample(
    reference: DataFrame, current: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Chi-square test of equal category shares, one row per categorical column."""
    tested = (
        _category_counts(reference, current, columns)
        .filter((F.col("total_n_ref") > 0) & (F.col("total_n_cur") > 0))
        .groupBy("feature")
        .agg(F.sum(_chi2_terms()).alias("chi2"), (F.count(F.lit(1)) - 1).alias("df"))
    )
    return tested.withColumn("p_value", chi2_tail(F.col("chi2"), F.col("df")))


def _pooled_z(share_ref: Column, share_cur: Column, n_ref: Column, n_cur: Column) -> Column:
    pooled = (share_ref * n_ref + share_cur * n_cur) / (n_ref + n_cur).cast("double")
    spread = F.sqrt(pooled * (1 - pooled) * (1 / n_ref.cast("double") + 1 / n_cur.cast("double")))
    return ratio(share_cur - share_ref, spread)


def two_proportion_z(
    reference: DataFrame, current: DataFrame, reference_column: str, current_column: str
) -> DataFrame:
    """Difference of two shares of ones: z, two-sided p-value and JS distance."""

    def side(df: DataFrame, column: str, name: str) -> DataFrame:
        return df.agg(
            F.count(column).alias(f"n_{name}"), F.count_if(F.col(column) == 1).alias(f"ones_{name}")
        )

    # Two one-row aggregates: the second is read as a scalar subquery.
    other = side(current, current_column, "cur").select(F.struct("n_cur", "ones_cur")).scalar()
    counts = side(reference, reference_column, "ref").select(
        "n_ref", "ones_ref", other["n_cur"].alias("n_cur"), other["ones_cur"].alias("ones_cur")
    )
    return _proportions(counts)


def _proportions(counts: DataFrame) -> DataFrame:
    p, q = F.col("share_ref"), F.col("share_cur")
    return (
        counts.filter((F.col("n_ref") > 0) & (F.col("n_cur") > 0))
        .withColumn("share_ref", ratio(F.col("ones_ref"), F.col("n_ref")))
        .withColumn("share_cur", ratio(F.col("ones_cur"), F.col("n_cur")))
        .withColumn("z", _pooled_z(p, q, F.col("n_ref"), F.col("n_cur")))
        .withColumn("p_value", normal_two_sided(F.col("z")))
        .withColumn("js", F.sqrt(F.greatest(_js_terms(p, q) + _js_terms(1 - p, 1 - q), F.lit(0.0))))
    )


def prediction_drift(
    reference: DataFrame,
    current: DataFrame,
    threshold: float | None = None,
    method: str = "test",
) -> DataFrame:
    """Share of predicted frauds now against the share of labels in the reference.

    ``method`` "test": drifted if the p-value is below ``threshold`` (0.05).
    "distance": if the Jensen-Shannon distance is ``threshold`` (0.1) or more.
    """
    result = two_proportion_z(reference, current, LABEL, PREDICTED)
    return _prediction_verdict(result, threshold, method)


def _prediction_verdict(proportions: DataFrame, threshold: float | None, method: str) -> DataFrame:
    limit = _limit(method, threshold)
    drifted = F.col("p_value") < limit if method == "test" else F.col("js") >= limit
    return proportions.withColumn("drifted", drifted)


def _limit(method: str, threshold: float | None) -> float:
    limits = {"test": DRIFT_P_THRESHOLD, "distance": DRIFT_DISTANCE_THRESHOLD}
    if method not in limits:
        raise ValueError(f"method is one of {sorted(limits)}, not {method!r}")
    return limits[method] if threshold is None else threshold


def column_drift(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str] = MODEL_COLS,
    threshold: float | None = None,
    method: str = "test",
) -> DataFrame:
    """Method, score and verdict per shared feature, by one rule for all sizes.

    ``method`` "test": KS test, or chi-square for few values, or a proportion test
    for two, drifted below ``threshold`` (0.05). "distance": normalised Wasserstein
    distance, or Jensen-Shannon for few values, drifted from ``threshold`` (0.1) on.
    """
    return _column_verdicts(column_statistics(reference, current, columns), threshold, method)


def _column_verdicts(stats: DataFrame, threshold: float | None, method: str) -> DataFrame:
    limit = _limit(method, threshold)
    few, two = F.col("n_values") <= FEW_VALUES, F.col("n_values") <= 2
    z = _pooled_z(F.col("share_ref"), F.col("share_cur"), F.col("total_n_ref"), F.col("total_n_cur"))
    is_test = F.lit(method == "test")
    kind = (
        F.when(is_test & two, "z")
        .when(is_test & few, "chi2")
        .when(is_test, "ks")
        .when(few, "js")
        .otherwise("wasserstein")
    )
    score = (
        F.when(F.col("method") == "z", normal_two_sided(z))
        .when(F.col("method") == "chi2", chi2_tail(F.col("chi2"), F.col("n_values") - 1))
        .when(
            F.col("method") == "ks",
            kolmogorov_tail(F.col("ks"), F.col("total_n_ref"), F.col("total_n_cur")),
        )
        .when(F.col("method") == "js", F.col("js"))
        .otherwise(F.col("w1_norm"))
    )
    verdict = F.col("score") < limit if method == "test" else F.col("score") >= limit
    return (
        stats.withColumn("method", kind)
        .withColumn("score", score)
        .withColumn("drifted", verdict)
    )


def drift_share(columns: DataFrame) -> DataFrame:
    """Drifted features, checked features and their share."""
    return columns.agg(
        F.count_if("drifted").alias("n_drifted_features"),
        F.count(F.lit(1)).alias("n_total_features"),
    ).withColumn("data_drift_score", ratio(F.col("n_drifted_features"), F.col("n_total_features")))


def drift_summary(
    reference: DataFrame | None,
    current: DataFrame | None,
    columns: Sequence[str] = MODEL_COLS,
    share_threshold: float = DRIFT_SHARE_THRESHOLD,
    prediction_threshold: float = DRIFT_P_THRESHOLD,
    lookback_days: int | None = None,
    evaluated_at: datetime | None = None,
) -> DataFrame | None:
    """The decision for a dataset as one row.

    A share strictly above the threshold or a drifted prediction is drift. None
    when neither side is given; a missing or empty side is "not drifted". The days
    the current side covers and the time of the decision are the caller's.
    """
    given = reference if reference is not None else current
    if given is None:
        return None
    if reference is None or current is None:
        counted = given.agg(F.count(F.lit(1)).alias("n"))
        n = F.col("n"), F.lit(0).cast("long")
        nothing = F.lit(0).cast("long")
        share = counted.select(
            nothing.alias("n_drifted_features"), nothing.alias("n_total_features"), F.lit(0.0).alias("data_drift_score"),
            (n[0] if current is None else n[1]).alias("reference_rows"), (n[1] if current is None else n[0]).alias("current_rows"),
        )
        predicted = F.lit(False)
    else:
        share, predicted = _whole_decision(reference, current, columns, prediction_threshold)
    data = F.col("data_drift_score") > share_threshold
    return share.select(
        "data_drift_score",
        "n_drifted_features",
        "n_total_features",
        data.alias("data_drift_detected"),
        predicted.alias("pred_drift_detected"),
        (data | predicted).alias("overall_drift"),
        F.lit(share_threshold).alias("threshold_data"),
        F.lit(prediction_threshold).alias("threshold_pred"),
        "reference_rows",
        "current_rows",
        F.lit(lookback_days).cast("int").alias("lookback_days"),
        F.lit(moment_text(evaluated_at)).cast("string").alias("evaluated_at"),
    )


def _whole_decision(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], prediction_threshold: float
) -> tuple[DataFrame, Column]:
    """Shares and rows of both sides as one row, and whether predictions drifted.

    Each side is read once: its number of rows and its predictions are two more columns of
    the values that are counted, and everything else comes from the counts, which running
    totals keep in a checkpoint. An empty side leaves no column to check.
    """
    names = shared_columns(reference, current, columns)
    extra = [F.lit(0.0).alias(ROWS)]
    sides = []
    predictions = LABEL in reference.columns and PREDICTED in current.columns
    for side, column in ((reference, LABEL), (current, PREDICTED)):
        ones = [(F.col(column) == 1).cast("double").alias(PREDICTION)] if predictions else []
        sides.append(side.select(*[F.col(f"`{c}`") for c in names], *extra, *ones))
    every = [*names, ROWS, *([PREDICTION] if predictions else [])]
    values = value_distribution(_value_counts(*sides, every))
    own = values.filter(F.col("code") < len(names))
    share = drift_share(_column_verdicts(_statistics(own, names), None, "test"))
    rows = values.filter(F.col("code") == len(names))
    total = lambda side: F.coalesce(rows.agg(F.sum(f"n_{side}")).scalar(), F.lit(0).cast("long"))
    share = share.withColumns({"reference_rows": total("ref"), "current_rows": total("cur")})
    if not predictions:
        return share, F.lit(False)
    counts = values.filter(F.col("code") == len(names) + 1).agg(
        *[F.sum(f"n_{x}").alias(f"n_{x}") for x in ("ref", "cur")],
        *[F.sum(F.when(F.col("value") == 1, F.col(f"n_{x}")).otherwise(0)).alias(f"ones_{x}") for x in ("ref", "cur")],
    )
    verdict = _prediction_verdict(_proportions(counts), prediction_threshold, "test")
    return share, F.coalesce(verdict.agg(F.max("drifted")).scalar(), F.lit(False))


def should_retrain(
    summary: DataFrame,
    dataset: DataFrame,
    previous: DataFrame,
    growth_threshold: float = GROWTH_THRESHOLD,
) -> DataFrame:
    """Retrain on drift, or when the dataset has grown by more than 5 %.

    ``dataset`` and ``previous`` are one-row metadata with ``record_count``.
    """
    now, before = (d.select("record_count").scalar() for d in (dataset, previous))
    grown = F.col("growth") > growth_threshold
    return summary.select("overall_drift", ratio(now - before, before).alias("growth")).select(
        "overall_drift",
        "growth",
        grown.alias("grown"),
        (F.col("overall_drift") | grown).alias("retrain"),
    )
