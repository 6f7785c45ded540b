"""Classification metrics from grouped counts, and the promotion rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.functions.columns import ratio
from cardflow.schema import LABEL, PROMOTION_MARGIN


def confusion(
    df: DataFrame, label: str = LABEL, prediction: str = "prediction", rows: str | None = None
) -> DataFrame:
    """Rows by label and prediction; ``rows`` names a column with the number each row stands for."""
    n = F.count(F.lit(1)) if rows is None else F.sum(rows)
    return df.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(n.alias("n"))


def f1_binary(
    df: DataFrame, label: str = LABEL, prediction: str = "prediction", rows: str | None = None
) -> DataFrame:
    """Precision, recall and F1 of class 1, 0 where undefined."""
    n = F.col("n")
    actual, predicted = F.col("label") == 1, F.col("prediction") == 1
    counts = confusion(df, label, prediction, rows).agg(
        *[
            F.coalesce(F.sum(F.when(condition, n)), F.lit(0)).alias(name)
            for name, condition in {
                "tp": actual & predicted,
                "fp": ~actual & predicted,
                "fn": actual & ~predicted,
            }.items()
        ]
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def classification_report(
    df: DataFrame, label: str = LABEL, prediction: str = "prediction"
) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and both averages."""
    sides = F.array(
        F.struct(
            F.col("label").alias("class"),
            F.col("n").alias("support"),
            F.lit(0).cast("long").alias("predicted"),
            F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hits"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            F.lit(0).cast("long").alias("support"),
            F.col("n").alias("predicted"),
            F.lit(0).cast("long").alias("hits"),
        ),
    )
    classes = (
        confusion(df, label, prediction)
        .select(F.inline(sides))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
        .select(
            F.col("class").cast("string").alias("class"),
            "support",
            "hits",
            ratio(F.col("hits"), F.col("predicted")).alias("precision"),
            ratio(F.col("hits"), F.col("support")).alias("recall"),
            ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"),
        )
    )
    scores = ("precision", "recall", "f1")
    support = F.sum("support")
    total = classes.agg(
        support.alias("support"),
        ratio(F.sum("hits"), support).alias("accuracy"),
        F.struct(*[F.avg(s).alias(s) for s in scores]).alias("macro"),
        F.struct(
            *[ratio(F.sum(F.col(s) * F.col("support")), support).alias(s) for s in scores]
        ).alias("weighted"),
    )
    missing = F.lit(None).cast("double")
    averages = total.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("accuracy").alias("class"),
                    missing.alias("precision"),
                    missing.alias("recall"),
                    F.col("accuracy").alias("f1"),
                    F.col("support").alias("support"),
                ),
                *[
                    F.struct(
                        F.lit(f"{kind} avg").alias("class"),
                        *[F.col(kind)[s].alias(s) for s in scores],
                        F.col("support").alias("support"),
                    )
                    for kind in ("macro", "weighted")
                ],
            )
        )
    )
    return classes.select("class", *scores, "support").unionByName(averages)


def score_summary(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col(prediction) == 1).alias("fraud_detected"),
    )


def promotion_decision(
    candidate_f1: DataFrame, production_f1: DataFrame | None, margin: float = PROMOTION_MARGIN
) -> DataFrame:
    """Whether a candidate replaces the production model.

    Both inputs are one-row results with a column ``f1``. A candidate wins by at
    least ``margin``, or when there is no production model (none, or F1 of 0).
    """
    production = F.lit(0.0)
    if production_f1 is not None:
        production = F.coalesce(production_f1.select("f1").scalar(), F.lit(0.0))
    scored = candidate_f1.select(F.col("f1").alias("candidate_f1"), production.alias("production_f1"))
    wins = F.col("candidate_f1") >= F.col("production_f1") + margin
    return scored.withColumn("promote", wins | (F.col("production_f1") == 0.0))
