"""Data rules, suites of rules, and routing of the rows that fail them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardflow.functions.columns import moment_text
from cardflow.operators.cleaning import present
from cardflow.operators.joins import join_back, may_send, repeated
from cardflow.schema import (
    ID,
    LABEL,
    MAX_AMOUNT,
    MERCHANT_CATEGORIES,
    RAW_COLS,
    V_COLS,
)

ROW = "row"
UNIQUE = "unique"
SCHEMA = "schema"
TABLE = "table"


@dataclass(frozen=True)
class Rule:
    """One expectation.

    ``check`` maps a DataFrame to a Column: true for a passing row (row rules) or
    true for a passing table (table rules, over aggregates).
    """

    kind: str
    level: str
    column: str
    check: Callable[[DataFrame], Column] | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}"


def exists(column: str) -> Rule:
    return Rule("exists", SCHEMA, column)


def not_null(column: str) -> Rule:
    return Rule("not_null", ROW, column, lambda df: present(df, column))


def unique(column: str) -> Rule:
    """Every row of a group of equal values fails; missing values pass."""
    return Rule("unique", UNIQUE, column)


def between(column: str, low: float | None = None, high: float | None = None) -> Rule:
    """Inclusive range, open where a bound is None; missing values pass."""

    def check(df: DataFrame) -> Column:
        inside = F.lit(True)
        if low is not None:
            inside = inside & (F.col(column) >= low)
        if high is not None:
            inside = inside & (F.col(column) <= high)
        return ~present(df, column) | inside

    return Rule("between", ROW, column, check)


def in_set(column: str, values: Sequence) -> Rule:
    """Member of ``values``; missing values pass."""
    return Rule(
        "in_set", ROW, column, lambda df: ~present(df, column) | F.col(column).isin(*values)
    )


def stdev_between(column: str, low: float) -> Rule:
    """Sample deviation of the present values is at least ``low``."""
    return Rule(
        "stdev",
        TABLE,
        column,
        lambda df: F.coalesce(
            F.stddev_samp(F.when(present(df, column), F.col(column))) >= low, F.lit(False)
        ),
    )


def row_count_between(low: int) -> Rule:
    return Rule("row_count", TABLE, "*", lambda df: F.count(F.lit(1)) >= low)


def raw_suite() -> list[Rule]:
    return [
        *[exists(c) for c in RAW_COLS],
        *[
            not_null(c)
            for c in ["transaction_id", "user_id", "card_id", "timestamp", "amount", LABEL]
        ],
        unique(ID),
        between("amount", low=0),
        in_set(LABEL, [0, 1]),
        between("hour_of_day", low=0, high=23),
        *[not_null(c) for c in V_COLS],
        row_count_between(1),
    ]


def processed_suite(columns: Sequence[str]) -> list[Rule]:
    rules = [not_null(c) for c in columns]
    rules.append(between("amount", low=0, high=MAX_AMOUNT))
    if "amount_normalized" in columns:
        rules.append(between("amount_normalized", low=-10, high=10))
    rules += [in_set(LABEL, [0, 1]), unique(ID)]
    rules += [between(c, low=-50, high=50) for c in V_COLS]
    rules.append(in_set("merchant_category", [*MERCHANT_CATEGORIES, "other"]))
    return rules


def feature_suite(columns: Sequence[str]) -> list[Rule]:
    rules = [not_null(c) for c in columns]
    optional = [
        between("amount_zscore", low=-20, high=20),
        between("tx_count_1h", low=0, high=1000),
        in_set("is_night_hour", [0, 1]),
    ]
    rules += [r for r in optional if r.column in columns]
    rules.append(in_set("is_international", [0, 1]))
    rules += [
        stdev_between(c, 0.0001) for c in ["amount", "amount_zscore", *V_COLS] if c in columns
    ]
    rules += [in_set(LABEL, [0, 1]), row_count_between(1)]
    return rules


def _applies(df: DataFrame, rule: Rule) -> bool:
    return rule.column == "*" or rule.column in df.columns


def _copies(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number of rows."""
    return (
        df.filter(present(df, column))
        .groupBy(F.col(column).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter("_rows > 1")
    )


def run_suite(
    df: DataFrame, suite: Sequence[Rule], name: str, failed: DataFrame | None = None
) -> DataFrame:
    """One row per rule: rows checked, rows that fail it and whether it holds.

    All rules share a single aggregate. Uniqueness adds one grouped count per
    column. A rule on an absent column fails without a job. ``failed`` gives the rows
    of ``df`` that ``tag_failures`` has tagged with this suite: rules on rows and
    uniqueness are then counted from their ``failed_rules`` and not checked again.
    """
    counted = failed is not None and _told_apart(suite)
    totals = [F.count(F.lit(1)).alias("rows")]
    results = []
    for i, rule in enumerate(suite):
        unexpected = F.lit(None).cast("long")
        if rule.level == SCHEMA or not _applies(df, rule):
            success = F.lit(_applies(df, rule))
        elif rule.level in (ROW, UNIQUE) and counted:
            unexpected = F.coalesce(F.col("_failed")[rule.name], F.lit(0).cast("long"))
            success = unexpected == 0
        elif rule.level == ROW:
            totals.append(F.count_if(~rule.check(df)).alias(f"r{i}"))
            unexpected, success = F.col(f"r{i}"), F.col(f"r{i}") == 0
        elif rule.level == UNIQUE:
            # Summed as a scalar subquery of the grouped counts.
            count = _copies(df, rule.column).agg(F.coalesce(F.sum("_rows"), F.lit(0)))
            unexpected = count.scalar()
            success = unexpected == 0
        else:
            totals.append(rule.check(df).alias(f"r{i}"))
            success = F.col(f"r{i}")
        results.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(rule.kind).alias("expectation"),
                F.lit(rule.column).alias("column"),
                unexpected.alias("unexpected"),
                success.alias("success"),
            )
        )
    total = df.agg(*totals)
    if counted:
        total = total.withColumn("_failed", _failures(failed).scalar())
    return (
        total
        .select("rows", F.inline(F.array(*results)))
        .select(
            F.lit(name).alias("suite"),
            "position",
            "expectation",
            "column",
            "rows",
            "unexpected",
            "success",
        )
    )


def _told_apart(suite: Sequence[Rule]) -> bool:
    """Whether each rule can be found by its name in ``failed_rules``, a split text."""
    names = [rule.name for rule in suite if rule.level in (ROW, UNIQUE)]
    return len(set(names)) == len(names) and not any("," in name for name in names)


def _failures(failed: DataFrame) -> DataFrame:
    """One map of rule names to numbers of tagged rows."""
    counts = failed.select(F.explode("failed_rules").alias("_rule")).groupBy("_rule").agg(
        F.count(F.lit(1)).alias("_n")
    )
    return counts.agg(F.map_from_entries(F.collect_list(F.struct("_rule", "_n"))))


def summarize_suite(results: DataFrame, evaluated_at: datetime | None = None) -> DataFrame:
    """One row per suite: passed, number of rules, the rules that failed, and the given time."""
    failed = F.when(~F.col("success"), F.concat_ws(":", "expectation", "column"))
    return results.groupBy("suite").agg(
        F.bool_and("success").alias("passed"),
        F.count(F.lit(1)).alias("total_expectations"),
        F.count_if(~F.col("success")).alias("failed_count"),
        F.sort_array(F.collect_list(failed)).alias("failed_expectations"),
        F.lit(moment_text(evaluated_at)).cast("string").alias("evaluated_at"),
    )


def tag_failures(df: DataFrame, suite: Sequence[Rule]) -> DataFrame:
    """Add ``failed_rules``: the names of all row rules and uniqueness rules a row fails.

    The names are gathered with ``concat_ws``, which skips nulls inside generated
    code. Values with copies are counted when this is called. As long as there are not
    too many, they are sent to the rows; else the rows are shuffled.
    """
    columns = df.columns
    names = []
    for i, rule in enumerate(suite):
        if not _applies(df, rule):
            continue
        if rule.level == ROW:
            names.append(F.when(~rule.check(df), F.lit(rule.name)))
        elif rule.level == UNIQUE:
            copies, n = repeated(df.filter(present(df, rule.column)), F.col(rule.column))
            copies = copies.withColumnsRenamed({"_value": f"_value{i}", "_rows": f"_rows{i}"})
            if may_send(df.sparkSession, n):
                copies = F.broadcast(copies)
            df = join_back(df, copies, {f"_value{i}": F.col(rule.column)})
            names.append(F.when(F.col(f"_rows{i}").isNotNull(), F.lit(rule.name)))
    text = F.concat_ws(",", *names) if names else F.lit("")
    empty = F.array().cast("array<string>")
    return df.withColumn("_failed", text).select(
        *columns,
        F.when(F.col("_failed") == "", empty)
        .otherwise(F.split("_failed", ","))
        .alias("failed_rules"),
    )


def split_by_rules(df: DataFrame, suite: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every row rule, and the others with their ``failed_rules``."""
    tagged = tag_failures(df, suite)
    passed = tagged.filter(F.size("failed_rules") == 0).drop("failed_rules")
    return passed, tagged.filter(F.size("failed_rules") > 0)


def only_table_level(results: DataFrame) -> bool:
    """Whether a suite failed without any row that failed. Only counts reach the driver."""
    failed, rows = results.agg(
        F.count_if(~F.col("success")), F.count_if(~F.col("success") & (F.col("unexpected") > 0))
    ).first()
    return failed > 0 and rows == 0


def broken_rules(results: DataFrame) -> Column:
    """Names of the rules that failed, as a scalar subquery."""
    name = F.concat_ws(":", "expectation", "column")
    return results.filter(~F.col("success")).agg(F.sort_array(F.collect_list(name))).scalar()


def route(
    df: DataFrame, suite: Sequence[Rule], results: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Rows to pass on and rows for the dead letter, given the result of ``run_suite``.

    Where only table rules fail, no row can be singled out: the whole batch goes
    to the dead letter and is passed on as well.
    """
    if only_table_level(results):
        return df, df.withColumn("failed_rules", broken_rules(results))
    return split_by_rules(df, suite)
