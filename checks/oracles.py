"""DuckDB SQL for the registered queries, built from common table expressions.

Each statement is written from the rules of the operators, not from their plans:
windows stand where the library splits groups, and sorted rows where it selects.
"""

from __future__ import annotations

V = [f"V{i}" for i in range(1, 29)]
V_LIST = ", ".join(V)
ENGINEERED = [
    "amount",
    "amount_normalized",
    "amount_log1p",
    "amount_zscore",
    "tx_count_1h",
    "is_night_hour",
    "is_high_amount",
    "is_international",
    "hour_of_day",
]
HALF = "TIMESTAMP '2024-01-16'"
CATEGORIES = (
    "'grocery','online','travel','restaurant','entertainment',"
    "'gas_station','pharmacy','electronics','clothing','atm'"
)
DRIFT = ["amount", *V]
MICROS = "'%Y-%m-%d %H:%M:%S.%f'"
ISO = "'%Y-%m-%dT%H:%M:%SZ'"


def _six(expr: str, name: str) -> str:
    return f"round({expr}, 6) + 0e0 AS {name}"


def _component(i: int) -> str:
    return f"((event_id * {7919 + 104729 * i}) % 2000003) / 2000003e0 * 6e0 - 3e0"


def _planted(i: int) -> str:
    plain = _component(i)
    if i == 3:
        return f"CASE WHEN event_id % 307 = 0 THEN 60e0 ELSE {plain} END AS V3"
    if i == 7:
        return f"CASE WHEN event_id % 103 = 0 THEN NULL ELSE {plain} END AS V7"
    return f"{plain} AS V{i}"


RAW_COLUMNS = f"""transaction_id, user_id, card_id, "timestamp", amount, merchant_id,
    merchant_category, is_international, hour_of_day, {V_LIST}, is_fraud_label"""

CTES = {
    "events_tx": (
        [],
        f"""
    SELECT event_id,
      'TX_' || event_id AS transaction_id,
      CASE WHEN event_id % 97 = 0 THEN NULL
           ELSE 'USER_' || lpad(user_id::VARCHAR, 5, '0') END AS user_id,
      'CARD_' || lpad(user_id::VARCHAR, 5, '0') AS card_id,
      ts AS "timestamp",
      CASE WHEN event_id % 101 = 0 THEN -value WHEN event_id % 71 = 0 THEN value * 2000e0
           WHEN event_id % 13 = 0 THEN value * 10e0 ELSE value END AS amount,
      CASE WHEN event_id % 83 = 0 THEN NULL
           ELSE 'MER_' || lpad(json_extract_string(props, '$.k'), 4, '0') END AS merchant_id,
      CASE WHEN event_id % 79 = 0 THEN NULL WHEN event_type = 'click' THEN 'online'
           WHEN event_type = 'view' THEN 'grocery' WHEN event_type = 'purchase' THEN 'electronics'
           WHEN event_type = 'error' THEN 'atm' WHEN event_type = 'signup' THEN 'signup'
           END AS merchant_category,
      CASE WHEN event_id % 89 = 0 THEN NULL ELSE event_id % 20 = 0 END AS is_international,
      CAST(CASE WHEN event_id % 73 = 0 THEN NULL WHEN event_id % 211 = 0 THEN 24
           ELSE hour(ts) END AS INTEGER) AS hour_of_day,
      {", ".join(_planted(i) for i in range(1, 29))},
      CAST(CASE WHEN event_id % 997 = 0 THEN 2
                WHEN event_type = 'error' AND event_id % 10 = 0 THEN 1 ELSE 0 END AS INTEGER)
        AS is_fraud_label
    FROM events""",
    ),
    "tx_raw": (
        ["events_tx"],
        f"""
    SELECT {RAW_COLUMNS} FROM events_tx
    UNION ALL
    SELECT {RAW_COLUMNS} FROM (
      SELECT * REPLACE ("timestamp" + INTERVAL 1 SECOND AS "timestamp", amount + 0.5e0 AS amount)
      FROM events_tx WHERE event_id % 53 = 0)""",
    ),
    "deduped": (
        ["tx_raw"],
        """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY "timestamp", amount) AS rn
      FROM tx_raw) WHERE rn = 1""",
    ),
    "clean": (
        ["deduped"],
        f"""
    SELECT transaction_id, user_id, card_id, date_trunc('second', "timestamp") AS "timestamp",
      least(amount, 50000e0) AS amount,
      coalesce((least(amount, 50000e0) - avg(least(amount, 50000e0)) OVER ())
        / nullif(stddev_samp(least(amount, 50000e0)) OVER (), 0), 0e0) AS amount_normalized,
      coalesce(merchant_id, 'UNKNOWN') AS merchant_id,
      CASE WHEN merchant_category IN ({CATEGORIES}) THEN merchant_category ELSE 'other' END
        AS merchant_category,
      CAST(coalesce(is_international, false) AS INTEGER) AS is_international,
      coalesce(hour_of_day, -1) AS hour_of_day,
      {V_LIST}, is_fraud_label
    FROM deduped
    WHERE amount >= 0 AND user_id IS NOT NULL AND V7 IS NOT NULL""",
    ),
    "features": (
        ["clean"],
        f"""
    SELECT transaction_id, user_id, card_id, "timestamp", amount, amount_normalized,
      ln(1 + amount) AS amount_log1p,
      coalesce((amount - avg(amount) OVER (PARTITION BY card_id))
        / nullif(stddev_samp(amount) OVER (PARTITION BY card_id), 0), 0e0) AS amount_zscore,
      CAST(count(*) OVER (PARTITION BY card_id ORDER BY "timestamp"
        RANGE BETWEEN INTERVAL 3600 SECOND PRECEDING AND CURRENT ROW) AS INTEGER) AS tx_count_1h,
      CAST(hour_of_day IN (22, 23, 0, 1, 2, 3, 4) AS INTEGER) AS is_night_hour,
      CAST(amount > 500 AS INTEGER) AS is_high_amount,
      is_international, hour_of_day, merchant_category, {V_LIST}, is_fraud_label
    FROM clean""",
    ),
    "baseline": (
        [],
        f"""
    SELECT event_id, CAST(epoch(date_trunc('second', ts)) - 1704067200 AS DOUBLE) AS "Time",
      {", ".join(f"{_component(i)} AS V{i}" for i in range(1, 29))},
      value AS "Amount",
      CAST(event_type = 'error' AND event_id % 10 = 0 AS INTEGER) AS "Class"
    FROM events""",
    ),
    "global_counts": (
        ["baseline"],
        """
    SELECT event_id, "Time", CAST(
      count(*) OVER (ORDER BY "Time" RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW)
      - count(*) OVER (PARTITION BY "Time")
      + row_number() OVER (PARTITION BY "Time"
          ORDER BY substr(md5(event_id::VARCHAR), 1, 4), event_id) AS INTEGER) AS tx_count_1h
    FROM baseline""",
    ),
    "canonical": (
        ["baseline", "global_counts"],
        f"""
    SELECT event_id, "Time", amount, amount_normalized, ln(1 + amount) AS amount_log1p,
      amount_normalized AS amount_zscore, tx_count_1h,
      CAST(hour_of_day IN (22, 23, 0, 1, 2, 3, 4) AS INTEGER) AS is_night_hour,
      CAST(amount > 500 AS INTEGER) AS is_high_amount, 0 AS is_international, hour_of_day,
      {V_LIST}, is_fraud_label
    FROM (
      SELECT event_id, b."Time", b."Amount" AS amount,
        coalesce((b."Amount" - avg(b."Amount") OVER ())
          / nullif(stddev_samp(b."Amount") OVER (), 0), 0e0) AS amount_normalized,
        CAST(floor(b."Time" / 3600) % 24 AS INTEGER) AS hour_of_day,
        tx_count_1h, {", ".join("b." + v for v in V)}, b."Class" AS is_fraud_label
      FROM baseline b JOIN global_counts USING (event_id))""",
    ),
    "inference": (
        ["clean"],
        f"""
    SELECT CAST(hour_of_day AS DOUBLE) AS "Time", amount, {V_LIST},
      CAST(amount > 100 AND V1 > 0 AS INTEGER) AS predicted_fraud
    FROM clean WHERE "timestamp" >= {HALF}""",
    ),
    "reference": (
        ["clean"],
        f"""SELECT * FROM clean WHERE "timestamp" < {HALF}""",
    ),
    "batches": (
        ["tx_raw"],
        """
    SELECT *, CASE WHEN CAST(substr(transaction_id, 4) AS BIGINT) % 1009 = 0 THEN 'broken_name'
      ELSE strftime(time_bucket(INTERVAL 5 MINUTE, "timestamp"), '%Y%m%d_%H%M%S') END AS batch_id
    FROM tx_raw""",
    ),
    "registry": (
        [],
        """
    SELECT 'model_' || o_custkey AS name, o_orderkey AS version,
      CASE o_orderstatus WHEN 'F' THEN 'Production' WHEN 'O' THEN 'Staging' ELSE 'Archived' END
        AS stage
    FROM orders""",
    ),
    "predicted": (
        ["clean"],
        """
    SELECT "timestamp", CAST(is_fraud_label = 1 AS INTEGER) AS label,
      CAST(amount > 100 AND V1 > 0 AS INTEGER) AS prediction
    FROM clean""",
    ),
    "sides": (
        ["reference", "inference"],
        f"""
    SELECT feature, value, is_ref FROM (
      SELECT {", ".join(DRIFT)}, 1 AS is_ref FROM reference
      UNION ALL
      SELECT {", ".join(DRIFT)}, 0 AS is_ref FROM inference)
    UNPIVOT (value FOR feature IN ({", ".join(DRIFT)}))""",
    ),
    "distribution": (
        ["sides"],
        """
    SELECT feature, value, n_ref, n_cur,
      sum(n_ref) OVER (PARTITION BY feature) AS t_ref,
      sum(n_cur) OVER (PARTITION BY feature) AS t_cur,
      sum(n_ref) OVER (PARTITION BY feature ORDER BY value) AS c_ref,
      sum(n_cur) OVER (PARTITION BY feature ORDER BY value) AS c_cur,
      lead(value) OVER (PARTITION BY feature ORDER BY value) AS next_value
    FROM (SELECT feature, value, sum(is_ref) AS n_ref, sum(1 - is_ref) AS n_cur
          FROM sides GROUP BY feature, value)""",
    ),
    # Quantile edges in place of the library's bins by rank.
    "edges": (
        ["sides"],
        """
    SELECT feature, quantile_disc(value, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS cuts
    FROM sides WHERE is_ref = 1 GROUP BY feature""",
    ),
    "bins": (
        ["sides", "edges"],
        """
    SELECT feature, bin, p_ref, p_cur FROM (
      SELECT feature, bin, sum(is_ref) / any_value(t_ref) AS p_ref,
        sum(1 - is_ref) / any_value(t_cur) AS p_cur
      FROM (
        SELECT s.feature, is_ref, len(list_filter(cuts, lambda c: c < value)) AS bin,
          sum(is_ref) OVER (PARTITION BY s.feature)::DOUBLE AS t_ref,
          sum(1 - is_ref) OVER (PARTITION BY s.feature)::DOUBLE AS t_cur
        FROM sides s JOIN edges e ON s.feature = e.feature)
      GROUP BY feature, bin)""",
    ),
    "column_stats": (
        ["distribution", "sides"],
        """
    SELECT d.feature, n_values, ks, w1, w1 / greatest(std_ref, 0.001e0) AS w1_norm, t_ref, t_cur
    FROM (SELECT feature, count(*) AS n_values, max(abs(c_ref / t_ref::DOUBLE - c_cur / t_cur::DOUBLE)) AS ks,
            sum(abs(c_ref / t_ref::DOUBLE - c_cur / t_cur::DOUBLE) * coalesce(next_value - value, 0e0)) AS w1,
            any_value(t_ref)::DOUBLE AS t_ref, any_value(t_cur)::DOUBLE AS t_cur
          FROM distribution GROUP BY feature) d
    JOIN (SELECT feature, stddev_pop(value) AS std_ref FROM sides WHERE is_ref = 1 GROUP BY feature) s
      ON d.feature = s.feature""",
    ),
    "column_scores": (
        ["column_stats"],
        """
    SELECT feature, n_values, t_ref,
      'ks' AS method,
      %s AS score
    FROM column_stats""",
    ),
    "prediction": (
        ["reference", "inference"],
        """
    SELECT *, p_pooled_z AS z FROM (
      SELECT n_ref, ones_ref, n_cur, ones_cur, share_ref, share_cur,
        coalesce((share_cur - share_ref) / nullif(sqrt((ones_ref + ones_cur) / (n_ref + n_cur)::DOUBLE
          * (1 - (ones_ref + ones_cur) / (n_ref + n_cur)::DOUBLE)
          * (1e0 / n_ref + 1e0 / n_cur)), 0), 0e0) AS p_pooled_z
      FROM (
        SELECT *, ones_ref / n_ref::DOUBLE AS share_ref, ones_cur / n_cur::DOUBLE AS share_cur
        FROM (SELECT count(is_fraud_label) AS n_ref,
                count(*) FILTER (is_fraud_label = 1) AS ones_ref FROM reference),
             (SELECT count(predicted_fraud) AS n_cur,
                count(*) FILTER (predicted_fraud = 1) AS ones_cur FROM inference)))""",
    ),
    "prediction_scored": (["prediction"], "SELECT *, %s AS p_value, %s AS js FROM prediction"),
    "summary": (
        ["column_scores", "prediction_scored", "reference", "inference"],
        """
    SELECT n_drifted / n_total::DOUBLE AS data_drift_score, n_drifted AS n_drifted_features,
      n_total AS n_total_features, n_drifted / n_total::DOUBLE > 0.3e0 AS data_drift_detected,
      pred AS pred_drift_detected, n_drifted / n_total::DOUBLE > 0.3e0 OR pred AS overall_drift,
      0.3e0 AS threshold_data, 0.05e0 AS threshold_pred, reference_rows, current_rows
    FROM (SELECT count(*) FILTER (score < 0.05e0) AS n_drifted,
            count(*) AS n_total FROM column_scores),
      (SELECT p_value < 0.05e0 AS pred
       FROM prediction_scored),
      (SELECT count(*) AS reference_rows FROM reference),
      (SELECT count(*) AS current_rows FROM inference)""",
    ),
    "raw_failures": (
        ["tx_raw"],
        "SELECT *, concat_ws(',', %s) AS failed_rules FROM"
        " (SELECT *, count(*) OVER (PARTITION BY transaction_id) AS copies FROM tx_raw)",
    ),
}


def _ks_p(ks: str, n: str, m: str) -> str:
    lam = f"({ks} * sqrt({n} * {m} / ({n} + {m})))"
    series = (
        f"list_sum(list_transform(range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 2e0 ELSE -2e0 END"
        f" * exp(-2e0 * k * k * {lam} * {lam})))"
    )
    return f"CASE WHEN {lam} < 0.2e0 THEN 1e0 ELSE least(greatest({series}, 0e0), 1e0) END"


def _erfc(x: str) -> str:
    t = f"(1e0 / (1e0 + 0.3275911e0 * {x}))"
    poly = (
        f"(0.254829592e0 * {t} - 0.284496736e0 * pow({t}, 2) + 1.421413741e0 * pow({t}, 3)"
        f" - 1.453152027e0 * pow({t}, 4) + 1.061405429e0 * pow({t}, 5))"
    )
    return f"({poly} * exp(-1e0 * {x} * {x}))"


def _js(p: str, q: str) -> str:
    """Divergence of (p, 1-p) and (q, 1-q)."""

    def half(a: str, b: str) -> str:
        return f"CASE WHEN {a} > 0 THEN {a} * ln({a} / (({a} + {b}) / 2)) ELSE 0e0 END"

    pairs = [(p, q), (q, p), (f"(1 - {p})", f"(1 - {q})"), (f"(1 - {q})", f"(1 - {p})")]
    return "sqrt(greatest((" + " + ".join(half(a, b) for a, b in pairs) + ") / 2, 0e0))"


def _raw_rule_names() -> str:
    critical = ["transaction_id", "user_id", "card_id", '"timestamp"', "amount", "is_fraud_label"]
    cases = [
        f"CASE WHEN {c} IS NULL THEN 'not_null:{c.strip(chr(34))}' END" for c in critical
    ]
    cases += [
        "CASE WHEN copies > 1 THEN 'unique:transaction_id' END",
        "CASE WHEN amount < 0 THEN 'between:amount' END",
        "CASE WHEN is_fraud_label NOT IN (0, 1) THEN 'in_set:is_fraud_label' END",
        "CASE WHEN hour_of_day NOT BETWEEN 0 AND 23 THEN 'between:hour_of_day' END",
    ]
    cases += [f"CASE WHEN {v} IS NULL THEN 'not_null:{v}' END" for v in V]
    return ", ".join(cases)


def _cte(name: str) -> str:
    text = CTES[name][1]
    if name == "column_scores":
        return text % _ks_p("ks", "t_ref", "t_cur")
    if name == "prediction_scored":
        return text % (_erfc("(abs(z) / sqrt(2e0))"), _js("share_ref", "share_cur"))
    if name == "raw_failures":
        return text % _raw_rule_names()
    return text


# The later fifth of the feature rows, with the rule that the trees learn as their label.
LATER_BY_RULE = """
    SELECT transaction_id, ((is_night_hour = 1 AND is_high_amount = 1) OR is_international = 1)::INTEGER AS label
    FROM (SELECT *, count(*) OVER () AS n,
            row_number() OVER (ORDER BY "timestamp", md5(transaction_id)) AS rn FROM features)
    WHERE rn > CAST(floor(n * 0.8e0) AS BIGINT)"""


def _with(select: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """The statement with every table expression it needs, each defined once."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in CTES[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    parts = [f"{name} AS ({_cte(name)})" for name in ordered]
    parts += [f"{name} AS ({text})" for name, text in (extra or {}).items()]
    return "WITH " + ",\n".join(parts) + "\n" + select


def _suite(name: str, source: str, rules: list[tuple[str, str, str | None, str]]) -> str:
    """Result rows of a suite: a plain CASE sum per rule."""
    selects = []
    for i, (kind, column, unexpected, success) in enumerate(rules):
        count = "NULL::BIGINT" if unexpected is None else f"({unexpected})::BIGINT"
        selects.append(
            f"SELECT '{name}' AS suite, {i} AS position, '{kind}' AS expectation,"
            f" '{column}' AS \"column\", (SELECT count(*) FROM {source}) AS \"rows\","
            f" {count} AS unexpected, {success} AS success"
        )
    return "\nUNION ALL ".join(selects)


def _row_rule(kind: str, column: str, bad: str, source: str) -> tuple[str, str, str, str]:
    count = f"SELECT coalesce(sum(CASE WHEN {bad} THEN 1 ELSE 0 END), 0) FROM {source}"
    return kind, column, count, f"({count}) = 0"


def _not_null(column: str, source: str):
    return _row_rule("not_null", column, f'"{column}" IS NULL', source)


def _unique(source: str):
    count = (
        f"SELECT coalesce(sum(c), 0) FROM (SELECT count(*) AS c FROM {source}"
        " WHERE transaction_id IS NOT NULL GROUP BY transaction_id) WHERE c > 1"
    )
    return "unique", "transaction_id", count, f"({count}) = 0"


def _label(source: str):
    return _row_rule("in_set", "is_fraud_label", "is_fraud_label NOT IN (0, 1)", source)


RAW_NAMES = [
    "transaction_id", "user_id", "card_id", "timestamp", "amount", "merchant_id",
    "merchant_category", "is_international", "hour_of_day", *V, "is_fraud_label",
]
PROCESSED_NAMES = [
    "transaction_id", "user_id", "card_id", "timestamp", "amount", "amount_normalized",
    "merchant_id", "merchant_category", "is_international", "hour_of_day", *V, "is_fraud_label",
]
FEATURE_NAMES = [
    "transaction_id", "user_id", "card_id", "timestamp", *ENGINEERED, "merchant_category",
    *V, "is_fraud_label",
]


def _raw_rules() -> list:
    s = "tx_raw"
    critical = ["transaction_id", "user_id", "card_id", "timestamp", "amount", "is_fraud_label"]
    return [
        *[("exists", c, None, "true") for c in RAW_NAMES],
        *[_not_null(c, s) for c in critical],
        _unique(s),
        _row_rule("between", "amount", "amount < 0", s),
        _label(s),
        _row_rule("between", "hour_of_day", "hour_of_day NOT BETWEEN 0 AND 23", s),
        *[_not_null(v, s) for v in V],
        ("row_count", "*", None, f"(SELECT count(*) FROM {s}) >= 1"),
    ]


def _processed_rules() -> list:
    s = "clean"
    return [
        *[_not_null(c, s) for c in PROCESSED_NAMES],
        _row_rule("between", "amount", "amount NOT BETWEEN 0 AND 50000", s),
        _row_rule("between", "amount_normalized", "abs(amount_normalized) > 10", s),
        _label(s),
        _unique(s),
        *[_row_rule("between", v, f"abs({v}) > 50", s) for v in V],
        _row_rule(
            "in_set", "merchant_category", f"merchant_category NOT IN ({CATEGORIES},'other')", s
        ),
    ]


def _feature_rules() -> list:
    s = "features"
    return [
        *[_not_null(c, s) for c in FEATURE_NAMES],
        _row_rule("between", "amount_zscore", "abs(amount_zscore) > 20", s),
        _row_rule("between", "tx_count_1h", "tx_count_1h NOT BETWEEN 0 AND 1000", s),
        _row_rule("in_set", "is_night_hour", "is_night_hour NOT IN (0, 1)", s),
        _row_rule("in_set", "is_international", "is_international NOT IN (0, 1)", s),
        *[
            ("stdev", c, None, f"(SELECT coalesce(stddev_samp({c}) >= 0.0001, false) FROM {s})")
            for c in ["amount", "amount_zscore", *V]
        ],
        _label(s),
        ("row_count", "*", None, f"(SELECT count(*) FROM {s}) >= 1"),
    ]


def _micros(column: str = '"timestamp"', name: str = '"timestamp"') -> str:
    return f"strftime({column}, {MICROS}) AS {name}"


def _iso(column: str = '"timestamp"', name: str = '"timestamp"') -> str:
    return f"strftime({column}, {ISO}) AS {name}"


def _rounded_features(source_columns: list[str]) -> str:
    rounded = {"amount_normalized", "amount_log1p", "amount_zscore"}
    return ", ".join(_six(c, c) if c in rounded else f'"{c}"' for c in source_columns)


RAW_TEXT = f"""transaction_id, user_id, card_id, {_micros()}, amount, merchant_id,
    merchant_category, is_international, hour_of_day, {V_LIST}, is_fraud_label"""

VALID = {
    "raw_ok": "SELECT * FROM raw_failures WHERE failed_rules = ''",
    "v_clean": f"""
    SELECT transaction_id, user_id, card_id, date_trunc('second', "timestamp") AS "timestamp",
      least(amount, 50000e0) AS amount,
      coalesce((least(amount, 50000e0) - avg(least(amount, 50000e0)) OVER ())
        / nullif(stddev_samp(least(amount, 50000e0)) OVER (), 0), 0e0) AS amount_normalized,
      {V_LIST}, is_fraud_label FROM raw_ok""",
    "v_processed": f"""
    SELECT * FROM v_clean WHERE abs(amount_normalized) <= 10
      AND {" AND ".join(f"abs({v}) <= 50" for v in V)}""",
    "v_features": """
    SELECT *, coalesce((amount - avg(amount) OVER (PARTITION BY card_id))
        / nullif(stddev_samp(amount) OVER (PARTITION BY card_id), 0), 0e0) AS amount_zscore,
      CAST(count(*) OVER (PARTITION BY card_id ORDER BY "timestamp"
        RANGE BETWEEN INTERVAL 3600 SECOND PRECEDING AND CURRENT ROW) AS INTEGER) AS tx_count_1h
    FROM v_processed""",
}
VALID_SELECT = f"""
    SELECT transaction_id, card_id, amount, {_six("amount_normalized", "amount_normalized")},
      {_six("amount_zscore", "amount_zscore")}, tx_count_1h, is_fraud_label
    FROM v_features WHERE abs(amount_zscore) <= 20 AND tx_count_1h <= 1000"""

# The same as of each arrival: statistics over the rows of this one and those before.
ARRIVAL = """CASE WHEN "timestamp" <= TIMESTAMP '2024-01-10' THEN 1
      WHEN "timestamp" <= TIMESTAMP '2024-01-20 12:00:00' THEN 2 ELSE 3 END"""
AS_OF_RUN = {
    "arrived": f"SELECT *, {ARRIVAL} AS arrival FROM tx_raw",
    "arrived_failures": "SELECT *, concat_ws(',', %s) AS failed_rules FROM"
    " (SELECT *, count(*) OVER (PARTITION BY transaction_id, arrival) AS copies FROM arrived)",
    "raw_ok": "SELECT * FROM arrived_failures WHERE failed_rules = ''",
    "v_clean": f"""
    SELECT transaction_id, card_id, arrival, date_trunc('second', "timestamp") AS "timestamp",
      least(amount, 50000e0) AS amount,
      coalesce((least(amount, 50000e0) - avg(least(amount, 50000e0)) OVER (ORDER BY arrival))
        / nullif(stddev_samp(least(amount, 50000e0)) OVER (ORDER BY arrival), 0), 0e0) AS amount_normalized,
      {V_LIST}, is_fraud_label FROM raw_ok""",
    "v_processed": VALID["v_processed"],
    "v_features": """
    SELECT *, coalesce((amount - avg(amount) OVER (PARTITION BY card_id ORDER BY arrival))
        / nullif(stddev_samp(amount) OVER (PARTITION BY card_id ORDER BY arrival), 0), 0e0) AS amount_zscore,
      CAST(count(*) OVER (PARTITION BY card_id ORDER BY "timestamp"
        RANGE BETWEEN INTERVAL 3600 SECOND PRECEDING AND CURRENT ROW) AS INTEGER) AS tx_count_1h
    FROM v_processed""",
}

RATIO = "coalesce({a} / nullif({b}, 0)::DOUBLE, 0e0)"


def _ratio(a: str, b: str) -> str:
    return RATIO.format(a=f"({a})", b=f"({b})")


def _report(source: str, label: str, prediction: str) -> str:
    return f"""
    , pairs AS (SELECT {label} AS l, {prediction} AS p FROM {source}),
    classes AS (SELECT l AS c FROM pairs UNION SELECT p FROM pairs),
    per_class AS (
      SELECT c, (SELECT count(*) FROM pairs WHERE l = c) AS support,
        {_ratio("SELECT count(*) FROM pairs WHERE l = c AND p = c", "SELECT count(*) FROM pairs WHERE p = c")} AS pr,
        {_ratio("SELECT count(*) FROM pairs WHERE l = c AND p = c", "SELECT count(*) FROM pairs WHERE l = c")} AS re
      FROM classes),
    scored AS (SELECT *, coalesce(2 * pr * re / nullif(pr + re, 0), 0e0) AS f FROM per_class)
    SELECT c::VARCHAR AS "class", {_six("pr", '"precision"')}, {_six("re", "recall")}, {_six("f", "f1")}, support
    FROM scored
    UNION ALL SELECT 'accuracy', NULL, NULL, round((SELECT avg(CASE WHEN l = p THEN 1e0 ELSE 0e0 END) FROM pairs), 6) + 0e0,
      (SELECT count(*) FROM pairs)
    UNION ALL SELECT 'macro avg', round(avg(pr), 6) + 0e0, round(avg(re), 6) + 0e0, round(avg(f), 6) + 0e0,
      sum(support)::BIGINT FROM scored
    UNION ALL SELECT 'weighted avg', round(sum(pr * support) / sum(support), 6) + 0e0,
      round(sum(re * support) / sum(support), 6) + 0e0, round(sum(f * support) / sum(support), 6) + 0e0,
      sum(support)::BIGINT FROM scored"""


def _f1(source: str, where: str = "true") -> str:
    def n(c: str) -> str:
        return f"count(*) FILTER ({c} AND {where})"

    tp, fp = n("label = 1 AND prediction = 1"), n("label <> 1 AND prediction = 1")
    fn = n("label = 1 AND prediction <> 1")
    return (
        f"SELECT {_ratio(tp, f'{tp} + {fp}')} AS pr, {_ratio(tp, f'{tp} + {fn}')} AS re,"
        f" {_ratio(f'2 * {tp}', f'2 * {tp} + {fp} + {fn}')} AS f FROM {source}"
    )


SNAPSHOT_KEY = "md5('42|' || transaction_id)"

UNION_COLUMNS = ", ".join(ENGINEERED + V)

BASELINE_TIME = """(TIMESTAMP '2013-09-01' + to_seconds(CAST("Time" AS BIGINT)))"""

DATASET = {
    "assembled": f"""
    SELECT 'BASE_' || event_id AS transaction_id, {UNION_COLUMNS}, is_fraud_label,
      {BASELINE_TIME} AS "timestamp", 'baseline' AS source FROM canonical
    UNION ALL
    SELECT transaction_id, {UNION_COLUMNS}, is_fraud_label, "timestamp",
      CASE WHEN "timestamp" < {HALF} THEN 'weekly' ELSE 'current' END FROM features"""
}


def _stratified(source: str, size: int, columns: str) -> str:
    """The rows with the smallest keys of each stratum, or all rows of a small table."""
    return f"""
    SELECT {columns} FROM (
      SELECT *, row_number() OVER (PARTITION BY is_fraud_label ORDER BY {SNAPSHOT_KEY}) AS rn,
        count(*) OVER () AS n, count(*) FILTER (is_fraud_label = 1) OVER () AS pos
      FROM {source})
    WHERE n <= {size}
      OR (is_fraud_label = 1 AND rn <= greatest(1, CAST(floor({size} * (pos / n::DOUBLE)) AS INTEGER)))
      OR (is_fraud_label = 0 AND rn <= {size} - greatest(1, CAST(floor({size} * (pos / n::DOUBLE)) AS INTEGER)))"""


VERSION = {
    "target": """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY "timestamp", amount) rn
      FROM tx_raw WHERE "timestamp" < TIMESTAMP '2024-01-20') WHERE rn = 1""",
    "incoming": """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY "timestamp", amount) rn
      FROM tx_raw WHERE "timestamp" >= TIMESTAMP '2024-01-15') WHERE rn = 1""",
    "fresh": "SELECT * FROM incoming WHERE transaction_id NOT IN (SELECT transaction_id FROM target)",
}

def _request_columns() -> str:
    return f'CAST(hour_of_day AS DOUBLE) AS "Time", amount AS "Amount", {V_LIST}'


def _chi2() -> str:
    names = ["merchant_category", "hour_of_day", "is_international"]
    sides = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c}::VARCHAR AS value, \"timestamp\" < {HALF} AS is_ref FROM clean"
        for c in names
    )
    half = "(chi2 / 2)"
    odd_terms = (
        f"list_sum(list_transform(range(1, ((df - 1) // 2 + 1)::BIGINT), lambda i: pow({half}, i - 0.5e0)"
        " / gamma(i + 0.5e0)))"
    )
    even_terms = (
        f"list_sum(list_transform(range(0, (df // 2)::BIGINT), lambda i: pow({half}, i) / gamma(i + 1)))"
    )
    p = f"""CASE WHEN df < 1 THEN 1e0
        WHEN df % 2 = 0 THEN least(exp(-{half}) * {even_terms}, 1e0)
        ELSE least({_erfc(f"sqrt({half})")} + coalesce(exp(-{half}) * {odd_terms}, 0e0), 1e0) END"""
    return f"""
    , cat AS ({sides}),
    cells AS (SELECT feature, value, count(*) FILTER (is_ref) AS a, count(*) FILTER (NOT is_ref) AS b
      FROM cat GROUP BY feature, value),
    expected AS (SELECT *, sum(a) OVER (PARTITION BY feature)::DOUBLE AS ta,
      sum(b) OVER (PARTITION BY feature)::DOUBLE AS tb FROM cells),
    tested AS (SELECT feature, sum(pow(a - (a + b) * ta / (ta + tb), 2) / ((a + b) * ta / (ta + tb))
        + pow(b - (a + b) * tb / (ta + tb), 2) / ((a + b) * tb / (ta + tb))) AS chi2,
      count(*) - 1 AS df FROM expected GROUP BY feature)
    SELECT feature, {_six("chi2", "chi2")}, df, {_six(p, "p_value")} FROM tested"""


def oracle_sql() -> dict[str, str]:
    batch_run = _with(VALID_SELECT, "raw_failures", extra=VALID)
    failures = AS_OF_RUN["arrived_failures"] % _raw_rule_names()
    as_of_run = _with(VALID_SELECT, "tx_raw", extra=AS_OF_RUN | {"arrived_failures": failures})
    summary_columns = """data_drift_score, n_drifted_features, n_total_features,
      data_drift_detected, pred_drift_detected, overall_drift, threshold_data, threshold_pred,
      reference_rows, current_rows"""
    return {
        "category_summary": _with(
            """
    SELECT merchant_category, count(*) AS transactions,
      count(*) FILTER (is_fraud_label = 1) AS frauds, sum(is_night_hour)::BIGINT AS at_night,
      sum(is_high_amount)::BIGINT AS high_amounts, sum(tx_count_1h)::BIGINT AS tx_count_1h,
      round(sum(amount), 4) AS amount, round(sum(abs(amount_zscore)), 4) AS abs_zscore
    FROM features GROUP BY merchant_category""",
            "features",
        ),
        "tx_raw": _with(f"SELECT {RAW_TEXT} FROM tx_raw", "tx_raw"),
        "incremental_scan": f"""
    SELECT event_id, {_micros("ts", "ts")}, user_id, value FROM events
    WHERE ts > TIMESTAMP '2024-01-10 06:00:00' AND ts <= TIMESTAMP '2024-01-20 12:00:00'""",
        "batch_select": _with(
            """
    SELECT batch_id, count(*) AS "rows", min(transaction_id) AS first_id FROM batches
    WHERE try_strptime(batch_id, '%Y%m%d_%H%M%S') >= TIMESTAMP '2024-01-08'
      AND try_strptime(batch_id, '%Y%m%d_%H%M%S') < TIMESTAMP '2024-01-15'
    GROUP BY batch_id""",
            "batches",
        ),
        "week_window": _with(
            """
    SELECT reason, 'week_' || strftime(date_trunc('week', "timestamp"), '%Y%m%d') AS week_key,
      count(*) AS "rows", count(DISTINCT transaction_id) AS ids
    FROM (
      SELECT *, 'scheduled' AS reason FROM tx_raw
      WHERE "timestamp" >= TIMESTAMP '2024-01-15' AND "timestamp" < TIMESTAMP '2024-01-22'
      UNION ALL
      SELECT *, 'drift' AS reason FROM tx_raw
      WHERE "timestamp" >= TIMESTAMP '2024-01-22' AND "timestamp" < TIMESTAMP '2024-01-24 09:30:00')
    GROUP BY ALL""",
            "tx_raw",
        ),
        "read_batches": _with(f"SELECT {RAW_TEXT} FROM tx_raw", "tx_raw"),
        "recent_files": _with(f"SELECT {RAW_TEXT} FROM tx_raw", "tx_raw"),
        "baseline_csv": _with(f'SELECT "Time", {V_LIST}, "Amount", "Class" FROM baseline', "baseline"),
        "tolerant_read": _with(
            """
    SELECT x.* FROM (
      SELECT count(*) FILTER (is_fraud_label IS DISTINCT FROM 1) AS good,
        count(*) FILTER (is_fraud_label = 1) AS bad FROM tx_raw) AS n,
    LATERAL (VALUES ('read', good, good, 0::BIGINT, 1::BIGINT, good),
      ('damaged', bad, 0::BIGINT, bad, 0::BIGINT, good),
      ('unreadable', NULL, 0::BIGINT, 0::BIGINT, 0::BIGINT, good))
      AS x(outcome, expected, decoded, lost, empty_files, rows_read)""",
            "tx_raw",
        ),
        "dedupe_tx": _with(
            f"SELECT transaction_id, card_id, {_micros()}, amount, is_fraud_label FROM deduped",
            "deduped",
        ),
        "drop_critical_nulls": _with(
            f"SELECT {RAW_TEXT} FROM tx_raw WHERE user_id IS NOT NULL AND V7 IS NOT NULL", "tx_raw"
        ),
        "fill_defaults": _with(
            """
    SELECT transaction_id, amount, coalesce(merchant_id, 'UNKNOWN') AS merchant_id,
      coalesce(merchant_category, 'other') AS merchant_category,
      coalesce(is_international, false) AS is_international,
      coalesce(hour_of_day, -1) AS hour_of_day FROM tx_raw""",
            "tx_raw",
        ),
        "normalize_timestamp": _with(
            f"SELECT transaction_id, amount, {_iso()}, {_iso(name='nanos')} FROM tx_raw", "tx_raw"
        ),
        "clamp_amount": _with(
            "SELECT transaction_id, least(amount, 50000e0) AS amount FROM tx_raw WHERE amount >= 0",
            "tx_raw",
        ),
        "normalize_category": _with(
            f"""SELECT transaction_id, amount, CASE WHEN merchant_category IN ({CATEGORIES})
      THEN merchant_category ELSE 'other' END AS merchant_category FROM tx_raw""",
            "tx_raw",
        ),
        "standardize_amount": _with(
            f"""SELECT transaction_id, amount,
      {_six("(amount - avg(amount) OVER ()) / stddev_samp(amount) OVER ()", "amount_normalized")}
    FROM tx_raw""",
            "tx_raw",
        ),
        "scaler_fit": f"""SELECT {_six("avg(value)", "amount_mean")},
      {_six("stddev_samp(value)", "amount_std")} FROM events""",
        "scaler_apply": f"""
    SELECT event_id, {_six("(value - m) / s", "scaled")} FROM events,
      (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events WHERE ts < {HALF})""",
        "clean_transactions": _with(
            f"""
    SELECT transaction_id, user_id, card_id, {_iso()}, amount,
      {_six("amount_normalized", "amount_normalized")}, merchant_id, merchant_category,
      is_international, hour_of_day, {V_LIST}, is_fraud_label FROM clean""",
            "clean",
        ),
        "night_log_high": _with(
            f"""
    SELECT transaction_id, amount,
      CAST(coalesce(hour_of_day IN (22, 23, 0, 1, 2, 3, 4), false) AS INTEGER) AS is_night_hour,
      {_six("CASE WHEN amount > -1 THEN ln(1 + amount) END", "amount_log1p")},
      CAST(amount > 500 AS INTEGER) AS is_high_amount
    FROM tx_raw""",
            "tx_raw",
        ),
        "card_zscore": _with(
            f"""
    SELECT transaction_id, amount, {_six('''coalesce((amount - avg(amount) OVER (PARTITION BY card_id))
      / nullif(stddev_samp(amount) OVER (PARTITION BY card_id), 0), 0e0)''', "amount_zscore")}
    FROM tx_raw""",
            "tx_raw",
        ),
        "tx_count_1h": _with(
            """
    SELECT transaction_id, amount, CAST(count(*) OVER (PARTITION BY card_id
      ORDER BY date_trunc('second', "timestamp")
      RANGE BETWEEN INTERVAL 3600 SECOND PRECEDING AND CURRENT ROW) AS INTEGER) AS tx_count_1h
    FROM tx_raw""",
            "tx_raw",
        ),
        "trailing_global": _with(
            'SELECT event_id, "Time", tx_count_1h FROM global_counts', "global_counts"
        ),
        "card_features": _with(
            f"""SELECT transaction_id, user_id, card_id, {_iso()}, {_rounded_features(ENGINEERED)},
      merchant_category, {V_LIST}, is_fraud_label FROM features""",
            "features",
        ),
        "history_features": _with(
            f"""SELECT transaction_id, amount, {_six("amount_zscore", "amount_zscore")}, tx_count_1h
    FROM features WHERE "timestamp" >= {HALF}""",
            "features",
        ),
        "baseline_canonical": _with(
            f"""SELECT event_id, "Time", {_rounded_features(ENGINEERED)}, {V_LIST}, is_fraud_label,
      'BASE_' || event_id AS transaction_id, {_micros(BASELINE_TIME)} FROM canonical""",
            "canonical",
        ),
        "inference_canonical": _with(
            f"SELECT amount, {V_LIST}, predicted_fraud FROM inference", "inference"
        ),
        "request_rows": _with(f"SELECT {_request_columns()} FROM clean", "clean"),
        "first_request_rows": _with(
            f"""SELECT {_request_columns()} FROM
      (SELECT * FROM clean ORDER BY "timestamp", transaction_id LIMIT 100)""",
            "clean",
        ),
        "suite_raw": _with(_suite("raw", "tx_raw", _raw_rules()), "tx_raw"),
        "suite_processed": _with(_suite("processed", "clean", _processed_rules()), "clean"),
        "suite_features": _with(_suite("features", "features", _feature_rules()), "features"),
        "suite_summary": _with(
            """
    SELECT suite, bool_and(success) AS passed, count(*) AS total_expectations,
      count(*) FILTER (NOT success) AS failed_count,
      coalesce(string_agg(expectation || ':' || "column", ',' ORDER BY expectation || ':' || "column")
        FILTER (NOT success), '') AS failed_expectations,
      '2024-01-31T06:00:00' AS evaluated_at
    FROM results GROUP BY suite""",
            "tx_raw",
            extra={"results": _suite("raw", "tx_raw", _raw_rules())},
        ),
        "failed_rows": _with(
            "SELECT transaction_id, amount, failed_rules FROM raw_failures WHERE failed_rules <> ''",
            "raw_failures",
        ),
        "passed_rows": _with(
            f"SELECT {RAW_TEXT} FROM raw_failures WHERE failed_rules = ''", "raw_failures"
        ),
        "processed_failures": _with(
            f"""
    SELECT * FROM (SELECT transaction_id, concat_ws(',',
      CASE WHEN abs(amount_normalized) > 10 THEN 'between:amount_normalized' END,
      CASE WHEN is_fraud_label NOT IN (0, 1) THEN 'in_set:is_fraud_label' END,
      {", ".join(f"CASE WHEN abs({v}) > 50 THEN 'between:{v}' END" for v in V)}) AS failed_rules
    FROM clean) WHERE failed_rules <> ''""",
            "clean",
        ),
        "table_level_route": _with(
            """SELECT transaction_id, '' AS failed_rules FROM clean
    UNION ALL SELECT transaction_id, 'stdev:V1' FROM clean""",
            "clean",
        ),
        "valid_features": batch_run,
        "batch_run": batch_run,
        "stream_batches": as_of_run,
        "increment_run": as_of_run,
        "assembled_split": _with(
            f"""
    SELECT source, CASE WHEN rn <= CAST(floor(n * 0.8e0) AS BIGINT) THEN 'train' ELSE 'test' END AS part,
      count(*) AS "rows", strftime(min(t), '%Y-%m-%d %H:%M:%S') AS first_time,
      strftime(max(t), '%Y-%m-%d %H:%M:%S') AS last_time
    FROM (
      SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY t, md5(id)) AS rn FROM (
        SELECT 'baseline' AS source, {BASELINE_TIME} AS t, event_id::VARCHAR AS id FROM baseline
        UNION ALL
        SELECT CASE WHEN "timestamp" >= TIMESTAMP '2024-01-15' AND "timestamp" < TIMESTAMP '2024-01-22'
          THEN 'current' ELSE 'weekly' END, "timestamp", transaction_id FROM features))
    GROUP BY ALL""",
            "baseline",
            "features",
        ),
        "sessions_30m": _with(
            f"""
    SELECT card_id, {_micros("min(s)", "session_start")},
      {_micros("max(s) + INTERVAL 30 MINUTE", "session_end")}, sum(n)::BIGINT AS row_count FROM (
      SELECT *, count(*) FILTER (begins) OVER (PARTITION BY card_id ORDER BY s) AS session FROM (
        SELECT *, coalesce(s - lag(s) OVER (PARTITION BY card_id ORDER BY s) > INTERVAL 30 MINUTE, true)
          AS begins FROM (
          SELECT card_id, date_trunc('second', "timestamp") AS s, count(*) AS n FROM tx_raw GROUP BY ALL)))
    GROUP BY card_id, session""",
            "tx_raw",
        ),
        "union_dataset": _with(
            f"""SELECT transaction_id, {_rounded_features(ENGINEERED)}, {V_LIST}, is_fraud_label,
      {_micros()}, source FROM assembled""",
            "canonical",
            "features",
            extra=DATASET,
        ),
        "insert_ignore": _with(
            f"SELECT transaction_id, card_id, {_micros()}, amount FROM fresh",
            "tx_raw",
            extra=VERSION,
        ),
        "merge_version": _with(
            f"""SELECT transaction_id, card_id, {_micros()}, amount FROM target
    UNION ALL SELECT transaction_id, card_id, {_micros()}, amount FROM fresh""",
            "tx_raw",
            extra=VERSION,
        ),
        "compact_week": _with(
            """
    SELECT transaction_id, amount, batch_id, 'week_20240115' AS week_key FROM batches
    WHERE try_strptime(batch_id, '%Y%m%d_%H%M%S') >= TIMESTAMP '2024-01-15'
      AND try_strptime(batch_id, '%Y%m%d_%H%M%S') < TIMESTAMP '2024-01-22'""",
            "batches",
        ),
        "dataset_metadata": _with(
            f"""SELECT count(*) AS record_count,
      {_six("count(*) FILTER (is_fraud_label = 1) / count(*)::DOUBLE", "fraud_rate")},
      '2024-01-31' AS processing_date FROM clean""",
            "clean",
        ),
        "fraud_rate": _with(
            f"""SELECT merchant_category, count(*) AS total,
      count(*) FILTER (is_fraud_label = 1) AS frauds,
      {_six("100e0 * count(*) FILTER (is_fraud_label = 1) / count(*)", "fraud_pct")}
    FROM clean GROUP BY merchant_category""",
            "clean",
        ),
        "label_counts": _with(
            """SELECT count(*) AS row_count, count(*) FILTER (is_fraud_label = 1) AS fraud_count
    FROM clean""",
            "clean",
        ),
        "imbalance_weight": _with(
            f"""SELECT count(*) FILTER (is_fraud_label = 0) AS negatives,
      count(*) FILTER (is_fraud_label = 1) AS positives,
      {_six('''coalesce(count(*) FILTER (is_fraud_label = 0)
        / nullif(count(*) FILTER (is_fraud_label = 1), 0)::DOUBLE, 1e0)''', "weight")}
    FROM clean""",
            "clean",
        ),
        "time_order": _with(f"SELECT {_iso()}, transaction_id FROM clean", "clean"),
        "temporal_split": _with(
            f"""
    SELECT transaction_id, {_iso()},
      CASE WHEN rn <= CAST(floor(n * 0.8e0) AS BIGINT) THEN 'train' ELSE 'test' END AS part
    FROM (SELECT *, count(*) OVER () AS n,
            row_number() OVER (ORDER BY "timestamp", md5(transaction_id)) AS rn FROM clean)""",
            "clean",
        ),
        "gbt_train_score": _with(
            f"SELECT transaction_id, label AS is_fraud_label, label AS prediction FROM ({LATER_BY_RULE})",
            "features",
        ),
        "param_search": _with(
            f"""
    SELECT hit AS precision, hit AS recall, hit AS f1
    FROM (SELECT coalesce(max(label), 0)::DOUBLE AS hit FROM ({LATER_BY_RULE}))""",
            "features",
        ),
        "stratified_snapshot": _with(
            _stratified("clean", 1000, "transaction_id, is_fraud_label, amount"), "clean"
        ),
        "pick_by_priority": _with(
            """
    SELECT name, version, stage FROM (
      SELECT *, row_number() OVER (PARTITION BY name
        ORDER BY CASE stage WHEN 'Staging' THEN 1 ELSE 2 END, version DESC) AS rn
      FROM registry WHERE stage IN ('Staging', 'Production')) WHERE rn = 1""",
            "registry",
        ),
        "pick_best_version": _with(
            """
    SELECT name, version, stage FROM registry WHERE stage IN ('Staging', 'Production')
    ORDER BY CASE stage WHEN 'Staging' THEN 1 ELSE 2 END, version DESC LIMIT 1""",
            "registry",
        ),
        "source_plan": _with(
            """
    SELECT 'baseline' AS source, 'baseline' AS name
    UNION ALL SELECT DISTINCT 'batch', batch_id FROM batches
    WHERE try_strptime(batch_id, '%Y%m%d_%H%M%S') >= TIMESTAMP '2024-01-15'
      AND try_strptime(batch_id, '%Y%m%d_%H%M%S') < TIMESTAMP '2024-01-22'
    UNION ALL SELECT DISTINCT 'weekly', 'week_' || strftime(date_trunc('week', "timestamp"), '%Y%m%d')
    FROM batches WHERE date_trunc('week', "timestamp") <> TIMESTAMP '2024-01-15'""",
            "batches",
        ),
        "reference_snapshot": _with(
            _stratified(
                "assembled",
                10000,
                f"{_rounded_features(ENGINEERED)}, {V_LIST}, is_fraud_label",
            ),
            "canonical",
            "features",
            extra=DATASET,
        ),
        "drift_ks": _with(
            f"""SELECT feature, {_six("ks", "ks")},
      {_six(_ks_p("ks", "t_ref", "t_cur"), "p_value")} FROM column_stats""",
            "column_stats",
        ),
        "drift_w1": _with(
            "SELECT feature, round(w1, 4) AS w1, round(w1_norm, 4) AS w1_norm FROM column_stats",
            "column_stats",
        ),
        "drift_psi": _with(
            f"""SELECT feature, {_six('''sum((greatest(p_cur, 1e-4) - greatest(p_ref, 1e-4))
      * ln(greatest(p_cur, 1e-4) / greatest(p_ref, 1e-4)))''', "psi")} FROM bins GROUP BY feature""",
            "bins",
        ),
        "drift_js": _with(
            f"""SELECT feature, {_six('''sqrt(greatest(sum(
        CASE WHEN p_ref > 0 THEN p_ref * ln(p_ref / ((p_ref + p_cur) / 2)) ELSE 0e0 END
        + CASE WHEN p_cur > 0 THEN p_cur * ln(p_cur / ((p_ref + p_cur) / 2)) ELSE 0e0 END) / 2, 0e0))''', "js")}
    FROM bins GROUP BY feature""",
            "bins",
        ),
        "drift_align": _with(
            """SELECT feature, value, sum(is_ref)::BIGINT AS n_ref, sum(1 - is_ref)::BIGINT AS n_cur
    FROM sides GROUP BY feature, value""",
            "sides",
        ),
        "drift_chi2": _with(_chi2(), "clean"),
        "prediction_drift": _with(
            f"""SELECT n_ref, ones_ref, n_cur, ones_cur, {_six("share_ref", "share_ref")},
      {_six("share_cur", "share_cur")}, {_six("z", "z")}, {_six("p_value", "p_value")}, {_six("js", "js")},
      p_value < 0.05e0 AS drifted
    FROM prediction_scored""",
            "prediction_scored",
        ),
        "drift_columns": _with(
            """SELECT feature, n_values, method, round(score, 4) AS score,
      score < 0.05e0 AS drifted
    FROM column_scores""",
            "column_scores",
        ),
        "drift_summary": _with(
            f"SELECT * REPLACE (round(data_drift_score, 6) + 0e0 AS data_drift_score) FROM"
            f" (SELECT {summary_columns}, 7 AS lookback_days, '2024-01-31T06:00:00' AS evaluated_at"
            f" FROM summary)",
            "summary",
        ),
        "summary_json": _with(
            """SELECT round(data_drift_score, 6) + 0e0 AS data_drift_score, n_drifted_features,
      n_total_features, overall_drift, reference_rows, current_rows, 7 AS lookback_days,
      '2024-01-31T06:00:00' AS evaluated_at, '2024-01-31' AS date
    FROM summary""",
            "summary",
        ),
        "retrain_decision": _with(
            f"""SELECT overall_drift, {_six("growth", "growth")}, growth > 0.05e0 AS grown,
      overall_drift OR growth > 0.05e0 AS retrain
    FROM (SELECT overall_drift, ((SELECT count(*) FROM clean) - reference_rows)
      / reference_rows::DOUBLE AS growth FROM summary)""",
            "summary",
            "clean",
        ),
        "confusion": _with(
            "SELECT label, prediction, count(*) AS n FROM predicted GROUP BY label, prediction",
            "predicted",
        ),
        "f1_score": _with(
            f"""SELECT {_six("pr", '"precision"')}, {_six("re", "recall")}, {_six("f", "f1")}
    FROM ({_f1("predicted")})""",
            "predicted",
        ),
        "class_report": _with(_report("predicted", "label", "prediction"), "predicted"),
        "label_report": "WITH base AS (SELECT * FROM labels)" + _report("base", "quality", "toxic"),
        "score_summary": _with(
            """SELECT count(*) AS total_records, count(*) FILTER (prediction = 1) AS fraud_detected
    FROM predicted""",
            "predicted",
        ),
        "promotion_decision": _with(
            f"""SELECT {_six("a.f", "candidate_f1")}, {_six("b.f", "production_f1")},
      a.f >= b.f + 0.01e0 OR b.f = 0 AS promote
    FROM ({_f1("predicted", f'"timestamp" >= {HALF}')}) a, ({_f1("predicted", f'"timestamp" < {HALF}')}) b""",
            "predicted",
        ),
        "dead_letter": _with(
            """SELECT transaction_id, amount, failed_rules, 'raw_validation' AS step,
      '20240131_000000' AS batch_id FROM raw_failures WHERE failed_rules <> ''""",
            "raw_failures",
        ),
        "snapshot_publish": _with(
            """SELECT transaction_id, amount, is_fraud_label, copy
    FROM clean, (VALUES ('version'), ('current')) AS t(copy)""",
            "clean",
        ),
        "prediction_log": _with(
            """SELECT transaction_id, amount, CAST(amount > 100 AND V1 > 0 AS INTEGER)
      AS "Predicted_Class", '20240131_000000' AS run_ts FROM clean""",
            "clean",
        ),
        "tumbling_5m": _with(
            f"""SELECT {_micros("w", "window_start")}, row_count, fraud_count FROM (
      SELECT time_bucket(INTERVAL 5 MINUTE, "timestamp") AS w, count(*) AS row_count,
        count(*) FILTER (is_fraud_label = 1) AS fraud_count FROM tx_raw GROUP BY w)""",
            "tx_raw",
        ),
        "sliding_1h": _with(
            f"""SELECT {_micros("w", "window_start")}, card_id, row_count FROM (
      SELECT time_bucket(INTERVAL 5 MINUTE, "timestamp") - INTERVAL 5 MINUTE * k AS w, card_id,
        count(*) AS row_count FROM tx_raw, range(12) AS r(k) GROUP BY w, card_id)""",
            "tx_raw",
        ),
        "stream_dedupe": _with("SELECT DISTINCT transaction_id, card_id FROM tx_raw", "tx_raw"),
        "stream_tumbling": _with(
            f"""SELECT {_micros("w", "window_start")}, row_count, fraud_count FROM (
      SELECT time_bucket(INTERVAL 5 MINUTE, "timestamp") AS w, count(*) AS row_count,
        count(*) FILTER (is_fraud_label = 1) AS fraud_count FROM tx_raw GROUP BY w)""",
            "tx_raw",
        ),
        "stream_trailing_count": _with(
            f"""SELECT card_id, epoch(s)::BIGINT AS "second", row_count, tx_count_1h FROM (
      SELECT card_id, s, row_count, CAST(sum(row_count) OVER (PARTITION BY card_id ORDER BY s
        RANGE BETWEEN INTERVAL 3600 SECOND PRECEDING AND CURRENT ROW) AS BIGINT) AS tx_count_1h
      FROM (SELECT card_id, date_trunc('second', "timestamp") AS s, count(*) AS row_count
            FROM tx_raw GROUP BY ALL))""",
            "tx_raw",
        ),
    }
