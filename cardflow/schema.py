"""Column lists, table schemas and fixed rule values, kept in one place."""

from __future__ import annotations

from pyspark.sql import types as T

V_COLS = [f"V{i}" for i in range(1, 29)]

# The rules compare against exactly these.
MERCHANT_CATEGORIES = [
    "grocery",
    "online",
    "travel",
    "restaurant",
    "entertainment",
    "gas_station",
    "pharmacy",
    "electronics",
    "clothing",
    "atm",
]
NIGHT_HOURS = [22, 23, 0, 1, 2, 3, 4]
MAX_AMOUNT = 50000.0
HIGH_AMOUNT = 500.0
HOUR_SECONDS = 3600
# Baseline rows count seconds from here: 2013-09-01 00:00:00 UTC.
BASELINE_EPOCH = 1377993600
SNAPSHOT_ROWS = 10_000
SNAPSHOT_SEED = 42
TRAIN_FRACTION = 0.8
DRIFT_SHARE_THRESHOLD = 0.3
DRIFT_P_THRESHOLD = 0.05
DRIFT_DISTANCE_THRESHOLD = 0.1
PROMOTION_MARGIN = 0.01
GROWTH_THRESHOLD = 0.05

ID = "transaction_id"
CARD = "card_id"
TS = "timestamp"
LABEL = "is_fraud_label"

RAW_COLS = [
    "transaction_id",
    "user_id",
    "card_id",
    "timestamp",
    "amount",
    "merchant_id",
    "merchant_category",
    "is_international",
    "hour_of_day",
    *V_COLS,
    "is_fraud_label",
]

CRITICAL_COLS = [
    "transaction_id",
    "user_id",
    "card_id",
    "timestamp",
    "amount",
    "is_fraud_label",
    *V_COLS,
]

PROCESSED_COLS = [
    "transaction_id",
    "user_id",
    "card_id",
    "timestamp",
    "amount",
    "amount_normalized",
    "merchant_id",
    "merchant_category",
    "is_international",
    "hour_of_day",
    *V_COLS,
    "is_fraud_label",
]

# What the model reads, in this order.
MODEL_COLS = [
    "amount",
    "amount_normalized",
    "amount_log1p",
    "amount_zscore",
    "tx_count_1h",
    "is_night_hour",
    "is_high_amount",
    "is_international",
    "hour_of_day",
    *V_COLS,
]

FEATURE_TABLE_COLS = [
    "transaction_id",
    "user_id",
    "card_id",
    "timestamp",
    *MODEL_COLS[:9],
    "merchant_category",
    *V_COLS,
    "is_fraud_label",
]

REQUEST_COLS = ["Time", "Amount", *V_COLS]


def _doubles(names: list[str]) -> list[T.StructField]:
    return [T.StructField(n, T.DoubleType()) for n in names]


def _strings(names: list[str]) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


RAW_SCHEMA = T.StructType(
    [
        *_strings(["transaction_id", "user_id", "card_id"]),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("amount", T.DoubleType()),
        *_strings(["merchant_id", "merchant_category"]),
        T.StructField("is_international", T.BooleanType()),
        T.StructField("hour_of_day", T.IntegerType()),
        *_doubles(V_COLS),
        T.StructField("is_fraud_label", T.IntegerType()),
    ]
)

BASELINE_SCHEMA = T.StructType(
    [*_doubles(["Time", *V_COLS, "Amount"]), T.StructField("Class", T.IntegerType())]
)
