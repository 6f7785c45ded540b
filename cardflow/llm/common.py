"""What the operators share: tables, scratch folders, remainders of ids."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardflow.session import shared_dir

# Rows per Arrow batch. Texts may be long, so a batch is kept to few rows.
BATCH_ROWS = "1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the place that all executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read from there."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(id_column: str | Column, modulus: int) -> Column:
    """crc32 of an id as text, modulo ``modulus``; null for a null id."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.crc32(column.cast("string").cast("binary")) % modulus


def arrow_map(docs: DataFrame, columns: list[str], function, outputs: str) -> DataFrame:
    """Run ``function`` over Arrow batches of ``columns``.

    The result has the first column, an id, under its own name and type, then ``outputs``.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    fields = [T.StructField(columns[0], docs.schema[columns[0]].dataType)]
    schema = T.StructType(fields + T.StructType.fromDDL(outputs).fields)
    return docs.select(*columns).mapInArrow(function, schema)
