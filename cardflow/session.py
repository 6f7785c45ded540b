"""What the library needs from a Spark session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are planned for. Rows are joined back to per-key
# statistics, so a key that holds a third of all rows is split by the adaptive
# skew join. That split follows map outputs: unlike a random salt it is safe
# when an executor is lost, and unlike a content salt it also splits exact copies.
RECOMMENDED_CONF = {
    # Projections of some 40 columns exceed the size up to which the JVM compiles a
    # method. Such stages then run as compiled split methods, about three times faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Passed and failed rows go to two folders without a sort per task.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}



def configure(spark: SparkSession) -> SparkSession:
    """Apply the recommended settings to a running session."""
    for name, value in RECOMMENDED_CONF.items():
        spark.conf.set(name, value)
    return spark


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor reaches, for checkpoints and scratch tables.

    It is the session's ``spark.checkpoint.dir``. Only a local-mode session may
    leave it unset and gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="cardflow-")
    return _local_dirs[context.applicationId]


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and read it from there afterwards."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once, as a table that plans know nothing else about.

    A checkpoint keeps what the plan before it says of its rows. After a projection of some 40
    columns that is so much that plans over it take minutes to optimise.
    """
    path = f"{shared_dir(df.sparkSession)}/rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
