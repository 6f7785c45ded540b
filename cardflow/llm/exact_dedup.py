"""Exact deduplication as a stateful stream over content digests.

1. One pass over the documents lands a narrow table: id, locator of the content (file and
   row), digest of the normalised text. Texts are equal if they are identical after
   lower-casing A-Z.
2. The table is read as a stream. The state, kept on disk by RocksDB and never expired, has
   for each digest the identifier and the locator of the row that stays (the largest id)
   and the number of rows. Spark combines the rows of a digest before the shuffle, so a
   text with a third of all rows is no hot key. Each call has a state of its own;
   ``stream_state`` over a folder that has one goes on from its last micro-batch.
3. A digest met again is a hit, and hits are checked on their full bytes: rows are grouped
   by digest and text together, combined before the shuffle. A digest that stands for more
   than one text is split into one group for each text.

Edge cases: null and empty texts are equal. A null id is smaller than every other. If the
largest id has several rows of one text, the one with the largest locator stays. Other
columns are kept, whatever they are called. No rows give no rows.
"""

from __future__ import annotations

import string

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardflow.llm.common import scratch, stored

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # All stores of an executor share this much memory; the rest of the state is on disk.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    # No disk reserved ahead, which would be several megabytes for each partition.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # A micro-batch writes what it changed, not its whole stores.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# Files of the landed table in a micro-batch.
FILES_PER_BATCH = 1000
LOCATOR = ["at_file", "at_row"]


def normalised(text: str | Column) -> Column:
    """Null as empty, A-Z in lower case, everything else as it is."""
    given = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    # lower() is the same and faster where every character is ASCII.
    other = F.translate(given, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(given) == F.length(given), F.lower(given)).otherwise(other)


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def located(docs: DataFrame, columns: list[str], names: list[str] = LOCATOR) -> DataFrame:
    """``columns`` of documents with the file and the row they were read from.

    Rows that don't come from files as they are (made in memory, projected) are stored first.
    """
    place = [F.col("_metadata.file_path").alias(names[0]), F.col("_metadata.row_index").alias(names[1])]
    if "_metadata" not in docs.columns:
        try:
            return docs.select(*columns, *place)
        except AnalysisException:
            pass
    return stored(docs.select(*columns), "documents").select(*columns, *place)


def stream_state(landed: DataFrame, path: str, folder: str, id_column: str) -> DataFrame:
    """Run the landed table through the state; digest, keep (struct), group_size of each digest."""
    spark = landed.sparkSession
    for name, value in STATE_CONF.items():
        spark.conf.set(name, value)
    groups = (
        spark.readStream.schema(landed.schema)
        .option("maxFilesPerTrigger", FILES_PER_BATCH)
        .parquet(path)
        .groupBy("digest")
        .agg(F.max(F.struct(id_column, *LOCATOR)).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    )

    def write(changed: DataFrame, epoch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{folder}/changed/epoch={epoch}")

    query = (
        groups.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", f"{folder}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    shape = T.StructType([*groups.schema.fields, T.StructField("epoch", T.IntegerType())])
    changed = spark.read.schema(shape).parquet(f"{folder}/changed")
    # Both only grow, so the last state of a digest has the largest of each.
    return changed.groupBy("digest").agg(F.max("keep").alias("keep"), F.max("group_size").alias("group_size"))


def resolve(docs: DataFrame, digest=sha256, id_column: str = "doc_id") -> DataFrame:
    """One row per document: id, locator, digest, keep_id, group_size, kept.

    ``digest`` maps the normalised text to its digest.
    """
    return resolve_rows(located(docs, [id_column, "text"]), id_column, digest)


def resolve_rows(rows: DataFrame, id_column: str, digest=sha256) -> DataFrame:
    """``resolve`` for rows of id, text and locator."""
    spark = rows.sparkSession
    folder = scratch(spark, "exact-dedup")
    text = normalised("text")
    texts = rows.select(id_column, *LOCATOR, digest(text).alias("digest"), text.alias("same"))
    texts.drop("same").write.parquet(f"{folder}/landed")
    landed = spark.read.schema(texts.drop("same").schema).parquet(f"{folder}/landed")
    # Written, so that Spark shuffles both sides of the join for the join and can split a
    # digest that many rows have.
    groups = stored(stream_state(landed, f"{folder}/landed", folder, id_column), "digest-groups")

    # Full bytes: a digest with two texts has two rows after the first grouping.
    by_text = texts.groupBy("digest", "same").agg(F.count(F.lit(1)).alias("rows"))
    shared = by_text.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    shared = stored(shared.select("digest"), "shared-digests")
    if shared.isEmpty():
        return _verdicts(landed.join(groups, "digest", "left"), id_column)
    apart = texts.join(shared, "digest", "left_semi")
    split = apart.groupBy("digest", "same").agg(
        F.max(F.struct(id_column, *LOCATOR)).alias("keep"), F.count(F.lit(1)).alias("group_size")
    )
    return _verdicts(landed.join(shared, "digest", "left_anti").join(groups, "digest", "left"), id_column).unionByName(
        _verdicts(apart.join(stored(split, "split-digests"), ["digest", "same"], "left"), id_column)
    )


def _verdicts(rows: DataFrame, id_column: str) -> DataFrame:
    here = F.struct(id_column, *LOCATOR)
    return rows.select(
        id_column,
        *LOCATOR,
        "digest",
        F.col(f"keep.{id_column}").alias("keep_id"),
        "group_size",
        here.eqNullSafe(F.col("keep")).alias("kept"),
    )


def drop_copies(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The documents without copies, all columns as they were."""
    names = LOCATOR
    while set(names) & set(docs.columns):
        names = [f"{n}_" for n in names]
    placed = located(docs, docs.columns, names)
    here = [F.col(own).alias(name) for own, name in zip(names, LOCATOR, strict=True)]
    dropped = resolve_rows(placed.select(id_column, "text", *here), id_column).filter(~F.col("kept"))
    same = [placed[own] == dropped[name] for own, name in zip(names, LOCATOR, strict=True)]
    return placed.join(dropped, same, "left_anti").drop(*names)
