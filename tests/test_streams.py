"""Streams fed in several micro-batches against the batch operators."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from cardflow.schema import CARD, ID, TS
from cardflow.streaming import streams

START = datetime(2024, 1, 1)


def _write_parts(spark, path, parts):
    for rows in parts:
        data = [(i, c, START + timedelta(seconds=s)) for i, c, s in rows]
        df = spark.createDataFrame(data, f"{ID} string, {CARD} string, {TS} timestamp")
        df.coalesce(1).write.mode("append").parquet(path)


def _drain(stream, root):
    query = (
        stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        .option("checkpointLocation", f"{root}/checkpoint").option("path", f"{root}/out").start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/out")


def _source(spark, path):
    schema = f"{ID} string, {CARD} string, {TS} timestamp"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def _rows(first, n, start, step):
    return [(f"t{first + i}", "hot" if i % 3 else f"c{i % 2}", start + i * step) for i in range(n)]


def test_trailing_count_over_micro_batches_equals_brute_force(spark, tmp_path):
    parts = [_rows(0, 60, 0, 50), _rows(60, 60, 3000, 50), _rows(120, 60, 6000, 50)]
    parts.append([("late", "z", 20000)])
    _write_parts(spark, f"{tmp_path}/in", parts)
    source = _source(spark, f"{tmp_path}/in")
    streams.start_trailing_counts(source, str(tmp_path), f"{tmp_path}/checkpoint", None).awaitTermination()
    written = spark.read.parquet(f"{tmp_path}/trailing").collect()
    assert len({r["epoch"] for r in written}) > 1
    got = streams.trailing_with_open(spark, str(tmp_path), f"{tmp_path}/checkpoint").collect()
    base = int((START - datetime(1970, 1, 1)).total_seconds())
    rows = [r for part in parts for r in part]
    assert len(got) == len({(c, s) for _, c, s in rows}) == len(written) + 1
    for r in got:
        second = r["second"] - base
        want = sum(c == r[CARD] and second - 3600 <= s <= second for _, c, s in rows)
        assert r["tx_count_1h"] == want


def test_open_windows_join_the_emitted_ones(spark, tmp_path):
    """A stream that has closed nothing yet, and one that goes on, equal the batch form."""
    label = F.lit(1).alias("is_fraud_label")
    for parts in ([_rows(0, 5, 0, 1)], [_rows(0, 5, 0, 1), _rows(5, 30, 200, 70)], [_rows(35, 3, 9000, 400)]):
        _write_parts(spark, f"{tmp_path}/in", parts)
        stream = streams.event_time(_source(spark, f"{tmp_path}/in").select("*", label))
        emitted = _drain(streams.tumbling_counts(stream), str(tmp_path))
        got = streams.tumbling_with_open(emitted, f"{tmp_path}/checkpoint")
        batch = streams.tumbling_counts(spark.read.parquet(f"{tmp_path}/in").select("*", label))
        assert got.exceptAll(batch).isEmpty() and batch.exceptAll(got).isEmpty()


def test_dedupe_across_micro_batches(spark, tmp_path):
    _write_parts(spark, f"{tmp_path}/in", [_rows(0, 20, 0, 1), _rows(10, 20, 12, 1)])
    out = _drain(streams.stream_dedupe(_source(spark, f"{tmp_path}/in")), str(tmp_path))
    assert out.count() == out.select(ID).distinct().count() == 30


def test_sliding_counts_equal_batch(spark, tmp_path):
    _write_parts(spark, f"{tmp_path}/in", [_rows(0, 40, 0, 60), [("end", "z", 40000)]])
    stream = streams.sliding_counts(streams.event_time(_source(spark, f"{tmp_path}/in")))
    out = _drain(stream, str(tmp_path))
    batch = streams.sliding_counts(spark.read.parquet(f"{tmp_path}/in").filter(F.col(CARD) != "z"))
    assert out.exceptAll(batch).isEmpty() and batch.exceptAll(out).isEmpty()


def test_sliding_panes_equal_the_windows(spark, plan_of):
    """Whole steps go through panes, a width with a rest through the window itself."""
    rows = spark.range(500).select(
        F.concat(F.lit("c"), F.col("id") % 3).alias(CARD), F.timestamp_seconds(F.col("id") * 977 % 100_000).alias(TS)
    )
    rows = rows.union(spark.createDataFrame([("c0", None)], f"{CARD} string, {TS} timestamp"))
    for width, step in (("1 hour", "5 minutes"), ("10 minutes", "10 minutes"), ("1 hour", "25 minutes")):
        got = streams.sliding_counts(rows, width=width, step=step)
        window = F.window(TS, width, step)
        want = rows.groupBy(window, CARD).count().select("window.start", CARD, "count")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert "Expand" not in plan_of(streams.sliding_counts(rows))
