"""Structured Streaming: block and log sources, live candles, waiting joins, replay, merge sinks. What steps through rows is in keyed."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.operators.merge import newer_wins
from ledgerloom.sources.shared import shared_dir
from ledgerloom.streaming.keyed import started_in


def stream_table(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files below a path (or glob) as a stream, with the schema that its present files have."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    return (reader if files_per_batch is None else reader.option("maxFilesPerTrigger", files_per_batch)).parquet(path)


def candles(swaps: DataFrame, late: str = "10 minutes", width: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Windowed OHLC of swaps (time, pool, order, price, volume); a slide shorter than the width gives rolling windows.

    In append mode a window comes out once, when the watermark has passed its end, and leaves the state then; swaps that come after
    that are not in it (see keyed.late_rows, and start the stream within keyed.started_in). In update mode windows come out whenever they change.
    """
    w = F.window("time", width, slide) if slide else F.window("time", width)
    return swaps.withWatermark("time", late).groupBy("pool", w.alias("w")).agg(
        F.min_by("price", "order").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "order").alias("close"),
        F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("swaps"),
    ).select("pool", F.col("w.start").alias("start"), "open", "high", "low", "close", "volume", "swaps")


def rolling(hours: DataFrame, width: int = 24) -> DataFrame:
    """Windows of `width` hours that slide by the hour (pool, start, swaps, volume) from hourly candles: what `candles` counts with a slide.

    A stream keeps one row per pool and hour in its state instead of one per window, and each batch's windows come from these. Rows are dealt
    by pool once, before each serves its windows.
    """
    starts = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.col("start") - F.make_dt_interval(hours=i))
    dealt = hours.select("pool", "start", "swaps", "volume").repartition("pool").withColumn("start", F.explode(starts))
    return dealt.groupBy("pool", "start").agg(F.sum("swaps").alias("swaps"), F.sum("volume").alias("volume"))


def awaiting(events: DataFrame, calls: DataFrame, wait: str = "5 minutes") -> DataFrame:
    """Events joined to their call of the same (block_number, log_index) within `wait`; those without one come out, null, once
    the watermark passes: the backlog."""
    e = events.withWatermark("time", "0 seconds").alias("e")
    c = calls.withWatermark("call_time", "0 seconds").alias("c")
    on = F.expr(f"e.block_number = c.block_number and e.log_index = c.log_index and c.call_time >= e.time and c.call_time <= e.time + interval {wait}")
    return e.join(c, on, "left_outer").select("e.*", F.col("c.value").alias("value"), F.col("c.value").isNull().alias("backlog"))


def once(rows: DataFrame, late: str = "1 hour") -> DataFrame:
    """Replayed rows dropped by (chain_id, block, log_index) within the watermark."""
    return rows.withWatermark("time", late).dropDuplicatesWithinWatermark(["chain_id", "block", "log_index"])


def merge_sink(path: str, keys: list[str], version: str, on_change: Callable[[DataFrame, DataFrame, int], None] | None = None, buckets: int = 64, keep: int = 2) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: a keyed table below `path` that every batch is merged into; `read_sink` reads it.

    Rows lie in buckets by a hash of their keys. A batch rewrites only the buckets it touches, as files of its own version
    (<path>/bucket=<b>/v=<batch>), and then puts the new state, one file that names each bucket's version, in place
    (<path>/_state/v=<batch>). A batch that is replayed starts from the state before it and writes the same files anew, so the result is
    exactly once. The last `keep` states and what they name stay for readers; older files go. on_change sees (the touched part of
    the table, batch, id) first, to capture before-images.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        files, folder = _files(spark, path)
        own = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        last = batch.groupBy(*keys).agg(F.max_by(F.struct(*batch.columns), version).alias("s")).select("s.*")
        touched = sorted(r[0] for r in batch.select(own).distinct().collect())  # at most `buckets`
        before = [v for v in _versions(files, folder, path) if v < batch_id]
        state = _named(spark, path, before[-1]) if before else {}
        olds = [f"{path}/bucket={b}/v={state[b]}" for b in touched if b in state]
        if olds:
            table = spark.read.schema(batch.schema).parquet(*olds)
            if on_change is not None:
                on_change(table, batch, batch_id)
            last = newer_wins(table, last, keys, version)
        new = f"{path}/_new/v={batch_id}"
        last.select(*batch.columns, own.alias("bucket")).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(new)
        for b in touched:
            target = folder(f"{path}/bucket={b}/v={batch_id}")
            files.delete(target, True)
            files.mkdirs(target.getParent())
            files.rename(folder(f"{new}/bucket={b}"), target)
        files.delete(folder(new), True)
        state = state | dict.fromkeys(touched, batch_id)
        spark.createDataFrame(sorted(state.items()) or [], "bucket int, v long").coalesce(1).write.mode("overwrite").parquet(f"{path}/_state/v={batch_id}")
        kept = [*before, batch_id][-keep:]
        named = {(b, v) for at in kept for b, v in _named(spark, path, at).items()}
        for b in touched:
            for status in files.listStatus(folder(f"{path}/bucket={b}")):
                if (b, int(status.getPath().getName()[2:])) not in named:
                    files.delete(status.getPath(), True)
        for v in before:
            if v not in kept:
                files.delete(folder(f"{path}/_state/v={v}"), True)

    return write


def _files(spark: SparkSession, path: str):
    """The file system of a path, and what makes a path of it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path
    return folder(path).getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _versions(files, folder, path: str) -> list[int]:
    """The finished states in order: those whose write was committed."""
    root = folder(f"{path}/_state")
    found = files.listStatus(root) if files.exists(root) else []
    return sorted(int(s.getPath().getName()[2:]) for s in found if files.exists(folder(f"{s.getPath().toString()}/_SUCCESS")))


def _named(spark: SparkSession, path: str, version: int) -> dict[int, int]:
    """Each bucket's version in a state: at most one row per bucket."""
    return {r["bucket"]: r["v"] for r in spark.read.schema("bucket int, v long").parquet(f"{path}/_state/v={version}").collect()}


def read_sink(spark: SparkSession, path: str) -> DataFrame:
    """The table that merge_sink keeps."""
    files, folder = _files(spark, path)
    state = _named(spark, path, _versions(files, folder, path)[-1])
    return spark.read.parquet(*[f"{path}/bucket={b}/v={v}" for b, v in sorted(state.items())])


def drain(stream: DataFrame, mode: str = "append", then: Callable[[DataFrame], DataFrame] = lambda batch: batch) -> DataFrame:
    """Run a stream over all that is there now and read what it put out (in complete mode the last result).

    then: what is made of each batch's result before it is written. Each batch writes a folder of its own number, so a batch that is replayed after a failure puts nothing out twice.
    """
    spark = stream.sparkSession
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"

    def write(batch: DataFrame, batch_id: int) -> None:
        then(batch).write.mode("overwrite").parquet(f"{base}/out" if mode == "complete" else f"{base}/out/batch={batch_id}")

    with started_in(spark):
        q = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).foreachBatch(write).start()
    q.awaitTermination()
    made = then(spark.createDataFrame([], stream.schema))
    return spark.read.schema(made.schema).option("basePath", f"{base}/out").parquet(f"{base}/out").select(*made.columns)
