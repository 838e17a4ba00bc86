"""Maintaining keyed tables: upserts with conflict policies, partial updates, deletes, versions, progress.

Each takes the current table and what comes in, and returns the new table, so that a sink can write a new snapshot
of the partitions it touches. With a table format that has MERGE the same frames feed `mergeInto`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.operators.ohlc import latest_state
from ledgerloom.operators.running import next_values


def first_wins(target: DataFrame, incoming: DataFrame, keys: list[str], order: str) -> DataFrame:
    """DO NOTHING: a key's first row stays; among incoming rows of one key the first by `order`."""
    rest = [c for c in target.columns if c not in keys]
    first = incoming.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("s")).select(*keys, *[F.col(f"s.{c}").alias(c) for c in rest])
    return target.unionByName(first.join(target.select(*keys), keys, "left_anti"))


def overwrite(target: DataFrame, incoming: DataFrame, keys: list[str], update: list[str]) -> DataFrame:
    """DO UPDATE of some columns: incoming must hold one row per key; new keys come in whole."""
    rest = [c for c in target.columns if c not in keys]
    both = target.withColumn("_t", F.lit(True)).alias("t").join(incoming.withColumn("_i", F.lit(True)).alias("i"), keys, "full_outer")
    pick = [
        (F.when(F.col("_i"), F.col(f"i.{c}")).otherwise(F.col(f"t.{c}")) if c in update else F.when(F.col("_t"), F.col(f"t.{c}")).otherwise(F.col(f"i.{c}"))).alias(c)
        for c in rest
    ]
    return both.select(*keys, *pick)


def newer_wins(target: DataFrame, incoming: DataFrame, keys: list[str], version: str, *, or_equal: bool = False) -> DataFrame:
    """Conditional update: an incoming row counts only if its version is greater (or equal) than what is there.

    One pass over the union: the greatest (version, side) of each key. Late rows therefore never replace newer state.
    """
    side = (1, 0) if or_equal else (0, 1)
    both = target.withColumn("_side", F.lit(side[1])).unionByName(incoming.withColumn("_side", F.lit(side[0])))
    both = both.withColumn("_order", F.struct(version, "_side"))
    return latest_state(both, keys, "_order").select(*target.columns)


def touch(users: DataFrame, seen: DataFrame) -> DataFrame:
    """first_seen and last_seen per address over the table and new sightings (address, ts)."""
    both = users.select("address", "first_seen", "last_seen").unionByName(seen.select("address", F.col("ts").alias("first_seen"), F.col("ts").alias("last_seen")))
    return both.groupBy("address").agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))


def update_by_key(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """UPDATE: changes (keys and new values) of keys that exist; others are ignored."""
    new = [c for c in changes.columns if c not in keys]
    marked = target.alias("t").join(changes.withColumn("_hit", F.lit(True)).alias("c"), keys, "left")
    return marked.select(*[F.when(F.col("_hit"), F.col(f"c.{c}")).otherwise(F.col(f"t.{c}")).alias(c) if c in new else F.col(c) for c in target.columns])


def delete_by_key(target: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return target.join(gone.select(*keys).distinct(), keys, "left_anti")


STAMP = ("source", "source_version")


def stamp(df: DataFrame, source: Column | str, version: int) -> DataFrame:
    """Source and version columns; with `stamped_keys` they are part of every key, so that versions live side by side."""
    return df.withColumns({"source": F.lit(source) if isinstance(source, str) else source, "source_version": F.lit(version)})


def stamped_keys(keys: list[str]) -> list[str]:
    return [*keys, *[c for c in STAMP if c not in keys]]


def active_version(df: DataFrame, active: DataFrame) -> DataFrame:
    """Rows of the version that is active for their source."""
    return df.join(active, ["source", "source_version"], "left_semi")


def checkpoint_totals(events: DataFrame, keys: list[str], totals: list[str]) -> DataFrame:
    """The last cumulative totals per key by (block, log_index)."""
    return events.groupBy(*keys).agg(*[F.max_by(c, F.struct("block", "log_index")).alias(c) for c in totals], F.max(F.struct("block", "log_index")).alias("at")).select(*keys, *totals, "at.block", "at.log_index")


BACKLOG = ("handler", "range_index")


def retry_backlog(failures: DataFrame, backlog: DataFrame | None = None, done: DataFrame | None = None) -> DataFrame:
    """Open failures per (handler, range): count, first and last time, last error.

    They are merged into an existing backlog; ranges that have been finished since (done: handler, range_index) leave it.
    """
    new = failures.groupBy(*BACKLOG).agg(
        F.count(F.lit(1)).alias("failure_count"), F.min("ts").alias("first_failed_at"), F.max("ts").alias("last_failed_at"), F.max_by("error", F.struct("ts", "error")).alias("last_error")
    )
    if backlog is not None:
        new = backlog.select(*new.columns).unionByName(new).groupBy(*BACKLOG).agg(
            F.sum("failure_count").alias("failure_count"), F.min("first_failed_at").alias("first_failed_at"), F.max("last_failed_at").alias("last_failed_at"),
            F.max_by("last_error", F.struct("last_failed_at", "last_error")).alias("last_error"),
        )
    return new if done is None else new.join(done.select(*BACKLOG).distinct(), list(BACKLOG), "left_anti")


def record_progress(progress: DataFrame, finished: DataFrame) -> DataFrame:
    """progress (handler, range_start, range_end) with the finished ranges: a range that is there gets its new end."""
    last = finished.groupBy("handler", "range_start").agg(F.max("range_end").alias("range_end"))
    return overwrite(progress, last, ["handler", "range_start"], ["range_end"])


def completion_watermark(done: DataFrame, key: str = "handler", index: str = "range_index", bucket: int = 10_000) -> DataFrame:
    """Per handler the last range before its first hole: the least one whose successor is not the next number, by buckets of ranges."""
    steps = next_values(done.select(key, index).distinct(), [key], index, "_next", bucket)
    return steps.filter(F.col("_next").isNull() | (F.col("_next") > F.col(index) + 1)).groupBy(key).agg(F.min(index).alias("complete_to"))


def completeness(rows: DataFrame, index: str, size: int) -> DataFrame:
    """Per range of `size`: count, bounds and whether every index is there."""
    return rows.groupBy(F.expr(f"{index} div {size}").alias("range")).agg(
        F.countDistinct(index).alias("n"), F.min(index).alias("first"), F.max(index).alias("last")
    ).withColumn("complete", (F.col("n") == size) & (F.col("first") == F.col("range") * size) & (F.col("last") == F.col("range") * size + size - 1))


def gaps(present: DataFrame, index: str, bucket: int = 100_000) -> DataFrame:
    """Holes (first, last) between present indices.

    Buckets are searched apart and then joined at their bounds, so no task orders the whole table.
    """
    from pyspark.sql import Window

    rows = present.select(F.col(index).alias("i")).distinct().withColumn("b", F.expr(f"i div {bucket}"))
    inside = rows.withColumn("next", F.lead("i").over(Window.partitionBy("b").orderBy("i"))).filter("next > i + 1").select("i", "next")
    ends = rows.groupBy("b").agg(F.min("i").alias("lo"), F.max("i").alias("hi"))
    across = ends.withColumn("next", F.lead("lo").over(Window.orderBy("b"))).filter("next > hi + 1").select(F.col("hi").alias("i"), "next")
    return inside.unionByName(across).select((F.col("i") + 1).alias("first"), (F.col("next") - 1).alias("last"))


def missing_ranges(done: DataFrame, first: int, last: int, step: int, key: str = "handler") -> DataFrame:
    """(key, range_index) between first and last that are not done. The ranges are rows of their own, dealt to tasks, before keys meet them."""
    ranges = done.sparkSession.range(first, last + 1, step).withColumnRenamed("id", "range_index")
    keys = done.select(key).distinct()  # handlers: configuration
    want = ranges.crossJoin(F.broadcast(keys.agg(F.collect_list(key).alias("_keys")))).select(F.explode("_keys").alias(key), "range_index")
    return want.join(done.select(key, "range_index"), [key, "range_index"], "left_anti")
