"""Block snapshots, rolling windows, as-of changes and candles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.functions import words

HOUR, DAY = 3600, 86_400
#: Columns of a swap whose last values in a block go into its snapshot, where they are there.
LAST = ("tick", "sqrt_price", "liquidity")


def is_text(df: DataFrame, name: str) -> bool:
    """Whether a column holds 256-bit integers as decimal text."""
    return df.schema[name].dataType.simpleString() == "string"


def magnitude_sum(df: DataFrame, name: str) -> Column:
    """Aggregate: the sum of absolute values, exact for decimal text and for numbers."""
    return words.sum_abs(F.col(name)) if is_text(df, name) else F.sum(F.abs(name))


def block_ohlc(swaps: DataFrame) -> DataFrame:
    """Per (pool, block): open and close by log index, high, low, volumes of absolute amounts, count, and the last tick, square-root
    price and liquidity where swaps have them. Null prices take no part. Amounts in decimal text are summed in 256 bits."""
    last = [F.max_by(c, "log_index").alias(f"last_{c}") for c in LAST if c in swaps.columns]
    return swaps.filter(F.col("price").isNotNull()).groupBy("pool", "block").agg(
        F.max("ts").alias("ts"),
        F.min_by("price", "log_index").alias("price_open"), F.max_by("price", "log_index").alias("price_close"),
        F.max("price").alias("price_high"), F.min("price").alias("price_low"),
        magnitude_sum(swaps, "amount0").alias("volume0"), magnitude_sum(swaps, "amount1").alias("volume1"), F.count(F.lit(1)).alias("swap_count"), *last,
    )


def with_metadata(snapshots: DataFrame, metadata: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of known pools, report of unknown pools: count and five of them)."""
    known = snapshots.join(metadata, "pool")
    missing = snapshots.join(metadata, "pool", "left_anti").groupBy("pool").agg(F.count(F.lit(1)).alias("n"))
    report = missing.agg(F.count(F.lit(1)).alias("pools"), F.sum("n").alias("rows"), F.slice(F.sort_array(F.collect_set("pool")), 1, 5).alias("samples"))
    return known, report


def latest_state(snapshots: DataFrame, keys: list[str], order: str = "block") -> DataFrame:
    rest = [c for c in snapshots.columns if c not in keys]
    best = snapshots.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("s"))
    return best.select(*keys, *[F.col(f"s.{c}").alias(c) for c in rest])


def _frame(start: int | None, end: int):
    return Window.partitionBy("pool", "_bucket").orderBy("ts").rangeBetween(Window.unboundedPreceding if start is None else start, end)


def rolling(snapshots: DataFrame, seconds: int = DAY) -> DataFrame:
    """Sums over (t - seconds, t] per pool, as the difference of two running sums: linear in the rows, however wide the window.

    A pool's rows are dealt to buckets of `seconds`; each also serves the next bucket, so that every window lies in one, and the
    busiest pool is as many tasks as it has buckets.
    """
    bucket = F.floor(F.col("ts") / seconds)
    out = snapshots.withColumn("_bucket", F.explode(F.array(bucket, bucket + 1)))
    for source, name in (("volume1", "volume_24h"), ("swap_count", "swaps_24h")):
        upto, before = _frame(None, 0), _frame(None, -seconds)
        if is_text(snapshots, source):
            out = out.withColumn(name, words.window_u256(F.col(source), upto, before))
        else:
            out = out.withColumn(name, F.sum(source).over(upto) - F.coalesce(F.sum(source).over(before), F.lit(0)))
    return out.filter(F.col("_bucket") == bucket).drop("_bucket")


def price_changes(snapshots: DataFrame, value: str = "price_close") -> DataFrame:
    """Changes against the last value at or before t - seconds (1 h and 24 h), ties to the greater block; null where there is none
    or it is zero.

    A pool's rows are dealt to buckets of a day. The value asked for lies in the row's bucket, in the one before it, or it is the
    last one of the buckets before those, which is carried along the pool's bucket ends: one row a bucket.
    """
    bucket = F.floor(F.col("ts") / DAY)
    point = F.struct("ts", "block", value)
    ends = snapshots.groupBy("pool", bucket.alias("_bucket")).agg(F.max(point).alias("_end"))
    # a bucket's carried end is the last one before the bucket that precedes it
    until = F.max("_end").over(Window.partitionBy("pool").orderBy("_bucket").rangeBetween(Window.unboundedPreceding, -2))
    ends = ends.select("pool", "_bucket", until.alias("_carried"))
    out = snapshots.withColumn("_own", bucket).withColumn("_bucket", F.explode(F.array("_own", F.col("_own") + 1)))
    names = {HOUR: "change_1h", DAY: "change_24h"}
    for seconds in names:
        out = out.withColumn(f"_at{seconds}", F.max(point).over(_frame(None, -seconds)))
    out = out.filter("_bucket = _own").join(ends, ["pool", "_bucket"])
    for seconds, name in names.items():
        was = F.coalesce(f"_at{seconds}", "_carried")[value]
        out = out.withColumn(name, F.when(was != 0, (F.col(value) - was) / was))
    return out.drop("_own", "_bucket", "_carried", *[f"_at{s}" for s in names])


def candles(snapshots: DataFrame, seconds: int = HOUR) -> DataFrame:
    start = (F.col("ts") - F.col("ts") % seconds).alias("start")
    volume = words.sum_u256(F.col("volume1")) if is_text(snapshots, "volume1") else F.sum("volume1")
    return snapshots.groupBy("pool", start).agg(
        F.min_by("price_open", "block").alias("open"), F.max("price_high").alias("high"), F.min("price_low").alias("low"),
        F.max_by("price_close", "block").alias("close"), volume.alias("volume"), F.sum("swap_count").alias("swaps"),
    )


def volume_usd(volume: Column, quote_decimals: Column | int, usd: Column) -> Column:
    decimals = quote_decimals if isinstance(quote_decimals, Column) else F.lit(quote_decimals)
    return volume.cast("double") / F.pow(F.lit(10.0), decimals.cast("double")) * usd
