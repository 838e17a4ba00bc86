"""Tick maps, active liquidity and the value locked in positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.functions.fixedpoint import position_udf
from ledgerloom.functions.words import sum_u256
from ledgerloom.operators.running import next_values, running_sums
from ledgerloom.operators.swaps import live_positions

RANGE = ["pool", "tick_lower", "tick_upper"]


def current_tick_map(liquidity: DataFrame) -> DataFrame:
    return liquidity.groupBy(*RANGE).agg(F.sum("liquidity_delta").alias("liquidity")).filter("liquidity > 0")


def validity(liquidity: DataFrame, bucket: int = 10_000) -> DataFrame:
    """Per pool and tick range: the net liquidity and the blocks [from_block, to_block) it holds for.

    A range's changes are summed per block, and then run through by buckets of blocks: a full range that holds most of a pool's
    changes is as many tasks as there are buckets.
    """
    steps = liquidity.groupBy(*RANGE, "block").agg(F.sum("liquidity_delta").alias("delta"))
    steps = next_values(running_sums(steps, RANGE, "block", {"liquidity": F.col("delta")}, bucket), RANGE, "block", "to_block", bucket)
    return steps.select(*RANGE, F.col("block").alias("from_block"), "to_block", "liquidity")


def tick_map(liquidity: DataFrame, targets: DataFrame, bucket: int = 1024) -> DataFrame:
    """The tick map of each target (pool, block): ranges with positive net liquidity up to and with that block.

    The changes are summed per block once and turned into validity intervals; a target meets one interval per range. Blocks are
    dealt to buckets: an interval goes to those of its pool's buckets that hold targets and that it touches, so targets and
    intervals meet by (pool, bucket), and the rows in between are of the order of the result.
    """
    live = validity(liquidity).filter("liquidity > 0")
    targets = targets.withColumn("_bucket", F.floor(F.col("block") / bucket))
    wanted = targets.groupBy("pool").agg(F.collect_set("_bucket").alias("_wanted"))
    first, last = F.floor(F.col("from_block") / bucket), F.floor((F.col("to_block") - 1) / bucket)
    touched = F.filter("_wanted", lambda b: (b >= first) & (F.col("to_block").isNull() | (b <= last)))
    live = live.join(wanted, "pool").withColumn("_bucket", F.explode(touched))
    inside = (F.col("t.block") >= F.col("v.from_block")) & (F.col("v.to_block").isNull() | (F.col("t.block") < F.col("v.to_block")))
    same = (F.col("t.pool") == F.col("v.pool")) & (F.col("t._bucket") == F.col("v._bucket"))
    return targets.alias("t").join(live.alias("v"), same & inside).select("t.pool", "t.block", "v.tick_lower", "v.tick_upper", "v.liquidity")


def active_liquidity(ticks: DataFrame) -> DataFrame:
    """Per (pool, block): liquidity of the ranges that hold the tick, lower end in, upper end out."""
    inside = (F.col("tick_lower") <= F.col("tick")) & (F.col("tick") < F.col("tick_upper"))
    return ticks.groupBy("pool", "block").agg(F.sum(F.when(inside, F.col("liquidity")).otherwise(0)).alias("active_liquidity"))


def position_totals(ticks: DataFrame, prices: DataFrame) -> DataFrame:
    """Per (pool, block) the sums of both tokens over its positions at its square-root price, as decimal text, and of those
    whose range holds its tick (active0, active1).

    ticks: pool, block, tick_lower, tick_upper, liquidity; prices: pool, block, sqrt_price and, for the active sums, tick. Targets without
    positions or price have no row.
    """
    return _totals(ticks.join(prices, ["pool", "block"]))


def _totals(rows: DataFrame) -> DataFrame:
    """position_totals of positions that have their price (and tick) beside them. A position's amounts are found where its row lies, once per
    distinct (price, range, liquidity) of an Arrow batch; amounts that nobody asks for are not found at all."""
    asked = ["sqrt_price", "tick_lower", "tick_upper", "liquidity"]
    rows = rows.dropna(subset=asked).withColumn("_a", position_udf(*asked))
    amount = lambda i: F.col("_a")[f"amount{i}"]
    sums = [sum_u256(amount(i)).alias(f"amount{i}") for i in (0, 1)]
    if "tick" in rows.columns:
        active = (F.col("tick_lower") <= F.col("tick")) & (F.col("tick") < F.col("tick_upper"))
        sums += [sum_u256(F.when(active, amount(i)).otherwise("0")).alias(f"active{i}") for i in (0, 1)]
        sums.append(sum_u256(F.when(active, F.col("liquidity")).otherwise("0")).alias("active_liquidity"))
    return rows.groupBy("pool", "block").agg(*sums)


def embedded_totals(calls: DataFrame) -> DataFrame:
    """position_totals where the positions come with the call's result: pool, block, tick, sqrt_price, positions (an array of
    tick_lower, tick_upper, liquidity). Positions without liquidity take no part; a result without any has no row. Positions keep their
    result's price: results are read, or decoded, once."""
    return _totals(live_positions(calls).withColumn("liquidity", F.col("liquidity").cast("string")))


def value_usd(base, quote, price, usd, supply=None, active=None) -> dict:
    """TVL, market cap and active value from token amounts (already scaled by decimals; active: the pair of active ones): null
    without a USD price of the quote."""
    out = {"tvl_usd": (base * price + quote) * usd}
    if supply is not None:
        out["market_cap_usd"] = supply * price * usd
    if active is not None:
        out["active_liquidity_usd"] = (active[0] * price + active[1]) * usd
    return out


def fill_snapshots(snapshots: DataFrame, tvl: DataFrame, bucket: int = 10_000) -> DataFrame:
    """TVL into snapshots. A row that exists keeps prices and volumes and gets the TVL columns; where only liquidity moved, a row
    comes in with the previous close (or the bootstrap price) in all four prices and no volume; without either it does not.

    The previous close is looked for in the row's bucket of blocks, and otherwise carried along the ends of the pool's buckets.

    snapshots: pool, block, ts, price_open/close/high/low, volume1, swap_count; tvl: pool, block, tvl_ts, tvl_usd, bootstrap.
    """
    both = snapshots.withColumn("_swap", F.lit(True)).join(tvl, ["pool", "block"], "full_outer").withColumn("_bucket", F.floor(F.col("block") / bucket))
    there = both.groupBy("pool", "_bucket").agg(F.max(F.when(F.col("price_close").isNotNull(), F.struct("block", "price_close"))).alias("_end"))
    earlier = Window.partitionBy("pool").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried_in = there.select("pool", "_bucket", F.max("_end").over(earlier)["price_close"].alias("_carried"))
    before = Window.partitionBy("pool", "_bucket").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    both = both.join(carried_in, ["pool", "_bucket"])
    carried = F.coalesce(F.last("price_close", ignorenulls=True).over(before), F.col("_carried"), F.col("bootstrap"))
    both = both.withColumn("_p", F.when(F.col("_swap"), None).otherwise(carried)).filter(F.col("_swap") | F.col("_p").isNotNull())
    prices = [F.coalesce(c, "_p").alias(c) for c in ("price_open", "price_close", "price_high", "price_low")]
    return both.select(
        "pool", "block", F.coalesce("tvl_ts", "ts").alias("ts"), *prices,
        F.coalesce("volume1", F.lit(0)).alias("volume1"), F.coalesce("swap_count", F.lit(0)).alias("swap_count"), "tvl_usd",
    )


def fill_state(state: DataFrame, tvl: DataFrame, snapshots: DataFrame) -> DataFrame:
    """TVL into the latest-state table: each pool's last TVL row updates a state of the same or an older block, keeping its price; a
    pool without state is bootstrapped; a newer state stays. The rolling columns are those of the filled snapshots at that block.

    state: pool, block, price, tvl_usd, volume_24h, swaps_24h; snapshots: what fill_snapshots returned.
    """
    from ledgerloom.operators.ohlc import DAY, rolling

    last = tvl.groupBy("pool").agg(F.max_by(F.struct("block", "tvl_usd", "bootstrap"), "block").alias("n")).select("pool", "n")
    # a pool's window ends at one block: of its snapshots only those of a day before that are looked at
    ends = last.select("pool", F.col("n.block").alias("_block")).join(snapshots.select("pool", F.col("block").alias("_block"), F.col("ts").alias("_ts")), ["pool", "_block"])
    near = snapshots.join(ends, "pool").filter((F.col("ts") <= F.col("_ts")) & (F.col("ts") > F.col("_ts") - DAY)).select(snapshots.columns)
    windows = rolling(near).select("pool", F.col("block").alias("w_block"), "volume_24h", "swaps_24h", F.col("price_close").alias("w_price"))
    both = state.withColumn("s", F.struct(*[c for c in state.columns if c != "pool"])).select("pool", "s").join(last, "pool", "full_outer")
    both = both.join(windows, (both["pool"] == windows["pool"]) & (F.col("n.block") == F.col("w_block")), "left").drop(windows["pool"])
    take = F.col("n").isNotNull() & (F.col("s").isNull() | (F.col("n.block") >= F.col("s.block")))
    pick = lambda new, old: F.when(take, new).otherwise(F.col(f"s.{old}")).alias(old)
    return both.select(
        "pool", pick(F.col("n.block"), "block"), pick(F.coalesce("s.price", "w_price", "n.bootstrap"), "price"), pick(F.col("n.tvl_usd"), "tvl_usd"),
        pick(F.coalesce("volume_24h", F.lit(0).cast("bigint")), "volume_24h"), pick(F.coalesce("swaps_24h", F.lit(0).cast("bigint")), "swaps_24h"),
    ).filter("price is not null")
