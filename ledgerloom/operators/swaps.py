"""Swap and liquidity events to one normal form (pool, block, ts, log_index, amounts, price; tick, square-root price, liquidity).

256-bit amounts are decimal text; those that are known to fit may be numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.functions import fixedpoint, words
from ledgerloom.functions.fixedpoint import approximate_price, tick_udf, with_sqrt_price

EVENT = ("block", "log_index")


def _text(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.simpleString() == "string"


def net_amounts(swaps: DataFrame) -> DataFrame:
    """V2 shape -> signed net amounts: what went in less what came out, in 256 bits where the amounts are decimal text."""
    sides = {f"amount{i}": (F.col(f"amount{i}_in"), F.col(f"amount{i}_out")) for i in (0, 1)}
    return words.with_differences(swaps, sides) if _text(swaps, "amount0_in") else swaps.withColumns({n: a - b for n, (a, b) in sides.items()})


def execution_price(base: Column, quote: Column, base_decimals: int = 0, quote_decimals: int = 0) -> Column:
    """Quote per base from net amounts (numbers or decimal text), scaled by the tokens' decimals; null where either side is zero."""
    base, quote = base.cast("double"), quote.cast("double")
    price = F.abs(quote) / F.abs(base) * F.lit(10.0 ** (base_decimals - quote_decimals))
    return F.when((base != 0) & (quote != 0), price)


def v2_swaps(swaps: DataFrame, base_is_token0: bool = True) -> DataFrame:
    net = net_amounts(swaps)
    base, quote = ("amount0", "amount1") if base_is_token0 else ("amount1", "amount0")
    return net.withColumn("price", execution_price(F.col(base), F.col(quote))).select("pool", "block", "ts", "log_index", "amount0", "amount1", "price")


def without_ticks(swaps: DataFrame) -> DataFrame:
    """Swaps of pools that have no ticks: zeros in their place."""
    return swaps.withColumns({"tick": F.lit(0), "sqrt_price": F.lit("0"), "liquidity": F.lit("0")})


def _as_text(df: DataFrame, columns: dict[str, bool]) -> DataFrame:
    """Words (name -> signed) as decimal text; what is a number or text already stays as text."""
    raw = {c for c in columns if df.schema[c].dataType.simpleString() == "binary"}
    text = lambda c, signed: (words.int256_text if signed else words.u256_text)(c) if c in raw else F.col(c).cast("string")
    return df.withColumns({c: text(c, signed) for c, signed in columns.items()})


def v3_swaps(decoded: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """Decoded Swap events (address; amount0, amount1, sqrtPriceX96, liquidity as words or text; tick) to the normal form.

    metadata: pool, is_token_0; the price is quote per base, as a double. Without it token 0 is the base.
    """
    rows = _as_text(decoded, {"amount0": True, "amount1": True, "sqrtPriceX96": False, "liquidity": False})
    out = rows.select(
        F.col("address").alias("pool"), F.col("block_number").alias("block"), "ts", "log_index", "amount0", "amount1",
        F.col("sqrtPriceX96").alias("sqrt_price"), F.col("tick").cast("int").alias("tick"), "liquidity",
    )
    if metadata is not None:
        out = out.join(metadata.select("pool", "is_token_0"), "pool")
    first = F.lit(True) if metadata is None else F.col("is_token_0")
    return out.withColumn("price", approximate_price(F.col("sqrt_price"), first))


def coin_swaps(decoded: DataFrame) -> DataFrame:
    """Coin swaps (with sqrt_price as text): the tick of the price, computed once per distinct price; prices out of range go."""
    ticks = decoded.select("sqrt_price").distinct().withColumn("tick", words.per_value(tick_udf, "int")("sqrt_price"))
    return decoded.join(ticks, "sqrt_price").filter(F.col("tick").isNotNull())


def modify_liquidity(decoded: DataFrame, *, tuple_form: bool = True) -> DataFrame:
    """ModifyLiquidity events to (pool, block, log_index, tick_lower, tick_upper, liquidity_delta).

    Tuple form: columns key.currency0, key.currency1, key.fee, key.tickSpacing, key.hooks, params.tickLower, params.tickUpper,
    params.liquidityDelta; the pool id is the hash of the key, once per distinct key. Flat form: id, tickLower, tickUpper, liquidityDelta.
    """
    from ledgerloom.operators.decode import pool_ids

    delta = "params.liquidityDelta" if tuple_form else "liquidityDelta"
    prefix = "params." if tuple_form else ""
    rows = decoded.withColumn("_delta", F.col(f"`{delta}`"))
    if decoded.schema[delta].dataType.simpleString() == "binary":
        rows = _as_text(rows, {"_delta": True})
    if tuple_form:
        names = {"currency0": "currency0", "currency1": "currency1", "fee": "fee", "tickSpacing": "tick_spacing", "hooks": "hooks"}
        rows = pool_ids(rows.withColumns({new: F.col(f"`key.{old}`") for old, new in names.items()})).withColumnRenamed("pool_id", "id")
    return rows.select(
        F.col("id").alias("pool"), F.col("block_number").alias("block"), "log_index", F.col(f"`{prefix}tickLower`").cast("int").alias("tick_lower"),
        F.col(f"`{prefix}tickUpper`").cast("int").alias("tick_upper"), F.col("_delta").alias("liquidity_delta"),
    )


def auction_swaps(events: DataFrame, hooks: DataFrame, checkpoint: DataFrame | None = None) -> DataFrame:
    """Auction swaps (hook, block, ts, log_index, tick, total_proceeds, total_sold; cumulative) to the normal form.

    hooks: hook, pool, is_token_0; checkpoint: pool, total_proceeds, total_sold. The totals become differences (a fall counts in
    full); proceeds are quote that came in, tokens sold are base that went out. An invalid tick drops its row, but only
    after it has moved the totals on. Totals in decimal text are differenced in 256 bits. There is no liquidity in these events.
    """
    rows = events.join(hooks.select("hook", "pool", "is_token_0"), "hook")
    deltas = cumulative_to_delta(rows, ["total_proceeds", "total_sold"], checkpoint)
    text = _text(events, "total_proceeds")
    minus = lambda c: words.negate(F.col(c)) if text else -F.col(c)
    first = F.col("is_token_0")
    deltas = deltas.withColumns({
        "amount0": F.when(first, minus("total_sold_delta")).otherwise(F.col("total_proceeds_delta")),
        "amount1": F.when(first, F.col("total_proceeds_delta")).otherwise(minus("total_sold_delta")),
    })
    valid = deltas.filter(F.col("tick").between(fixedpoint.MIN_TICK, fixedpoint.MAX_TICK))
    priced = with_sqrt_price(valid).withColumn("price", approximate_price(F.col("sqrt_price"), F.col("is_token_0")))
    return priced.select("pool", "block", "ts", "log_index", "amount0", "amount1", "sqrt_price", "tick", F.lit("0").alias("liquidity"), "price")


def mint_burn(mints: DataFrame, burns: DataFrame) -> DataFrame:
    """Mints add and burns take liquidity."""
    cols = ["pool", "block", "log_index", "tick_lower", "tick_upper"]
    return mints.select(*cols, F.col("amount").alias("liquidity_delta")).unionByName(burns.select(*cols, (-F.col("amount")).alias("liquidity_delta")))


def hook_swaps(events: DataFrame, calls: DataFrame, *, strict: bool = False) -> DataFrame:
    """Events joined to the pool-state call of the same (block, log_index).

    A reverted call skips its swap. A missing call raises when strict, and otherwise leaves the row with missing = true.
    """
    calls = calls.select(*EVENT, F.col("value").alias("slot0"), "is_reverted")
    out = events.join(calls, list(EVENT), "left").filter(~F.coalesce(F.col("is_reverted"), F.lit(False)))
    missing = F.col("is_reverted").isNull()
    if strict:
        checked = F.when(missing, F.raise_error(F.concat(F.lit("no pool state for event "), F.col("block"), F.lit("/"), F.col("log_index")))).otherwise(F.col("slot0"))
        out = out.withColumn("slot0", checked)
    return out.withColumn("missing", missing).drop("is_reverted")


def cumulative_to_delta(events: DataFrame, totals: list[str], checkpoint: DataFrame | None = None, *, key: str = "pool", bucket: int = 10_000) -> DataFrame:
    """Cumulative totals per key in (block, log_index) order to differences; a fall means a restart and counts in full.

    checkpoint: the key's last totals before these events. Rows to be dropped later must still be here: they move the total on.
    Each bucket of blocks is ordered apart and takes its start from the last row of the bucket before, so a busy key's events
    are never ordered in one task. Totals may be numbers or decimal text (256 bits).
    """
    text = {c: _text(events, c) for c in totals}
    events = events.withColumn("_b", F.expr(f"block div {bucket}"))
    ends = events.groupBy(key, "_b").agg(F.max_by(F.struct(*totals), F.struct(*EVENT)).alias("_end"))
    starts = ends.select(key, "_b", F.lag("_end").over(Window.partitionBy(key).orderBy("_b")).alias("_start"))
    if checkpoint is not None:
        starts = starts.join(checkpoint.select(key, F.struct(*totals).alias("_seed")), key, "left")
    else:
        starts = starts.withColumn("_seed", F.col("_start"))
    inside = Window.partitionBy(key, "_b").orderBy(*EVENT)
    out = events.join(starts, [key, "_b"])
    for c in totals:
        before = F.coalesce(F.lag(c).over(inside), F.col(f"_start.{c}"), F.col(f"_seed.{c}"), F.lit("0" if text[c] else 0))
        if text[c]:
            out = words.with_differences(out.withColumn("_was", before), {"_gap": (F.col(c), F.col("_was"))})
            out = out.withColumn(f"{c}_delta", F.when(F.col("_gap").startswith("-"), F.col(c)).otherwise(F.col("_gap"))).drop("_was", "_gap")
        else:
            out = out.withColumn(f"{c}_delta", F.when(F.col(c) >= before, F.col(c) - before).otherwise(F.col(c)))
    return out.drop("_b", "_start", "_seed")


def last_per_block(swaps: DataFrame) -> DataFrame:
    """The end-of-block swap of each pool: the one with the greatest log index."""
    rest = [c for c in swaps.columns if c not in ("pool", "block")]
    best = swaps.groupBy("pool", "block").agg(F.max_by(F.struct(*rest), "log_index").alias("s"))
    return best.select("pool", "block", *[F.col(f"s.{c}").alias(c) for c in rest])


def live_positions(calls: DataFrame, positions: str = "positions") -> DataFrame:
    """One row per position of a call's array with liquidity other than zero."""
    p = F.explode(F.filter(F.col(positions), lambda x: x["liquidity"] != 0))
    return calls.select(*[c for c in calls.columns if c != positions], p.alias("p")).select("*", "p.*").drop("p")
