"""Swaps, snapshots, windows, tick maps and serving queries over the projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.operators import ohlc, swaps as S, tvl
from ledgerloom.plans.base import query
from ledgerloom.sources import fixtures as fx
from ledgerloom.sources.fixtures import with_views

NORM = """, n AS (SELECT pool, block, ts, log_index, amount0_in - amount0_out AS amount0, amount1_in - amount1_out AS amount1 FROM v_swaps),
s AS (SELECT *, CASE WHEN amount0 <> 0 AND amount1 <> 0 THEN abs(amount1)::DOUBLE / abs(amount0)::DOUBLE END AS price FROM n)"""
OHLC = NORM + """, o AS (SELECT pool, block, max(ts) AS ts, arg_min(price, log_index) AS price_open, arg_max(price, log_index) AS price_close,
max(price) AS price_high, min(price) AS price_low, sum(abs(amount0))::BIGINT AS volume0, sum(abs(amount1))::BIGINT AS volume1, count(*) AS swap_count
FROM s WHERE price IS NOT NULL GROUP BY pool, block)"""


def market(sql: str) -> str:
    return with_views(OHLC + sql, "v_swaps")


def _ohlc(spark, sf) -> DataFrame:
    return ohlc.block_ohlc(S.v2_swaps(fx.swaps(spark, sf)))


@query("g08_v2_net_swaps", with_views(NORM + " SELECT pool, block, log_index, amount0, amount1 FROM s", "v_swaps"))
def g08(spark, sf):
    return S.net_amounts(fx.swaps(spark, sf)).select("pool", "block", "log_index", "amount0", "amount1")


@query("g09_execution_price", with_views(NORM + " SELECT pool, block, log_index, price FROM s", "v_swaps"))
def g09(spark, sf):
    return S.v2_swaps(fx.swaps(spark, sf)).select("pool", "block", "log_index", "price")


@query("g02_mint_burn", """SELECT l_partkey % 16 AS pool, floor(epoch(l_shipdate))::BIGINT // 604800 AS block, count(*) AS n,
sum((CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE -l_quantity END)::BIGINT)::BIGINT AS net FROM lineitem GROUP BY 1, 2""")
def g02(spark, sf):
    liq = fx.liquidity(spark, sf).withColumn("log_index", F.lit(0)).withColumn("amount", F.abs("liquidity_delta"))
    moves = S.mint_burn(liq.filter("liquidity_delta > 0"), liq.filter("liquidity_delta < 0"))
    return moves.groupBy("pool", "block").agg(F.count(F.lit(1)).alias("n"), F.sum("liquidity_delta").alias("net"))


@query("g03_hook_swaps", with_views("""
SELECT l.block_number AS block, l.log_index, l.event_id, c.value AS slot0, c.value IS NULL AS missing FROM v_logs l
LEFT JOIN v_calls c USING (block_number, log_index) WHERE NOT coalesce(c.is_reverted, false)""", "v_logs", "v_calls"))
def g03(spark, sf):
    events = fx.logs(spark, sf).select(F.col("block_number").alias("block"), "log_index", "event_id")
    calls = fx.calls(spark, sf).withColumnRenamed("block_number", "block")
    return S.hook_swaps(events, calls).select("block", "log_index", "event_id", "slot0", "missing")


@query("g05_cumulative_to_delta", """
WITH e AS (SELECT user_id AS pool, event_id // 10 AS block, event_id % 10 AS log_index, round(value * 100)::BIGINT AS total FROM events),
d AS (SELECT *, coalesce(lag(total) OVER (PARTITION BY pool ORDER BY block, log_index), 100) AS was FROM e)
SELECT pool, block, log_index, CASE WHEN total >= was THEN total - was ELSE total END AS total_delta FROM d""")
def g05(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").selectExpr("user_id as pool", "event_id div 10 as block", "event_id % 10 as log_index", "cast(round(value * 100) as bigint) as total")
    seed = e.select("pool").distinct().withColumn("total", F.lit(100))
    return S.cumulative_to_delta(e, ["total"], seed).select("pool", "block", "log_index", "total_delta")


@query("g10_last_swap_per_block", with_views(NORM + """ SELECT pool, block, max(log_index) AS log_index, arg_max(amount0, log_index) AS amount0,
arg_max(price, log_index) AS price FROM s GROUP BY pool, block""", "v_swaps"))
def g10(spark, sf):
    return S.last_per_block(S.v2_swaps(fx.swaps(spark, sf))).select("pool", "block", "log_index", "amount0", "price")


@query("g11_live_positions", """SELECT l_orderkey AS call_id, (l_suppkey % 10 * 60)::INTEGER AS tick_lower, l_quantity::BIGINT AS liquidity, count(*) AS n
FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1, 2, 3""")
def g11(spark, sf):
    line = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr(
        "l_orderkey as call_id", "named_struct('tick_lower', cast(l_suppkey % 10 * 60 as int), 'liquidity', cast(if(l_linestatus = 'O', l_quantity, 0) as bigint)) as p")
    calls = line.groupBy("call_id").agg(F.collect_list("p").alias("positions"))
    return S.live_positions(calls).groupBy("call_id", "tick_lower", "liquidity").agg(F.count(F.lit(1)).alias("n"))


@query("h01_block_ohlc", market(" SELECT * FROM o"))
def h01(spark, sf):
    return _ohlc(spark, sf)


@query("h02_v2_inverse_ohlc", with_views(NORM + """ SELECT pool, block, max(p) AS price_high, min(p) AS price_low, count(*) AS swap_count, 0 AS last_tick, '0' AS last_liquidity FROM
(SELECT *, abs(amount0)::DOUBLE / abs(amount1)::DOUBLE AS p FROM s WHERE amount0 <> 0 AND amount1 <> 0) GROUP BY pool, block""", "v_swaps"))
def h02(spark, sf):
    snaps = ohlc.block_ohlc(S.without_ticks(S.v2_swaps(fx.swaps(spark, sf), base_is_token0=False)))
    return snaps.select("pool", "block", "price_high", "price_low", "swap_count", "last_tick", "last_liquidity")


@query("h03_missing_pools", market(" SELECT count(DISTINCT pool) AS pools, count(*) AS rows, list_sort(list(DISTINCT pool))[1:5] AS samples FROM o WHERE pool % 3 = 0"))
def h03(spark, sf):
    known = spark.read.parquet(f"{sf}/part.parquet").selectExpr("p_partkey % 16 as pool").filter("pool % 3 <> 0").distinct()
    return ohlc.with_metadata(_ohlc(spark, sf), known)[1]


@query("h04_volume_usd", market(" SELECT pool, block, volume1::DOUBLE / pow(10.0::DOUBLE, 2.0::DOUBLE) * (1.0 + pool % 3)::DOUBLE AS volume_usd FROM o"))
def h04(spark, sf):
    snaps = _ohlc(spark, sf)
    usd = snaps.select("pool").distinct().withColumn("usd", (1 + F.col("pool") % 3).cast("double"))
    return snaps.join(usd, "pool").select("pool", "block", ohlc.volume_usd(F.col("volume1"), 2, F.col("usd")).alias("volume_usd"))


@query("h05_latest_state", market(" SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY pool ORDER BY block DESC) = 1"))
def h05(spark, sf):
    snaps = _ohlc(spark, sf)
    return ohlc.latest_state(snaps, ["pool"]).select(*snaps.columns)


@query("h06_rolling_24h", market(""" SELECT pool, block, sum(volume1) OVER w::BIGINT AS volume_24h, sum(swap_count) OVER w::BIGINT AS swaps_24h FROM o
WINDOW w AS (PARTITION BY pool ORDER BY ts RANGE BETWEEN 86399 PRECEDING AND CURRENT ROW)""").replace("OVER w::BIGINT", "OVER w"))
def h06(spark, sf):
    return ohlc.rolling(_ohlc(spark, sf)).select("pool", "block", "volume_24h", "swaps_24h")


@query("h07_price_change", market(""", c AS (SELECT o.pool, o.block, o.price_close AS p, h.price_close AS p1, d.price_close AS p24 FROM o
ASOF LEFT JOIN o h ON o.pool = h.pool AND o.ts - 3600 >= h.ts ASOF LEFT JOIN o d ON o.pool = d.pool AND o.ts - 86400 >= d.ts)
SELECT pool, block, CASE WHEN p1 <> 0 THEN (p - p1) / p1 END AS change_1h, CASE WHEN p24 <> 0 THEN (p - p24) / p24 END AS change_24h FROM c"""))
def h07(spark, sf):
    return ohlc.price_changes(_ohlc(spark, sf)).select("pool", "block", "change_1h", "change_24h")


TICKS = """, t AS (SELECT DISTINCT pool, block FROM v_liq WHERE block % 13 = 0),
m AS (SELECT t.pool, t.block, l.tick_lower, l.tick_upper, sum(l.liquidity_delta)::BIGINT AS liquidity FROM t JOIN v_liq l ON l.pool = t.pool AND l.block <= t.block
GROUP BY ALL HAVING sum(l.liquidity_delta) > 0)"""


def _targets(liq: DataFrame) -> DataFrame:
    return liq.filter("block % 13 = 0").select("pool", "block").distinct()


@query("h08_tick_map", with_views(TICKS + " SELECT * FROM m", "v_liq"))
def h08(spark, sf):
    liq = fx.liquidity(spark, sf)
    return tvl.tick_map(liq, _targets(liq))


@query("h09_current_tick_map", with_views(" SELECT pool, tick_lower, tick_upper, sum(liquidity_delta)::BIGINT AS liquidity FROM v_liq GROUP BY ALL HAVING sum(liquidity_delta) > 0", "v_liq"))
def h09(spark, sf):
    return tvl.current_tick_map(fx.liquidity(spark, sf))


@query("h10_active_liquidity", with_views(TICKS + """ SELECT pool, block, sum(CASE WHEN tick_lower <= 300 AND 300 < tick_upper THEN liquidity ELSE 0 END)::BIGINT AS active_liquidity
FROM m GROUP BY pool, block""", "v_liq"))
def h10(spark, sf):
    liq = fx.liquidity(spark, sf)
    return tvl.active_liquidity(tvl.tick_map(liq, _targets(liq)).withColumn("tick", F.lit(300)))


@query("h11_hourly_candles", market(""" SELECT pool, ts - ts % 3600 AS start, arg_min(price_open, block) AS open, max(price_high) AS high, min(price_low) AS low,
arg_max(price_close, block) AS close, sum(volume1)::BIGINT AS volume, sum(swap_count)::BIGINT AS swaps FROM o GROUP BY 1, 2"""))
def h11(spark, sf):
    return ohlc.candles(_ohlc(spark, sf))


@query("m01_top_pools", market(""", l AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY pool ORDER BY block DESC) = 1)
SELECT pool, price_close, price_close * volume0 AS market_cap FROM l ORDER BY market_cap DESC NULLS LAST, pool LIMIT 10 OFFSET 2"""))
def m01(spark, sf):
    """Top pools: a page of the ranking is what is asked for."""
    state = ohlc.latest_state(_ohlc(spark, sf), ["pool"]).withColumn("market_cap", F.col("price_close") * F.col("volume0"))
    return state.select("pool", "price_close", "market_cap").orderBy(F.desc_nulls_last("market_cap"), "pool").offset(2).limit(10)


@query("m02_pool_detail", market(" SELECT pool, block, price_close, volume1 FROM o WHERE pool = 5"))
def m02(spark, sf):
    return ohlc.block_ohlc(S.v2_swaps(fx.swaps(spark, sf)).filter("pool = 5")).select("pool", "block", "price_close", "volume1")


@query("m03_block_chart", market(" SELECT pool, block, ts, price_close, volume1 FROM o WHERE pool = 3 AND ts > (SELECT max(ts) FROM o) - 86400"))
def m03(spark, sf):
    snaps = _ohlc(spark, sf)
    last = snaps.agg(F.max("ts").alias("last"))
    return snaps.filter("pool = 3").join(F.broadcast(last)).filter("ts > last - 86400").select("pool", "block", "ts", "price_close", "volume1").orderBy("ts")


@query("m04_candles_30d", market(""" SELECT pool, ts - ts % 3600 AS start, arg_min(price_open, block) AS open, arg_max(price_close, block) AS close
FROM o WHERE ts > (SELECT max(ts) FROM o) - 2592000 GROUP BY 1, 2"""))
def m04(spark, sf):
    snaps = _ohlc(spark, sf)
    last = snaps.agg(F.max("ts").alias("last"))
    return ohlc.candles(snaps.join(F.broadcast(last)).filter("ts > last - 2592000")).select("pool", "start", "open", "close")


@query("m06_protocol_volume", market(" SELECT coalesce(sum(volume1), 0)::BIGINT AS volume, coalesce(sum(swap_count), 0)::BIGINT AS swaps, count(DISTINCT pool) AS pools FROM o"))
def m06(spark, sf):
    return _ohlc(spark, sf).agg(F.coalesce(F.sum("volume1"), F.lit(0)).alias("volume"), F.coalesce(F.sum("swap_count"), F.lit(0)).alias("swaps"), F.countDistinct("pool").alias("pools"))
