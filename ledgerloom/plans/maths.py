"""Fixed-point mathematics, 256-bit sums and value locked, over the projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions import fixedpoint as fp, words
from ledgerloom.operators import entities, ohlc, swaps as S, tvl
from ledgerloom.plans.base import query
from ledgerloom.plans.market import OHLC, TICKS, _ohlc, _targets
from ledgerloom.sources import fixtures as fx
from ledgerloom.sources.fixtures import with_views


@query("j01_tick_to_sqrt_price")
def j01(spark, sf):
    """All ticks that line items name, per distinct tick (256-bit: no SQL twin; test_functions holds the known values)."""
    line = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("l_orderkey", "cast(l_partkey % 2001 - 1000 as int) as tick")
    return fp.with_sqrt_price(line)


@query("j02_sqrt_price_to_tick", "SELECT DISTINCT (l_partkey % 2001 - 1000)::INTEGER AS tick, (l_partkey % 2001 - 1000)::INTEGER AS back FROM lineitem")
def j02_g06(spark, sf):
    """Ticks to prices and back (J2, G6): the round trip is the identity."""
    ticks = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("cast(l_partkey % 2001 - 1000 as int) as tick").distinct()
    return ticks.withColumn("back", fp.tick_udf(fp.sqrt_price_udf("tick")))


@query("j04_position_amounts")
def j03_j04(spark, sf):
    liq = fx.liquidity(spark, sf).filter("liquidity_delta > 0").selectExpr("pool", "tick_lower", "tick_upper", "cast(liquidity_delta * 1000000 as string) as liquidity").distinct()
    return liq.withColumn("sqrt_price", fp.sqrt_price_udf(F.lit(300))).withColumn("a", fp.position_udf("sqrt_price", "tick_lower", "tick_upper", "liquidity")).select("pool", "tick_lower", "tick_upper", "liquidity", "a.*")


@query("j05_decimal_price")
def j05(spark, sf):
    ticks = spark.read.parquet(f"{sf}/part.parquet").selectExpr("p_partkey", "cast(p_partkey % 2001 - 1000 as int) as tick", "p_size % 2 = 0 as is_token_0")
    priced = fp.with_sqrt_price(ticks)
    return priced.withColumn("price", fp.price_udf("sqrt_price", "is_token_0", F.lit(18), F.lit(6))).withColumn("near", fp.approximate_price(F.col("sqrt_price"), F.col("is_token_0")))


@query("j06_raw_to_decimal", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (round(l_extendedprice * 100)::BIGINT // 100)::VARCHAR || CASE WHEN round(l_extendedprice * 100)::BIGINT % 100 = 0 THEN '' ELSE regexp_replace('.' || lpad((round(l_extendedprice * 100)::BIGINT % 100)::VARCHAR, 2, '0'), '0+$', '') END AS amount
FROM lineitem""")
def j06(spark, sf):
    line = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cast(round(l_extendedprice * 100) as bigint) as cents")
    return line.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", fp.to_decimal(F.col("cents").cast("string"), F.lit(2)).alias("amount"))


@query("j07_u256_sums", """SELECT l_partkey % 16 AS pool, sum(round(l_extendedprice * 100)::HUGEINT * 10000000000000000000000)::VARCHAR AS total FROM lineitem GROUP BY 1""")
def j07(spark, sf):
    line = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("l_partkey % 16 as pool", "concat(cast(cast(round(l_extendedprice * 100) as bigint) as string), repeat('0', 22)) as raw")
    return line.groupBy("pool").agg(words.sum_u256(F.col("raw")).alias("total"))


@query("j07_signed_sums", """SELECT l_partkey % 16 AS pool, sum(CASE WHEN l_linestatus = 'O' THEN l_quantity::HUGEINT ELSE 0 END)::VARCHAR AS plus, sum(CASE WHEN l_linestatus <> 'O' THEN l_quantity::HUGEINT ELSE 0 END)::VARCHAR AS minus,
sum(l_quantity::HUGEINT)::VARCHAR AS magnitude FROM lineitem GROUP BY 1""")
def j07b(spark, sf):
    liq = fx.liquidity(spark, sf).select("pool", F.col("liquidity_delta").cast("string").alias("raw"))
    plus, minus = words.sum_signed(F.col("raw"))
    return liq.groupBy("pool").agg(plus.alias("plus"), minus.alias("minus"), words.sum_abs(F.col("raw")).alias("magnitude"))


@query("k07_tvl")
def k07(spark, sf):
    """Position amounts at tick 300 of every 13th block's tick map, valued (256-bit amounts: no SQL twin; see test_tvl)."""
    liq = fx.liquidity(spark, sf)
    totals = _position_totals(liq)
    scaled = {c: F.col(c).cast("double") / 1e6 for c in ("amount0", "amount1", "active0", "active1")}
    worth = tvl.value_usd(scaled["amount0"], scaled["amount1"], F.lit(1.5), F.lit(2.0), active=(scaled["active0"], scaled["active1"]))
    return totals.withColumns(worth)


def _position_totals(liq: DataFrame) -> DataFrame:
    targets = _targets(liq)
    ticks = tvl.tick_map(liq, targets).withColumn("liquidity", F.concat("liquidity", F.lit("000000")))
    return tvl.position_totals(ticks, targets.withColumns({"sqrt_price": fp.sqrt_price_udf(F.lit(300)), "tick": F.lit(300)}))


@query("k07_active_liquidity", with_views(TICKS + """ SELECT pool, block, (sum(CASE WHEN tick_lower <= 300 AND 300 < tick_upper THEN liquidity ELSE 0 END)::HUGEINT * 1000000)::VARCHAR AS active_liquidity FROM m GROUP BY pool, block""", "v_liq"))
def k07_active(spark, sf):
    """The active part of the positions in 256 bits (K7)."""
    return _position_totals(fx.liquidity(spark, sf)).select("pool", "block", "active_liquidity")


@query("k07_embedded_positions", """SELECT l_partkey % 16 AS pool, l_orderkey AS block, (sum(CASE WHEN l_suppkey % 10 * 60 <= 300 AND 300 < l_suppkey % 10 * 60 + 600 AND l_quantity > 20 THEN l_quantity::BIGINT ELSE 0 END)::HUGEINT * 1000)::VARCHAR AS active_liquidity
FROM lineitem GROUP BY 1, 2 HAVING sum(CASE WHEN l_quantity > 20 THEN 1 ELSE 0 END) > 0""")
def k07_embedded(spark, sf):
    """Totals of positions that come with a call's result (K7)."""
    line = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("l_partkey % 16 as pool", "l_orderkey as block", "named_struct('tick_lower', cast(l_suppkey % 10 * 60 as int), 'tick_upper', cast(l_suppkey % 10 * 60 + 600 as int), 'liquidity', cast(if(l_quantity > 20, l_quantity * 1000, 0) as bigint)) as p")
    calls = line.groupBy("pool", "block").agg(F.collect_list("p").alias("positions")).withColumns({"tick": F.lit(300), "sqrt_price": F.lit(str(fp.sqrt_price_at(300)))})
    return tvl.embedded_totals(calls).select("pool", "block", "active_liquidity")


TVL = """, t AS (SELECT pool, block, max(block) * 1200 + 5 AS tvl_ts, sum(abs(liquidity_delta))::DOUBLE AS tvl_usd, CASE WHEN pool % 2 = 0 THEN 7.0::DOUBLE END AS bootstrap FROM v_liq WHERE block % 3 = 0 GROUP BY pool, block),
h AS (SELECT * FROM o WHERE block % 2 = 0)"""
FILL = """, b AS (SELECT coalesce(h.pool, t.pool) AS pool, coalesce(h.block, t.block) AS block, h.pool IS NOT NULL AS swap, h.ts, price_open, price_close, price_high, price_low, volume1, swap_count, tvl_ts, tvl_usd, bootstrap FROM h FULL JOIN t ON h.pool = t.pool AND h.block = t.block),
c AS (SELECT *, CASE WHEN NOT swap THEN coalesce(last_value(price_close IGNORE NULLS) OVER (PARTITION BY pool ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), bootstrap) END AS p FROM b),
f AS (SELECT pool, block, coalesce(tvl_ts, ts) AS ts, coalesce(price_open, p) AS price_open, coalesce(price_close, p) AS price_close, coalesce(price_high, p) AS price_high, coalesce(price_low, p) AS price_low,
coalesce(volume1, 0)::BIGINT AS volume1, coalesce(swap_count, 0)::BIGINT AS swap_count, tvl_usd FROM c WHERE swap OR p IS NOT NULL)"""


def _tvl(spark, sf) -> tuple[DataFrame, DataFrame]:
    t = fx.liquidity(spark, sf).filter("block % 3 = 0").groupBy("pool", "block").agg(F.sum(F.abs("liquidity_delta")).cast("double").alias("tvl_usd"))
    t = t.withColumns({"tvl_ts": F.col("block") * 1200 + 5, "bootstrap": F.when(F.col("pool") % 2 == 0, F.lit(7.0))})
    return _ohlc(spark, sf).filter("block % 2 = 0"), t


@query("k08_fill_snapshots", with_views(OHLC + TVL + FILL + " SELECT * FROM f", "v_swaps", "v_liq"))
def k08(spark, sf):
    return tvl.fill_snapshots(*_tvl(spark, sf))


@query("m05_tvl_history", with_views(OHLC + TVL + FILL + " SELECT pool, ts, tvl_usd FROM f WHERE pool = 2 AND ts > (SELECT max(ts) FROM f) - 2592000 AND tvl_usd IS NOT NULL", "v_swaps", "v_liq"))
def m05(spark, sf):
    """A pool's value locked over the last 30 days (M5)."""
    snaps = tvl.fill_snapshots(*_tvl(spark, sf))
    last = snaps.agg(F.max("ts").alias("last"))
    rows = snaps.filter("pool = 2 and tvl_usd is not null").join(F.broadcast(last)).filter("ts > last - 2592000")
    return rows.select("pool", "ts", "tvl_usd").orderBy("ts")


@query("m06_protocol_tvl", with_views(OHLC + TVL + FILL + """, l AS (SELECT pool, arg_max(tvl_usd, block) AS tvl_usd FROM f WHERE tvl_usd IS NOT NULL GROUP BY pool) SELECT sum(tvl_usd) AS tvl_usd, count(*) AS pools FROM l""", "v_swaps", "v_liq"))
def m06_tvl(spark, sf):
    """The value locked over all pools' latest states (M6)."""
    snaps = tvl.fill_snapshots(*_tvl(spark, sf)).filter("tvl_usd is not null")
    return ohlc.latest_state(snaps, ["pool"]).agg(F.sum("tvl_usd").alias("tvl_usd"), F.count(F.lit(1)).alias("pools"))


@query("k10_migrated_tvl", with_views(OHLC + TVL + """, g AS (SELECT DISTINCT l_partkey % 16 AS pool FROM lineitem WHERE l_partkey % 16 % 3 = 0), sn AS (SELECT * FROM o WHERE pool IN (SELECT pool FROM g)), tv AS (SELECT * FROM t WHERE pool IN (SELECT pool FROM g))
SELECT coalesce(sn.pool, tv.pool) AS pool, count(*) AS rows, count(tv.tvl_usd) AS filled, sum(coalesce(swap_count, 0))::BIGINT AS swaps FROM sn FULL JOIN tv ON sn.pool = tv.pool AND sn.block = tv.block
WHERE sn.pool IS NOT NULL OR tv.bootstrap IS NOT NULL OR EXISTS (SELECT 1 FROM sn x WHERE x.pool = tv.pool AND x.block < tv.block) GROUP BY 1""", "v_swaps", "v_liq"))
def k10(spark, sf):
    """Backfill over all history: snapshots from the swaps of migrated pools alone, filled with their value locked."""
    pools = fx.swaps(spark, sf).select(F.col("pool").alias("address")).distinct().withColumn("migrated_from", F.when(F.col("address") % 3 == 0, F.col("address")))
    snaps = ohlc.block_ohlc(entities.migrated_only(S.v2_swaps(fx.swaps(spark, sf)), pools))
    _, t = _tvl(spark, sf)
    out = tvl.fill_snapshots(snaps, t.join(pools.filter("migrated_from is not null").select(F.col("address").alias("pool")), "pool", "left_semi"))
    return out.groupBy("pool").agg(F.count(F.lit(1)).alias("rows"), F.count("tvl_usd").alias("filled"), F.sum("swap_count").alias("swaps"))


@query("k09_fill_state", with_views(OHLC + TVL + FILL + """, st AS (SELECT pool, block, price_close AS price, 0.5::DOUBLE AS tvl_usd, 1::BIGINT AS volume_24h, 1::BIGINT AS swaps_24h FROM h WHERE pool < 12 AND (block <= 1300 OR pool % 3 = 0) QUALIFY row_number() OVER (PARTITION BY pool ORDER BY block DESC) = 1),
nw AS (SELECT * FROM t WHERE block <= 1400 QUALIFY row_number() OVER (PARTITION BY pool ORDER BY block DESC) = 1),
w AS (SELECT pool, block, price_close, sum(volume1) OVER r AS v, sum(swap_count) OVER r AS k FROM f WINDOW r AS (PARTITION BY pool ORDER BY ts RANGE BETWEEN 86399 PRECEDING AND CURRENT ROW))
SELECT coalesce(s.pool, n.pool) AS pool, CASE WHEN take THEN n.block ELSE s.block END AS block, CASE WHEN take THEN coalesce(s.price, w.price_close, n.bootstrap) ELSE s.price END AS price, CASE WHEN take THEN n.tvl_usd ELSE s.tvl_usd END AS tvl_usd,
(CASE WHEN take THEN coalesce(v, 0) ELSE s.volume_24h END)::BIGINT AS volume_24h, (CASE WHEN take THEN coalesce(k, 0) ELSE s.swaps_24h END)::BIGINT AS swaps_24h
FROM (SELECT st AS s, nw AS n, nw.pool IS NOT NULL AND (st.pool IS NULL OR nw.block >= st.block) AS take FROM st FULL JOIN nw ON st.pool = nw.pool) x LEFT JOIN w ON w.pool = n.pool AND w.block = n.block
WHERE CASE WHEN take THEN coalesce(s.price, w.price_close, n.bootstrap) ELSE s.price END IS NOT NULL""", "v_swaps", "v_liq"))
def k09(spark, sf):
    snaps, t = _tvl(spark, sf)
    state = ohlc.latest_state(snaps.filter("pool < 12 and (block <= 1300 or pool % 3 = 0)"), ["pool"])
    state = state.selectExpr("pool", "block", "price_close as price", "0.5D as tvl_usd", "1L as volume_24h", "1L as swaps_24h")
    return tvl.fill_state(state, t.filter("block <= 1400"), tvl.fill_snapshots(snaps, t))
