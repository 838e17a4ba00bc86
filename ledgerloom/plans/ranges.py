"""Range files, call results and event normal forms over the projections."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import fixedpoint as fp, words
from ledgerloom.operators import decode, discover, ohlc, reorg, swaps as S
from ledgerloom.plans.base import query
from ledgerloom.sources import fixtures as fx, range_files, scan
from ledgerloom.sources.fixtures import with_views
from ledgerloom.sources.shared import cut, shared_dir
from ledgerloom.streaming import streams


def _raw_logs(spark, sf) -> DataFrame:
    return fx.logs(spark, sf).selectExpr("block_number", "block_timestamp", "cast(null as binary) as transaction_hash", "log_index", "address", "topics", "data")


@query("a02_scan_logs", with_views(" SELECT block_number, log_index, lower(lpad(to_hex(emitter), 40, '0')) AS address FROM v_logs WHERE block_number >= (SELECT max(event_id) FROM events) // 80 AND block_number < (SELECT max(event_id) FROM events) // 20", "v_logs"))
def a02_a10(spark, sf):
    """Logs written as range files and scanned back for a block range, pruned by partition."""
    path = f"{shared_dir(spark)}/ranges-{uuid.uuid4().hex}"
    top = spark.read.parquet(f"{sf}/events.parquet").agg(F.max("event_id")).first()[0]
    size = max(1, top // 640)
    scan.write_ranges(_raw_logs(spark, sf), path, size)
    rows = scan.scan(spark, path, "logs", blocks=(top // 80, top // 20), columns=["block_number", "log_index", "address"], range_size=size)
    return rows.select("block_number", "log_index", F.lower(F.hex("address")).alias("address"))


@query("a05_once_calls", "SELECT s_suppkey AS contract_address, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey END AS extra FROM supplier")
def a05(spark, sf):
    """Once-call files whose later ones have one more column (A5)."""
    path = f"{shared_dir(spark)}/once-{uuid.uuid4().hex}"
    s = spark.read.parquet(f"{sf}/supplier.parquet")
    s.filter("s_suppkey % 2 <> 0").selectExpr("s_suppkey as contract_address", "s_name as name").write.parquet(path)
    s.filter("s_suppkey % 2 = 0").selectExpr("s_suppkey as contract_address", "s_name as name", "s_nationkey as extra").write.mode("append").parquet(path)
    return scan.scan_once_calls(spark, path).select("contract_address", "name", "extra")


@query("a12_merge_sink", """SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def a12(spark, sf):
    """The latest event per user, kept by a foreachBatch merge over two batches."""
    path = f"{shared_dir(spark)}/state-{uuid.uuid4().hex}"
    sink = streams.merge_sink(path, ["user_id"], "event_id")
    e = spark.read.parquet(f"{sf}/events.parquet").select("user_id", "event_id", "event_type")
    sink(e.filter("event_id % 3 <> 0"), 0)
    sink(e.filter("event_id % 3 = 0"), 1)
    return streams.read_sink(spark, path).select("user_id", "event_id", "event_type")


@query("a14_compact", with_views(""", c AS (SELECT number // 49 AS range, count(DISTINCT number) AS n, min(number) AS a, max(number) AS b FROM v_blocks GROUP BY 1)
SELECT v.number, v.hash FROM v_blocks v JOIN c ON c.range = v.number // 49 WHERE n = 49 AND a = range * 49 AND b = range * 49 + 48 AND b < (SELECT max(number) FROM v_blocks) - 128""", "v_blocks"))
def a14_l07(spark, sf):
    """Blocks of settled, complete ranges, ready for range files."""
    b = fx.blocks(spark, sf)
    return scan.compact(b, reorg.settled_ranges(b, 49), 49).select("number", "hash")


def _word(value: Column | str, signed: bool = False) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    text = F.lpad(F.hex(value.cast("bigint")), 64, "0")
    return F.when(value < 0, F.concat(F.lit("F" * 48), F.lpad(F.hex(value.cast("bigint")), 16, "0"))).otherwise(text) if signed else text


V3_SWAP = decode.parse_event("Swap(address indexed sender, address indexed recipient, int64 amount0, int64 amount1, uint160 sqrt, uint64 liquidity, int24 tick)")


@query("g01_v3_swaps", """SELECT l_orderkey AS block_number, count(*) AS n, sum(l_quantity::BIGINT)::BIGINT AS amount0, sum(-round(l_extendedprice * 100)::BIGINT)::BIGINT AS amount1, sum((l_suppkey % 10 * 60 - 300)::BIGINT)::BIGINT AS ticks FROM lineitem GROUP BY 1""")
def g01(spark, sf):
    """V3-shaped swap logs, encoded from line items and decoded natively."""
    line = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("l_orderkey as block_number", "l_linenumber as log_index", "cast(l_quantity as bigint) as q", "-cast(round(l_extendedprice * 100) as bigint) as p", "l_suppkey % 10 * 60 - 300 as t")
    data = F.unhex(F.concat(_word("q"), _word("p", True), _word("q"), _word("q"), _word("t", True)))
    who = F.unhex(F.lit("00" * 32))
    logs = line.select("block_number", "log_index", F.unhex(F.lit("11" * 20)).alias("address"), F.array(F.unhex(F.lit(V3_SWAP["topic0"].hex())), who, who).alias("topics"), data.alias("data"))
    good, _ = decode.decode_static(logs, V3_SWAP)
    return good.groupBy("block_number").agg(F.count(F.lit(1)).alias("n"), F.sum("amount0").alias("amount0"), F.sum("amount1").alias("amount1"), F.sum("tick").alias("ticks"))


V3_WIDE = decode.parse_event("Swap(address indexed sender, address indexed recipient, int256 amount0, int256 amount1, uint160 sqrtPriceX96, uint128 liquidity, int24 tick)")


def _shifted(value: str) -> Column:
    """A word that holds value * 2^80, in two's complement."""
    v = F.col(value)
    return F.concat(F.when(v < 0, "F" * 28).otherwise("0" * 28), F.lpad(F.hex(v.cast("bigint")), 16, "0"), F.lit("0" * 20))


def _wide_swaps(spark, sf) -> DataFrame:
    """V3 swaps with amounts far beyond 64 bits, encoded from the projected swaps and decoded again, in the normal form."""
    net = S.net_amounts(fx.swaps(spark, sf)).withColumns({"t": F.col("amount0") % 700, "one": F.lit(1)})
    data = F.unhex(F.concat(_shifted("amount0"), _shifted("amount1"), _shifted("one"), _word(F.abs("amount0")), _word("t", True)))
    emitter, who = F.expr("unhex(lpad(hex(pool), 40, '0'))"), F.unhex(F.lit("00" * 32))
    logs = net.select(F.col("block").alias("block_number"), "log_index", emitter.alias("address"), F.array(F.unhex(F.lit(V3_WIDE["topic0"].hex())), who, who).alias("topics"), data.alias("data"), "ts")
    good, _ = decode.decode_static(logs, V3_WIDE, keep=("ts",))
    out = S.v3_swaps(good)
    return out.withColumn("pool", F.conv(F.hex("pool"), 16, 10).cast("bigint"))


WIDE = """, n AS (SELECT pool, block, ts, log_index, (amount0_in - amount0_out)::HUGEINT * 1208925819614629174706176 AS amount0, (amount1_in - amount1_out)::HUGEINT * 1208925819614629174706176 AS amount1, amount0_in - amount0_out AS a FROM v_swaps)"""


@query("g01_wide_swaps", with_views(WIDE + " SELECT pool, block, log_index, amount0::VARCHAR AS amount0, amount1::VARCHAR AS amount1, '1208925819614629174706176' AS sqrt_price, (a % 700)::INTEGER AS tick, abs(a)::VARCHAR AS liquidity FROM n", "v_swaps"))
def g01_wide(spark, sf):
    """V3 swaps of 256 bits to the normal form, without Python (G1)."""
    return _wide_swaps(spark, sf).select("pool", "block", "log_index", "amount0", "amount1", "sqrt_price", "tick", "liquidity")


@query("h01_wide_ohlc", with_views(WIDE + """ SELECT pool, block, sum(abs(amount0))::VARCHAR AS volume0, sum(abs(amount1))::VARCHAR AS volume1, count(*) AS swap_count, arg_max((a % 700)::INTEGER, log_index) AS last_tick,
'1208925819614629174706176' AS last_sqrt_price, arg_max(abs(a)::VARCHAR, log_index) AS last_liquidity FROM n GROUP BY pool, block""", "v_swaps"))
def h01_wide(spark, sf):
    """Snapshots of 256-bit swaps with their last tick, price and liquidity (H1)."""
    return ohlc.block_ohlc(_wide_swaps(spark, sf)).select("pool", "block", "volume0", "volume1", "swap_count", "last_tick", "last_sqrt_price", "last_liquidity")


@query("h06_wide_rolling", with_views(WIDE + """, o AS (SELECT pool, block, max(ts) AS ts, sum(abs(amount1)) AS volume1 FROM n GROUP BY pool, block)
SELECT pool, block, (sum(volume1) OVER (PARTITION BY pool ORDER BY ts RANGE BETWEEN 86399 PRECEDING AND CURRENT ROW))::VARCHAR AS volume_24h FROM o""", "v_swaps"))
def h06_wide(spark, sf):
    return ohlc.rolling(ohlc.block_ohlc(_wide_swaps(spark, sf))).select("pool", "block", "volume_24h")


@query("g08_wide_net_swaps", with_views(""" SELECT pool, block, log_index, ((amount0_in - amount0_out)::HUGEINT * 10000000000000000000000)::VARCHAR AS amount0, ((amount1_in - amount1_out)::HUGEINT * 10000000000000000000000)::VARCHAR AS amount1 FROM v_swaps""", "v_swaps"))
def g08_wide(spark, sf):
    """Net amounts of 256-bit decimal text."""
    big = {c: F.when(F.col(c) == 0, "0").otherwise(F.concat(F.col(c).cast("string"), F.lit("0" * 22))) for c in ("amount0_in", "amount1_in", "amount0_out", "amount1_out")}
    return S.net_amounts(fx.swaps(spark, sf).withColumns(big)).select("pool", "block", "log_index", "amount0", "amount1")


@query("g05_auction_swaps", """WITH e AS (SELECT user_id AS hook, event_id // 10 AS block, event_id % 10 AS log_index, round(value * 100)::BIGINT AS total, event_id % 13 = 0 AS invalid FROM events WHERE user_id % 3 <> 2),
d AS (SELECT *, coalesce(lag(total) OVER (PARTITION BY hook ORDER BY block, log_index), 0) AS was FROM e), f AS (SELECT *, (CASE WHEN total >= was THEN total - was ELSE total END)::HUGEINT * 10000000000000000000000 AS delta FROM d)
SELECT hook + 1000 AS pool, block, log_index, (CASE WHEN hook % 2 = 0 THEN -delta ELSE delta END)::VARCHAR AS amount0, (CASE WHEN hook % 2 = 0 THEN delta ELSE -delta END)::VARCHAR AS amount1, (total % 500)::INTEGER AS tick FROM f WHERE NOT invalid""")
def g05_auction(spark, sf):
    """Cumulative auction totals of 256 bits to signed swaps; rows of invalid ticks go but move the totals on."""
    e = spark.read.parquet(f"{sf}/events.parquet").selectExpr("user_id as hook", "event_id div 10 as block", "event_id % 10 as log_index", "unix_timestamp(ts) as ts", "cast(round(value * 100) as bigint) as total", "event_id")
    total = F.when(F.col("total") == 0, "0").otherwise(F.concat(F.col("total").cast("string"), F.lit("0" * 22)))
    e = e.withColumns({"total_proceeds": total, "total_sold": total, "tick": F.when(F.col("event_id") % 13 == 0, 900_000).otherwise(F.col("total") % 500).cast("int")})
    hooks = e.filter("hook % 3 <> 2").select("hook").distinct().withColumns({"pool": F.col("hook") + 1000, "is_token_0": F.col("hook") % 2 == 0})
    return S.auction_swaps(e, hooks).select("pool", "block", "log_index", "amount0", "amount1", "tick")


MODIFY = decode.parse_event("ModifyLiquidity((uint24 fee, int24 spacing) key, (int24 lower, int24 upper, int64 delta) params)")


@query("g04_modify_liquidity", with_views(" SELECT pool, tick_lower, tick_upper, sum(liquidity_delta)::BIGINT AS delta, count(*) AS n FROM v_liq GROUP BY ALL", "v_liq"))
def g04_c08(spark, sf):
    """Liquidity events with static tuples, flattened to dotted columns and decoded natively."""
    liq = fx.liquidity(spark, sf)
    data = F.unhex(F.concat(_word("pool"), _word(F.lit(60)), _word("tick_lower"), _word("tick_upper"), _word("liquidity_delta", True)))
    logs = liq.select(F.col("block").alias("block_number"), F.lit(0).alias("log_index"), F.unhex(F.lit("11" * 20)).alias("address"), F.array(F.unhex(F.lit(MODIFY["topic0"].hex()))).alias("topics"), data.alias("data"))
    good, _ = decode.decode_static(logs, MODIFY)
    pool = F.col("`key.fee`").cast("bigint")
    return good.groupBy(pool.alias("pool"), F.col("`params.lower`").cast("int").alias("tick_lower"), F.col("`params.upper`").cast("int").alias("tick_upper")).agg(F.sum("`params.delta`").alias("delta"), F.count(F.lit(1)).alias("n"))


MODIFY_KEY = decode.parse_event("ModifyLiquidity((address currency0, address currency1, uint24 fee, int24 tickSpacing, address hooks) key, (int24 tickLower, int24 tickUpper, int256 liquidityDelta) params)")


@query("g04_tuple_liquidity", with_views(" SELECT block, tick_lower, tick_upper, (sum(liquidity_delta)::HUGEINT * 1208925819614629174706176)::VARCHAR AS delta, count(DISTINCT pool) AS pools, count(*) AS n FROM v_liq GROUP BY block, tick_lower, tick_upper", "v_liq"))
def g04_tuple(spark, sf):
    """Liquidity events in tuple form: the pool id from the key, 256-bit deltas."""
    liq = fx.liquidity(spark, sf)
    data = F.unhex(F.concat(_word("pool"), _word(F.col("pool") + 1), _word(F.lit(3000)), _word(F.lit(60)), _word(F.lit(9)), _word("tick_lower"), _word("tick_upper"), _shifted("liquidity_delta")))
    logs = liq.select(F.col("block").alias("block_number"), F.lit(0).alias("log_index"), F.unhex(F.lit("11" * 20)).alias("address"), F.array(F.unhex(F.lit(MODIFY_KEY["topic0"].hex()))).alias("topics"), data.alias("data"))
    moves = S.modify_liquidity(decode.decode_static(logs, MODIFY_KEY)[0])
    plus, minus = words.sum_signed(F.col("liquidity_delta"))
    sums = moves.groupBy("block", "tick_lower", "tick_upper").agg(plus.alias("plus"), minus.alias("minus"), F.countDistinct("pool").alias("pools"), F.count(F.lit(1)).alias("n"))
    sums = words.with_differences(sums, {"delta": (F.col("plus"), F.col("minus"))})
    return sums.select("block", "tick_lower", "tick_upper", "delta", "pools", "n")


@query("g06_coin_swap_ticks", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_partkey % 500 - 250)::INTEGER AS tick FROM lineitem WHERE l_partkey % 11 <> 0")
def g06(spark, sf):
    """Ticks from square-root prices, those out of range dropped."""
    line = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    prices = cut(line.select((F.col("l_partkey") % 500 - 250).cast("int").alias("t")).distinct().withColumn("sqrt_price", fp.sqrt_price_udf("t")))
    rows = line.withColumn("t", (F.col("l_partkey") % 500 - 250).cast("int")).join(prices, "t").withColumn("sqrt_price", F.when(F.col("l_partkey") % 11 == 0, "1").otherwise(F.col("sqrt_price")))
    return S.coin_swaps(rows).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "tick")


@query("c11_position_arrays", """SELECT l_orderkey AS block_number, (l_suppkey % 10 * 60)::INTEGER AS lower, l_quantity::BIGINT AS liquidity, count(*) AS n FROM lineitem WHERE l_quantity % 2 = 0 GROUP BY 1, 2, 3""")
def c09_c11(spark, sf):
    """Call results holding arrays of positions, encoded per order and decoded in Arrow batches; zero liquidity goes."""
    line = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.col("l_orderkey").alias("block_number"), F.concat(_word(F.col("l_suppkey") % 10 * 60), _word(F.when(F.col("l_quantity") % 2 == 0, F.col("l_quantity")).otherwise(0))).alias("w"))
    both = line.groupBy("block_number").agg(F.collect_list("w").alias("w"))
    lows, liqs = F.transform("w", lambda x: F.substring(x, 1, 64)), F.transform("w", lambda x: F.substring(x, 65, 64))
    n = _word(F.size("w"))
    data = F.unhex(F.concat(F.lit("40".rjust(64, "0")), _word(F.size("w") * 32 + 96), n, F.array_join(lows, ""), n, F.array_join(liqs, "")))
    rows = both.select("block_number", F.lit(0).alias("log_index"), F.lit(0).alias("address"), data.alias("data"))
    got = decode.decode_dynamic(rows, decode.parse_event("getPositions(int32[] lower, uint32[] liquidity)")["params"])
    calls = got.select("block_number", F.arrays_zip("lower", "liquidity").alias("positions"))
    return S.live_positions(calls).groupBy("block_number", F.col("lower").cast("int").alias("lower"), "liquidity").agg(F.count(F.lit(1)).alias("n"))


@query("d02_two_events_one_collection", "SELECT DISTINCT 'coins' AS collection, user_id AS address FROM events WHERE event_type IN ('click', 'view')")
def d02(spark, sf):
    """Two creation events that feed one collection."""
    e = spark.read.parquet(f"{sf}/events.parquet").selectExpr("'coins' as collection", "user_id as address", "event_id as block_number", "event_type")
    both = discover.union_all(e.filter("event_type = 'click'"), e.filter("event_type = 'view'"))
    return discover.as_of(both, 1 << 40).select("collection", "address")


RECHAINED = """s AS (SELECT * FROM v_swaps WHERE block % 53 <> 0 UNION ALL SELECT pool, block, ts, log_index, amount0_in * 2, amount1_in * 2, amount0_out * 2, amount1_out * 2 FROM v_swaps WHERE block % 53 = 0 AND block % 2 = 0)"""


@query("l06_recomputed_ranges", with_views(f""", {RECHAINED} SELECT pool, block, count(*) AS swaps, sum(amount0_in)::BIGINT AS amount0_in, sum(amount1_out)::BIGINT AS amount1_out FROM s GROUP BY 1, 2""", "v_swaps"))
def l06_recomputed(spark, sf):
    """A derived table by block ranges after a reorganisation: blocks are orphaned, some of them come again with other swaps, and only
    their ranges are rewritten; the result is that of a full rebuild (L6)."""
    old, path = fx.swaps(spark, sf), f"{shared_dir(spark)}/derived-{uuid.uuid4().hex}"
    derive = lambda rows: rows.groupBy("pool", "block").agg(F.count(F.lit(1)).alias("swaps"), F.sum("amount0_in").alias("amount0_in"), F.sum("amount1_out").alias("amount1_out")).withColumn("block_number", F.col("block"))
    scan.write_ranges(derive(old), path, 8, "overwrite")
    orphaned = old.filter("block % 53 = 0").select(F.col("block").alias("number")).distinct()
    again = old.filter("block % 53 = 0 and block % 2 = 0").select("pool", "block", "ts", "log_index", *[(F.col(c) * 2).alias(c) for c in ("amount0_in", "amount1_in", "amount0_out", "amount1_out")])
    now = reorg.retract(old, orphaned).unionByName(again).withColumn("block_number", F.col("block"))
    reorg.recompute(spark, path, now, orphaned, derive, size=8)
    return spark.read.parquet(path).select("pool", "block", "swaps", "amount0_in", "amount1_out")


@query("a06_range_files", """SELECT event_id, event_type AS event_name FROM events WHERE user_id % 3 = 1 AND event_type IN ('click', 'view') AND event_id // 10 >= (SELECT max(event_id) FROM events) // 10 // 4 AND event_id // 10 < (SELECT max(event_id) FROM events) // 10 // 2""")
def a06_files(spark, sf):
    """Events in range files by source and name, read for a half-open range: only overlapping files of those names are opened."""
    e = spark.read.parquet(f"{sf}/events.parquet")
    top = e.agg(F.max("event_id")).first()[0] // 10
    path = f"{shared_dir(spark)}/events-{uuid.uuid4().hex}"
    range_files.write_range_files(e.selectExpr("event_id div 10 as block_number", "event_id", "concat('src', user_id % 3) as source_name", "event_type as event_name"), path, max(1, top // 16))
    range_files.register(spark)
    rows = spark.read.format("block_ranges").load(path)
    return rows.filter((F.col("source_name") == "src1") & F.col("event_name").isin("click", "view") & (F.col("block_number") >= top // 4) & (F.col("block_number") < top // 2)).select("event_id", "event_name")
