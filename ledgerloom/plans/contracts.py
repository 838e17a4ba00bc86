"""Call planning and auditing, and entity builders, over the projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.operators import calls as C, entities as E, swaps as S
from ledgerloom.plans.base import query
from ledgerloom.sources import fixtures as fx
from ledgerloom.sources.fixtures import with_views


@query("e01_parameter_grid", """SELECT s_suppkey, [a, b] AS args FROM supplier, (VALUES ('1'), ('2'), ('3')) x(a), (VALUES ('p'), ('q')) y(b)""")
def e01(spark, sf):
    s = spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey", F.expr("array(array('1', '2', '3'), array('p', 'q'))").alias("params"))
    return C.parameter_grid(s)


@query("e02_every_n_blocks", with_views(" SELECT number FROM v_blocks WHERE number % 25 = 0", "v_blocks"))
def e02(spark, sf):
    return C.every_n(fx.blocks(spark, sf), 25).select("number")


@query("e03_throttle", """WITH RECURSIVE e AS (SELECT user_id AS key, event_id AS number, floor(epoch(ts))::BIGINT AS ts FROM events),
r AS (SELECT key, min_by(number, (ts, number)) AS number, min(ts) AS ts FROM e WHERE ts >= 86400 GROUP BY key
UNION ALL SELECT r.key, n.number, n.ts FROM r, LATERAL (SELECT number, ts FROM e WHERE e.key = r.key AND e.ts >= r.ts + 86400 ORDER BY ts, number LIMIT 1) n) SELECT key, number, ts FROM r""")
def e03(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").selectExpr("user_id as key", "event_id as number", "unix_timestamp(ts) as ts")
    return C.throttle(e, 86_400)


@query("e04_once_per_address", "SELECT user_id AS address, min(event_id // 10) AS block_number FROM events WHERE user_id % 5 <> 0 GROUP BY 1")
def e04(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").selectExpr("user_id as address", "event_id div 10 as block_number")
    return C.once_per_address(e, e.filter("address % 5 = 0").select("address").distinct())


@query("e05_event_plan", """SELECT event_id // 10 AS block_number, event_id % 10 AS log_index, 'f' AS function, 99 AS call_target FROM events WHERE event_type = 'click' AND event_id // 10 >= 20
UNION ALL SELECT event_id // 10, event_id % 10, 'g', user_id FROM events WHERE event_type = 'view' AND user_id % 2 = 0""")
def e05(spark, sf):
    t = spark.read.parquet(f"{sf}/events.parquet").selectExpr("event_id div 10 as block_number", "event_id % 10 as log_index", "user_id as address", "'s' as source", "event_type as topic0")
    config = spark.createDataFrame([("s", "click", "f", 20, 99), ("s", "view", "g", 0, None)], "source string, topic0 string, function string, start_block long, target long")
    return C.event_plan(t, config, t.filter("address % 2 = 0")).select("block_number", "log_index", "function", "call_target")


@query("e06_event_parameters", with_views(" SELECT event_id, lower(lpad(to_hex(emitter), 64, '0')) AS param FROM v_logs WHERE has_topics UNION ALL SELECT event_id, lower(lpad(to_hex(event_id), 64, '0')) FROM v_logs", "v_logs"))
def e06(spark, sf):
    logs = fx.logs(spark, sf)
    both = C.event_parameters(logs, "topic", 1).unionByName(C.event_parameters(logs, "data", 1)).unionByName(C.event_parameters(logs, "data", 2))
    return both.select("event_id", F.lower(F.hex("param")).alias("param"))


KEY = """p AS (SELECT p_partkey, lower(lpad(to_hex(p_size), 64, '0') || lpad(to_hex(p_size + 1), 64, '0') || lpad(to_hex(p_size * 100), 64, '0') ||
CASE WHEN p_size < 25 THEN repeat('f', 58) || right(to_hex((p_size - 25)::BIGINT), 6) ELSE lpad(to_hex(p_size - 25), 64, '0') END || lpad('7', 64, '0')) AS param FROM part)"""


def _keyed(spark, sf) -> DataFrame:
    """Events whose data hold a word of noise and then a pool key."""
    n = lambda c: F.lpad(F.hex(F.expr(c).cast("bigint")), 64, "0")
    spacing = F.when(F.col("p_size") < 25, F.concat(F.lit("F" * 48), F.lpad(F.hex((F.col("p_size") - 25).cast("bigint")), 16, "0"))).otherwise(n("p_size - 25"))
    data = F.unhex(F.concat(n("p_partkey"), n("p_size"), n("p_size + 1"), n("p_size * 100"), spacing, n("7")))
    return spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", data.alias("data"))


@query("e06_pool_key_parameters", f"WITH {KEY} SELECT * FROM p")
def e06_key(spark, sf):
    """The key tuple from the second word on."""
    return C.event_parameters(_keyed(spark, sf), "pool_key", 1).select("p_partkey", F.lower(F.hex("param")).alias("param"))


@query("e06_pool_id_parameters")
def e06_id(spark, sf):
    """The pool id of the first five words (no hash of this kind in SQL; test_operators holds it against pool_ids)."""
    rows = _keyed(spark, sf).withColumn("data", F.expr("substring(data, 33)"))
    return C.event_parameters(rows, "pool_id").select("p_partkey", F.lower(F.hex("param")).alias("param"))


@query("e07_audit", """WITH x AS (SELECT user_id AS k, count(*) AS expected FROM events WHERE event_id % 3 <> 1 GROUP BY 1), s AS (SELECT user_id AS k, count(*) AS stored FROM events WHERE event_id % 3 <> 2 AND user_id % 7 <> 0 GROUP BY 1)
SELECT coalesce(x.k, s.k) AS k, coalesce(expected, 0) AS expected, coalesce(stored, 0) AS stored, CASE WHEN coalesce(expected, 0) = coalesce(stored, 0) THEN 'none'
WHEN coalesce(expected, 0) < coalesce(stored, 0) AND coalesce(expected, 0) > 0 THEN 'index' ELSE 'recollect' END AS action FROM x FULL JOIN s ON x.k = s.k""")
def e07(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").selectExpr("user_id as k", "event_id")
    return C.audit(e.filter("event_id % 3 <> 1"), e.filter("event_id % 3 <> 2 and k % 7 <> 0"), ["k"])


def _wide(spark, sf) -> tuple[DataFrame, DataFrame]:
    s = spark.read.parquet(f"{sf}/supplier.parquet")
    old = s.selectExpr("s_suppkey as contract_address", "if(s_suppkey % 2 = 0, s_name, null) as name", "s_nationkey as nation")
    return old, s.filter("s_suppkey % 3 <> 0").selectExpr("s_suppkey as contract_address", "concat('new ', s_name) as name", "s_suppkey * 2 as extra")


@query("e08_merge_once_columns", """SELECT s_suppkey AS contract_address, CASE WHEN s_suppkey % 2 = 0 THEN s_name WHEN s_suppkey % 3 <> 0 THEN 'new ' || s_name END AS name, s_nationkey AS nation,
CASE WHEN s_suppkey % 3 <> 0 THEN s_suppkey * 2 END AS extra FROM supplier""")
def e08(spark, sf):
    return C.merge_once(*_wide(spark, sf))


@query("e09_null_cells", "SELECT s_suppkey AS contract_address, 'name' AS function FROM supplier WHERE s_suppkey % 2 <> 0")
def e09(spark, sf):
    return C.null_cells(_wide(spark, sf)[0])


@query("e09_fillable", "SELECT 'name' AS function, count(*) AS cells FROM supplier WHERE s_suppkey % 2 <> 0 AND s_suppkey % 3 <> 0 HAVING count(*) > 0")
def e09b(spark, sf):
    return C.fillable(*_wide(spark, sf))


@query("e10_reverted_calls", with_views(" SELECT block_number, log_index, target, function_name FROM v_calls WHERE is_reverted", "v_calls"))
def e10(spark, sf):
    return C.reverted(fx.calls(spark, sf)).select("block_number", "log_index", "target", "function_name")


# -- entities: parts are creation events, suppliers the token metadata, orders the receipts -----------------------------

CREATES = """WITH c AS (SELECT p_partkey AS pool, p_partkey % 150 AS asset, p_size % 10 AS numeraire, p_partkey AS transaction_hash, p_partkey % 500 AS block_number FROM part),
m AS (SELECT s_suppkey AS address, s_name AS name, 'S' || s_nationkey AS symbol, s_nationkey AS decimals FROM supplier),
w AS (SELECT c.*, a.name AS asset_name, CASE WHEN numeraire = 0 THEN 'ETH' ELSE q.symbol END AS quote_symbol, CASE WHEN numeraire = 0 THEN 18 ELSE q.decimals END AS quote_decimals
FROM c LEFT JOIN m a ON a.address = asset LEFT JOIN m q ON q.address = numeraire)"""


def _creates(spark, sf) -> DataFrame:
    c = spark.read.parquet(f"{sf}/part.parquet").selectExpr(
        "p_partkey as pool", "p_partkey % 150 as asset", "p_size % 10 as numeraire", "p_partkey as transaction_hash", "p_partkey % 500 as block_number", "p_size % 3 as kind")
    m = spark.read.parquet(f"{sf}/supplier.parquet").selectExpr("s_suppkey as address", "s_name as name", "concat('S', s_nationkey) as symbol", "s_nationkey as decimals")
    return E.with_metadata(c, m, 0)


@query("f01_token_metadata", CREATES + " SELECT pool, asset_name, quote_symbol, quote_decimals FROM w")
def f01(spark, sf):
    return _creates(spark, sf).select("pool", "asset_name", "quote_symbol", "quote_decimals")


@query("f02_missing_metadata", CREATES + """ SELECT pool, CASE WHEN asset_name IS NOT NULL AND quote_symbol IS NOT NULL THEN 'ready' WHEN asset % 4 = 0 THEN 'skipped' ELSE 'blocked' END AS route FROM w""")
def f02(spark, sf):
    skipped = spark.range(0, 150, 4).select(F.col("id").alias("address"), F.lit("no code").alias("reason"))
    ready, blocked, listed = E.route_missing(_creates(spark, sf), skipped)
    return ready.select("pool", F.lit("ready").alias("route")).unionByName(blocked.select("pool", F.lit("blocked").alias("route"))).unionByName(listed.select("pool", F.lit("skipped").alias("route")))


@query("f03_latest_call", with_views(""" SELECT target, function_name, value FROM v_calls WHERE block_number < (SELECT max(event_id) FROM events) // 12 QUALIFY row_number() OVER (PARTITION BY target, function_name ORDER BY block_number DESC, log_index DESC) = 1""", "v_calls"))
def f03(spark, sf):
    top = spark.read.parquet(f"{sf}/events.parquet").agg(F.max("event_id")).first()[0]
    return E.latest_call(fx.calls(spark, sf), ["target", "function_name"], before=top // 12).select("target", "function_name", "value")


@query("f04_pool_create", CREATES + """ SELECT pool AS address, asset AS base_token, numeraire AS quote_token, asset < numeraire AS is_token_0, 'v3' AS type, 3000 AS fee, block_number AS created_block, o_custkey AS creator
FROM w LEFT JOIN orders ON o_orderkey = transaction_hash WHERE asset_name IS NOT NULL AND quote_symbol IS NOT NULL""")
def f04(spark, sf):
    """Pool rows of creation events."""
    ready, _, _ = E.route_missing(_creates(spark, sf), spark.createDataFrame([], "address long, reason string"))
    receipts = spark.read.parquet(f"{sf}/orders.parquet").selectExpr("o_orderkey as transaction_hash", "o_custkey as from_address")
    return E.pools_from(E.with_sender(ready, receipts), "v3", F.lit(3000))


def _auctions(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Creation events from parts, and the once calls of their hooks from suppliers, with the key of a pool each."""
    ready, _, _ = E.route_missing(_creates(spark, sf), spark.createDataFrame([], "address long, reason string"))
    creates = ready.withColumns({"hook": F.col("pool") % 120, "integrator": F.col("pool") % 7, "creator": F.col("pool") % 11})
    a = lambda n: F.expr(f"unhex(lpad(hex({n}), 40, '0'))")
    calls = spark.read.parquet(f"{sf}/supplier.parquet").select(
        F.col("s_suppkey").alias("hook"), a("s_suppkey").alias("currency0"), a("s_suppkey + 1").alias("currency1"), F.lit(3000).alias("fee"), F.lit(60).alias("tick_spacing"), a("s_suppkey").alias("hooks"),
        *[(F.col("s_suppkey") * (i + 2)).alias(c) for i, c in enumerate(E.AUCTION) if c != "is_token_0"], (F.col("s_suppkey") % 2 == 0).alias("is_token_0"))
    return creates, calls


@query("f05_v4_create", CREATES + """ SELECT asset AS base_token, numeraire AS quote_token, s_suppkey % 2 = 0 AS is_token_0, 'v4' AS type, 3000 AS fee, s_suppkey * 3 AS min_threshold, s_suppkey * 4 AS max_threshold,
s_suppkey * 5 AS starting_time, s_suppkey * 6 AS ending_time, block_number AS created_block, pool % 11 AS creator, pool % 7 AS integrator FROM w JOIN supplier ON s_suppkey = pool % 120
WHERE asset_name IS NOT NULL AND quote_symbol IS NOT NULL""")
def f05(spark, sf):
    """V4 auctions' pools; test_operators holds their ids against pool_ids."""
    return E.v4_creates(*_auctions(spark, sf))[0].drop("address")


@query("f05_v4_configs", CREATES + """ SELECT s_suppkey AS hook_address, s_suppkey * 2 AS num_tokens_to_sell, s_suppkey * 7 AS starting_tick, s_suppkey * 10 AS gamma, s_suppkey % 2 = 0 AS is_token_0, s_suppkey * 12 AS num_pd_slugs, count(*) AS n
FROM w JOIN supplier ON s_suppkey = pool % 120 WHERE asset_name IS NOT NULL AND quote_symbol IS NOT NULL GROUP BY ALL""")
def f05_configs(spark, sf):
    columns = ["hook_address", "num_tokens_to_sell", "starting_tick", "gamma", "is_token_0", "num_pd_slugs"]
    return E.v4_creates(*_auctions(spark, sf))[1].groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


@query("f05_missing_hooks", CREATES + " SELECT pool FROM w WHERE asset_name IS NOT NULL AND quote_symbol IS NOT NULL AND pool % 120 NOT IN (SELECT s_suppkey FROM supplier)")
def f05_missing(spark, sf):
    return E.v4_creates(*_auctions(spark, sf))[2].select("pool")


@query("f08_hook_configs", """SELECT o_custkey AS asset, o_orderkey % 5 AS status, (o_orderkey % 7 * 60)::INTEGER AS far_tick, o_custkey < o_orderkey % 90 AS is_token_0, CASE WHEN o_orderkey % 3 = 0 THEN 'rehype' ELSE 'dhook' END AS type, count(*) AS n
FROM orders GROUP BY ALL""")
def f08(spark, sf):
    """Hook pools with their configuration rows (F8)."""
    o = spark.read.parquet(f"{sf}/orders.parquet")
    a = lambda n: F.expr(f"unhex(lpad(hex({n}), 40, '0'))")
    creates = o.selectExpr("o_orderkey as block_number", "0 as log_index", "o_custkey as asset", "o_orderkey % 90 as numeraire", "o_custkey as creator")
    state = o.select(
        F.col("o_orderkey").alias("block_number"), F.lit(0).alias("log_index"), a("o_orderkey").alias("currency0"), a("o_orderkey + 1").alias("currency1"), F.lit(3000).alias("fee"), F.lit(60).alias("tick_spacing"), a("7L").alias("hooks"),
        F.lit(10).alias("total_tokens_on_bonding_curve"), F.lit(1).alias("hook_contract"), (F.col("o_orderkey") % 5).alias("status"), (F.col("o_orderkey") % 7 * 60).cast("int").alias("far_tick"), (F.col("o_orderkey") % 3 == 0).alias("rehype"))
    pools, configs = E.hook_creates(creates, state)
    both = pools.select(F.col("address").alias("pool_id"), F.col("base_token").alias("asset"), "type").join(configs, "pool_id")
    return both.groupBy("asset", "status", "far_tick", "is_token_0", "type").agg(F.count(F.lit(1)).alias("n"))


@query("f06_hook_create", """WITH p AS (SELECT l_orderkey AS o, min(l_suppkey % 10 * 60)::INTEGER AS lower, max(l_suppkey % 10 * 60 + 600)::INTEGER AS upper FROM lineitem GROUP BY 1)
SELECT o_orderkey AS pool, o_custkey AS status, lower, upper, CASE WHEN o_custkey % 50 < 25 THEN upper ELSE lower END AS start_tick, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey * 3 END AS starting_time
FROM orders JOIN p ON o = o_orderkey""")
def f06(spark, sf):
    """State, positions and beneficiaries of the creation's (block, log): tick bounds and start tick."""
    o = spark.read.parquet(f"{sf}/orders.parquet")
    key = ["o_orderkey as block_number", "0 as log_index"]
    line = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("l_orderkey as block_number", "0 as log_index", "named_struct('tick_lower', cast(l_suppkey % 10 * 60 as int), 'tick_upper', cast(l_suppkey % 10 * 60 + 600 as int)) as p")
    positions = line.groupBy("block_number", "log_index").agg(F.collect_list("p").alias("positions"))
    creates = o.selectExpr(*key, "o_orderkey as pool", "o_custkey % 50 as asset", "25 as numeraire")
    out = E.hook_state(creates, o.selectExpr(*key, "o_custkey as status"), positions, o.filter("o_orderkey % 2 = 0").selectExpr(*key, "o_custkey * 3 as beneficiaries"))
    return out.select("pool", "status", "lower", "upper", "start_tick", F.col("beneficiaries").alias("starting_time"))


@query("f07_scheduled_create", """WITH p AS (SELECT l_orderkey AS o, min(l_suppkey % 10 * 60)::INTEGER AS lower, max(l_suppkey % 10 * 60 + 600)::INTEGER AS upper FROM lineitem GROUP BY 1)
SELECT o_orderkey AS pool, o_custkey AS status, CASE WHEN o_custkey % 50 < 25 THEN upper ELSE lower END AS start_tick, o_custkey * 3 AS beneficiaries, o_custkey * 5 AS starting_time FROM orders JOIN p ON o = o_orderkey WHERE o_orderkey % 4 <> 0""")
def f07(spark, sf):
    """As F6, with the starting time of a call of its own; creations without one wait."""
    o = spark.read.parquet(f"{sf}/orders.parquet")
    key = ["o_orderkey as block_number", "0 as log_index"]
    line = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("l_orderkey as block_number", "0 as log_index", "named_struct('tick_lower', cast(l_suppkey % 10 * 60 as int), 'tick_upper', cast(l_suppkey % 10 * 60 + 600 as int)) as p")
    positions = line.groupBy("block_number", "log_index").agg(F.collect_list("p").alias("positions"))
    creates = o.selectExpr(*key, "o_orderkey as pool", "o_custkey % 50 as asset", "25 as numeraire")
    starting = o.filter("o_orderkey % 4 <> 0").selectExpr(*key, "o_custkey * 5 as starting_time")
    out = E.hook_state(creates, o.selectExpr(*key, "o_custkey as status"), positions, o.selectExpr(*key, "o_custkey * 3 as beneficiaries"), starting)
    return out.select("pool", "status", "start_tick", "beneficiaries", "starting_time")


@query("f09_coin_create", """SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN 'creator' ELSE 'content' END AS kind, coalesce(CASE WHEN p_partkey % 3 = 0 THEN p_partkey * 10 END, p_partkey * 7) AS pool, s_name AS quote
FROM part JOIN supplier ON s_suppkey = p_size""")
def f09(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet").selectExpr("p_partkey as id", "p_size", "p_size as numeraire", "if(p_partkey % 3 = 0, p_partkey * 10, null) as event_pool", "p_partkey * 7 as computed_pool")
    quotes = spark.read.parquet(f"{sf}/supplier.parquet").selectExpr("cast(s_suppkey as int) as numeraire", "s_name as quote")
    return E.coin_creates(p.filter("p_size % 2 = 0"), p.filter("p_size % 2 <> 0"), quotes).select("id", "kind", "pool", "quote")


POOLS = """WITH pools AS (SELECT p_partkey AS address, p_size % 7 AS base_token, p_size % 5 AS quote_token, p_size AS fee, p_partkey % 2 AS source, 1 AS source_version,
CASE WHEN p_partkey % 2 = 0 THEN p_partkey + 100000 END AS migration_pool, CASE WHEN p_partkey % 4 = 0 THEN 'v2' WHEN p_partkey % 4 = 2 THEN 'dhook' END AS migration_type,
CASE WHEN p_partkey % 9 = 0 THEN p_partkey - 1 END AS migrated_from, p_partkey % 500 AS created_block FROM part)"""


def _pools(spark, sf) -> DataFrame:
    return spark.read.parquet(f"{sf}/part.parquet").selectExpr(
        "p_partkey as address", "p_size % 7 as base_token", "p_size % 5 as quote_token", "p_size as fee", "p_size % 7 < p_size % 5 as is_token_0", "p_partkey % 2 as source", "1 as source_version",
        "if(p_partkey % 2 = 0, p_partkey + 100000, null) as migration_pool", "case when p_partkey % 4 = 0 then 'v2' when p_partkey % 4 = 2 then 'dhook' end as migration_type",
        "cast(null as bigint) as migrated_at", "p_partkey % 7 as integrator", "if(p_partkey % 3 = 0, 'rehype', 'multicurve') as type", "if(p_partkey % 9 = 0, p_partkey - 1, null) as migrated_from", "p_partkey % 500 as created_block")


@query("f10_migration_pool", POOLS + """, m AS (SELECT CASE WHEN o_orderkey % 6 = 0 THEN 0 ELSE o_orderkey % 2000 + 100000 END AS pool, o_orderkey AS block_number FROM orders)
SELECT m.pool AS address, base_token, quote_token, fee, p.address AS migrated_from, block_number, p.address % 7 AS integrator FROM m JOIN pools p ON p.migration_pool = m.pool WHERE m.pool <> 0 AND source = 0""")
def f10(spark, sf):
    m = spark.read.parquet(f"{sf}/orders.parquet").selectExpr("if(o_orderkey % 6 = 0, 0, o_orderkey % 2000 + 100000) as pool", "o_orderkey as block_number")
    out = E.migration_pools(m, _pools(spark, sf), spark.createDataFrame([(0, 1)], "source long, source_version int"))
    return out.select("address", "base_token", "quote_token", "fee", "migrated_from", "block_number", "integrator")


@query("f11_v2_migration_pool", POOLS + """, m AS (SELECT CASE WHEN o_orderkey % 6 = 0 THEN 0 ELSE o_orderkey % 2000 + 100000 END AS pool, o_orderkey AS block_number FROM orders)
SELECT m.pool AS address, base_token, quote_token, fee, p.address AS migrated_from, block_number FROM m JOIN pools p ON p.migration_pool = m.pool WHERE m.pool <> 0 AND migration_type = 'v2'""")
def f11(spark, sf):
    """Migrations of one type."""
    m = spark.read.parquet(f"{sf}/orders.parquet").selectExpr("if(o_orderkey % 6 = 0, 0, o_orderkey % 2000 + 100000) as pool", "o_orderkey as block_number")
    return E.migration_pools(m, _pools(spark, sf), kind="v2").select("address", "base_token", "quote_token", "fee", "migrated_from", "block_number")


HOOK_MIGRATIONS = """, m AS (SELECT o_orderkey AS block_number, o_orderkey % 9 AS asset FROM orders),
g AS (SELECT base_token, min(address) AS address FROM pools WHERE source = 1 AND source_version = 1 AND address % 7 <> 0 GROUP BY 1), o AS (SELECT p.* FROM pools p JOIN g USING (address))"""


def _hook_migrations(spark, sf) -> tuple[DataFrame, DataFrame]:
    a = lambda n: F.expr(f"unhex(lpad(hex({n}), 40, '0'))")
    m = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_orderkey").alias("block_number"), (F.col("o_orderkey") % 9).alias("asset"), a("o_orderkey").alias("currency0"), a("o_orderkey + 1").alias("currency1"), F.lit(0).alias("fee"), F.lit(60).alias("tick_spacing"), a("9L").alias("hooks"))
    return E.hook_migrations(m, _pools(spark, sf).filter("address % 7 <> 0"), 1, 1)


@query("f12_hook_migration", POOLS + HOOK_MIGRATIONS + """ SELECT block_number, base_token, quote_token, fee, o.address % 7 AS integrator, o.address AS migrated_from,
CASE WHEN o.address % 3 = 0 THEN 'migration_rehype' ELSE 'migration_dhook' END AS type, CASE WHEN o.address % 3 = 0 THEN 'rehype' ELSE 'dhook' END AS migration_type FROM m JOIN o ON o.base_token = m.asset""")
def f12(spark, sf):
    """Hook migrations by base token and source; test_operators holds the new ids against pool_ids."""
    return _hook_migrations(spark, sf)[0].select("block_number", "base_token", "quote_token", "fee", "integrator", "migrated_from", "type", "migration_type")


@query("f12_without_origin", POOLS + HOOK_MIGRATIONS + " SELECT block_number, asset FROM m WHERE asset NOT IN (SELECT base_token FROM o)")
def f12_missing(spark, sf):
    return _hook_migrations(spark, sf)[1].select("block_number", "asset")


@query("f14_migration_backfill", POOLS + """, m AS (SELECT address, address + 500000 AS successor, created_block + 7 AS block_number FROM pools WHERE address % 10 = 0),
k AS (SELECT address, base_token, migrated_from, created_block FROM pools UNION ALL SELECT address + 500000, base_token, address, created_block FROM pools WHERE address % 20 = 0)
SELECT k.address, k.base_token, m.successor AS migration_pool FROM k LEFT JOIN m ON m.address = k.address AND m.successor NOT IN (SELECT address FROM k)
UNION ALL SELECT m.successor, base_token, NULL FROM pools p JOIN m ON m.address = p.address WHERE m.successor NOT IN (SELECT address FROM k)""")
def f14(spark, sf):
    """Half of the migrations are known; the replay adds the rest only."""
    pools = _pools(spark, sf).withColumn("migration_pool", F.lit(None).cast("bigint"))
    known = pools.filter("address % 20 = 0").withColumns({"migrated_from": F.col("address"), "address": F.col("address") + 500_000})
    m = pools.filter("address % 10 = 0").selectExpr("address", "address + 500000 as successor", "created_block + 7 as block_number")
    progress = spark.createDataFrame([], "handler string, range_start long, range_end long")
    return E.backfill(pools.unionByName(known), m, progress, copied_from="a", to="b")[0].select("address", "base_token", "migration_pool")


@query("f14_copied_progress", with_views(", p AS (SELECT handler, range_index AS range_start, range_index + 1 AS range_end FROM v_progress) SELECT * FROM p UNION ALL SELECT 'backfill', range_start, range_end FROM p WHERE handler = '1-URGENT'", "v_progress"))
def f14_progress(spark, sf):
    pools = _pools(spark, sf)
    m = pools.filter("address % 10 = 0").selectExpr("address", "address + 500000 as successor", "created_block + 7 as block_number")
    progress = fx.progress(spark, sf).selectExpr("handler", "range_index as range_start", "range_index + 1 as range_end")
    return E.backfill(pools, m, progress, copied_from="1-URGENT", to="backfill")[1]


@query("f13_liquidity_migration", POOLS + """, m AS (SELECT address, address + 500000 AS successor, created_block + 7 AS block_number FROM pools WHERE address % 10 = 0)
SELECT address, base_token, CASE WHEN m.successor IS NOT NULL THEN m.successor ELSE migration_pool END AS migration_pool, m.block_number AS migrated_at, migrated_from, created_block FROM pools LEFT JOIN m USING (address)
UNION ALL SELECT m.successor, base_token, NULL, NULL, p.address, m.block_number FROM pools p JOIN m ON m.address = p.address WHERE m.successor NOT IN (SELECT address FROM pools)""")
def f13(spark, sf):
    """Successor pools come in, where no pool has their address yet, and origins are updated."""
    pools = _pools(spark, sf)
    m = pools.filter("address % 10 = 0").selectExpr("address", "address + 500000 as successor", "created_block + 7 as block_number")
    return E.migrate(pools, m).select("address", "base_token", "migration_pool", "migrated_at", "migrated_from", "created_block")


@query("f16_pool_metadata", POOLS + """ SELECT p.address, p.quote_token, coalesce(n_regionkey, 18) AS base_decimals, n_name AS total_supply FROM pools p LEFT JOIN pools o ON o.address = p.migrated_from
LEFT JOIN nation ON n_nationkey = coalesce(o.base_token, p.base_token) AND n_nationkey <> 3 WHERE p.source = 1 AND p.created_block >= 50 AND p.created_block < 400""")
def f16(spark, sf):
    tokens = spark.read.parquet(f"{sf}/nation.parquet").where("n_nationkey <> 3").selectExpr("n_nationkey as address", "n_regionkey as decimals", "n_name as total_supply")
    scope = spark.createDataFrame([(1, 1)], "source long, source_version int")
    return E.pool_metadata(_pools(spark, sf), tokens, scope, from_block=50, to_block=400).select("address", "quote_token", "base_decimals", "total_supply")


@query("f17_unpriced_quotes", POOLS + " SELECT DISTINCT quote_token AS token FROM pools WHERE quote_token NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey < 2)")
def f17(spark, sf):
    prices = spark.read.parquet(f"{sf}/nation.parquet").where("n_nationkey < 2").selectExpr("n_nationkey as token")
    return E.unpriced_quotes(_pools(spark, sf), prices)


@query("f18_migrated_swaps", POOLS + " SELECT l_orderkey, l_partkey AS pool, count(*) AS n FROM lineitem WHERE l_partkey IN (SELECT address FROM pools WHERE migrated_from IS NOT NULL AND migration_type = 'v2') GROUP BY 1, 2")
def f18_g07(spark, sf):
    """Swaps of known migration pools."""
    swaps = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("l_orderkey", "l_partkey as pool")
    return E.migrated_only(swaps, _pools(spark, sf), "v2").groupBy("l_orderkey", "pool").agg(F.count(F.lit(1)).alias("n"))
