"""Oracle, latest and transitive prices and best paths over the projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.operators import pricing as P
from ledgerloom.plans.base import query
from ledgerloom.sources import fixtures as fx
from ledgerloom.sources.fixtures import with_views


@query("i01_oracle_price", with_views(""" SELECT target, block_number, value::DOUBLE / 1e8::DOUBLE AS price FROM v_calls WHERE NOT is_reverted
QUALIFY row_number() OVER (PARTITION BY target ORDER BY block_number DESC, log_index) = 1""", "v_calls"))
def i01(spark, sf):
    return P.oracle_price(fx.calls(spark, sf))


@query("i01_oracle_rows", with_views(""", a AS (SELECT target, block_number, value::DOUBLE / 1e8::DOUBLE AS price FROM v_calls WHERE NOT is_reverted
QUALIFY row_number() OVER (PARTITION BY target ORDER BY block_number DESC, log_index) = 1)
SELECT target * 2 AS token, repeat('0', 40) AS quote, block_number AS block, ts, price FROM a JOIN v_blocks ON number = block_number""", "v_calls", "v_blocks"))
def i01_rows(spark, sf):
    """Oracle answers as rows of the price table, quoted in dollars (the zero address), at their blocks' times."""
    calls = fx.calls(spark, sf)
    feeds = calls.select("target", (F.col("target") * 2).alias("token")).distinct()
    return P.oracle_rows(P.oracle_price(calls), feeds, fx.blocks(spark, sf)).withColumn("quote", F.hex("quote"))


@query("i02_price_pools", """SELECT 'A' || c_custkey || 'USDCPool' AS name, 'A' || c_custkey AS base FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 5 <> 0
UNION ALL SELECT 'B' || c_custkey || 'axlUSDCPool', 'B' || c_custkey FROM customer WHERE c_custkey % 2 = 1 AND c_custkey % 5 <> 0""")
def i02(spark, sf):
    """Pools by their names in the registry; those without a slot0-like call do not count."""
    return P.price_pools(*_registry(spark, sf)).select("name", "base")


def _registry(spark, sf) -> tuple[DataFrame, DataFrame]:
    c = spark.read.parquet(f"{sf}/customer.parquet")
    functions = F.when(F.col("c_custkey") % 5 == 0, F.array(F.lit("fee()"))).when(F.col("c_custkey") % 2 == 0, F.array(F.lit("fee()"), F.lit("slot0()"))).otherwise(F.array(F.lit("getSlot0(bytes32)")))
    named = c.select(F.expr("if(c_custkey % 2 = 0, concat('A', c_custkey, 'USDCPool'), concat('B', c_custkey, 'axlUSDCPool'))").alias("name"), functions.alias("functions"))
    contracts = named.unionByName(c.select(F.col("c_name").alias("name"), functions.alias("functions")))
    return contracts, spark.createDataFrame([("USDC",), ("axlUSDC",), ("WETH",)], "symbol string")


@query("i02_slot0_prices", """SELECT c_custkey AS token, CASE WHEN c_custkey % 2 = 0 THEN 500000 ELSE 5 END AS quote, max(o_orderkey) AS block, o_orderkey % 3 AS ts,
CASE WHEN c_custkey < CASE WHEN c_custkey % 2 = 0 THEN 500000 ELSE 5 END THEN 16.0 ELSE 1 / 16.0 END::DOUBLE * 1000000000000.0::DOUBLE AS price FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_custkey % 5 <> 0 GROUP BY ALL""")
def i02_prices(spark, sf):
    """Price rows of the pools' slot0 results, one per token and time."""
    pools = P.price_pools(*_registry(spark, sf))
    c = spark.read.parquet(f"{sf}/customer.parquet")
    tokens = c.select(F.expr("if(c_custkey % 2 = 0, concat('A', c_custkey), concat('B', c_custkey))").alias("symbol"), F.col("c_custkey").alias("address"), F.lit(18).alias("decimals"))
    tokens = tokens.unionByName(spark.createDataFrame([("USDC", 500_000, 6), ("axlUSDC", 5, 6)], "symbol string, address long, decimals int"))
    calls = spark.read.parquet(f"{sf}/orders.parquet").select(F.expr("if(o_custkey % 2 = 0, concat('A', o_custkey, 'USDCPool'), concat('B', o_custkey, 'axlUSDCPool'))").alias("source"), F.col("o_orderkey").alias("block"), (F.col("o_orderkey") % 3).alias("ts"), F.lit(str(4 << 96)).alias("sqrt_price"))
    return P.slot0_prices(pools, calls, tokens)


PRICES = """WITH p AS (SELECT p_partkey % 97 + 3 AS token, (p_partkey % 97 + 3) // 2 AS quote, p_partkey % 400 AS block, (1 + p_size % 4)::DOUBLE / 2.0::DOUBLE AS price FROM part),
l AS (SELECT token, quote, block, arg_min(price, price) AS price FROM p WHERE block < 300 GROUP BY token, quote, block QUALIFY row_number() OVER (PARTITION BY token, quote ORDER BY block DESC) = 1)"""


def _prices(spark, sf) -> DataFrame:
    p = spark.read.parquet(f"{sf}/part.parquet").selectExpr("p_partkey % 97 + 3 as token", "(p_partkey % 97 + 3) div 2 as quote", "p_partkey % 400 as block", "cast(1 + p_size % 4 as double) / 2.0D as price")
    return P.latest_prices(p.groupBy("token", "quote", "block").agg(F.min("price").alias("price")), 300)


@query("i03_latest_prices", PRICES + " SELECT token, quote, block, price FROM l")
def i03(spark, sf):
    return _prices(spark, sf)


@query("i04_transitive_prices", PRICES.replace("WITH p", "WITH RECURSIVE p") + """, r AS (SELECT 1::BIGINT AS token, 1.0::DOUBLE AS usd, 0::BIGINT AS block, 0 AS hops UNION ALL
SELECT l.token, l.price * r.usd, greatest(l.block, r.block), hops + 1 FROM r JOIN l ON l.quote = r.token) SELECT * FROM r""")
def i04(spark, sf):
    known = spark.range(1, 2).select(F.col("id").alias("token"), F.lit(1.0).alias("usd"), F.lit(0).cast("bigint").alias("block"))
    return P.resolve_usd(_prices(spark, sf), known)


@query("i05_price_precedence", """SELECT p_partkey AS token, CASE WHEN p_partkey < 5 THEN 1.0 WHEN p_partkey % 2 = 0 THEN 2.0 WHEN p_partkey % 3 = 0 AND p_size < 30 THEN 3.0 WHEN p_size < 40 THEN 4.0 END::DOUBLE AS usd FROM part
WHERE p_partkey < 5 OR p_partkey % 2 = 0 OR (p_partkey % 3 = 0 AND p_size < 30) OR p_size < 40 UNION ALL SELECT -1, 2.0""")
def i05(spark, sf):
    """Stable coins, oracle, stored, cache; what rests on a later block does not count; the native coin is the wrapped one (part 10)."""
    p = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_partkey").alias("token"), F.col("p_size").alias("block"))
    at = lambda cond, usd, late=0: p.filter(cond).withColumns({"usd": F.lit(usd), "block": F.col("block") + late})
    found = P.usd_prices(at("token < 5", 1.0), at("token % 2 = 0", 2.0), at("token % 3 = 0", 3.0, 10), at("true", 4.0), bound=40, native=-1, wrapped=10)
    return found.select("token", "usd")


@query("i06_frontier_edges", """WITH s AS (SELECT l_partkey AS pool, l_orderkey AS block, CASE WHEN l_quantity > 25 THEN l_quantity::BIGINT * 30 END AS liquidity_usd, l_linenumber - 1 AS liquidity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey, l_orderkey ORDER BY l_linenumber, l_quantity, l_suppkey, l_extendedprice) = 1),
l AS (SELECT * FROM s WHERE block < (SELECT max(l_orderkey) FROM lineitem) // 4 QUALIFY row_number() OVER (PARTITION BY pool ORDER BY block DESC) = 1)
SELECT pool, block, coalesce(liquidity_usd, 0) AS weight FROM l WHERE liquidity_usd >= 1000 OR (liquidity_usd IS NULL AND liquidity > 0)""")
def i06(spark, sf):
    line = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("l_partkey as pool", "l_orderkey as block", "l_linenumber", "l_quantity", "l_suppkey", "l_extendedprice")
    one = line.groupBy("pool", "block").agg(F.min(F.struct("l_linenumber", "l_quantity", "l_suppkey", "l_extendedprice")).alias("s"))
    snaps = one.selectExpr("pool", "block", "if(s.l_quantity > 25, cast(s.l_quantity as bigint) * 30, null) as liquidity_usd", "s.l_linenumber - 1 as liquidity")
    return P.frontier_edges(snaps, line.agg(F.max("block")).first()[0] // 4).select("pool", "block", "weight")


PATHS = """, g AS (SELECT a, b, a * 100 + b AS pool, liquidity AS weight FROM v_edges UNION ALL SELECT b, a, a * 100 + b, liquidity FROM v_edges),
e AS (SELECT a, b, arg_max(pool, (weight, -pool)) AS pool, max(weight) AS weight FROM g GROUP BY a, b)"""


def _edges(spark, sf) -> DataFrame:
    return fx.edges(spark, sf).select("a", "b", (F.col("a") * 100 + F.col("b")).alias("pool"), F.col("liquidity").alias("weight"))


def _paths(spark, sf) -> DataFrame:
    edges = _edges(spark, sf)
    tokens = spark.read.parquet(f"{sf}/part.parquet").selectExpr("p_partkey % 40 as token").distinct().filter("token > 0")
    return P.best_paths(edges, tokens, spark.range(1).withColumnRenamed("id", "token"))


def _hops() -> str:
    """The synchronous relaxation written out hop by hop."""
    sql = ", s0 AS (SELECT DISTINCT p_partkey % 40 AS target, p_partkey % 40 AS tok, NULL::BIGINT AS bottleneck, []::BIGINT[] AS path FROM part WHERE p_partkey % 40 > 0), v0 AS (SELECT target, tok FROM s0)"
    for h in range(1, 6):
        sql += f""", c{h} AS (SELECT s.target, e.b AS tok, coalesce(least(s.bottleneck, e.weight), e.weight) AS bottleneck, list_append(s.path, e.pool) AS path FROM s{h - 1} s JOIN e ON e.a = s.tok
WHERE NOT EXISTS (SELECT 1 FROM v{h - 1} v WHERE v.target = s.target AND v.tok = e.b)),
t{h} AS (SELECT * FROM c{h} QUALIFY row_number() OVER (PARTITION BY target, tok ORDER BY bottleneck DESC, path) = 1),
f{h} AS (SELECT target, tok AS anchor, bottleneck, path, {h} AS hops FROM t{h} WHERE tok = 0),
s{h} AS (SELECT * FROM t{h} WHERE target NOT IN (SELECT target FROM f{h})), v{h} AS (SELECT * FROM v{h - 1} UNION ALL SELECT target, tok FROM t{h})"""
    return sql + ", f AS (" + " UNION ALL ".join(f"SELECT * FROM f{h}" for h in range(1, 6)) + ")"


@query("i07_best_paths", with_views(PATHS + _hops() + " SELECT * FROM f", "v_edges"))
def i07(spark, sf):
    return _paths(spark, sf)


@query("i08_price_along_path", with_views(PATHS + _hops() + """ SELECT target, CASE WHEN hops = 1 THEN CASE WHEN path[1] // 100 = target THEN 2.0 ELSE 0.5 END
ELSE list_reduce(list_prepend(1.0::DOUBLE, list_transform(list_zip(path, list_prepend(target, n)), lambda z: CASE WHEN z[1] // 100 = z[2] THEN 2.0 ELSE 0.5 END::DOUBLE)), lambda x, y: x * y) END::DOUBLE AS price FROM
(SELECT *, CASE WHEN hops = 1 THEN [] ELSE list_transform(range(1, hops), lambda i: (CASE WHEN i = 1 THEN n1 WHEN i = 2 THEN n2 WHEN i = 3 THEN n3 ELSE n4 END)) END AS n FROM
(SELECT *, CASE WHEN n3 IS NULL OR path[4] IS NULL THEN NULL WHEN path[4] // 100 = n3 THEN path[4] % 100 ELSE path[4] // 100 END AS n4 FROM
(SELECT *, CASE WHEN path[3] // 100 = n2 THEN path[3] % 100 ELSE path[3] // 100 END AS n3 FROM (SELECT *, CASE WHEN path[2] // 100 = n1 THEN path[2] % 100 ELSE path[2] // 100 END AS n2 FROM
(SELECT *, CASE WHEN path[1] // 100 = target THEN path[1] % 100 ELSE path[1] // 100 END AS n1 FROM f)))))""".replace("list_zip(path, list_prepend(target, n)), lambda z: CASE WHEN z[1] // 100 = z[2]", "range(1, hops + 1), lambda i: CASE WHEN path[i] // 100 = list_prepend(target, n)[i]"), "v_edges"))
def i08(spark, sf):
    pools = _edges(spark, sf).select("pool", F.col("a").alias("base"), F.col("b").alias("quote"), F.lit(2.0).alias("price"))
    return P.price_along(_paths(spark, sf), pools)


@query("i09_path_cache", """SELECT p_partkey AS target FROM part WHERE p_partkey * 1000 < 400000 AND 400000 - p_partkey * 1000 < 302400 AND NOT (p_partkey % 7 = 3)""")
def i09(spark, sf):
    cache = spark.read.parquet(f"{sf}/part.parquet").selectExpr("p_partkey as target", "p_partkey * 1000 as resolved_block", "array(p_partkey % 7, p_partkey % 2) as path")
    pools = spark.range(7).filter("id <> 3").withColumnRenamed("id", "pool")
    return P.drop_broken(P.fresh_paths(cache, 400_000), pools).select("target")


@query("i09_updated_cache", with_views(PATHS.replace("liquidity AS weight FROM v_edges", "w AS weight FROM n").replace("SELECT b, a, a * 100 + b, liquidity FROM v_edges", "SELECT b, a, a * 100 + b, w FROM n").replace(", g AS", """, n AS (SELECT a, b, CASE WHEN (a + b) % 7 = 3 THEN liquidity * 2 ELSE liquidity END AS w FROM v_edges WHERE (a * 3 + b) % 11 <> 5)
, g AS""") + _hops() + """ SELECT t.target, anchor, bottleneck, f.hops, array_to_string(path, '-') AS path FROM (SELECT DISTINCT p_partkey % 40 AS target FROM part WHERE p_partkey % 40 > 0) t LEFT JOIN f USING (target)""", "v_edges"))
def i09_updated(spark, sf):
    """A cache of all tokens' paths, then pools that went and pools that grew: only what they touch is solved again, and all is as from scratch."""
    old, anchor = _edges(spark, sf), spark.range(1).withColumnRenamed("id", "token")
    tokens = spark.read.parquet(f"{sf}/part.parquet").selectExpr("p_partkey % 40 as token").distinct().filter("token > 0")
    new = old.filter("(a * 3 + b) % 11 <> 5").withColumn("weight", F.when((F.col("a") + F.col("b")) % 7 == 3, F.col("weight") * 2).otherwise(F.col("weight")))
    empty = spark.createDataFrame([], "target long, anchor long, bottleneck long, hops int, path array<bigint>, resolved_block long")
    cache = P.update_paths(empty, old, old, tokens, anchor, 100)
    return P.update_paths(cache, old, new, tokens, anchor, 200).select("target", "anchor", "bottleneck", "hops", F.array_join("path", "-").alias("path"))
