"""Merges, entity tables, coverage and progress over the projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.operators import decode, entities, merge, ohlc
from ledgerloom.operators.running import running_sums
from ledgerloom.plans.base import query
from ledgerloom.plans.market import _ohlc, market
from ledgerloom.sources import fixtures as fx
from ledgerloom.sources.fixtures import with_views


def _halves(spark, sf) -> tuple[DataFrame, DataFrame]:
    """State up to week 1350, and what comes in after week 1300: late rows, equal rows and new ones."""
    cols = ["pool", "block", "price_close", "swap_count"]
    snaps = _ohlc(spark, sf).select(*cols)
    return ohlc.latest_state(snaps.filter("block <= 1350 and pool < 12"), ["pool"]).select(*cols), snaps.filter("block % 7 = 0").withColumn("swap_count", F.lit(0).cast("bigint"))


HALVES = """, target AS (SELECT pool, block, price_close, swap_count FROM o WHERE block <= 1350 AND pool < 12 QUALIFY row_number() OVER (PARTITION BY pool ORDER BY block DESC) = 1),
incoming AS (SELECT pool, block, price_close, 0::BIGINT AS swap_count FROM o WHERE block % 7 = 0)"""


@query("k01_insert_first_wins", market(HALVES + """ SELECT * FROM target UNION ALL SELECT * FROM
(SELECT * FROM incoming QUALIFY row_number() OVER (PARTITION BY pool ORDER BY block) = 1) WHERE pool NOT IN (SELECT pool FROM target)"""))
def k01(spark, sf):
    target, incoming = _halves(spark, sf)
    return merge.first_wins(target, incoming, ["pool"], "block")


@query("k02_upsert_columns", market(HALVES + """, l AS (SELECT * FROM incoming QUALIFY row_number() OVER (PARTITION BY pool ORDER BY block DESC) = 1)
SELECT pool, coalesce(t.block, l.block) AS block, coalesce(l.price_close, t.price_close) AS price_close, coalesce(t.swap_count, l.swap_count) AS swap_count
FROM target t FULL JOIN l USING (pool)"""))
def k02(spark, sf):
    target, incoming = _halves(spark, sf)
    return merge.overwrite(target, ohlc.latest_state(incoming, ["pool"]), ["pool"], ["price_close"])


@query("k03_newer_wins", market(HALVES + """ SELECT pool, block, price_close, swap_count FROM (SELECT *, 1 AS s FROM target UNION ALL SELECT *, 0 FROM incoming)
QUALIFY row_number() OVER (PARTITION BY pool ORDER BY block DESC, s DESC) = 1"""))
def k03(spark, sf):
    target, incoming = _halves(spark, sf)
    return merge.newer_wins(target, incoming, ["pool"], "block")


@query("l08_equal_or_newer_wins", market(HALVES + """ SELECT pool, block, price_close, swap_count FROM (SELECT *, 0 AS s FROM target UNION ALL SELECT *, 1 FROM incoming)
QUALIFY row_number() OVER (PARTITION BY pool ORDER BY block DESC, s DESC) = 1"""))
def l08(spark, sf):
    target, incoming = _halves(spark, sf)
    return merge.newer_wins(target, incoming, ["pool"], "block", or_equal=True)


SEEN = """, seen AS (SELECT from_address AS address, ts FROM v_transfers UNION ALL SELECT to_address, ts FROM v_transfers)"""


@query("k04_touch_users", with_views(SEEN + """ SELECT address, min(ts) AS first_seen, max(ts) AS last_seen FROM
(SELECT * FROM seen UNION ALL SELECT c_custkey, 0 FROM customer WHERE c_custkey % 5 = 0) GROUP BY address""", "v_transfers"))
def k04(spark, sf):
    known = spark.read.parquet(f"{sf}/customer.parquet").where("c_custkey % 5 = 0").selectExpr("c_custkey as address", "0L as first_seen", "0L as last_seen")
    return merge.touch(known, entities.sightings(fx.transfers(spark, sf)))


@query("k05_update_delete", """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'moved' ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 4 <> 1""")
def k05(spark, sf):
    c = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_mktsegment")
    changes = c.filter("c_custkey % 3 = 0").select("c_custkey", F.lit("moved").alias("c_mktsegment"))
    return merge.delete_by_key(merge.update_by_key(c, changes, ["c_custkey"]), c.filter("c_custkey % 4 = 1"), ["c_custkey"])


@query("k06_versions", """SELECT s_suppkey, source, source_version FROM (SELECT s_suppkey, 'v' || s_suppkey % 3 AS source, unnest([1, 2]) AS source_version FROM supplier)
WHERE (source = 'v0' AND source_version = 1) OR (source = 'v1' AND source_version = 2)""")
def k06_k13(spark, sf):
    """Two versions stamped and inserted side by side, as their keys hold the stamp; then each source's active one."""
    s = spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey")
    source = F.concat(F.lit("v"), F.col("s_suppkey") % 3)
    one, two = (merge.stamp(s, source, v) for v in (1, 2))
    both = merge.first_wins(one, two.unionByName(two).withColumn("n", F.lit(0)), merge.stamped_keys(["s_suppkey"]), "n")
    active = spark.createDataFrame([("v0", 1), ("v1", 2)], "source string, source_version int")
    return merge.active_version(both, active)


@query("k11_checkpoint_totals", with_views(""", r AS (SELECT *, sum(amount0_in) OVER (PARTITION BY pool ORDER BY block, log_index ROWS UNBOUNDED PRECEDING)::BIGINT AS total FROM v_swaps)
SELECT pool, arg_max(total, (block, log_index)) AS total, max(block) AS block, max((block, log_index))[2] AS log_index FROM r GROUP BY pool""", "v_swaps"))
def k11(spark, sf):
    s = running_sums(fx.swaps(spark, sf), ["pool"], "block", {"total": F.col("amount0_in")}, 16, ("log_index",)).select("pool", "block", "log_index", "total")
    return merge.checkpoint_totals(s, ["pool"], ["total"])


@query("k12_retry_backlog", """SELECT o_orderpriority AS handler, floor(epoch(o_orderdate))::BIGINT // 86400 AS range_index, count(*) AS failure_count, min(o_orderkey) AS first_failed_at,
max(o_orderkey) AS last_failed_at, arg_max(o_orderstatus, (o_orderkey, o_orderstatus)) AS last_error FROM orders WHERE o_custkey % 11 = 0 GROUP BY 1, 2""")
def k12(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").where("o_custkey % 11 = 0")
    return merge.retry_backlog(o.selectExpr("o_orderpriority as handler", "unix_timestamp(o_orderdate) div 86400 as range_index", "o_orderkey as ts", "o_orderstatus as error"))


@query("k12_incremental_backlog", """WITH f AS (SELECT o_orderpriority AS handler, floor(epoch(o_orderdate))::BIGINT // 86400 AS range_index, o_orderkey, o_orderstatus FROM orders WHERE o_custkey % 11 = 0),
d AS (SELECT DISTINCT o_orderpriority AS handler, floor(epoch(o_orderdate))::BIGINT // 86400 AS range_index FROM orders WHERE o_custkey % 13 = 0)
SELECT handler, range_index, count(*) AS failure_count, min(o_orderkey) AS first_failed_at, max(o_orderkey) AS last_failed_at FROM f ANTI JOIN d USING (handler, range_index) GROUP BY 1, 2""")
def k12_incremental(spark, sf):
    """Failures merged into an existing backlog, and what was finished since taken out."""
    o = spark.read.parquet(f"{sf}/orders.parquet").selectExpr("o_orderpriority as handler", "unix_timestamp(o_orderdate) div 86400 as range_index", "o_orderkey as ts", "o_orderstatus as error", "o_custkey")
    f = o.filter("o_custkey % 11 = 0")
    out = merge.retry_backlog(f.filter("ts % 2 = 1"), merge.retry_backlog(f.filter("ts % 2 = 0")), o.filter("o_custkey % 13 = 0"))
    return out.drop("last_error")


@query("k12_handler_progress", with_views(""", p AS (SELECT handler, range_index AS range_start, range_index + 1 AS range_end FROM v_progress WHERE range_index % 3 <> 0)
SELECT handler, range_index AS range_start, CASE WHEN range_index % 2 = 0 THEN range_index + 2 ELSE range_index + 1 END AS range_end FROM v_progress WHERE range_index % 3 <> 0 OR range_index % 2 = 0""", "v_progress"))
def k12_progress(spark, sf):
    p = fx.progress(spark, sf).selectExpr("handler", "range_index as range_start", "range_index + 1 as range_end")
    finished = p.filter("range_start % 2 = 0").withColumn("range_end", F.col("range_end") + 1)
    return merge.record_progress(p.filter("range_start % 3 <> 0"), finished.unionByName(p.filter("range_start % 2 = 0")))


@query("h12_row_key_counts", with_views(" SELECT block_number, function_name, count(*) AS n FROM v_calls GROUP BY 1, 2", "v_calls"))
def h12(spark, sf):
    return fx.calls(spark, sf).groupBy("block_number", "function_name").agg(F.count(F.lit(1)).alias("n"))


@query("h13_range_completeness", with_views(""" SELECT number // 100 AS range, count(DISTINCT number) AS n, min(number) AS first, max(number) AS last,
count(DISTINCT number) = 100 AND min(number) = number // 100 * 100 AND max(number) = number // 100 * 100 + 99 AS complete FROM v_blocks GROUP BY number // 100""", "v_blocks"))
def h13(spark, sf):
    return merge.completeness(fx.blocks(spark, sf), "number", 100)


@query("h14_completion_watermark", with_views(""", i AS (SELECT handler, range_index, range_index - row_number() OVER (PARTITION BY handler ORDER BY range_index) AS g FROM v_progress)
SELECT handler, min(last) AS complete_to FROM (SELECT handler, g, max(range_index) AS last FROM i GROUP BY 1, 2) GROUP BY handler""", "v_progress"))
def h14(spark, sf):
    return merge.completion_watermark(fx.progress(spark, sf))


@query("h15_handlers_in_range", with_views(" SELECT handler, max(range_index) AS greatest FROM v_progress WHERE range_index BETWEEN 9200 AND 9400 GROUP BY handler", "v_progress"))
def h15(spark, sf):
    return fx.progress(spark, sf).filter("range_index between 9200 and 9400").groupBy("handler").agg(F.max("range_index").alias("greatest"))


@query("d06_missing_ranges", with_views(""", b AS (SELECT min(range_index) AS lo, max(range_index) AS hi FROM v_progress), h AS (SELECT DISTINCT handler FROM v_progress)
SELECT handler, r AS range_index FROM (SELECT handler, unnest(range(lo, hi + 1)) AS r FROM h, b) ANTI JOIN v_progress p ON p.handler = h.handler AND p.range_index = r""".replace("FROM (SELECT handler, unnest(range(lo, hi + 1)) AS r FROM h, b) ANTI", "FROM (SELECT handler, unnest(range(lo, hi + 1)) AS r FROM h, b) h ANTI").replace("SELECT handler, r AS", "SELECT h.handler, h.r AS"), "v_progress"))
def d06(spark, sf):
    done = fx.progress(spark, sf)
    lo, hi = done.agg(F.min("range_index"), F.max("range_index")).first()
    return merge.missing_ranges(done, lo, hi, 1)


@query("d07_block_gaps", with_views(""", n AS (SELECT number, lead(number) OVER (ORDER BY number) AS nxt FROM v_blocks)
SELECT number + 1 AS first, nxt - 1 AS last FROM n WHERE nxt > number + 1""", "v_blocks"))
def d07(spark, sf):
    return merge.gaps(fx.blocks(spark, sf), "number", 1000)


@query("f15_transfers_users", with_views(SEEN + " SELECT address, min(ts) AS first_seen, max(ts) AS last_seen FROM seen WHERE address > 17 GROUP BY address", "v_transfers"))
def f15(spark, sf):
    return entities.users(fx.transfers(spark, sf).filter("from_address > 17 or to_address > 17")).filter("address > 17")


@query("m10_holder_balances", with_views(""", m AS (SELECT token, to_address AS holder, value FROM v_transfers UNION ALL SELECT token, from_address, -value FROM v_transfers)
SELECT token, holder, sum(value)::BIGINT AS balance FROM m GROUP BY 1, 2""", "v_transfers"))
def m10(spark, sf):
    return entities.balances(fx.transfers(spark, sf))


@query("m10_holder_counts", with_views(""", m AS (SELECT token, to_address AS holder, value FROM v_transfers UNION ALL SELECT token, from_address, -value FROM v_transfers)
SELECT token, count(*) AS holders FROM (SELECT token, holder FROM m GROUP BY 1, 2 HAVING sum(value) > 0) GROUP BY token""", "v_transfers"))
def m10b(spark, sf):
    return entities.balances(fx.transfers(spark, sf)).filter("balance > 0").groupBy("token").agg(F.count(F.lit(1)).alias("holders"))


@query("m07_multi_key_sort", "SELECT *, row_number() OVER (ORDER BY c_nationkey, c_acctbal DESC, c_custkey) - 1 AS place FROM customer")
def m07(spark, sf):
    """A sorted table with each row's place in it: rows come sorted by range, and are numbered within their partition and by its offset."""
    from ledgerloom.sources.shared import cut

    c = spark.read.parquet(f"{sf}/customer.parquet").orderBy("c_nationkey", F.desc("c_acctbal"), "c_custkey")
    c = cut(c.withColumn("_id", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_id", 33))
    sizes = c.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offset = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before")
    placed = c.join(sizes.select("_part", offset), "_part").withColumn("place", F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
    return placed.drop("_id", "_part", "_before").orderBy("place")


@query("f15_transfer_shapes", """SELECT lower(lpad(to_hex(event_id % 7 + 1000), 40, '0')) AS token, event_id AS log_index, floor(epoch(ts))::BIGINT AS ts, lower(lpad(to_hex(user_id + 500), 40, '0')) AS from_address,
lower(lpad(to_hex(event_id % 97), 40, '0')) AS to_address, (event_id::HUGEINT * 1208925819614629174706176)::VARCHAR AS value FROM events WHERE user_id % 10 <> 3""")
def f15_shapes(spark, sf):
    """Transfers from raw logs of both event shapes; those that a precompiled contract sent do not count."""
    e = spark.read.parquet(f"{sf}/events.parquet")
    topics = [decode.parse_event(t)["topic0"].hex() for t in entities.TRANSFER_SHAPES]
    hexed = lambda c, n: F.lpad(F.hex(F.expr(c)), n, "0")
    sender = hexed("if(user_id % 10 = 3, 4L, user_id + 500)", 64)
    amount = F.concat(hexed("event_id", 44), F.lit("0" * 20))
    more = F.when(F.col("event_id") % 2 == 0, "").otherwise(F.lit("0" * 126 + "07"))
    logs = e.select(
        F.col("event_id").alias("block_number"), F.col("event_id").alias("log_index"), F.unix_timestamp("ts").alias("block_timestamp"), F.unhex(hexed("event_id % 7 + 1000", 40)).alias("address"),
        F.transform(F.array(F.when(F.col("event_id") % 2 == 0, topics[0]).otherwise(topics[1]), sender, hexed("event_id % 97", 64)), F.unhex).alias("topics"),
        F.unhex(F.concat(amount, more)).alias("data"))
    rows = entities.transfers_of(logs)
    return rows.select(*[F.lower(F.hex(c)).alias(c) for c in ("token", "from_address", "to_address")], "log_index", "ts", "value")


DAILY = """v_days AS (SELECT token, day, holder, sum(value)::BIGINT AS value FROM (SELECT token, ts // 86400 AS day, to_address AS holder, value FROM v_transfers
  UNION ALL SELECT token, ts // 86400, from_address, -value FROM v_transfers) GROUP BY 1, 2, 3),
v_held AS (SELECT token, day, holder, sum(value) OVER (PARTITION BY token, holder ORDER BY day) > 0 AS held FROM v_days),
v_turns AS (SELECT token, day, held::INTEGER - coalesce(lag(held::INTEGER) OVER (PARTITION BY token, holder ORDER BY day), 0) AS turn FROM v_held),
v_tokens AS (SELECT token, day, sum(turn) AS turns FROM v_turns GROUP BY 1, 2)"""


@query("m10_token_metrics", with_views(f""", {DAILY}, v AS (SELECT token, ts // 86400 AS day, count(*) AS transfers, sum(value)::BIGINT AS volume FROM v_transfers GROUP BY 1, 2)
SELECT token, day, transfers, volume, (sum(coalesce(turns, 0)) OVER (PARTITION BY token ORDER BY day))::BIGINT AS holder_count FROM v LEFT JOIN v_tokens USING (token, day)""", "v_transfers"))
def m10_metrics(spark, sf):
    """Per token and day: transfers, volume and how many hold the token at the day's end."""
    return entities.token_metrics(fx.transfers(spark, sf))


@query("m10_holders_by_block", with_views(""", m AS (SELECT token, block, holder, sum(value)::BIGINT AS value FROM (SELECT token, block, to_address AS holder, value FROM v_transfers
  UNION ALL SELECT token, block, from_address, -value FROM v_transfers) GROUP BY 1, 2, 3),
h AS (SELECT token, block, holder, sum(value) OVER (PARTITION BY token, holder ORDER BY block) > 0 AS held FROM m),
t AS (SELECT token, block, sum(held::INTEGER - coalesce(before::INTEGER, 0)) AS turns FROM (SELECT *, lag(held) OVER (PARTITION BY token, holder ORDER BY block) AS before FROM h) GROUP BY 1, 2)
SELECT token, block, (sum(turns) OVER (PARTITION BY token ORDER BY block))::BIGINT AS holder_count FROM t WHERE turns <> 0""", "v_transfers"))
def m10_by_block(spark, sf):
    """The number of holders of a token at each block where it changes."""
    return entities.holder_counts(fx.transfers(spark, sf), "block", 16)


@query("m10_portfolios", with_views(""", m AS (SELECT token, to_address AS holder, value, ts FROM v_transfers UNION ALL SELECT token, from_address, -value, ts FROM v_transfers)
SELECT holder, token, sum(value)::BIGINT AS balance, min(ts) AS first_interacted, max(ts) AS last_interacted FROM m GROUP BY 1, 2""", "v_transfers"))
def m10_portfolios(spark, sf):
    return entities.portfolios(fx.transfers(spark, sf))


@query("m10_cumulated_fees", with_views(""", f AS (SELECT pool, log_index % 3 AS beneficiary, (amount0_in * 3) // 1000 AS fee0, (amount1_in * 3) // 1000 AS fee1 FROM v_swaps)
SELECT pool, beneficiary, sum(fee0)::BIGINT::VARCHAR AS token0_fees, sum(fee1)::BIGINT::VARCHAR AS token1_fees FROM f GROUP BY 1, 2""", "v_swaps"))
def m10_fees(spark, sf):
    """Fees of pools by beneficiary, batch by batch into a table of totals."""
    f = fx.swaps(spark, sf).selectExpr("pool", "block", "log_index % 3 as beneficiary", "cast(amount0_in * 3 div 1000 as string) as fee0", "cast(amount1_in * 3 div 1000 as string) as fee1")
    return entities.cumulated_fees(f.filter("block % 2 = 1"), entities.cumulated_fees(f.filter("block % 2 = 0")))


@query("m10_token_tables", """WITH f AS (SELECT p_partkey % 150 AS token, count(*) AS pools, min(p_partkey % 500) AS first_block FROM part GROUP BY 1),
b AS (SELECT o_custkey % 7 AS token, count(*) AS transfers FROM orders GROUP BY 1)
SELECT s_suppkey AS token, s_name AS name, coalesce(pools, 0) AS pools, first_block, coalesce(transfers, 0) AS transfers FROM supplier LEFT JOIN f ON f.token = s_suppkey LEFT JOIN b ON b.token = s_suppkey""")
def m10c(spark, sf):
    """A token's page: its pools and transfers beside its own row."""
    token = spark.read.parquet(f"{sf}/supplier.parquet").select(F.col("s_suppkey").alias("token"), F.col("s_name").alias("name"))
    pools = spark.read.parquet(f"{sf}/part.parquet").selectExpr("p_partkey % 150 as token", "p_partkey % 500 as block")
    pools = pools.groupBy("token").agg(F.count(F.lit(1)).alias("pools"), F.min("block").alias("first_block"))
    moves = fx.transfers(spark, sf).groupBy("token").agg(F.count(F.lit(1)).alias("transfers"))
    return token.join(pools, "token", "left").join(moves, "token", "left").na.fill(0, ["pools", "transfers"])


@query("m08_union_with_fallback", """SELECT c_custkey, o_orderkey FROM customer JOIN orders ON o_custkey = c_custkey
UNION ALL SELECT c_custkey, -1 FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c.c_custkey)""")
def m08(spark, sf):
    c, o = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("customer", "orders"))
    have = o.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey").join(c.select("c_custkey"), "c_custkey", "left_semi")
    seeds = c.select("c_custkey", F.lit(-1).cast("bigint").alias("o_orderkey")).join(o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")
    return have.unionByName(seeds)


@query("m09_parallel_arrays", """SELECT o_orderpriority, k, v FROM (SELECT o_orderpriority, unnest(list(o_orderkey ORDER BY o_orderkey)) AS k,
unnest(list(o_custkey ORDER BY o_orderkey)) AS v FROM orders WHERE o_orderstatus IN ('F', 'P') GROUP BY o_orderpriority, o_custkey % 50)""")
def m09(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").filter(F.array_contains(F.array(F.lit("F"), F.lit("P")), F.col("o_orderstatus")))
    g = o.groupBy("o_orderpriority", (F.col("o_custkey") % 50).alias("g")).agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "o_custkey"))).alias("a"))
    return g.select("o_orderpriority", F.explode(F.arrays_zip(F.col("a.o_orderkey").alias("k"), F.col("a.o_custkey").alias("v"))).alias("z")).select("o_orderpriority", F.col("z.k").alias("k"), F.col("z.v").alias("v"))
