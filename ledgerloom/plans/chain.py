"""Scans, matching, decoding, discovery and reorganisations over the projected chain tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions import keccak, words
from ledgerloom.operators import decode, discover, matching, reorg
from ledgerloom.plans.base import query
from ledgerloom.sources import fixtures as fx, scan
from ledgerloom.sources.fixtures import with_views
from ledgerloom.sources.shared import shared_dir

HEX = "lower(lpad(to_hex(user_id), 40, '0'))"


def _hex(n: str, width: int) -> str:
    return f"lower(lpad(hex({n}), {width}, '0'))"


def _events(spark) -> DataFrame:
    """A registry: which event of which contract, from which block."""
    rows = [(u, t, b) for u in range(0, 60, 2) for t, b in (("click", 0), ("purchase", 300))]
    df = spark.createDataFrame(rows, "user_id long, event_type string, start_block long")
    return df.select(F.expr("unhex(lpad(hex(user_id), 40, '0'))").alias("address"), F.expr("unhex(rpad(md5(event_type), 64, '0'))").alias("topic0"), "start_block", F.col("event_type").alias("name"))


@query("a01_scan_blocks", with_views(""", t AS (SELECT max(number) AS top FROM v_blocks)
SELECT number, hash, ts AS timestamp, number % 5 AS transaction_count FROM v_blocks, t WHERE number >= top // 5 AND number < top // 2""", "v_blocks"))
def a01(spark, sf):
    """Whole headers written as block ranges and scanned for a half-open range: only its ranges' files and the asked columns are read (A1)."""
    b = fx.blocks(spark, sf)
    top = b.agg(F.max("number")).first()[0]
    head = b.select("number", F.unhex("hash").alias("hash"), F.unhex("parent_hash").alias("parent_hash"), F.col("ts").alias("timestamp"), (F.col("number") % 5).alias("transaction_count"))
    path, size = f"{shared_dir(spark)}/blocks-{uuid.uuid4().hex}", max(1, top // 64)
    scan.write_ranges(scan.as_table(head, "blocks"), path, size)
    rows = scan.scan(spark, path, "blocks", blocks=(top // 5, top // 2), columns=["number", "hash", "timestamp", "transactions"], range_size=size)
    return rows.select("number", F.lower(F.hex("hash")).alias("hash"), "timestamp", "transaction_count")


@query("a03_scan_receipts", """WITH r AS (SELECT o_orderkey, o_custkey, o_orderkey // 64 AS block FROM orders), t AS (SELECT max(block) AS top FROM r)
SELECT block AS block_number, lower(lpad(to_hex(o_custkey), 40, '0')) AS from_address, count(*) AS n, sum(o_custkey * 21)::BIGINT AS cumulative_gas_used FROM r, t WHERE block >= top // 4 AND block < top * 3 // 4 GROUP BY 1, 2""")
def a03_receipts(spark, sf):
    """Receipts written as block ranges and scanned for a range of blocks (A3)."""
    o = spark.read.parquet(f"{sf}/orders.parquet")
    receipts = o.selectExpr("o_orderkey div 64 as block_number", "unix_timestamp(o_orderdate) as block_timestamp", "unhex(lpad(hex(o_orderkey), 64, '0')) as transaction_hash", "unhex(lpad(hex(o_custkey), 40, '0')) as from_address", "o_custkey * 21 as cumulative_gas_used")
    top = receipts.agg(F.max("block_number")).first()[0]
    path, size = f"{shared_dir(spark)}/receipts-{uuid.uuid4().hex}", max(1, top // 64)
    scan.write_ranges(scan.as_table(receipts, "receipts"), path, size)
    rows = scan.scan(spark, path, "receipts", blocks=(top // 4, top * 3 // 4), columns=["block_number", "from", "cumulative_gas_used"], range_size=size)
    return rows.groupBy("block_number", F.lower(F.hex("from_address")).alias("from_address")).agg(F.count(F.lit(1)).alias("n"), F.sum("cumulative_gas_used").cast("bigint").alias("cumulative_gas_used"))


@query("a03_tx_addresses", """SELECT l.l_orderkey AS transaction_hash, l.l_linenumber, o.o_custkey AS from_address, o.o_custkey % 97 AS to_address
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey AND o.o_orderkey % 4 <> 0""")
def a03(spark, sf):
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_orderkey").alias("transaction_hash"), "l_linenumber")
    receipts = spark.read.parquet(f"{sf}/orders.parquet").where("o_orderkey % 4 <> 0").selectExpr("o_orderkey as transaction_hash", "o_custkey as from_address", "o_custkey % 97 as to_address")
    return scan.tx_addresses(rows, receipts).select("transaction_hash", "l_linenumber", "from_address", "to_address")


@query("a04_factories_as_of", "SELECT event_type AS collection, user_id AS address, min(event_id // 10) AS created_block FROM events WHERE event_id // 10 <= (SELECT max(event_id) FROM events) // 25 GROUP BY 1, 2")
def a04(spark, sf):
    f = spark.read.parquet(f"{sf}/events.parquet").selectExpr("event_type as collection", "user_id as address", "event_id div 10 as block_number")
    return discover.as_of(f, spark.read.parquet(f"{sf}/events.parquet").agg(F.max("event_id")).first()[0] // 25)


def _decoded(spark, sf) -> DataFrame:
    return spark.read.parquet(f"{sf}/events.parquet").selectExpr(
        "concat('src', cast(user_id % 3 as string)) as source_name", "event_type as event_name", "user_id as contract_address",
        "event_id div 10 as block_number", "event_id % 10 as log_index", "event_id")


@query("a06_query_events", "SELECT event_id FROM events WHERE user_id % 3 = 1 AND event_type = 'click' AND event_id // 10 >= (SELECT max(event_id) FROM events) // 200 AND event_id // 10 < (SELECT max(event_id) FROM events) // 15")
def a06(spark, sf):
    top = spark.read.parquet(f"{sf}/events.parquet").agg(F.max("event_id")).first()[0]
    return matching.query_events(_decoded(spark, sf), source="src1", event="click", from_block=top // 200, to_block=top // 15).select("event_id")


@query("a07_query_calls", with_views(" SELECT value FROM v_calls WHERE target = 7 AND block_number >= 20", "v_calls"))
def a07(spark, sf):
    calls = fx.calls(spark, sf).withColumnRenamed("target", "contract_address")
    return matching.query_events(calls, address=7, from_block=20).select("value")


@query("a11_resize_ranges", with_views(" SELECT number, hash, number // 100 AS block_bucket FROM v_blocks", "v_blocks"))
def a11(spark, sf):
    return scan.resize_ranges(fx.blocks(spark, sf).select("number", "hash"), 100)


@query("a11_same_rows", "SELECT c_custkey, 'left' AS side FROM customer WHERE c_custkey % 50 = 0")
def a11b(spark, sf):
    c = spark.read.parquet(f"{sf}/customer.parquet")
    return scan.differing_rows(c, c.filter("c_custkey % 50 <> 0")).select("c_custkey", "side")


@query("a14_settled_ranges", with_views(""", c AS (SELECT number // 49 AS range, count(DISTINCT number) AS n, min(number) AS a, max(number) AS b FROM v_blocks GROUP BY 1)
SELECT range, n FROM c WHERE n = 49 AND a = range * 49 AND b = range * 49 + 48 AND b < (SELECT max(number) FROM v_blocks) - 128""", "v_blocks"))
def a14(spark, sf):
    return reorg.settled_ranges(fx.blocks(spark, sf), 49)


@query("b01_match_logs", with_views(""" SELECT event_id, event_type AS name FROM v_logs WHERE has_topics AND emitter % 2 = 0 AND emitter < 60
AND (event_type = 'click' OR (event_type = 'purchase' AND block_number >= 300))""", "v_logs"))
def b01(spark, sf):
    return matching.match_events(fx.logs(spark, sf), _events(spark)).select("event_id", "name")


def _created(spark, sf) -> DataFrame:
    return spark.read.parquet(f"{sf}/events.parquet").where("user_id % 4 = 1").selectExpr("'coins' as collection", "unhex(lpad(hex(user_id), 40, '0')) as address", "event_id div 10 as block_number").groupBy("collection", "address").agg(F.max("block_number").alias("created_block"))


@query("b02_match_factory_logs", with_views(" SELECT event_id, emitter FROM v_logs WHERE has_topics AND emitter % 4 = 1 AND event_type = 'view'", "v_logs"))
def b02(spark, sf):
    events = spark.createDataFrame([("coins", "view")], "collection string, t string").select("collection", F.expr("unhex(rpad(md5(t), 64, '0'))").alias("topic0"))
    return matching.match_factory_events(fx.logs(spark, sf), events, _created(spark, sf)).select("event_id", "emitter")


@query("b03_skip_topicless", with_views(" SELECT event_id FROM v_logs WHERE has_topics", "v_logs"))
def b03(spark, sf):
    return matching.topic0(fx.logs(spark, sf)).select("event_id")


@query("b04_prefilter_addresses", with_views(" SELECT event_id FROM v_logs WHERE emitter % 4 = 1 OR (emitter % 2 = 0 AND emitter < 60)", "v_logs"))
def b04(spark, sf):
    return matching.from_known(fx.logs(spark, sf), _created(spark, sf), _events(spark)).select("event_id")


@query("b05_triggers", with_views(" SELECT event_id, 'any' AS source FROM v_logs WHERE has_topics AND event_type IN ('click', 'view') UNION ALL SELECT event_id, 'one' FROM v_logs WHERE has_topics AND event_type = 'click' AND emitter = 4", "v_logs"))
def b05(spark, sf):
    rows = [(None, "click", "any", 0), (None, "view", "any", 0), (4, "click", "one", 10), (4, "click", "one", 0)]
    m = spark.createDataFrame(rows, "u long, t string, source string, start_block long").select(
        F.expr("unhex(lpad(hex(u), 40, '0'))").alias("address"), F.expr("unhex(rpad(md5(t), 64, '0'))").alias("topic0"), "source", "start_block")
    return matching.triggers(fx.logs(spark, sf), m).select("event_id", "source")


@query("b06_events_of_type", "SELECT event_id FROM events WHERE user_id % 3 = 2 AND event_type = 'view' AND event_id // 10 >= 100 AND user_id = 5")
def b06(spark, sf):
    return matching.of_type(_decoded(spark, sf), "src2", "view", 100, F.lit(5)).select("event_id")


@query("b07_precompiles", with_views(" SELECT log_index FROM v_transfers WHERE from_address NOT BETWEEN 1 AND 17 AND to_address NOT BETWEEN 1 AND 17", "v_transfers"))
def b07(spark, sf):
    return fx.transfers(spark, sf).filter(matching.not_precompiled("from_address", "to_address")).select("log_index")


@query("b08_not_reverted", with_views(" SELECT value FROM v_calls WHERE NOT is_reverted", "v_calls"))
def b08(spark, sf):
    return matching.not_reverted(fx.calls(spark, sf)).select("value")


RANGES = """SELECT range_index * 10 AS start, range_index * 10 + 10 AS "end", handler AS source, CASE WHEN range_index % 2 = 0 THEN 'f' ELSE 'g' END AS function FROM v_progress"""


def _ranges(spark, sf) -> DataFrame:
    return fx.progress(spark, sf).selectExpr("range_index * 10 as start", "range_index * 10 + 10 as end", "handler as source", "if(range_index % 2 = 0, 'f', 'g') as function")


@query("b09_repair_scope", with_views(f", r AS ({RANGES}) SELECT * FROM r WHERE \"end\" - 1 >= 90000 AND start <= 92000 AND source IN ('1-URGENT', '2-HIGH') AND function = 'f'", "v_progress"))
def b09(spark, sf):
    return matching.repair_scope(_ranges(spark, sf), from_block=90_000, to_block=92_000, sources=("1-URGENT", "2-HIGH"), functions=("f",))


@query("b10_overlapping_files", with_views(f", r AS ({RANGES}) SELECT * FROM r WHERE \"end\" >= 92005 AND start < 94005", "v_progress"))
def b10(spark, sf):
    return matching.overlapping(_ranges(spark, sf), 92_005, 94_005)


@query("b11_role_from_address", """SELECT s_suppkey, CASE WHEN s_nationkey % 2 = 0 THEN 'v2' WHEN s_nationkey % 3 = 0 THEN 'v4' ELSE 'unknown' END AS role FROM supplier""")
def b11(spark, sf):
    s = spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey", "s_nationkey")
    n = spark.read.parquet(f"{sf}/nation.parquet").select(F.col("n_nationkey").alias("address"))
    roles = n.filter("address % 2 = 0").withColumn("role", F.lit("v2")).withColumn("priority", F.lit(0)).unionByName(n.filter("address % 3 = 0").withColumn("role", F.lit("v4")).withColumn("priority", F.lit(1)))
    return matching.role_of(s, "s_nationkey", roles).select("s_suppkey", "role")


@query("b12_token_order", "SELECT p_partkey, unhex(lpad(to_hex(p_partkey), 8, '0')) < unhex(lpad(to_hex(p_size * 20), 8, '0')) AS is_token_0 FROM part")
def b12(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet")
    return p.select("p_partkey", matching.is_token0(F.expr("unhex(lpad(hex(p_partkey), 8, '0'))"), F.expr("unhex(lpad(hex(p_size * 20), 8, '0'))")).alias("is_token_0"))


EVENT = decode.parse_event("Priced(address indexed user, uint64 cents, uint64 id)")


@query("c02_decode_static", with_views(" SELECT block_number, log_index, lower(lpad(to_hex(emitter), 40, '0')) AS user, round(value * 100)::BIGINT::DECIMAL(20,0) AS cents, event_id::DECIMAL(20,0) AS id FROM v_logs WHERE has_topics", "v_logs"))
def c02_c03(spark, sf):
    """Topics and data words to typed columns in signature order, natively."""
    good, _ = decode.decode_static(fx.logs(spark, sf), EVENT)
    return good.select("block_number", "log_index", F.lower(F.hex("user")).alias("user"), "cents", "id")


@query("c06_rejected_logs", with_views(" SELECT block_number, log_index FROM v_logs WHERE NOT has_topics", "v_logs"))
def c06(spark, sf):
    return decode.decode_static(fx.logs(spark, sf), EVENT)[1].select("block_number", "log_index")


@query("c12_lenient_numbers", """SELECT event_id, CASE WHEN try_cast(props->>'$.k' AS BIGINT) BETWEEN 0 AND 255 THEN try_cast(props->>'$.k' AS BIGINT)::DECIMAL(20,0) END AS k, CASE WHEN round(value * 1000) BETWEEN -32768 AND 32767 THEN round(value * 1000)::DECIMAL(20,0) END AS v FROM events""")
def c12(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    return e.select("event_id", words.narrow(F.get_json_object("props", "$.k"), 8).alias("k"), words.narrow(F.round(F.col("value") * 1000).cast("bigint").cast("string"), 16, signed=True).alias("v"))


INDEXED = decode.parse_event("Created((uint24 fee, int24 spacing) indexed key, uint64 id)")


@query("c07_indexed_tuple", "SELECT p_partkey AS block_number, md5(p_name) || md5(p_name) AS hash, p_size::DECIMAL(20,0) AS id FROM part")
def c07(spark, sf):
    """An indexed tuple is there by its hash alone."""
    p = spark.read.parquet(f"{sf}/part.parquet")
    topics = F.array(F.unhex(F.lit(INDEXED["topic0"].hex())), F.unhex(F.concat(F.md5("p_name"), F.md5("p_name"))))
    data = F.unhex(F.lpad(F.hex(F.col("p_size").cast("bigint")), 64, "0"))
    logs = p.select(F.col("p_partkey").alias("block_number"), F.lit(0).alias("log_index"), F.unhex(F.lit("11" * 20)).alias("address"), topics.alias("topics"), data.alias("data"))
    return decode.decode_static(logs, INDEXED)[0].select("block_number", F.lower(F.hex(F.col("`key.hash`"))).alias("hash"), "id")


@query("c10_named_results", """SELECT s_suppkey AS address, s_nationkey::DECIMAL(20,0) AS decimals, NULL::VARCHAR AS "name", NULL::DECIMAL(20,0) AS "config.fee" FROM supplier
UNION ALL SELECT s_suppkey, NULL, s_name, (s_nationkey * 2)::DECIMAL(20,0) FROM supplier""")
def c10(spark, sf):
    """Results under their names: a lone scalar by its function, named values and the fields of tuples by theirs."""
    word = lambda c: F.lpad(F.hex(c.cast("bigint")), 64, "0")
    s = spark.read.parquet(f"{sf}/supplier.parquet").select(F.col("s_suppkey").alias("address"), "s_nationkey", "s_name")
    scalar, named = decode.parse_event("f(uint64)")["params"], decode.parse_event("f(string name, (uint64 fee) config)")["params"]
    text = F.hex(F.encode("s_name", "UTF-8"))
    one = s.select("address", F.unhex(word(F.col("s_nationkey"))).alias("data"))
    two = s.select("address", F.unhex(F.concat(F.lit("40".rjust(64, "0")), word(F.col("s_nationkey") * 2), word(F.octet_length("s_name")), F.rpad(text, 64 * 2, "0"))).alias("data"))
    read = lambda df, f, p: decode.decode_dynamic(df, p, keep=("address",)).toDF("address", *decode.result_names(f, p))
    return read(one, "decimals", scalar).unionByName(read(two, "getConfig", named), allowMissingColumns=True)


@query("c12_flexible_numbers", """SELECT event_id, (event_id::HUGEINT * 1000000000000000000)::VARCHAR AS wide, CASE WHEN event_id % 2 = 0 THEN '-' || (event_id * 7 + 1)::VARCHAR ELSE (event_id * 7 + 1)::VARCHAR END AS signed,
CASE WHEN event_id % 2 <> 0 THEN (event_id * 7 + 1)::VARCHAR END AS unsigned FROM events""")
def c12_flexible(spark, sf):
    """Numbers of narrower types and numeric text as 256-bit integers; a negative one is no unsigned number."""
    e = spark.read.parquet(f"{sf}/events.parquet").select("event_id", F.concat(F.when(F.col("event_id") % 2 == 0, "-").otherwise("+"), F.lit("00"), F.col("event_id") * 7 + 1).alias("t"))
    zeros = F.concat(F.col("event_id").cast("string"), F.lit("0" * 18))
    return e.select("event_id", words.flexible(zeros).alias("wide"), words.flexible(F.col("t"), signed=True).alias("signed"), words.flexible(F.col("t")).alias("unsigned"))


@query("c14_strip_nul", "SELECT c_custkey, c_name AS name FROM customer")
def c14(spark, sf):
    c = spark.read.parquet(f"{sf}/customer.parquet")
    return c.select("c_custkey", words.strip_nul(F.concat(F.lit("\u0000"), F.col("c_name"), F.lit("\u0000"))).alias("name"))


@query("c15_hex_text", "SELECT c_custkey, '0x' || lower(lpad(to_hex(c_custkey), 40, '0')) AS address FROM customer")
def c15(spark, sf):
    c = spark.read.parquet(f"{sf}/customer.parquet")
    return c.select("c_custkey", words.show(words.unshow(F.expr("concat('0x', lpad(hex(c_custkey), 40, '0'))"))).alias("address"))


@query("c01_topic_hashes")
def c01(spark, sf):
    """Signatures made of the event types, hashed once per distinct signature (no hash of this kind in SQL)."""
    e = spark.read.parquet(f"{sf}/events.parquet").select("event_id", F.concat(F.initcap("event_type"), F.lit("(address,uint256)")).cast("binary").alias("signature"))
    return keccak.with_hash(e, "signature", "topic0").select("event_id", words.show(F.col("topic0")).alias("topic0"))


@query("c04_decode_dynamic", "SELECT c_custkey AS block_number, 0 AS log_index, c_nationkey AS address, c_name AS name, c_custkey::DECIMAL(20,0) AS id FROM customer")
def c04(spark, sf):
    """Customer names as encoded strings with an amount, decoded in Arrow batches."""
    c = spark.read.parquet(f"{sf}/customer.parquet")
    text = F.hex(F.encode("c_name", "UTF-8"))
    data = F.unhex(F.concat(F.lit("40".rjust(64, "0")), F.lpad(F.hex("c_custkey"), 64, "0"), F.lpad(F.hex(F.octet_length("c_name").cast("bigint")), 64, "0"), F.rpad(text, 64 * 3, "0")))
    rows = c.select(F.col("c_custkey").alias("block_number"), F.lit(0).alias("log_index"), F.col("c_nationkey").alias("address"), data.alias("data"))
    return decode.decode_dynamic(rows, decode.parse_event("Named(string name, uint64 id)")["params"])


@query("c13_pool_ids")
def c13(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet")
    a = lambda n: F.expr(f"unhex(lpad(hex({n}), 40, '0'))")
    keys = p.select("p_partkey", a("p_size").alias("currency0"), a("p_size + 1").alias("currency1"), (F.col("p_size") * 100).alias("fee"), (F.col("p_size") - 25).alias("tick_spacing"), a("7L").alias("hooks"))
    return decode.pool_ids(keys).select("p_partkey", words.show(F.col("pool_id")).alias("pool_id"))


@query("d01_created_addresses", with_views(""" SELECT collection, lower(lpad(to_hex(a), 40, '0')) AS address, min(block_number) AS created_block FROM
(SELECT 'topic' AS collection, emitter AS a, block_number FROM v_logs WHERE has_topics AND event_type = 'click' AND emitter = 3
UNION ALL SELECT 'data', event_id, block_number FROM v_logs WHERE has_topics AND event_type = 'view' AND emitter = 3) GROUP BY 1, 2""", "v_logs"))
def d01(spark, sf):
    m = spark.createDataFrame([(3, "click", "topic", "topic", 1), (3, "view", "data", "data", 1)], "u long, t string, collection string, place string, index int")
    m = m.select(F.expr("unhex(lpad(hex(u), 40, '0'))").alias("address"), F.expr("unhex(rpad(md5(t), 64, '0'))").alias("topic0"), "collection", "place", "index")
    return discover.created(fx.logs(spark, sf), m).select("collection", F.lower(F.hex("address")).alias("address"), "created_block")


@query("d01_nested_data", """SELECT 'coins' AS collection, lower(lpad(to_hex(a), 40, '0')) AS address, min(b) AS created_block FROM
(SELECT l_orderkey AS b, list(l_partkey ORDER BY l_linenumber, l_partkey) AS l FROM lineitem GROUP BY 1), LATERAL (SELECT l[2] AS a) WHERE len(l) > 1 GROUP BY 2""")
def d01_nested(spark, sf):
    """Addresses at data[0][1]: the second element of an array that the first word points to."""
    line = spark.read.parquet(f"{sf}/lineitem.parquet").groupBy(F.col("l_orderkey").alias("block_number")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("l"))
    word = lambda c: F.lpad(F.hex(c.cast("bigint")), 64, "0")
    data = F.unhex(F.concat(F.lit("20".rjust(64, "0")), word(F.size("l")), F.array_join(F.transform("l", lambda x: word(x["l_partkey"])), "")))
    factory, topic = F.unhex(F.lit("11" * 20)), F.unhex(F.lit("22" * 32))
    logs = line.select("block_number", F.lit(0).alias("log_index"), factory.alias("address"), F.array(topic).alias("topics"), data.alias("data"))
    m = spark.createDataFrame([("coins", "data", 0, 1, True)], "collection string, place string, index int, inner int, dynamic_array boolean").withColumns({"address": factory, "topic0": topic})
    return discover.created(logs, m).select("collection", F.lower(F.hex("address")).alias("address"), "created_block")


@query("d03_collection_sizes", "SELECT event_type AS collection, count(DISTINCT user_id) AS addresses FROM events GROUP BY 1")
def d03(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").selectExpr("event_type as collection", "user_id as address")
    return discover.collection_sizes(e).select("collection", "addresses")


@query("d04_uncovered", """WITH e AS (SELECT DISTINCT user_id AS address, event_id // 100 AS range FROM events) SELECT * FROM e
EXCEPT SELECT user_id, event_id // 100 FROM events WHERE event_type = 'click'""")
def d04(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").selectExpr("user_id as address", "event_id div 100 as range", "event_type")
    return discover.uncovered(e.select("address", "range").distinct(), e.filter("event_type = 'click'").select("address", "range").distinct(), ["address", "range"])


@query("d05_seen_contracts", "SELECT DISTINCT lower(lpad(to_hex(user_id), 40, '0')) AS address, event_id // 10 // 20 AS range FROM events WHERE user_id < 60 AND user_id % 2 = 0")
def d05(spark, sf):
    return discover.seen_contracts(fx.logs(spark, sf), _events(spark), 20).select(F.lower(F.hex("address")).alias("address"), "range")


@query("l01_broken_links", with_views(" SELECT b.number, b.parent_hash, p.hash AS before FROM v_blocks b JOIN v_blocks p ON p.number = b.number - 1 WHERE b.parent_hash <> p.hash", "v_blocks"))
def l01(spark, sf):
    return reorg.broken_links(fx.blocks(spark, sf)).select("number", "parent_hash", "before")


def _fork(spark, sf) -> DataFrame:
    """Every run of blocks between holes as a chain, each with a second branch, from its 30th to its 40th block, that dies."""
    b = fx.blocks(spark, sf).select(F.expr("number div 50").alias("chain"), "number", "hash", F.expr("md5(cast(number - 1 as string))").alias("parent_hash"))
    own = F.col("number") % 50
    branch = F.when(own == 30, F.col("parent_hash")).otherwise(F.concat("parent_hash", F.lit("s")))
    side = b.filter(own.between(30, 40)).select("chain", "number", F.concat("hash", F.lit("s")).alias("hash"), branch.alias("parent_hash"))
    return b.unionByName(side)


@query("l06_canonical_chain", "SELECT event_id AS number, md5(event_id::VARCHAR) AS hash FROM events WHERE event_id % 50 <> 49")
def l06(spark, sf):
    return reorg.canonical(_fork(spark, sf), chain="chain").select("number", "hash")


@query("l02_orphans", "SELECT event_id AS number, md5(event_id::VARCHAR) || 's' AS hash FROM events WHERE event_id % 50 BETWEEN 30 AND 40")
def l02_orphans(spark, sf):
    f = _fork(spark, sf)
    return reorg.orphans(f, reorg.canonical(f, chain="chain").drop("chain")).select("number", "hash")


@query("l02_retract_orphans", "SELECT event_id, event_id AS block FROM events WHERE event_id % 50 NOT BETWEEN 30 AND 40")
def l02(spark, sf):
    """Derived rows without those of blocks that an orphaned branch touched."""
    f = _fork(spark, sf)
    gone = reorg.orphans(f, reorg.canonical(f, chain="chain").drop("chain"))
    return reorg.retract(spark.read.parquet(f"{sf}/events.parquet").selectExpr("event_id", "event_id as block"), gone).select("event_id", "block")


def _images(spark, sf):
    target = spark.read.parquet(f"{sf}/customer.parquet").selectExpr("c_custkey as pool", "c_nationkey as v")
    first = target.filter("pool % 3 = 0").selectExpr("pool", "v + 100 as v", "10 as b")
    second = target.filter("pool % 6 = 0").selectExpr("pool", "v + 200 as v", "20 as b").unionByName(target.limit(0).selectExpr("pool", "v", "20 as b"))
    return target, first, second


@query("l03_roll_back", "SELECT c_custkey AS pool, c_nationkey AS v FROM customer")
def l03_l05(spark, sf):
    """Capture images over two updates, one of them inserting a key, and roll both back."""
    from ledgerloom.operators.merge import overwrite

    target, first, second = _images(spark, sf)
    keys = ["pool"]
    new = spark.range(1).select((F.lit(-1)).cast("bigint").alias("pool"), F.lit(5).alias("v"), F.lit(20).alias("b"))
    second = second.unionByName(new)
    images = reorg.capture_images(target, first, keys, "b")
    after = overwrite(target, first.drop("b"), keys, ["v"])
    images = images.unionByName(reorg.capture_images(after, second, keys, "b"))
    final = overwrite(after, second.drop("b"), keys, ["v"])
    return reorg.roll_back(final, images, spark.range(10, 21).withColumnRenamed("id", "number"), keys)


@query("l04_uncovered_deletes", """SELECT t AS "table", o_orderkey AS block FROM orders, (VALUES ('swaps'), ('prices')) v(t) WHERE NOT (t = 'swaps' AND o_orderkey % 2 = 0)""")
def l04(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    images = o.filter("o_orderkey % 2 = 0").select(F.lit("swaps").alias("table"), F.col("o_orderkey").alias("changed_at"))
    tables = spark.createDataFrame([("swaps",), ("prices",)], "table string")
    return reorg.uncovered_deletes(tables, o.select(F.col("o_orderkey").alias("number")), images)


@query("l09_waiting_events", with_views(""" SELECT l.event_id, CASE WHEN c.value IS NOT NULL THEN 'ready' WHEN (SELECT max(block_timestamp) FROM v_logs) - l.block_timestamp > 300 THEN 'backlog' ELSE 'waiting' END AS state
FROM v_logs l LEFT JOIN v_calls c USING (block_number, log_index)""", "v_logs", "v_calls"))
def l09(spark, sf):
    events = fx.logs(spark, sf).select("block_number", "log_index", "event_id", F.col("block_timestamp").alias("ts"))
    now = events.agg(F.max("ts")).first()[0]
    return reorg.waiting(events, fx.calls(spark, sf), now).select("event_id", "state")


@query("l10_stuck_blocks", """SELECT o_custkey AS number, list_sort(list_filter(['1-URGENT', '2-HIGH', '3-MEDIUM'], lambda x: NOT list_contains(list(DISTINCT o_orderpriority), x))) AS missing
FROM orders GROUP BY o_custkey HAVING len(list_filter(['1-URGENT', '2-HIGH', '3-MEDIUM'], lambda x: NOT list_contains(list(DISTINCT o_orderpriority), x))) > 0""")
def l10(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").groupBy(F.col("o_custkey").alias("number")).agg(F.collect_set("o_orderpriority").alias("done"))
    return reorg.stuck(o.withColumn("ts", F.lit(0)).withColumn("inputs_ready", F.lit(True)), ["1-URGENT", "2-HIGH", "3-MEDIUM"], 1000, 100).select("number", "missing")


@query("l11_status_complete", "SELECT o_orderkey, (NOT (o_custkey % 2 = 0) OR o_orderstatus = 'F') AND (NOT (o_custkey % 3 = 0) OR o_orderstatus = 'O') AS complete FROM orders")
def l11(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").selectExpr("o_orderkey", "o_orderstatus = 'F' as logs", "o_custkey % 2 = 0 as expect_logs", "o_orderstatus = 'O' as calls", "o_custkey % 3 = 0 as expect_calls")
    return reorg.complete(o, ["logs", "calls"]).select("o_orderkey", "complete")


@query("l13_idempotent_replay", "SELECT DISTINCT l_orderkey AS block, l_linenumber AS log_index FROM lineitem")
def l13(spark, sf):
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("1 as chain_id", "l_orderkey as block", "l_linenumber as log_index")
    return reorg.first_per_log(rows.unionByName(rows)).select("block", "log_index")
