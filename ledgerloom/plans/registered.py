"""The contract registry as it lies on disk, and call results with nested values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.functions import keccak, words
from ledgerloom.operators import decode, discover, tvl
from ledgerloom.plans.base import query
from ledgerloom.plans.ranges import _word
from ledgerloom.sources import registry as R

#: Per contract its addresses and first block.
ADDRESSES = """a AS (SELECT s_name AS contract, s_nationkey * 10 AS start_block, s_suppkey, unnest(CASE WHEN s_suppkey % 2 = 0 THEN [s_suppkey, s_suppkey + 100] ELSE [s_suppkey] END) AS address FROM supplier)"""


def _files(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as the contracts of a registry file per nation, in the forms that a file may have: one address or several, an event by
    itself or a list, a factory with one or two creation events."""
    s = spark.read.parquet(f"{sf}/supplier.parquet")
    address = lambda c: F.concat(F.lit("0x"), F.lpad(F.hex(F.expr(c)), 40, "0"))
    event = lambda kind, name=None: F.struct(F.lit(name).alias("name"), F.lit(f"{kind}(address indexed user, uint256 value)").alias("signature"))
    hook = lambda kind: F.struct(
        F.lit(kind).alias("name"), F.lit("address").alias("topics_signature"), F.lit("uint256,(uint256,address)").alias("data_signature"), F.lit("data[1][1]").alias("factory_parameters"))
    factory = lambda events: F.array(F.struct(F.lit("made").alias("collection_name"), events.alias("factory_events")))
    base = (F.expr("s_nationkey * 10").alias("start_block"),)
    one = F.to_json(F.struct(address("s_suppkey").alias("address"), *base, F.array(event("View", "Seen"), event("Purchase")).alias("events"), factory(hook("Signup")).alias("factories")))
    two = F.to_json(F.struct(F.array(address("s_suppkey"), address("s_suppkey + 100")).alias("address"), *base, event("Click").alias("events"), factory(F.array(hook("Signup"), hook("Error"))).alias("factories")))
    entry = F.concat(F.to_json(F.struct(F.col("s_name").alias("n"))).substr(F.lit(6), F.length("s_name") + 2), F.lit(":"), F.when(F.col("s_suppkey") % 2 == 0, two).otherwise(one))
    files = s.groupBy(F.col("s_nationkey").cast("string").alias("chain")).agg(F.array_join(F.collect_list(entry), ",").alias("v"))
    return files.select("chain", F.concat(F.lit("{"), "v", F.lit("}")).alias("value"))


def _logs(spark: SparkSession, sf: str, types: str) -> DataFrame:
    """Events as logs of their users, topic0 the hash of the event type with these types; data: amount, 7, the event as an address."""
    e = spark.read.parquet(f"{sf}/events.parquet").withColumn("signature", F.concat(F.initcap("event_type"), F.lit(f"({types})")).cast("binary"))
    e = keccak.with_hash(e, "signature", "topic0")
    data = F.unhex(F.concat(_word(F.round(F.col("value") * 100).cast("bigint")), _word(F.lit(7)), _word("event_id")))
    return e.select(
        "event_id", F.expr("event_id div 10").alias("block_number"), F.expr("event_id % 10").alias("log_index"), F.unhex(F.lpad(F.hex("user_id"), 40, "0")).alias("address"),
        F.array("topic0", F.unhex(_word("user_id"))).alias("topics"), data.alias("data"))


@query("a08_registry_events", f"""WITH {ADDRESSES}, l(odd, kind, name) AS (VALUES (0, 'click', 'Click'), (1, 'view', 'Seen'), (1, 'purchase', 'Purchase'))
SELECT event_id, contract, name FROM events JOIN a ON user_id = address JOIN l ON event_type = kind AND odd = s_suppkey % 2 WHERE event_id // 10 >= start_block""")
def a08_events(spark, sf):
    """Logs of the registered contracts' events."""
    matchers = R.event_matchers(R.registry(_files(spark, sf)))
    return R.match_registry(_logs(spark, sf, "address,uint256"), matchers).select("event_id", "contract", "name")


@query("a08_registry_created", f"""WITH {ADDRESSES} SELECT 'made' AS collection, lower(lpad(to_hex(event_id), 40, '0')) AS address, min(event_id // 10) AS created_block FROM events JOIN a ON user_id = address
WHERE event_id // 10 >= start_block AND (event_type = 'signup' OR event_type = 'error' AND s_suppkey % 2 = 0) GROUP BY ALL""")
def a08_created(spark, sf):
    """Addresses that the registered factories' creation events hold in a member of a tuple in place: once each, from their first block, also
    where several contracts have one factory address."""
    matchers = R.factory_matchers(R.registry(_files(spark, sf)))
    found = discover.created(_logs(spark, sf, "address,uint256,(uint256,address)"), matchers)
    return found.select("collection", F.lower(F.hex("address")).alias("address"), "created_block")


@query("a08_registry_calls", """SELECT s_name AS contract, CASE WHEN s_suppkey % 3 = 0 THEN 'once' WHEN s_suppkey % 3 = 1 THEN '15m' ELSE 'on_events' END AS frequency,
CASE WHEN s_suppkey % 3 = 2 THEN 1 + s_suppkey % 2 ELSE 0 END AS triggers, CASE s_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'self' ELSE 'topics[1]' END AS bound FROM supplier""")
def a08_calls(spark, sf):
    """Calls of any frequency, set off by one event or several, their parameters bound to the contract or to an event."""
    s = spark.read.parquet(f"{sf}/supplier.parquet")
    trigger = F.struct(F.col("s_name").alias("source"), F.lit("Swap(int24)").alias("event"))
    call = lambda frequency, **bound: F.struct(
        F.lit("f(address)").alias("function"), F.lit("uint256").alias("output_type"), frequency.alias("frequency"),
        F.array(F.struct(F.lit("address").alias("type"), *[F.lit(v).alias(k) for k, v in bound.items()])).alias("params"))
    on = lambda t: F.struct(t.alias("on_events"))
    contract = lambda c: F.to_json(F.struct(F.lit("0x" + "0f" * 20).alias("address"), F.array(c).alias("calls")))
    forms = [contract(F.struct(F.lit("f(address)").alias("function"), F.lit("uint256").alias("output_type"))), contract(call(F.lit("15M"), source="self")),
             contract(call(on(trigger), from_event="topics[1]")), contract(call(on(F.array(trigger, trigger)), from_event="topics[1]"))]
    kind = F.col("s_suppkey") % 3
    value = F.when(kind == 0, forms[0]).when(kind == 1, forms[1]).when(F.col("s_suppkey") % 2 == 0, forms[2]).otherwise(forms[3])
    files = s.select(F.lit("c").alias("chain"), F.concat(F.lit('{"'), "s_name", F.lit('":'), value, F.lit("}")).alias("value"))
    calls = R.registry(files)["calls"]
    first = F.get("params", F.lit(0))
    return calls.select("contract", "frequency", F.coalesce(F.size("triggers"), F.lit(0)).alias("triggers"), F.coalesce(first["from_event"], first["source"]).alias("bound"))


POSITIONS = decode.parse_event("getPositions((int24 tickLower, int24 tickUpper, uint128 liquidity)[] positions, (string label, uint256[] fees)[] notes)")["params"]


def _signed(c: Column) -> Column:
    """A signed long as a word."""
    return F.concat(F.when(c < 0, F.lit("F" * 48)).otherwise(F.lit("0" * 48)), F.lpad(F.hex(c.cast("bigint")), 16, "0"))


def _results(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as the results of a call: a position per line, and two notes with a label and its fees."""
    line = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.col("l_orderkey").alias("block_number"),
        F.concat(_signed(F.col("l_suppkey") % 10 * 60 - 300), _signed(F.col("l_suppkey") % 10 * 60 + 300), _word(F.col("l_quantity").cast("bigint"))).alias("w"))
    both = line.groupBy("block_number").agg(F.collect_list("w").alias("w"))
    n = F.size("w")
    note = lambda label, fees: F.concat(  # noqa: E731  offsets of the label and the fees, the label, the fees
        _word(F.lit(64)), _word(F.lit(128)), _word(F.lit(len(label))), F.lit(label.encode().hex().ljust(64, "0")), _word(F.lit(len(fees))), *[_word(f) for f in fees])
    first, second = note("up", [F.col("block_number")]), note("down", [F.col("block_number") + 1, F.lit(0)])
    notes = F.concat(_word(F.lit(2)), _word(F.lit(64)), _word(F.lit(64 + 32 * 6)), first, second)
    data = F.concat(_word(F.lit(64)), _word(n * 96 + 96), _word(n), F.array_join("w", ""), notes)
    return both.select("block_number", F.lit(0).alias("log_index"), F.lit(0).alias("address"), F.unhex(data).alias("data"))


@query("c11_position_structs", """SELECT l_orderkey AS block_number, (l_suppkey % 10 * 60 - 300)::BIGINT AS tick_lower, (l_suppkey % 10 * 60 + 300)::BIGINT AS tick_upper, l_quantity::BIGINT::VARCHAR AS liquidity, count(*) AS n FROM lineitem GROUP BY ALL""")
def c11_structs(spark, sf):
    """Arrays of tuples as arrays of structs, a row per position."""
    p = decode.decode_dynamic(_results(spark, sf), POSITIONS).select("block_number", F.explode("positions").alias("p"))
    return p.groupBy("block_number", F.col("p.tickLower").alias("tick_lower"), F.col("p.tickUpper").alias("tick_upper"), F.col("p.liquidity").alias("liquidity")).agg(F.count(F.lit(1)).alias("n"))


@query("c11_nested_arrays", """SELECT DISTINCT l_orderkey AS block_number, label, fee::VARCHAR AS fee FROM lineitem, LATERAL (VALUES ('up', l_orderkey), ('down', l_orderkey + 1), ('down', 0)) n(label, fee)""")
def c11_nested(spark, sf):
    """Text and arrays within tuples within arrays."""
    n = decode.decode_dynamic(_results(spark, sf), POSITIONS).select("block_number", F.explode("notes").alias("n"))
    return n.select("block_number", F.col("n.label").alias("label"), F.explode("n.fees").alias("fee"))


@query("k07_decoded_positions", """SELECT l_orderkey AS pool, sum(l_quantity::BIGINT)::VARCHAR AS active_liquidity FROM lineitem WHERE l_suppkey % 10 * 60 - 300 <= 0 AND 0 < l_suppkey % 10 * 60 + 300
GROUP BY l_orderkey""")
def k07_decoded(spark, sf):
    """The value of positions as they are decoded: liquidity that is active at tick 0."""
    got = decode.decode_dynamic(_results(spark, sf), POSITIONS)
    place = lambda p: F.struct(p["tickLower"].cast("int").alias("tick_lower"), p["tickUpper"].cast("int").alias("tick_upper"), p["liquidity"].alias("liquidity"))
    calls = got.select(F.col("block_number").alias("pool"), F.lit(0).alias("block"), F.lit(0).alias("tick"), F.lit(str(1 << 96)).alias("sqrt_price"), F.transform("positions", place).alias("positions"))
    return tvl.embedded_totals(calls).filter("active_liquidity <> '0'").select("pool", "active_liquidity")
