import json
import os
import random
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import Window, functions as F

from ledgerloom.functions import words
from ledgerloom.operators import calls, decode, discover, entities, merge, ohlc, pricing, reorg, swaps, tvl
from ledgerloom.plans import catalogue, contracts
from ledgerloom.sources import registry, scan
from ledgerloom.streaming import streams

SWAP = "pool long, block long, ts long, log_index long, amount0 long, amount1 long, price double"


def test_block_ohlc_of_three_swaps(spark):
    rows = [(1, 1, 0, 0, 10, -20, 2.0), (1, 1, 0, 1, 5, -15, 3.0), (1, 1, 0, 2, 20, -20, 1.0), (2, 1, 0, 0, 100, -150, 1.5), (3, 1, 0, 0, 5, 5, None)]
    got = {r["pool"]: r for r in ohlc.block_ohlc(spark.createDataFrame(rows, SWAP)).collect()}
    r = got[1]
    assert (r["price_open"], r["price_close"], r["price_high"], r["price_low"], r["volume0"], r["volume1"], r["swap_count"]) == (2, 1, 3, 1, 35, 55, 3)
    r = got[2]
    assert (r["price_open"], r["price_close"], r["volume0"], r["volume1"]) == (1.5, 1.5, 100, 150)
    assert 3 not in got


def test_hook_swaps(spark):
    events = spark.createDataFrame([(1, 5, "a"), (2, 5, "b"), (3, 1, "c"), (4, 1, "d")], "block long, log_index long, e string")
    state = spark.createDataFrame([(1, 5, 10, False), (2, 5, 20, None), (3, 1, 30, True)], "block long, log_index long, value long, is_reverted boolean")
    got = {r["e"]: (r["slot0"], r["missing"]) for r in swaps.hook_swaps(events, state.na.fill(False)).collect()}
    assert got == {"a": (10, False), "b": (20, False), "d": (None, True)}
    with pytest.raises(Exception, match="no pool state"):
        swaps.hook_swaps(events, state.na.fill(False), strict=True).collect()


def test_cumulative_totals_restart(spark):
    rows = [(1, 1, 0, 5), (1, 2, 0, 9), (1, 3, 0, 4), (2, 1, 0, 7)]
    seed = spark.createDataFrame([(1, 3)], "pool long, t long")
    got = swaps.cumulative_to_delta(spark.createDataFrame(rows, "pool long, block long, log_index long, t long"), ["t"], seed).orderBy("pool", "block").collect()
    assert [r["t_delta"] for r in got] == [2, 4, 4, 7]
    many = spark.createDataFrame([(1, b, i, 100 * b + 7 * i) for b in range(0, 90, 4) for i in range(3)], "pool long, block long, log_index long, t long")
    small, large = (swaps.cumulative_to_delta(many, ["t"], bucket=n) for n in (7, 10_000))
    assert scan.differing_rows(small, large).isEmpty()


def test_tick_range_bounds(spark):
    ticks = spark.createDataFrame([(1, 1, 0, 10, 5, t) for t in ()] or [(1, b, 0, 10, 5, b) for b in (-1, 0, 9, 10)], "pool long, block long, tick_lower int, tick_upper int, liquidity long, tick int")
    assert {r["block"]: r["active_liquidity"] for r in tvl.active_liquidity(ticks).collect()} == {-1: 0, 0: 5, 9: 5, 10: 0}


def test_interval_tick_map_equals_direct_sum(spark):
    import random

    rng = random.Random(1)
    liq = spark.createDataFrame([(rng.randrange(3), rng.randrange(40), 60 * rng.randrange(3), 600, rng.randrange(-5, 9)) for _ in range(400)], "pool long, block long, tick_lower int, tick_upper int, liquidity_delta long")
    targets = liq.select("pool", "block").distinct()
    direct = targets.alias("t").join(liq.alias("l"), F.expr("t.pool = l.pool and l.block <= t.block")).groupBy("t.pool", "t.block", "tick_lower", "tick_upper").agg(F.sum("liquidity_delta").alias("liquidity")).filter("liquidity > 0")
    assert scan.differing_rows(direct, tvl.tick_map(liq, targets)).isEmpty()


def test_conditional_merge(spark):
    t = spark.createDataFrame([(1, 10, "old"), (2, 10, "old")], "k long, b long, v string")
    i = spark.createDataFrame([(1, 9, "late"), (2, 10, "same"), (3, 1, "new")], "k long, b long, v string")
    strict = {r["k"]: r["v"] for r in merge.newer_wins(t, i, ["k"], "b").collect()}
    loose = {r["k"]: r["v"] for r in merge.newer_wins(t, i, ["k"], "b", or_equal=True).collect()}
    assert strict == {1: "old", 2: "old", 3: "new"} and loose == {1: "old", 2: "same", 3: "new"}


def test_replay_is_idempotent(spark):
    t = spark.createDataFrame([(1, 10, "x")], "k long, b long, v string")
    i = spark.createDataFrame([(1, 11, "y"), (2, 3, "z")], "k long, b long, v string")
    once = merge.newer_wins(t, i, ["k"], "b")
    assert scan.differing_rows(once, merge.newer_wins(once, i, ["k"], "b")).isEmpty()


def test_rollback_takes_the_oldest_image(spark):
    target = spark.createDataFrame([(1, "c"), (2, "n"), (3, "k")], "k long, v string")
    images = spark.createDataFrame([(1, 5, ("a",)), (1, 6, ("b",)), (2, 6, None)], "k long, changed_at long, image struct<v: string>")
    gone = spark.createDataFrame([(5,), (6,)], "number long")
    assert {r["k"]: r["v"] for r in reorg.roll_back(target, images, gone, ["k"]).collect()} == {1: "a", 3: "k"}


def test_event_call_audit(spark):
    e = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (3, 1)], "b long, l long")
    s = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (2, 1), (4, 1)], "b long, l long")
    got = {r["b"]: r["action"] for r in calls.audit(e, s, ["b", "l"]).collect()}
    assert got == {1: "none", 2: "index", 3: "recollect", 4: "recollect"}


def test_latest_call_orders_nulls_last(spark):
    rows = [("f", 5, 1, "a"), ("f", 5, None, "b"), ("f", 4, 9, "c"), ("f", 9, 0, "d")]
    got = entities.latest_call(spark.createDataFrame(rows, "fn string, block_number long, log_index long, v string"), ["fn"], before=9).first()
    assert got["v"] == "b"


def test_throttle_carries_state(spark):
    b = spark.createDataFrame([("a", n, n * 7) for n in range(1, 40)], "key string, number long, ts long")
    taken, want = 0, []
    for n in range(1, 40):
        if n * 7 >= taken + 20:
            want.append(n)
            taken = n * 7
    assert sorted(r["number"] for r in calls.throttle(b, 20).collect()) == want
    first = calls.throttle(b.filter("number < 20"), 20)
    seed = first.groupBy("key").agg(F.max("ts").alias("taken"))
    both = first.unionByName(calls.throttle(b.filter("number >= 20"), 20, seed))
    assert sorted(r["number"] for r in both.collect()) == want


def test_broken_path_has_no_price(spark):
    paths = spark.createDataFrame([(5, [1, 2]), (6, [1, 9])], "target long, path array<long>")
    pools = spark.createDataFrame([(1, 5, 6, 2.0), (2, 7, 6, 4.0)], "pool long, base long, quote long, price double")
    assert {r["target"]: r["price"] for r in pricing.price_along(paths, pools).collect()} == {5: 0.5, 6: None}


def test_range_files_round_trip(spark, tmp_path):
    logs = spark.createDataFrame([(n, 0, bytearray(b"t"), n % 3, bytearray(20), [bytearray(32)], bytearray(n % 7)) for n in range(95)], scan.SCHEMAS["logs"])
    scan.write_ranges(logs, str(tmp_path / "logs"), 10)
    got = scan.scan(spark, str(tmp_path / "logs"), "logs", blocks=(15, 42), range_size=10)
    scan.assert_same_rows(got, logs.filter("block_number >= 15 and block_number < 42"))
    assert "PartitionFilters: [isnotnull(block_bucket" in got._jdf.queryExecution().toString() and got.select("block_number").distinct().count() == 27
    with pytest.raises(ValueError):
        scan.select_fields(logs, ["nothing"])
    with pytest.raises(ValueError):
        scan.assert_same_rows(logs, logs.limit(3))


REGISTRY = {
    "one.json": {
        "Hub": {
            "address": ["0x" + "0a" * 20, "0x" + "0b" * 20], "start_block": 7,
            "events": [{"signature": "Made(address indexed who, (uint256 a, address b) pair)"}, {"name": "Gone", "signature": "Left(uint256)"}],
            "calls": [
                {"function": "get(address)", "output_type": "(address, uint96)[]", "frequency": {"on_events": {"source": "Hub", "event": "Made(address)"}}, "params": [{"type": "address", "from_event": "topics[1]"}]},
                {"function": "f(uint8)", "output_type": "uint256", "frequency": "15M", "params": [{"type": "uint8", "values": ["1", "2"]}]},
                {"function": "g()", "output_type": "uint256", "frequency": 100},
            ],
            "factories": [{
                "collection_name": "coins", "factory_events": {"name": "Made", "topics_signature": "address", "data_signature": "(uint256,address),string,address[]", "factory_parameters": "data[0][1]"},
                "calls": [{"function": "name()", "output_type": "string", "frequency": "once"}], "events": [{"signature": "Transfer(address,address,uint256)"}],
            }],
        },
    },
    "two.json": {
        "Empty": {"address": "0x" + "0c" * 20},
        "Twin": {"address": "0x" + "0d" * 20, "factories": [{"collection_name": "pools", "factory_events": [
            {"name": "A", "topics_signature": "address,address", "factory_parameters": "topics[2]"},
            {"name": "B", "topics_signature": "", "data_signature": "(uint256,address),string,address[]", "factory_parameters": "data[2][3]"}]}]},
    },
}


def test_registry_equals_a_walk_of_its_files(spark, tmp_path):
    for chain in ("x", "y"):
        (tmp_path / chain).mkdir()
        for name, content in REGISTRY.items():
            (tmp_path / chain / name).write_text(json.dumps(content, indent=2))
    reg = registry.registry(registry.read_registry(spark, str(tmp_path)))
    assert {k: v.count() for k, v in reg.items()} == {"contracts": 8, "events": 6, "calls": 8, "factories": 6}
    events = {(r["contract"], r["collection"], r["name"]) for r in reg["events"].filter("chain = 'x'").collect()}
    assert events == {("Hub", None, "Made"), ("Hub", None, "Gone"), ("Hub", "coins", "Transfer")}
    found = {r["function"]: r for r in reg["calls"].filter("chain = 'y'").collect()}
    assert [found[f]["frequency"] for f in ("get(address)", "f(uint8)", "g()", "name()")] == ["on_events", "15m", "100", "once"]
    assert [t.asDict() for t in found["get(address)"]["triggers"]] == [{"source": "Hub", "event": "Made(address)"}]
    assert found["f(uint8)"]["params"][0]["values"] == ["1", "2"] and found["get(address)"]["params"][0]["from_event"] == "topics[1]"
    assert reg["calls"].filter("frequency = '15m'").select(scan.duration_seconds(F.col("frequency"))).first()[0] == 900
    topics = {r["name"]: bytes(r["topic0"]) for r in registry.event_matchers(reg).collect()}
    assert topics == {"Made": decode.keccak256(b"Made(address,(uint256,address))"), "Gone": decode.keccak256(b"Left(uint256)")}
    places = {(r["collection"], r["place"], r["index"], r["inner"], r["dynamic_array"]) for r in registry.factory_matchers(reg).collect()}
    assert places == {("coins", "data", 1, None, False), ("pools", "topic", 2, None, False), ("pools", "data", 3, 3, True)}


def test_registry_refuses_what_it_cannot_read(spark):
    files = lambda *texts: spark.createDataFrame([("x", t) for t in texts], "chain string, value string")
    with pytest.raises(ValueError, match="twice"):
        registry.registry(files('{"A": {"address": "0x01"}}', '{"A": {"address": "0x02"}}'))
    with pytest.raises(ValueError, match="no JSON"):
        registry.registry(files("[1"))
    assert all(t.count() == 0 for t in registry.registry(files("{}")).values())


def test_canonical_chain_with_a_long_fork(spark):
    rows = [(n, f"h{n}", f"h{n - 1}") for n in range(300)] + [(n, f"s{n}", f"s{n - 1}" if n > 250 else "h249") for n in range(250, 290)]
    chain = reorg.canonical(spark.createDataFrame(rows, "number long, hash string, parent_hash string"))
    assert {r["hash"] for r in chain.collect()} == {f"h{n}" for n in range(300)}


def test_merge_sink_versions(spark, tmp_path):
    sink = streams.merge_sink(str(tmp_path), ["k"], "b")
    make = lambda *r: spark.createDataFrame(list(r), "k long, b long, v string")
    sink(make((1, 1, "a"), (1, 2, "b")), 0)
    sink(make((1, 1, "late"), (2, 5, "c")), 1)
    sink(make((1, 1, "late"), (2, 5, "c")), 1)
    assert {(r["k"], r["v"]) for r in streams.read_sink(spark, str(tmp_path)).collect()} == {(1, "b"), (2, "c")}
    for n in range(2, 6):
        sink(make(*[(k, n, f"v{n}") for k in range(40)]), n)
    rows = streams.read_sink(spark, str(tmp_path)).collect()
    assert len(rows) == 40 and {r["v"] for r in rows if r["k"] != 2} == {"v5"}
    assert len(list((tmp_path / "_state").iterdir())) == 2  # older versions go


def test_awaiting_calls(spark, tmp_path):
    e = spark.sql("select 1L block_number, 0L log_index, timestamp'2024-01-01 00:00:00' time union all select 2L, 0L, timestamp'2024-01-01 00:01:00' union all select 9L, 0L, timestamp'2024-01-01 03:00:00'")
    c = spark.sql("select 1L block_number, 0L log_index, timestamp'2024-01-01 00:02:00' call_time, 7 value union all select 8L, 0L, timestamp'2024-01-01 03:00:00', 0")
    e.write.parquet(str(tmp_path / "e"))
    c.write.parquet(str(tmp_path / "c"))
    joined = streams.awaiting(streams.stream_table(spark, str(tmp_path / "e")), streams.stream_table(spark, str(tmp_path / "c")))
    got = {r["block_number"]: r["backlog"] for r in streams.drain(joined).collect()}
    assert got[1] is False and got.get(2) is True and 9 not in got


def test_every_query_runs_at_the_least_scale(spark, sf):
    for name, q in catalogue.QUERIES.items():
        assert q(spark, sf).columns, name


# -- order over several Arrow batches -------------------------------------------------------------------------------------


def _taken(times, seconds, start=0):
    out, taken = [], start
    for t in sorted(times):
        if t >= taken + seconds:
            out.append(t)
            taken = t
    return out


def test_throttle_of_one_busy_key(spark):
    rng = random.Random(2)
    times = rng.sample(range(1, 2_000_000), 25_000)
    b = spark.createDataFrame([(7, i, t) for i, t in enumerate(times)] + [(8, 1, 50), (8, 2, 50), (8, 3, None), (9, 1, 3)], "key long, number long, ts long")
    for span in (3, 64, 100_000):
        got = calls.throttle(b, 50, span=span).collect()
        assert sorted(r["ts"] for r in got if r["key"] == 7) == _taken(times, 50)
        assert [r["number"] for r in got if r["key"] == 8] == [1] and not [r for r in got if r["key"] == 9]


# -- bucketed forms against the direct ones, on one busy pool -------------------------------------------------------------


def _snapshots(spark, n=1500, step=90_000):
    rng, ts, rows = random.Random(4), 0, []
    for b in range(n):
        ts += rng.choice((0, 60, 3600, 9000, step, 4 * step))
        rows.append((1, b * 7, ts, float(rng.randrange(0, 50)), rng.randrange(1000), 1))
    return spark.createDataFrame(rows, "pool long, block long, ts long, price_close double, volume1 long, swap_count long")


def test_rolling_sums_equal_one_window(spark):
    snaps = _snapshots(spark)
    w = Window.partitionBy("pool").orderBy("ts").rangeBetween(-86_399, 0)
    direct = snaps.withColumns({"volume_24h": F.sum("volume1").over(w), "swaps_24h": F.sum("swap_count").over(w)})
    assert scan.differing_rows(direct, ohlc.rolling(snaps)).isEmpty()
    wide = snaps.withColumn("volume1", F.concat(F.col("volume1") + 1, F.lit("0" * 30)))
    direct = direct.select("block", F.concat((F.col("volume_24h") + F.col("swaps_24h")).cast("string"), F.lit("0" * 30)).alias("volume_24h"))
    assert scan.differing_rows(direct, ohlc.rolling(wide).select("block", "volume_24h")).isEmpty()


def test_changes_equal_one_window(spark):
    snaps = _snapshots(spark)
    direct = snaps
    for seconds, name in ((3600, "change_1h"), (86_400, "change_24h")):
        w = Window.partitionBy("pool").orderBy("ts").rangeBetween(Window.unboundedPreceding, -seconds)
        was = F.max(F.struct("ts", "block", "price_close")).over(w)["price_close"]
        direct = direct.withColumn(name, F.when(was != 0, (F.col("price_close") - was) / was))
    assert scan.differing_rows(direct, ohlc.price_changes(snaps)).isEmpty()


def test_filled_snapshots_equal_one_window(spark):
    snaps = _snapshots(spark).selectExpr("pool", "block", "ts", "price_close as price_open", "if(price_close > 40, null, price_close) as price_close", "price_close as price_high", "price_close as price_low", "volume1", "swap_count")
    value = spark.range(0, 12_000, 11).selectExpr("1L as pool", "id as block", "id * 3 as tvl_ts", "cast(id as double) as tvl_usd", "cast(null as double) as bootstrap")
    one, many = (tvl.fill_snapshots(snaps.filter("block > 300"), value, bucket=n) for n in (10**9, 90))
    assert scan.differing_rows(one, many).isEmpty() and one.filter("volume1 = 0 and price_close is not null").count() > 100


@pytest.mark.parametrize("bucket", [4, 1024])
def test_bucketed_tick_map_equals_direct_sum(spark, bucket):
    rng = random.Random(5)
    liq = spark.createDataFrame([(1, rng.randrange(200), 60 * rng.randrange(3), 600, rng.randrange(-5, 9)) for _ in range(500)], "pool long, block long, tick_lower int, tick_upper int, liquidity_delta long")
    targets = spark.range(0, 230, 3).selectExpr("1L as pool", "id as block")
    direct = targets.alias("t").join(liq.alias("l"), F.expr("t.pool = l.pool and l.block <= t.block")).groupBy("t.pool", "t.block", "tick_lower", "tick_upper").agg(F.sum("liquidity_delta").alias("liquidity")).filter("liquidity > 0")
    assert scan.differing_rows(direct, tvl.tick_map(liq, targets, bucket)).isEmpty()


def test_canonical_chain_by_buckets_and_from_the_middle_of_a_run(spark):
    rows = [("a", n, f"h{n}", f"h{n - 1}") for n in range(95)] + [("a", n, f"s{n}", f"s{n - 1}" if n > 40 else "h30") for n in range(40, 99)]
    rows += [("b", n, f"h{n}", f"h{n - 1}") for n in range(10)] + [("b", 4, "q4", "h3")]
    df = spark.createDataFrame(rows, "c string, number long, hash string, parent_hash string")
    for bucket in (7, 10_000):
        got = {(r["c"], r["hash"]) for r in reorg.canonical(df, chain="c", bucket=bucket).collect()}
        assert got == {("a", f"h{n}") for n in range(31)} | {("a", f"s{n}") for n in range(40, 99)} | {("b", f"h{n}") for n in range(10)}


# -- 256 bits, keys and ids ----------------------------------------------------------------------------------------------


def test_256_bit_text(spark):
    rng = random.Random(6)
    numbers = [0, 1, 10**26, 10**52, 10**26 - 1, (1 << 256) - 1, *(rng.getrandbits(rng.randrange(1, 257)) for _ in range(300))]
    pairs = [(str(a), str(b), a.to_bytes(32, "big"), (b - (1 << 255)).to_bytes(32, "big", signed=True)) for a, b in zip(numbers, reversed(numbers))]
    df = spark.createDataFrame(pairs, "a string, b string, w binary, s binary")
    out = words.with_differences(df, {"d": (F.col("a"), F.col("b"))}).select("a", "b", "d", words.u256_text("w").alias("u"), words.int256_text("s").alias("i"))
    for r in out.collect():
        assert int(r["d"]) == int(r["a"]) - int(r["b"]) and r["u"] == r["a"] and int(r["i"]) == int(r["b"]) - (1 << 255)


def test_flexible_numbers(spark):
    texts = ["7", "+7", "-7", "007", "-0", "", "x", "1.5", None, str((1 << 256) - 1), str(1 << 256), "-" + str(1 << 255), str(1 << 255)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", words.flexible(F.col("t")).alias("u"), words.flexible(F.col("t"), signed=True).alias("s")).collect()
    assert [r["u"] for r in rows] == ["7", "7", None, "7", "0", None, None, None, None, texts[9], None, None, texts[12]]
    assert [r["s"] for r in rows] == ["7", "7", "-7", "7", "0", None, None, None, None, None, None, texts[11], None]


def test_amounts_beyond_64_bits_in_snapshots(spark):
    big = 3 * 10**30
    rows = [(1, 1, 0, i, str(big * (-1) ** i), str(-big), 2.0 + i, 10 * i, str(i), str(i)) for i in range(3)]
    df = spark.createDataFrame(rows, "pool long, block long, ts long, log_index long, amount0 string, amount1 string, price double, tick int, sqrt_price string, liquidity string")
    r = ohlc.block_ohlc(df).first()
    assert r["volume0"] == str(3 * big) and r["volume1"] == str(3 * big) and (r["last_tick"], r["last_sqrt_price"], r["last_liquidity"]) == (20, "2", "2")


def test_pool_ids_of_creations_migrations_and_events(spark, sf):
    a = lambda n: bytearray(n.to_bytes(20, "big"))
    key = [(1, a(1), a(2), 3000, -60, a(9))]
    keys = spark.createDataFrame(key, "hook long, currency0 binary, currency1 binary, fee int, tick_spacing int, hooks binary")
    want = bytes(decode.pool_ids(keys).first()["pool_id"])
    calls_ = keys.withColumns({c: F.lit(5) if c != "is_token_0" else F.lit(True) for c in entities.AUCTION})
    creates = spark.createDataFrame([(1, 7, 8, 100, 3), (2, 7, 8, 100, 3)], "hook long, asset long, numeraire long, block_number long, creator long")
    pools, configs, missing = entities.v4_creates(creates, calls_)
    assert bytes(pools.first()["address"]) == want == bytes(configs.first()["pool_id"]) and [r["hook"] for r in missing.collect()] == [2]
    known = spark.createDataFrame([(20, 7, 8, 500, "rehype", "s", 1), (10, 7, 8, 700, "dhook", "s", 1), (5, 7, 8, 1, "dhook", "t", 1)], "address long, base_token long, quote_token long, fee int, type string, source string, source_version int")
    moves = keys.select(F.lit(7).cast("bigint").alias("asset"), F.lit(9).alias("block_number"), *entities.POOL_KEY).unionByName(keys.select(F.lit(70).cast("bigint").alias("asset"), F.lit(9).alias("block_number"), *entities.POOL_KEY))
    new, lost = entities.hook_migrations(moves, known, "s", 1)
    r = new.first()
    assert (bytes(r["address"]), r["migrated_from"], r["fee"], r["type"]) == (want, 10, 700, "migration_dhook") and lost.first()["asset"] == 70
    events = contracts._keyed(spark, sf).withColumn("data", F.expr("substring(data, 33)"))
    got = {r["p_partkey"]: bytes(r["param"]) for r in calls.event_parameters(events, "pool_id").collect()}
    p = spark.read.parquet(f"{sf}/part.parquet").selectExpr("p_partkey", *[f"unhex(lpad(hex({n}), 40, '0')) as {c}" for n, c in (("p_size", "currency0"), ("p_size + 1", "currency1"), ("7L", "hooks"))], "p_size * 100 as fee", "p_size - 25 as tick_spacing")
    assert got == {r["p_partkey"]: bytes(r["pool_id"]) for r in decode.pool_ids(p).collect()}


def test_nested_creation_data_out_of_bounds(spark):
    word = lambda n: n.to_bytes(32, "big")
    data = [word(32) + word(2) + word(5) + word(6), word(32) + word(1) + word(5) + word(6), word(1 << 200), word(32), b""]
    topic, factory = bytearray(32), bytearray(20)
    logs = spark.createDataFrame([(i, factory, [topic], bytearray(d)) for i, d in enumerate(data)], "block_number long, address binary, topics array<binary>, data binary")
    m = spark.createDataFrame([(factory, topic, "c", "data", 0, 1, True)], "address binary, topic0 binary, collection string, place string, index int, inner int, dynamic_array boolean")
    got = discover.created(logs, m).collect()
    assert [(int.from_bytes(r["address"], "big"), r["created_block"]) for r in got] == [(6, 0)]


def test_long_price_chains_resolve(spark):
    prices = spark.createDataFrame([(i + 1, i, 2.0, i) for i in range(70)], "token long, quote long, price double, block long")
    got = pricing.resolve_usd(prices, spark.createDataFrame([(0, 1.0, 0)], "token long, usd double, block long"))
    assert {r["token"]: r["usd"] for r in got.collect()} == {i: 2.0**i for i in range(71)}


def test_the_rest_works_without_the_training_data_folders(tmp_path):
    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "ledgerloom", tmp_path / "ledgerloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'h01_block_ohlc' in q and not [n for n in q if n.startswith('op')] and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, check=True, timeout=120)
