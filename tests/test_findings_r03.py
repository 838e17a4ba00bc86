"""What the third round of review found: queries against their SQL on tables that are small but odd, and plans that call Python per distinct value."""

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from ledgerloom.functions import fixedpoint as fp, words
from ledgerloom.operators import calls, decode, discover, pricing, reorg, swaps, tvl
from ledgerloom.plans import catalogue
from ledgerloom.streaming import keyed, streams
from ledgerloom.streaming import keyed, streams


def same_as_sql(spark, folder, name):
    rows = catalogue.QUERIES[name](spark, str(folder)).toPandas()
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in folder.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    want = con.execute(catalogue.ORACLES[name]).df()
    text = lambda df: sorted(map(str, df[list(want.columns)].astype(object).where(df.notna(), None).values.tolist()))
    plain = lambda rows: [r.replace(".0,", ",").replace(".0]", "]") for r in rows]
    assert plain(text(rows)) == plain(text(want)) and len(want)


def write(folder, **tables):
    con = duckdb.connect()
    for name, sql in tables.items():
        con.execute(f"COPY ({sql}) TO '{folder}/{name}.parquet'")


def hashed_after_distinct(df):
    """Whether no Python lies below the grouping that makes values distinct."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return "EvalPython" in plan and "EvalPython" not in plan[plan.index("Aggregate"):]


def test_pool_ids_are_hashed_once_per_key_and_keys_are_not_decoded_in_filters(spark):
    zero = "X'" + "00" * 20 + "'"
    rows = spark.range(4).selectExpr(f"{zero} as currency0", f"{zero} as currency1", "if(id = 3, null, id % 2) as fee", "-60L as tick_spacing", f"{zero} as hooks", "id")
    out = decode.pool_ids(rows)
    assert hashed_after_distinct(out)
    filters = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter " in line]
    assert len(filters) == 1 and "isnotnull(pythonUDF" in filters[0]
    got = {r["id"]: bytes(r["pool_id"]) for r in out.collect()}
    assert sorted(got) == [0, 1, 2] and got[0] == got[2] != got[1]


def test_registry_created_where_contracts_share_an_address(spark, tmp_path):
    write(tmp_path, supplier="SELECT i AS s_suppkey, 'S' || i AS s_name, 0 AS s_nationkey, 0.0 AS s_acctbal FROM (VALUES (2), (102), (3)) t(i)",
          events="SELECT i::BIGINT AS event_id, TIMESTAMP '2024-01-01' AS ts, [102, 2, 3][i % 3 + 1]::BIGINT AS user_id, ['signup', 'error'][i % 2 + 1] AS event_type, 1.0 AS value FROM range(12) t(i)")
    same_as_sql(spark, tmp_path, "a08_registry_created")


def test_throttle_over_many_map_tasks(spark):
    rows = spark.createDataFrame(pd.DataFrame({"number": range(4000)})).selectExpr("number % 5 as key", "number", "86400 + number * 37 as ts").repartition(6)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the join may become a broadcast as it runs
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")
    try:
        out = calls.throttle(rows, 3000)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("REPARTITION_BY_COL") == plan.count("MapInPandas")  # each step's rows are dealt for it alone
        got = sorted((r["key"], r["number"]) for r in out.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    want = []
    for key in range(5):
        taken = 0
        for n in range(key, 4000, 5):
            if 86400 + n * 37 >= taken + 3000:
                want.append((key, n))
                taken = 86400 + n * 37
    assert got == want


def test_migration_to_an_address_that_is_a_pool_already(spark, tmp_path):
    write(tmp_path, part="SELECT i::BIGINT AS p_partkey, (i % 50)::INTEGER AS p_size FROM (VALUES (0), (10), (11), (500010)) t(i)")
    same_as_sql(spark, tmp_path, "f13_liquidity_migration")


def test_several_calls_over_files_that_all_span_more_than_a_month(spark, tmp_path):
    write(tmp_path, events="SELECT i::BIGINT AS event_id, TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * (i % 60 * 20) AS ts, 1::BIGINT AS user_id, 'view' AS event_type, 1.0 AS value FROM range(240) t(i)")
    same_as_sql(spark, tmp_path, "l09_several_calls")


def far_blocks(folder):
    """A few blocks in each quarter of more than four years, so that the first file lies over 400 days after the one that follows it."""
    write(folder, events="SELECT (k * 3500000 + i)::BIGINT AS event_id FROM range(4) a(k), range(200) b(i)")


def test_ancestors_in_a_stream_of_years(spark, tmp_path):
    far_blocks(tmp_path)
    same_as_sql(spark, tmp_path, "l01_stream_ancestors")


def test_reorgs_in_a_stream_of_years(spark, tmp_path):
    far_blocks(tmp_path)
    same_as_sql(spark, tmp_path, "l01_stream_reorgs")


def test_reorgs_where_blocks_are_missing_or_come_twice(spark, tmp_path):
    # two of three numbers, some of the first thousand twice, and nulls: 10 of the 31 blocks of another parent come without the one before them
    write(tmp_path, events="SELECT CASE WHEN i % 11 > 0 THEN i % 4000 END::BIGINT AS event_id FROM range(5000) t(i) WHERE i % 3 > 0")
    same_as_sql(spark, tmp_path, "l01_stream_reorgs")


def test_coin_swap_ticks_are_found_once_per_price(spark):
    rows = spark.range(3).selectExpr("case id when 0 then '79228162514264337593543950336' when 1 then '1' end as sqrt_price", "id")
    out = swaps.coin_swaps(rows)
    assert hashed_after_distinct(out)
    assert [(r["id"], r["tick"]) for r in out.collect()] == [(0, 0)]


def test_differences_of_short_and_long_numbers(spark):
    sizes = ["", "0", "7", "9" * 26, "1" + "0" * 26, "9" * 37, "1" + "0" * 37, "9" * 52, "1" + "0" * 52, str(2**256 - 1)]
    df = spark.createDataFrame([(a, b) for a in [*sizes, None] for b in sizes], "a string, b string")
    out = words.with_differences(df, {"d": (F.col("a"), F.col("b"))})
    for r in out.collect():
        assert r["d"] == (None if r["a"] is None else str(int(r["a"] or 0) - int(r["b"] or 0)))
    assert "decimal(37,0)" in out._jdf.queryExecution().optimizedPlan().toString()  # short ones are one subtraction


def test_decoded_rows_keep_columns_of_their_logs(spark):
    event = decode.parse_event("Moved(address indexed who, int64 amount)")
    logs = spark.range(2).selectExpr(
        "id as block_number", "0 as log_index", "X'01' as address", f"array(X'{event['topic0'].hex()}', unhex(repeat('00', 32))) as topics", "unhex(lpad(hex(id), 64, '0')) as data", "id * 10 as ts")
    rows = decode.decode_static(logs, event, keep=("ts",))[0].collect()
    assert [(r["ts"], r["amount"]) for r in rows] == [(0, 0), (10, 1)]


def test_embedded_positions_keep_their_price_without_a_join(spark):
    position = "named_struct('tick_lower', {}, 'tick_upper', {}, 'liquidity', {})"
    rows = spark.range(2).selectExpr("id as pool", "7 as block", "if(id = 0, 5, 50) as tick", f"if(id = 0, '{fp.sqrt_price_at(5)}', null) as sqrt_price", "array({}, {}, {}) as positions".format(
        position.format(0, 10, 1000), position.format(20, 30, 4000), position.format(0, 10, 0)))
    out = tvl.embedded_totals(rows)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert "EvalPython" not in out.select("pool", "active_liquidity")._jdf.queryExecution().optimizedPlan().toString()
    want = [fp.position_amounts(fp.sqrt_price_at(5), *p) for p in ((0, 10, 1000), (20, 30, 4000))]
    assert [r.asDict() for r in out.collect()] == [{"pool": 0, "block": 7, "amount0": str(want[0][0] + want[1][0]), "amount1": str(want[0][1] + want[1][1]), "active0": str(want[0][0]), "active1": str(want[0][1]), "active_liquidity": "1000"}]


def test_sums_at_the_border_of_a_limb(spark):
    pairs = [("0", "0"), ("9" * 26, "0"), ("9" * 26, "1"), ("9" * 52, "1"), ("1" + "0" * 51, "5")]
    df = spark.createDataFrame([(i, v) for i, p in enumerate(pairs) for v in p], "i int, v string")
    assert [r["s"] for r in df.groupBy("i").agg(words.sum_u256(F.col("v")).alias("s")).orderBy("i").collect()] == [str(int(a) + int(b)) for a, b in pairs]


def test_created_addresses_meet_few_matchers_by_broadcast_and_many_by_shuffle(spark, monkeypatch):
    word = lambda n: f"{n:064x}"
    good, short, far = word(32) + word(2) + word(5) + word(6), word(32) + word(1) + word(5) + word(6), word(1 << 70) + word(2) + word(5) + word(6)
    logs = spark.createDataFrame([(1, good), (2, short), (3, far), (4, good)], "block_number long, h string").selectExpr("block_number", "X'11' as address", "array(X'22') as topics", "unhex(h) as data")
    m = spark.createDataFrame([("pools", "data", 0, 1, True), ("plain", "data", 2, None, None)], "collection string, place string, index int, inner int, dynamic_array boolean").selectExpr("*", "X'11' as address", "X'22' as topic0")
    for limit, broadcast in ((discover.FEW_MATCHERS, True), (0, False)):
        monkeypatch.setattr(discover, "FEW_MATCHERS", limit)
        out = discover.created(logs, m)
        plan = out._jdf.queryExecution().sparkPlan().toString()
        assert ("Broadcast" in plan) == broadcast and ("CartesianProduct" in plan) != broadcast
        if broadcast:
            assert plan.count("conv(") < 20  # the offset is not decoded once per place that names it
        assert sorted((r["collection"], r["address"].hex()[-2:], r["created_block"]) for r in out.collect()) == [("plain", "05", 1), ("pools", "06", 1)]


def test_rolling_windows_from_hours(spark):
    swaps = spark.range(200).selectExpr("id % 3 as pool", "timestamp_seconds(1700000000 + id * 2777) as time", "id as order", "id as price", "id * 5 as volume")
    hours, windows = streams.candles(swaps), streams.candles(swaps, width="24 hours", slide="1 hour")
    rows = lambda df: sorted(map(tuple, df.select("pool", "start", "swaps", "volume").collect()))
    assert rows(streams.rolling(hours)) == rows(windows)


def test_throttle_of_many_keys_in_few_groups(spark, tmp_path):
    rows = spark.range(400).selectExpr("id % 7 as key", "id as number", "86400 + id * 37 as ts", "timestamp_seconds(86400 + id * 37) as time")
    end = spark.range(1).selectExpr("cast(null as bigint) as key", "cast(null as bigint) as number", "cast(null as bigint) as ts", "timestamp_seconds(900000000) as time")
    for part in (rows.filter("number >= 200"), rows.filter("number < 200"), end):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = keyed.throttled(streams.stream_table(spark, f"{tmp_path}/in", 1), 3000, late="1 day", groups=2)
    got = sorted((r["key"], r["number"]) for r in streams.drain(stream).collect())
    want = []
    for key in range(7):
        taken = 0
        for n in range(key, 400, 7):
            if 86400 + n * 37 >= taken + 3000:
                want.append((key, n))
                taken = 86400 + n * 37
    assert got == want


def test_only_endings_as_long_as_a_symbol_are_looked_up(spark):
    names = ["WETHUSDCPool", "WETHaxlUSDCPool", "USDCPool", "XUSDCPool", "APool", "Pool", "WETHUSDC"]
    contracts, tokens = spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame([("USDC",), ("axlUSDC",), ("WETH",)], "symbol string")
    out = pricing.price_pools(contracts, tokens)
    assert sorted(map(tuple, out.collect())) == [("WETHUSDCPool", "WETH", "USDC"), ("WETHaxlUSDCPool", "WETH", "axlUSDC"), ("XUSDCPool", "X", "USDC")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan and "RepartitionByExpression [name" in plan


def test_canonical_deals_blocks_once_to_find_runs_also_over_buckets(spark, monkeypatch):
    from ledgerloom.sources import shared

    plans, cut = [], shared.cut
    monkeypatch.setattr(shared, "cut", lambda df: plans.append(df._jdf.queryExecution().sparkPlan().toString()) or cut(df))
    own = spark.range(40).selectExpr("1 as chain", "id as number", "concat('h', id) as hash", "concat('h', id - 1) as parent_hash")
    side = spark.range(12, 19).selectExpr("1 as chain", "id as number", "concat('s', id) as hash", "if(id = 12, 'h11', concat('s', id - 1)) as parent_hash")
    out = reorg.canonical(own.unionByName(side).unionByName(own), chain="chain", bucket=7)
    assert sorted((r["number"], r["hash"]) for r in out.collect()) == [(n, f"h{n}") for n in range(40)]
    assert "Join" not in plans[0]  # heights meet those below them in their bucket
