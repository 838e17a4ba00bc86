"""Chain-shaped projections of the driver's tables, and the same as SQL for DuckDB.

There is no chain data to test on, so swaps, liquidity changes, transfers, blocks, logs, calls and price edges are
projected from the star schema and the event table. Every projection is a plain select; CTE holds its DuckDB twin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

WEEK = 604_800

_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def swaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pool, block, ts, log_index, amounts in and out of both tokens (V2 shape). A block is a week; 1 h is 3 blocks."""
    line = _read(spark, sf_dir, "lineitem").withColumn("block", _div("unix_timestamp(l_shipdate)", WEEK))
    line = line.selectExpr("l_partkey % 16 as pool", "block", "block * 1200 as ts", *(c.strip() for c in _LINE.split(",")))
    numbered = line.selectExpr("*", f"cast(row_number() over (partition by pool, block order by {_LINE}) as bigint) as log_index")
    base, quote = "cast(l_quantity as bigint)", "cast(round(l_extendedprice * 100) as bigint)"
    return numbered.selectExpr(
        "pool", "block", "ts", "log_index",
        f"if(l_returnflag = 'R', {base}, 0L) as amount0_in", f"if(l_returnflag = 'R', 0L, {quote}) as amount1_in",
        f"if(l_returnflag = 'R', 0L, {base}) as amount0_out", f"if(l_returnflag = 'R', {quote}, 0L) as amount1_out",
    )


def liquidity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pool, block, tick_lower, tick_upper, liquidity_delta, one row per line."""
    return _read(spark, sf_dir, "lineitem").selectExpr(
        "l_partkey % 16 as pool", f"unix_timestamp(l_shipdate) div {WEEK} as block",
        "cast(l_suppkey % 10 * 60 as int) as tick_lower", "cast(l_suppkey % 10 * 60 + 600 as int) as tick_upper",
        "cast(if(l_linestatus = 'O', l_quantity, -l_quantity) as bigint) as liquidity_delta",
    )


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as log_index", f"unix_timestamp(o_orderdate) div {WEEK} as block", "unix_timestamp(o_orderdate) as ts",
        "o_custkey % 7 as token", "o_custkey as from_address", "o_custkey % 97 as to_address",
        "cast(round(o_totalprice * 100) as bigint) as value",
    )


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """number, hash, parent_hash with a wrong parent every 97th block and a hole every 50th."""
    return _read(spark, sf_dir, "events").where("event_id % 50 <> 49").selectExpr(
        "event_id as number", "md5(cast(event_id as string)) as hash",
        "md5(concat(cast(event_id - 1 as string), if(event_id % 97 = 0, 'x', ''))) as parent_hash", "unix_timestamp(ts) as ts",
    )


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw logs: two topics (event type, user) and one data word, as hex-free binary built from the event row."""
    return _read(spark, sf_dir, "events").selectExpr(
        "event_id div 10 as block_number", "event_id % 10 as log_index", "unix_timestamp(ts) as block_timestamp",
        "user_id as emitter", "event_type", "value", "event_id",
        "unhex(lpad(hex(user_id), 40, '0')) as address",
        "if(event_id % 23 = 0, array(), array(unhex(rpad(md5(event_type), 64, '0')), unhex(lpad(hex(user_id), 64, '0')))) as topics",
        "unhex(concat(lpad(hex(cast(round(value * 100) as bigint)), 64, '0'), lpad(hex(event_id), 64, '0'))) as data",
    )


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call results triggered by some logs: (block_number, log_index), target, value, is_reverted."""
    return _read(spark, sf_dir, "events").where("event_id % 3 = 0").selectExpr(
        "event_id div 10 as block_number", "event_id % 10 as log_index", "user_id as target",
        "event_type as function_name", "event_id as value", "event_id % 33 = 0 as is_reverted",
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undirected pools between tokens 0..39 that lie at most two apart, with their liquidity."""
    return _read(spark, sf_dir, "lineitem").selectExpr(
        "l_partkey % 40 as a", "l_suppkey % 40 as b", "cast(round(l_extendedprice * 100) as bigint) as cents"
    ).where("a <> b and abs(a - b) <= 2").groupBy("a", "b").sum("cents").withColumnRenamed("sum(cents)", "liquidity")


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """handler, range index: which ranges of a day each a handler has finished."""
    return _read(spark, sf_dir, "orders").selectExpr("o_orderpriority as handler", "unix_timestamp(o_orderdate) div 86400 as range_index").distinct()


def _div(a: str, b: int):
    from pyspark.sql import functions as F

    return F.expr(f"{a} div {b}")


#: The same projections as common table expressions for DuckDB.
CTE = {
    "v_swaps": f"""v_swaps AS (SELECT pool, block, block * 1200 AS ts,
      row_number() OVER (PARTITION BY pool, block ORDER BY {_LINE}) AS log_index,
      CASE WHEN l_returnflag = 'R' THEN l_quantity::BIGINT ELSE 0 END AS amount0_in,
      CASE WHEN l_returnflag = 'R' THEN 0 ELSE round(l_extendedprice * 100)::BIGINT END AS amount1_in,
      CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity::BIGINT END AS amount0_out,
      CASE WHEN l_returnflag = 'R' THEN round(l_extendedprice * 100)::BIGINT ELSE 0 END AS amount1_out
      FROM (SELECT *, l_partkey % 16 AS pool, floor(epoch(l_shipdate))::BIGINT // {WEEK} AS block FROM lineitem))""",
    "v_liq": f"""v_liq AS (SELECT l_partkey % 16 AS pool, floor(epoch(l_shipdate))::BIGINT // {WEEK} AS block,
      (l_suppkey % 10 * 60)::INTEGER AS tick_lower, (l_suppkey % 10 * 60 + 600)::INTEGER AS tick_upper,
      (CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE -l_quantity END)::BIGINT AS liquidity_delta FROM lineitem)""",
    "v_transfers": f"""v_transfers AS (SELECT o_orderkey AS log_index, floor(epoch(o_orderdate))::BIGINT // {WEEK} AS block,
      floor(epoch(o_orderdate))::BIGINT AS ts, o_custkey % 7 AS token, o_custkey AS from_address, o_custkey % 97 AS to_address,
      round(o_totalprice * 100)::BIGINT AS value FROM orders)""",
    "v_blocks": """v_blocks AS (SELECT event_id AS number, md5(event_id::VARCHAR) AS hash,
      md5((event_id - 1)::VARCHAR || CASE WHEN event_id % 97 = 0 THEN 'x' ELSE '' END) AS parent_hash, floor(epoch(ts))::BIGINT AS ts
      FROM events WHERE event_id % 50 <> 49)""",
    "v_calls": """v_calls AS (SELECT event_id // 10 AS block_number, event_id % 10 AS log_index, user_id AS target,
      event_type AS function_name, event_id AS value, event_id % 33 = 0 AS is_reverted FROM events WHERE event_id % 3 = 0)""",
    "v_logs": """v_logs AS (SELECT event_id // 10 AS block_number, event_id % 10 AS log_index, floor(epoch(ts))::BIGINT AS block_timestamp,
      user_id AS emitter, event_type, value, event_id, event_id % 23 <> 0 AS has_topics FROM events)""",
    "v_edges": """v_edges AS (SELECT l_partkey % 40 AS a, l_suppkey % 40 AS b, sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS liquidity
      FROM lineitem WHERE l_partkey % 40 <> l_suppkey % 40 AND abs(l_partkey % 40 - l_suppkey % 40) <= 2 GROUP BY ALL)""",
    "v_progress": "v_progress AS (SELECT DISTINCT o_orderpriority AS handler, floor(epoch(o_orderdate))::BIGINT // 86400 AS range_index FROM orders)",
}


def with_views(sql: str, *names: str) -> str:
    """A DuckDB query that starts with the named projections; sql may go on with further expressions after a comma."""
    return "WITH " + ",\n".join(CTE[n] for n in names) + sql
