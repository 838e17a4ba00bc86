"""Streaming queries, drained over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.plans.base import query
from ledgerloom.sources.shared import shared_dir
from ledgerloom.streaming import derive, keyed, streams

#: The files that a stream comes in, a share of the events each by their numbers, in the order in which they come.
PARTS = (1, 0, 3, 2)
#: Rows of a file where a part may be several files: one task writes a file, and one reads it.
FILE_ROWS = 250_000


def _arriving(spark: SparkSession, rows: DataFrame, parts: tuple[int, ...] = PARTS, file_rows: int | None = None) -> DataFrame:
    """rows (event_id, time, ..) as a stream of one file after the other, a batch each, and a last one that only moves the watermark:
    one row, null but for its time, further after the others than these lie apart.

    With file_rows a part of the rows is as many files as that asks for on average, the same number for each part, and a batch takes so many.
    """
    path = f"{shared_dir(spark)}/arriving-{uuid.uuid4().hex}"
    top, first, last, count = rows.agg(F.max("event_id"), F.min("time"), F.max("time"), F.count(F.lit(1))).first()
    part = F.expr(f"event_id * {len(parts)} div {top + 1}")
    files = max(1, round(count / len(parts) / file_rows)) if file_rows else 1
    for turn, n in enumerate(parts):
        own = rows.filter(part == n)
        (own.coalesce(1) if files == 1 else own.repartition(files, "event_id")).write.mode("append").parquet(path)
        if files > 1:  # what has no rows is no file, but a batch counts on it
            for _ in range((turn + 1) * files - len(spark.read.schema(rows.schema).parquet(path).inputFiles())):
                rows.limit(0).coalesce(1).write.mode("append").parquet(path)
    names = {f.name: f.dataType for f in rows.schema}
    end = spark.range(1).select(*[((F.lit(last) + F.expr(f"interval {(last - first).days + 400} days")) if c == "time" else F.lit(None)).cast(t).alias(c) for c, t in names.items()])
    end.coalesce(1).write.mode("append").parquet(path)
    return streams.stream_table(spark, path, files)


def _lateness(*tables: DataFrame) -> str:
    """How late a row may come when files come in any order: as long as the times of all rows lie apart."""
    ends = [t.agg(F.min("time"), F.max("time")).first() for t in tables]
    return f"{(max(last for _, last in ends) - min(first for first, _ in ends)).days + 1} days"


def _events(spark, sf) -> DataFrame:
    return streams.stream_table(spark, f"{sf}/events.parque[t]").withColumn("ts", F.col("ts").cast("timestamp"))


@query("l12_stream_candles", """SELECT user_id AS pool, time_bucket(INTERVAL '1 hour', ts) AS start, arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low, arg_max(value, event_id) AS close,
sum(round(value * 100)::BIGINT)::BIGINT AS volume, count(*) AS swaps FROM events GROUP BY 1, 2""")
def l12_a13(spark, sf):
    """Live hourly candles from a file stream."""
    swaps = _events(spark, sf).selectExpr("user_id as pool", "ts as time", "event_id as order", "value as price", "cast(round(value * 100) as bigint) as volume")
    return streams.drain(streams.candles(swaps), "complete").withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("l12_stream_rolling", """SELECT user_id AS pool, s AS start, count(*) AS swaps, sum(round(value * 100)::BIGINT)::BIGINT AS volume
FROM (SELECT *, unnest([time_bucket(INTERVAL '1 hour', ts) - INTERVAL 1 HOUR * i for i in range(24)]) AS s FROM events) GROUP BY 1, 2""")
def l12b(spark, sf):
    """Live 24-hour windows that slide by the hour, made of each batch's hourly candles."""
    swaps = _events(spark, sf).selectExpr("user_id as pool", "ts as time", "event_id as order", "value as price", "cast(round(value * 100) as bigint) as volume")
    return streams.drain(streams.candles(swaps), "complete", streams.rolling).select("pool", F.col("start").cast("timestamp_ntz").alias("start"), "swaps", "volume")


PRICED = ("user_id as pool", "ts as time", "event_id as order", "value as price", "cast(round(value * 100) as bigint) as volume")
#: When a file's rows come, the watermark is a day behind the latest row of the files before.
ARRIVED = f"""f(part, turn) AS (VALUES {", ".join(f"({p}, {i})" for i, p in enumerate(PARTS))}), e AS (SELECT *, event_id * {len(PARTS)} // (max(event_id) OVER () + 1) AS part FROM events),
x AS (SELECT e.*, turn, time_bucket(INTERVAL '1 hour', ts) AS start FROM e JOIN f USING (part)),
w AS (SELECT a.turn, date_trunc('millisecond', max(b.ts)) - INTERVAL 1 DAY AS mark FROM f a LEFT JOIN x b ON b.turn < a.turn GROUP BY a.turn),
late AS (SELECT x.* FROM x JOIN w USING (turn) WHERE start + INTERVAL 1 HOUR <= mark)"""


@query("l12_closed_candles", f"""WITH {ARRIVED} SELECT user_id AS pool, start, arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low, arg_max(value, event_id) AS close,
sum(round(value * 100)::BIGINT)::BIGINT AS volume, count(*) AS swaps FROM x ANTI JOIN late USING (event_id) GROUP BY 1, 2""")
def l12_closed(spark, sf):
    """Hourly candles that come out once, when they close, over files that come out of order; what comes too late is not in them."""
    rows = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).selectExpr("event_id", *PRICED)
    out = streams.drain(streams.candles(_arriving(spark, rows), late="1 day"), "append").filter("pool is not null")
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("l12_late_swaps", f"WITH {ARRIVED} SELECT event_id FROM late")
def l12_late(spark, sf):
    """The side table of the closed candles: swaps that came after their hour had closed."""
    rows = spark.read.parquet(f"{sf}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("time"))
    return streams.drain(keyed.late_rows(_arriving(spark, rows), "1 day")).filter("event_id is not null").select("event_id")


def _chain(spark, sf, parent: str) -> tuple[DataFrame, str]:
    """Chains of a thousand blocks, twelve seconds each, with a hole every 50th, and how late they may come; parent: the number that a block
    builds on."""
    rows = spark.read.parquet(f"{sf}/events.parquet").where("event_id % 50 <> 49").selectExpr(
        "event_id", "event_id div 1000 as chain_id", "event_id as number", "md5(cast(event_id as string)) as hash", f"md5({parent}) as parent_hash", "timestamp_seconds(event_id * 12) as time")
    return _arriving(spark, rows), _lateness(rows)


@query("l01_stream_reorgs", """SELECT event_id // 1000 AS chain_id, event_id AS number, 'detached' AS kind FROM events WHERE event_id % 97 = 0 AND event_id % 1000 > 0 AND event_id % 50 NOT IN (0, 49)
AND event_id - 1 IN (SELECT event_id FROM events)""")
def l01(spark, sf):
    """Reorgs in a block stream of several chains, whose files come out of order: a block is detached from the one before it, if that came."""
    b, late = _chain(spark, sf, "concat(cast(event_id - 1 as string), if(event_id % 97 = 0, 'x', ''))")
    return streams.drain(keyed.reorgs(b, late=late)).select("chain_id", "number", "kind")


@query("l01_stream_ancestors", """SELECT event_id // 1000 AS chain_id, event_id AS number, CASE WHEN event_id % 1000 >= 5 AND (event_id - 5) % 50 <> 49 THEN event_id - 5 END AS ancestor
FROM events WHERE event_id % 97 = 0 AND event_id % 1000 > 0 AND event_id % 50 NOT IN (0, 49)""")
def l01_ancestors(spark, sf):
    """Blocks that build on one five back: the ancestor is the tracked block of that hash."""
    b, late = _chain(spark, sf, "cast(event_id - if(event_id % 97 = 0, 5, 1) as string)")
    return streams.drain(keyed.reorgs(b, late=late)).select("chain_id", "number", "ancestor")


@query("l09_stream_ready", "SELECT event_id AS block_number, event_id * 2 AS value FROM events WHERE event_id % 7 <= 5 AND event_id % 3 <> 0")
def l09(spark, sf):
    """Events whose call came within five minutes, by a stream join."""
    e = _events(spark, sf).selectExpr("event_id as block_number", "0 as log_index", "ts as time")
    c = _events(spark, sf).where("event_id % 3 <> 0").selectExpr("event_id as block_number", "0 as log_index", "ts + make_interval(0, 0, 0, 0, 0, int(event_id % 7), 0) as call_time", "event_id * 2 as value")
    return streams.drain(streams.awaiting(e, c)).filter("not backlog").select("block_number", "value")


@query("l09_several_calls", """WITH e AS (SELECT *, CASE event_id % 4 WHEN 0 THEN []::VARCHAR[] WHEN 1 THEN ['slot0'] ELSE ['fee', 'slot0'] END AS needs FROM events),
c AS (SELECT event_id, 'slot0' AS name, event_id % 7 AS minutes FROM events WHERE event_id % 3 <> 0 UNION ALL SELECT event_id, 'fee', event_id % 11 FROM events WHERE event_id % 5 <> 0),
g AS (SELECT event_id, list_sort(list(name)) AS came FROM c WHERE minutes <= 5 GROUP BY 1),
m AS (SELECT event_id, needs, list_filter(needs, lambda n: NOT list_contains(coalesce(came, []), n)) AS missing FROM e LEFT JOIN g USING (event_id))
SELECT event_id AS block_number, CASE WHEN len(missing) = 0 THEN 'ready' ELSE 'backlog' END AS state, array_to_string(missing, ',') AS missing, len(needs) - len(missing) AS came FROM m""")
def l09_several(spark, sf):
    """Events that await several calls, and calls that come before or after them in files out of order: ready and backlog."""
    e = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    needs = "case event_id % 4 when 0 then array() when 1 then array('slot0') else array('fee', 'slot0') end"
    events = e.selectExpr("event_id", "event_id as block_number", "0 as log_index", f"cast({needs} as array<string>) as needs", "ts as time")
    after = lambda n: f"ts + make_interval(0, 0, 0, 0, 0, int(event_id % {n}), 0) as time"
    calls = e.where("event_id % 3 <> 0").selectExpr("event_id", "event_id as block_number", "0 as log_index", "'slot0' as name", "event_id as result", after(7))
    calls = calls.unionByName(e.where("event_id % 5 <> 0").selectExpr("event_id", "event_id as block_number", "0 as log_index", "'fee' as name", "event_id as result", after(11)))
    out = streams.drain(keyed.awaited(_arriving(spark, events, file_rows=FILE_ROWS), _arriving(spark, calls, (0, 2, 1, 3), FILE_ROWS), late=_lateness(events, calls)))
    return out.select("block_number", "state", F.array_join("missing", ",").alias("missing"), F.size("calls").cast("bigint").alias("came"))


@query("l13_stream_once", "SELECT event_id AS block, user_id AS log_index FROM events")
def l13(spark, sf):
    e = _events(spark, sf).selectExpr("1 as chain_id", "event_id as block", "user_id as log_index", "ts as time")
    return streams.drain(streams.once(e.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy"))).select("block", "log_index")


@query("e03_stream_throttle", """WITH RECURSIVE e AS (SELECT user_id AS key, event_id AS number, floor(epoch(ts))::BIGINT AS ts FROM events),
r AS (SELECT key, min_by(number, (ts, number)) AS number, min(ts) AS ts FROM e WHERE ts >= 86400 GROUP BY key
UNION ALL SELECT r.key, n.number, n.ts FROM r, LATERAL (SELECT number, ts FROM e WHERE e.key = r.key AND e.ts >= r.ts + 86400 ORDER BY ts, number LIMIT 1) n) SELECT key, number, ts FROM r""")
def e03(spark, sf):
    """Calls that fall due a day after the one before, over blocks whose files come out of order."""
    rows = spark.read.parquet(f"{sf}/events.parquet").selectExpr("event_id", "user_id as key", "event_id as number", "unix_timestamp(ts) as ts", "cast(ts as timestamp) as time")
    return streams.drain(keyed.throttled(_arriving(spark, rows), 86_400, late=_lateness(rows)))


def _pools_and_states() -> list[derive.Derivation]:
    """Pools by their first swap, and their latest state, which looks its pool's first block up."""

    def pools(t: dict) -> dict:
        return {"pools": t["swaps"].groupBy("pool").agg(F.min("block").alias("created_block"), F.min_by("price", "block").alias("first_price"))}

    def states(t: dict) -> dict:
        last = t["swaps"].groupBy("pool").agg(F.max_by(F.struct("block", "price"), "block").alias("s")).select("pool", "s.block", "s.price")
        return {"pool_state": last.join(t["pools"], "pool").select("pool", "block", "price", (F.col("block") - F.col("created_block")).alias("age"))}

    made = derive.Derivation("pools", ("swaps",), {"pools": derive.Output(("pool",), "created_block", "first", "created_block")}, pools)
    return [derive.Derivation("states", ("swaps", "pools"), {"pool_state": derive.Output(("pool",), "block", "newest", "block")}, states), made]


DERIVED = """SELECT user_id AS pool, max(event_id) AS block, arg_max(value, event_id) AS price, max(event_id) - min(event_id) AS age, min(event_id) AS created_block FROM events GROUP BY 1"""


@query("t01_derivations", DERIVED)
def t01(spark, sf):
    """Two derivations, one of which reads the other's output, over whole tables."""
    swaps = spark.read.parquet(f"{sf}/events.parquet").selectExpr("user_id as pool", "event_id as block", "value as price")
    out = derive.run(_pools_and_states(), {"swaps": swaps})
    return out["pool_state"].join(out["pools"].select("pool", "created_block"), "pool")


@query("t01_stream_derivations", DERIVED)
def t01_stream(spark, sf):
    """The same derivations over a stream of several files in order of their blocks."""
    rows = spark.read.parquet(f"{sf}/events.parquet").selectExpr("event_id", "user_id as pool", "event_id as block", "value as price", "cast(ts as timestamp) as time")
    path, steps = f"{shared_dir(spark)}/derived-{uuid.uuid4().hex}", _pools_and_states()
    write = derive.sink(steps, path, lambda batch: {"swaps": batch.filter("pool is not null").select("pool", "block", "price")})
    stream = _arriving(spark, rows, (0, 1, 2, 3))
    stream.writeStream.option("checkpointLocation", f"{path}-state").trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    states, pools = steps
    return derive.read(spark, path, states, "pool_state").join(derive.read(spark, path, pools, "pools").select("pool", "created_block"), "pool")
