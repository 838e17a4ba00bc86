"""Token prices: oracles, latest prices, transitive resolution and best paths over pools."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.fixedpoint import approximate_price, price_udf
from ledgerloom.sources.shared import cut, shared_dir

MIN_LIQUIDITY = 1000
MAX_HOPS = 5
FRESH_BLOCKS = 302_400


def oracle_price(calls: DataFrame, decimals: int = 8) -> DataFrame:
    """Per oracle the answer of its highest block that did not revert, as a price; the first call wins a tie."""
    good = calls.filter(~F.coalesce(F.col("is_reverted"), F.lit(False)))
    best = good.groupBy("target").agg(F.max_by("value", F.struct("block_number", -F.col("log_index"))).alias("answer"), F.max("block_number").alias("block_number"))
    return best.select("target", "block_number", (F.col("answer").cast("double") / F.lit(10.0**decimals)).alias("price"))


def oracle_rows(answers: DataFrame, feeds: DataFrame, blocks: DataFrame) -> DataFrame:
    """Price rows (token, quote, block, ts, price) of oracle answers as they are kept: in US dollars, whose address is zero.

    answers: what oracle_price returned; feeds: target, token; blocks: number, ts.
    """
    rows = answers.join(feeds, "target").join(blocks.select(F.col("number").alias("block_number"), "ts"), "block_number")
    return rows.select("token", F.unhex(F.lit("00" * 20)).alias("quote"), F.col("block_number").alias("block"), "ts", "price")


def price_pools(contracts: DataFrame, tokens: DataFrame) -> DataFrame:
    """Pools named <Base><Quote>Pool in the registry: base and quote by the longest quote symbol that ends the name.

    contracts: name and, where the registry has it, functions (an array of its calls): only pools with a slot0-like call count. The
    proper endings of a name that are as long as some symbol are looked up among the symbols, so names meet symbols by equality. Names are
    dealt to tasks before that, however few files they come in.
    """
    stem = F.regexp_extract("name", "^(.*)Pool$", 1)
    rows = contracts.withColumn("stem", stem).filter("stem <> ''")
    if "functions" in contracts.columns:
        plain = F.transform("functions", lambda f: F.regexp_extract(f, r"^([^(]*)", 1))
        rows = rows.filter(F.arrays_overlap(plain, F.array(F.lit("slot0"), F.lit("getSlot0"))))
    lengths = tokens.agg(F.collect_set(F.length("symbol")).alias("_lengths"))  # one row
    ends = F.transform(F.filter("_lengths", lambda n: n < F.length("stem")), lambda n: F.right(F.col("stem"), n))
    dealt = rows.select("name", "stem").repartition("name").crossJoin(F.broadcast(lengths))
    pairs = dealt.select("name", "stem", F.explode(ends).alias("quote")).join(tokens.select(F.col("symbol").alias("quote")).distinct(), "quote")
    best = pairs.groupBy("name", "stem").agg(F.max_by("quote", F.length("quote")).alias("quote"))
    return best.select("name", F.expr("left(stem, length(stem) - length(quote))").alias("base"), "quote")


def slot0_prices(pools: DataFrame, calls: DataFrame, tokens: DataFrame, *, exact: bool = False) -> DataFrame:
    """Price rows (token, quote, block, ts, price) of the pools' slot0 results; zero prices give none.

    pools: name, base, quote (symbols); calls: source (the pool's name), block, ts, sqrt_price; tokens: symbol, address, decimals. The token
    order is that of the addresses. exact: decimal text, computed once per distinct price; else a double, without Python. Several
    results of one token at one time count as one: that of the greatest block.
    """
    side = lambda c: tokens.select(F.col("symbol").alias(c), F.col("address").alias(f"{c}_address"), F.col("decimals").alias(f"{c}_decimals"))
    known = pools.join(side("base"), "base").join(side("quote"), "quote").withColumn("is_token_0", F.col("base_address") < F.col("quote_address"))
    rows = calls.join(known.withColumnRenamed("name", "source"), "source")
    if exact:
        asked = ["sqrt_price", "is_token_0", "base_decimals", "quote_decimals"]
        rows = rows.join(rows.select(*asked).distinct().withColumn("price", price_udf(*asked)), asked)
    else:
        rows = rows.withColumn("price", approximate_price(F.col("sqrt_price"), F.col("is_token_0")) * F.pow(F.lit(10.0), (F.col("base_decimals") - F.col("quote_decimals")).cast("double")))
    best = rows.filter(F.col("price").isNotNull()).groupBy(F.col("base_address").alias("token"), "ts")
    best = best.agg(F.max_by(F.struct("block", F.col("quote_address").alias("quote"), "price"), F.struct("block", "source")).alias("s"))
    return best.select("token", "s.quote", "s.block", "ts", "s.price")


def latest_prices(prices: DataFrame, before: int) -> DataFrame:
    """The last (token, quote) price strictly before a block."""
    rest = [c for c in prices.columns if c not in ("token", "quote")]
    best = prices.filter(F.col("block") < before).groupBy("token", "quote").agg(F.max_by(F.struct(*rest), "block").alias("s"))
    return best.select("token", "quote", *[F.col(f"s.{c}").alias(c) for c in rest])


def resolve_usd(prices: DataFrame, known: DataFrame) -> DataFrame:
    """Transitive prices: usd(token) = price * usd(quote) until nothing is added. The first resolution of a token stays.

    prices: token, quote, price, block; known: token, usd, block. The block of a result is the greatest one used. Each round
    joins only the tokens resolved in the round before and adds its own folder to the result, so nothing is written twice; there are
    as many rounds as the longest chain, and every round resolves a token more, so they end.
    """
    spark = prices.sparkSession
    path = f"{shared_dir(spark)}/usd-{uuid.uuid4().hex}"
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in known.select("token", "usd", "block").schema) + ", hops int"
    known.select("token", "usd", "block").write.parquet(f"{path}/hops=0")
    hop = 0
    while True:
        done = spark.read.schema(schema).parquet(path)
        front = done.filter(F.col("hops") == hop)
        hop += 1
        step = prices.alias("p").join(front.alias("k"), F.col("p.quote") == F.col("k.token")).select(
            F.col("p.token").alias("token"), (F.col("p.price") * F.col("k.usd")).alias("usd"), F.greatest("p.block", "k.block").alias("block"), F.col("p.quote").alias("via")
        )
        step = step.join(done.select("token"), "token", "left_anti")
        step = step.groupBy("token").agg(F.min_by(F.struct("usd", "block"), F.struct(-F.col("block"), "via")).alias("s")).select("token", "s.usd", "s.block")
        step.select(*[F.col(f.name).cast(f.dataType) for f in known.select("token", "usd", "block").schema]).write.parquet(f"{path}/hops={hop}")
        if spark.read.schema(schema).parquet(f"{path}/hops={hop}").isEmpty():
            return spark.read.schema(schema).parquet(path)


def by_precedence(*sources: DataFrame) -> DataFrame:
    """One price per token: of the first source that has it (stable coins, oracle, cache, stored)."""
    all_ = None
    for i, s in enumerate(sources):
        s = s.select("token", "usd", F.lit(i).alias("rank"))
        all_ = s if all_ is None else all_.unionByName(s)
    return all_.groupBy("token").agg(F.min_by(F.struct("usd", "rank"), "rank").alias("s")).select("token", "s.usd", "s.rank")


def usd_prices(stable: DataFrame, oracle: DataFrame, stored: DataFrame, cache: DataFrame, *, bound: int, native=None, wrapped=None) -> DataFrame:
    """(token, usd, rank): stable coins at one, then oracle answers, then stored prices, then the cache; cached and stored rows count
    only if what they rest on (`block`) lies before `bound`. The native coin has the wrapped coin's price unless it has its own.

    stable: token; the others: token, usd, block.
    """
    before = lambda df: df.filter(F.col("block") < bound)
    found = by_precedence(stable.select("token", F.lit(1.0).alias("usd")), oracle, before(stored), before(cache))
    if native is None:
        return found
    as_native = found.filter(F.col("token") == F.lit(wrapped)).select(F.lit(native).alias("token"), "usd", "rank")
    return found.unionByName(as_native.join(found.filter(F.col("token") == F.lit(native)).select("token"), "token", "left_anti"))


def frontier_edges(snapshots: DataFrame, before: int) -> DataFrame:
    """Each pool's latest snapshot before a block, then the liquidity filter: USD liquidity of at least 1000, or unknown with raw liquidity (weight 0)."""
    rest = [c for c in snapshots.columns if c != "pool"]
    last = snapshots.filter(F.col("block") < before).groupBy("pool").agg(F.max_by(F.struct(*rest), "block").alias("s")).select("pool", "s.*")
    usd, raw = F.col("liquidity_usd"), F.col("liquidity")
    return last.filter((usd >= MIN_LIQUIDITY) | (usd.isNull() & (raw > 0))).withColumn("weight", F.coalesce(usd, F.lit(0)))


def undirected(edges: DataFrame) -> DataFrame:
    """(a, b, pool, weight): both directions."""
    return edges.select("a", "b", "pool", "weight").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "pool", "weight"))


def hops_to(edges: DataFrame, anchors: DataFrame, max_hops: int) -> DataFrame:
    """(token, away): how many hops a token is from the nearest anchor, up to max_hops. edges (a, b) in both directions.

    Each round joins only the tokens of the round before and adds its own folder.
    """
    spark = edges.sparkSession
    path, kind = f"{shared_dir(spark)}/hops-{uuid.uuid4().hex}", edges.schema["a"].dataType
    anchors.select(F.col("token").cast(kind)).distinct().write.parquet(f"{path}/away=0")
    for hop in range(1, max_hops + 1):
        done = spark.read.schema(f"token {kind.simpleString()}, away int").parquet(path)
        front = done.filter(F.col("away") == hop - 1).select(F.col("token").alias("b"))
        step = edges.join(front, "b").select(F.col("a").alias("token")).distinct().join(done.select("token"), "token", "left_anti")
        step.write.parquet(f"{path}/away={hop}")
    return spark.read.schema(f"token {kind.simpleString()}, away int").parquet(path)


def downhill(edges: DataFrame, anchors: DataFrame, max_hops: int) -> tuple[DataFrame, DataFrame]:
    """(a, b, weight, pool) of the pools that come a hop nearer to an anchor, the best of each pair, and (token, away). Written."""
    both = cut(undirected(edges).groupBy("a", "b").agg(F.max_by(F.struct("weight", "pool"), F.struct("weight", -F.col("pool"))).alias("e")).select("a", "b", "e.weight", "e.pool"))
    away = cut(hops_to(both.select("a", "b"), anchors, max_hops))
    side = lambda c: away.select(F.col("token").alias(c), F.col("away").alias(f"away_{c}"))
    down = both.join(side("a"), "a").join(side("b"), "b").filter("away_b = away_a - 1")
    return cut(down.select("a", "b", "weight", F.col("pool").cast("bigint").alias("pool"))), away


def best_paths(edges: DataFrame, targets: DataFrame, anchors: DataFrame, max_hops: int = MAX_HOPS) -> DataFrame:
    """(target, anchor, bottleneck, hops, path): for each target token the pools to an anchor at the first hop that meets one,
    with the greatest bottleneck weight; ties by the smaller anchor and path.

    The hops from every token to its nearest anchor are found first, from the few anchors outward. A path that meets an anchor at the
    first hop possible comes a hop nearer with every pool, so only such pools are followed: the targets advance together along
    them, one join per hop, and of the ways to one token only the best stays. Targets out of reach never start.
    """
    down, away = downhill(edges, anchors, max_hops)
    state = targets.select("token").distinct().join(away, "token").filter("away > 0").select(
        F.col("token").alias("target"), F.col("token").alias("at"), F.col("away").alias("hops"), F.lit(None).cast("bigint").alias("bottleneck"), F.array().cast("array<bigint>").alias("path"))
    found = None
    for hop in range(1, max_hops + 1):
        step = state.join(down, F.col("at") == F.col("a")).select(
            "target", F.col("b").alias("at"), "hops", F.coalesce(F.least("bottleneck", "weight"), F.col("weight")).alias("bottleneck"), F.concat("path", F.array("pool")).alias("path")
        )
        order = F.struct(-F.col("bottleneck"), F.col("path"))
        step = cut(step.groupBy("target", "at").agg(F.min_by(F.struct("hops", "bottleneck", "path"), order).alias("s")).select("target", "at", "s.hops", "s.bottleneck", "s.path"))
        hit = step.filter(F.col("hops") == hop).groupBy("target").agg(F.min_by(F.struct(F.col("at").alias("anchor"), "bottleneck", "path"), F.struct(-F.col("bottleneck"), "at", "path")).alias("s"))
        hit = hit.select("target", "s.*", F.lit(hop).alias("hops"))
        found = hit if found is None else found.unionByName(hit)
        state = step.filter(F.col("hops") > hop)
    return found


def price_along(paths: DataFrame, pools: DataFrame) -> DataFrame:
    """(target, price): prices multiplied from base to quote and divided from quote to base along the path.

    pools: pool, base, quote, price. Null where a pool is missing, does not touch the token reached, or has no price.
    """
    hops = paths.select("target", F.posexplode("path").alias("i", "pool")).join(pools, "pool", "left")
    steps = hops.groupBy("target").agg(F.sort_array(F.collect_list(F.struct("i", "base", "quote", "price"))).alias("steps"))
    start = F.struct(F.col("target").cast("bigint").alias("at"), F.lit(1.0).alias("p"))

    def step(acc: Column, s: Column) -> Column:
        good = s["price"].isNotNull() & (s["price"] != 0) & acc["p"].isNotNull()
        forward, back = good & (s["base"] == acc["at"]), good & (s["quote"] == acc["at"])
        return F.struct(
            F.when(forward, s["quote"]).when(back, s["base"]).cast("bigint").alias("at"),
            F.when(forward, acc["p"] * s["price"]).when(back, acc["p"] / s["price"]).alias("p"),
        )

    return steps.select("target", F.aggregate("steps", start, step)["p"].alias("price"))


def fresh_paths(cache: DataFrame, block: int) -> DataFrame:
    """Cached paths (also those that found nothing) resolved before the block and less than 302 400 blocks ago."""
    return cache.filter((F.col("resolved_block") < block) & (F.lit(block) - F.col("resolved_block") < FRESH_BLOCKS))


def drop_broken(cache: DataFrame, pools: DataFrame) -> DataFrame:
    """Cached paths all of whose pools still exist."""
    broken = cache.select("target", F.explode("path").alias("pool")).join(pools.select("pool"), "pool", "left_anti").select("target").distinct()
    return cache.join(broken, "target", "left_anti")


def touched_targets(old: DataFrame, new: DataFrame, anchors: DataFrame, max_hops: int = MAX_HOPS) -> DataFrame:
    """(token): those whose best path may differ between two states of the pools (edges as best_paths takes them).

    A token's result is decided by the pools that lead downhill from it. So it is touched where such a pool came, went, or changed its
    weight, or where downhill pools, of either state, lead from it to a token with that. The search goes uphill from the changes,
    a join a hop, and sees nothing else of the graph.
    """
    (was, _), (is_, _) = downhill(old, anchors, max_hops), downhill(new, anchors, max_hops)
    changed = was.exceptAll(is_).unionByName(is_.exceptAll(was)).select(F.col("a").alias("token")).distinct()
    uphill = cut(was.unionByName(is_).select("a", "b").distinct())
    found = front = cut(changed)
    for _ in range(max_hops - 1):
        front = cut(uphill.join(front.withColumnRenamed("token", "b"), "b").select(F.col("a").alias("token")).distinct().join(found, "token", "left_anti"))
        found = cut(found.unionByName(front))
    return found


def update_paths(cache: DataFrame, old: DataFrame, new: DataFrame, targets: DataFrame, anchors: DataFrame, block: int, max_hops: int = MAX_HOPS) -> DataFrame:
    """The path cache (target, anchor, bottleneck, hops, path, resolved_block) after the pools went from old to new by `block`.

    Solved again are only targets that the change touches, that the cache does not hold, or whose entry has grown old (fresh_paths).
    What has no path is kept as an entry without one, and is not looked for again until it is touched or old. Entries of tokens that
    are no longer targets go.
    """
    wanted = targets.select(F.col("token").alias("target")).distinct()
    held = cache.join(wanted, "target", "left_semi")
    touched = touched_targets(old, new, anchors, max_hops).select(F.col("token").alias("target"))
    kept = cut(fresh_paths(held, block).join(touched, "target", "left_anti"))
    open_ = cut(wanted.join(kept.select("target"), "target", "left_anti"))
    solved = best_paths(new, open_.select(F.col("target").alias("token")), anchors, max_hops)
    entries = open_.join(solved, "target", "left").withColumn("resolved_block", F.lit(block).cast(cache.schema["resolved_block"].dataType))
    return kept.unionByName(entries.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in cache.schema]))
