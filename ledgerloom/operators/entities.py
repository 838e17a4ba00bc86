"""Tokens, pools, users and transfers from creation events, call results and receipts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.operators.running import running_sums

#: The metadata of the native coin, and the decimals of every asset.
NATIVE = {"name": "Native Ether", "symbol": "ETH", "decimals": 18}
ASSET_DECIMALS = 18


def latest_call(calls: DataFrame, keys: list[str], before: int | None = None) -> DataFrame:
    """Per key the last result before a block: greatest block, then trigger log index with nulls last."""
    rows = calls if before is None else calls.filter(F.col("block_number") < before)
    rest = [c for c in calls.columns if c not in keys]
    order = F.struct("block_number", F.coalesce(F.col("log_index").cast("bigint"), F.lit((1 << 62))))
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("s"))
    return best.select(*keys, *[F.col(f"s.{c}").alias(c) for c in rest])


def with_metadata(creates: DataFrame, metadata: DataFrame, zero) -> DataFrame:
    """Creation events with name, symbol and decimals of the asset and of the numeraire; the zero address is the native coin."""
    asset = metadata.select(F.col("address").alias("asset"), F.col("name").alias("asset_name"), F.col("symbol").alias("asset_symbol"))
    quote = metadata.select(F.col("address").alias("numeraire"), "name", "symbol", "decimals")
    out = creates.join(asset, "asset", "left").join(quote, "numeraire", "left").withColumn("asset_decimals", F.lit(ASSET_DECIMALS))
    native = F.col("numeraire") == F.lit(zero)
    return out.select("*", *[F.when(native, F.lit(v)).otherwise(F.col(k)).alias(f"quote_{k}") for k, v in NATIVE.items()]).drop("name", "symbol", "decimals")


def route_missing(creates: DataFrame, skipped: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ready, blocked: a call result is still due, skipped: listed with a reason)."""
    complete = F.col("asset_name").isNotNull() & F.col("quote_symbol").isNotNull()
    listed = creates.filter(~complete).join(skipped.select(F.col("address").alias("asset"), "reason"), "asset")
    blocked = creates.filter(~complete).join(skipped.select(F.col("address").alias("asset")), "asset", "left_anti")
    return creates.filter(complete), blocked, listed


def with_sender(creates: DataFrame, receipts: DataFrame) -> DataFrame:
    return creates.join(receipts.select("transaction_hash", F.col("from_address").alias("creator")), "transaction_hash", "left")


def pools_from(creates: DataFrame, pool_type: str, fee: Column | None = None, extra: dict[str, Column] | None = None) -> DataFrame:
    """Pool rows of a creation event: token order, type, fee and what a variant adds."""
    first = F.col("asset") < F.col("numeraire")
    return creates.select(
        F.col("pool").alias("address"), F.col("asset").alias("base_token"), F.col("numeraire").alias("quote_token"), first.alias("is_token_0"),
        F.lit(pool_type).alias("type"), (fee if fee is not None else F.lit(None).cast("int")).alias("fee"), F.col("block_number").alias("created_block"), "creator",
        *[c.alias(k) for k, c in (extra or {}).items()],
    )


#: What a V4 auction's configuration row holds of its hook's once call.
AUCTION = (
    "num_tokens_to_sell", "min_proceeds", "max_proceeds", "starting_time", "ending_time", "starting_tick", "ending_tick", "epoch_length", "gamma",
    "is_token_0", "num_pd_slugs",
)
POOL_KEY = ("currency0", "currency1", "fee", "tick_spacing", "hooks")


def v4_creates(creates: DataFrame, hook_calls: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """V4 auctions: (pools, configurations, missing) of creation events (hook, asset, numeraire, block_number, creator and what an
    asset's metadata gives: integrator, initializer, migrator, migration_pool).

    hook_calls: hook, the five parts of the pool key and AUCTION. The pool's address is the id of its key; the token order is the one the hook
    says. Events whose hook has no call are missing.
    """
    from ledgerloom.operators.decode import pool_ids

    known = pool_ids(hook_calls)
    rows = creates.join(known, "hook")
    extra = [c for c in ("integrator", "initializer", "migrator", "migration_pool") if c in creates.columns]
    pools = rows.select(
        F.col("pool_id").alias("address"), F.col("asset").alias("base_token"), F.col("numeraire").alias("quote_token"), "is_token_0", F.lit("v4").alias("type"), "fee",
        F.col("min_proceeds").alias("min_threshold"), F.col("max_proceeds").alias("max_threshold"), "starting_time", "ending_time",
        F.col("block_number").alias("created_block"), "creator", *extra,
    )
    configs = rows.select("pool_id", F.col("hook").alias("hook_address"), *AUCTION)
    return pools, configs, creates.join(hook_calls.select("hook"), "hook", "left_anti")


def _ticks(positions: DataFrame, key: list[str]) -> DataFrame:
    low, high = F.transform("positions", lambda p: p["tick_lower"]), F.transform("positions", lambda p: p["tick_upper"])
    return positions.select(*key, F.array_min(low).alias("lower"), F.array_max(high).alias("upper"))


def hook_state(creates: DataFrame, state: DataFrame, positions: DataFrame, beneficiaries: DataFrame, starting: DataFrame | None = None) -> DataFrame:
    """Creates joined to the calls of the same (block, log_index): state, the lowest and highest tick of the positions
    and the start tick on their far side, beneficiaries if there are any, and for a scheduled auction its starting_time."""
    key = ["block_number", "log_index"]
    out = creates.join(state, key).join(_ticks(positions, key), key).join(beneficiaries, key, "left")
    out = out if starting is None else out.join(starting.select(*key, "starting_time"), key)
    return out.withColumn("start_tick", F.when(F.col("asset") < F.col("numeraire"), F.col("upper")).otherwise(F.col("lower")))


def hook_creates(creates: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hook pools (pools, configurations): creates (block_number, log_index, asset, numeraire, creator) with the state call of the same event:
    the pool key, total_tokens_on_bonding_curve, hook_contract, status, far_tick. The type is rehype where the state says so."""
    from ledgerloom.operators.decode import pool_ids

    rows = creates.join(pool_ids(state), ["block_number", "log_index"]).withColumn("is_token_0", F.col("asset") < F.col("numeraire"))
    kind = F.when(F.col("rehype"), "rehype").otherwise("dhook") if "rehype" in state.columns else F.lit("dhook")
    pools = rows.select(
        F.col("pool_id").alias("address"), F.col("asset").alias("base_token"), F.col("numeraire").alias("quote_token"), "is_token_0", kind.alias("type"), "fee",
        F.col("block_number").alias("created_block"), "creator",
    )
    names = ("total_tokens_on_bonding_curve", "hook_contract", "status", "far_tick", "is_token_0")
    return pools, rows.select("pool_id", F.col("hooks").alias("hook_address"), "numeraire", *names)


def coin_creates(creator: DataFrame, content: DataFrame, quotes: DataFrame) -> DataFrame:
    """Creator and content coins as one; known quote tokens only; the pool hash of the event wins over the computed one."""
    both = creator.withColumn("kind", F.lit("creator")).unionByName(content.withColumn("kind", F.lit("content")))
    return both.join(quotes, "numeraire").withColumn("pool", F.coalesce("event_pool", "computed_pool")).drop("event_pool", "computed_pool")


#: What a migration pool takes over from its origin, where pools have it.
INHERITED = ("base_token", "quote_token", "is_token_0", "fee", "integrator", "initializer")


def migration_pools(migrations: DataFrame, pools: DataFrame, scopes: DataFrame | None = None, *, kind: str | None = None) -> DataFrame:
    """New pools from migrations: migration.pool = pools.migration_pool (within (source, source_version) scopes, of one migration type),
    taking over tokens, fee, integrator and initializer; `migrated_from` names the origin. Zero pools go."""
    origin = pools if scopes is None else pools.join(scopes, ["source", "source_version"], "left_semi")
    origin = origin if kind is None else origin.filter(F.col("migration_type") == kind)
    taken = [c for c in INHERITED if c in pools.columns]
    origin = origin.select(F.col("migration_pool").alias("pool"), F.col("address").alias("migrated_from"), *taken)
    return migrations.filter("pool <> 0").join(origin, "pool").select(F.col("pool").alias("address"), *taken, "migrated_from", "block_number")


def hook_migrations(migrations: DataFrame, pools: DataFrame, source, source_version: int) -> tuple[DataFrame, DataFrame]:
    """(new pools, migrations without an origin): Migrate events (asset, the five parts of the pool key, block_number) matched to a pool
    of that source and version by its base token; of several the least address. The new pool's address is the id of the event's key;
    a rehype origin gives migration_rehype, any other migration_dhook."""
    from ledgerloom.operators.decode import pool_ids

    taken = [c for c in INHERITED if c in pools.columns]
    origin = pools.filter((F.col("source") == source) & (F.col("source_version") == source_version))
    origin = origin.groupBy(F.col("base_token").alias("asset")).agg(F.min_by(F.struct(F.col("address").alias("migrated_from"), "type", *taken), "address").alias("o"))
    keys = [c for c in POOL_KEY if c != "fee"]
    rows = pool_ids(migrations).drop(*keys, "fee").join(origin, "asset", "left")
    rehype = F.col("o.type") == "rehype"
    new = rows.filter(F.col("o").isNotNull()).select(
        F.col("pool_id").alias("address"), *[F.col(f"o.{c}").alias(c) for c in taken], F.col("o.migrated_from").alias("migrated_from"),
        F.when(rehype, "migration_rehype").otherwise("migration_dhook").alias("type"), F.when(rehype, "rehype").otherwise("dhook").alias("migration_type"), "block_number",
    )
    return new, rows.filter(F.col("o").isNull()).select("asset", "pool_id", "block_number")


def migrate(pools: DataFrame, migrations: DataFrame) -> DataFrame:
    """A liquidity migration (address, successor, block_number): the successor comes in, where no pool has its address yet (the first row
    of an address stays), and the origin learns of it."""
    from ledgerloom.operators.merge import first_wins, update_by_key

    rest = [c for c in pools.columns if c not in ("address", "migration_pool", "migrated_at", "migrated_from", "created_block")]
    new = pools.join(migrations, "address").select(
        F.col("successor").alias("address"), *rest, F.lit(None).cast("bigint").alias("migration_pool"), F.lit(None).cast("bigint").alias("migrated_at"),
        F.col("address").alias("migrated_from"), F.col("block_number").alias("created_block"),
    ).select(*pools.columns)
    told = update_by_key(pools, migrations.select("address", F.col("successor").alias("migration_pool"), F.col("block_number").alias("migrated_at")), ["address"])
    return first_wins(told, new, ["address"], "created_block")


def backfill(pools: DataFrame, migrations: DataFrame, progress: DataFrame, *, copied_from: str, to: str) -> tuple[DataFrame, DataFrame]:
    """Replay of the migrations that no pool knows of yet, and the progress table with the ranges that `copied_from` has finished
    taken over for `to`. progress: handler, range_start, range_end."""
    from ledgerloom.operators.merge import first_wins

    new = migrations.join(pools.select(F.col("address").alias("successor")), "successor", "left_anti")
    done = progress.filter(F.col("handler") == copied_from).withColumn("handler", F.lit(to)).select(*progress.columns)
    return migrate(pools, new), first_wins(progress, done, ["handler", "range_start"], "range_end")


def pool_metadata(pools: DataFrame, tokens: DataFrame, scopes: DataFrame, addresses: DataFrame | None = None, from_block=None, to_block=None) -> DataFrame:
    """Pools in scope with the base token's decimals and supply: the token is the pool's own, or, for a migrated pool, its origin's."""
    rows = pools.join(scopes, ["source", "source_version"], "left_semi")
    if addresses is not None:
        rows = rows.join(addresses.select("address"), "address", "left_semi")
    if from_block is not None:
        rows = rows.filter(F.col("created_block") >= from_block)
    if to_block is not None:
        rows = rows.filter(F.col("created_block") < to_block)
    origin = pools.select(F.col("address").alias("o_address"), F.col("base_token").alias("o_base"))
    t = tokens.select(F.col("address").alias("t_address"), F.col("decimals").alias("base_decimals"), "total_supply")
    rows = rows.join(origin, F.col("migrated_from") == F.col("o_address"), "left")
    rows = rows.join(t, F.col("t_address") == F.coalesce("o_base", "base_token"), "left")
    return rows.select("address", "quote_token", "is_token_0", F.coalesce("base_decimals", F.lit(ASSET_DECIMALS)).alias("base_decimals"), "total_supply")


def unpriced_quotes(pools: DataFrame, prices: DataFrame) -> DataFrame:
    return pools.select(F.col("quote_token").alias("token")).distinct().join(prices.select("token"), "token", "left_anti")


def migrated_only(swaps: DataFrame, pools: DataFrame, kind: str | None = None) -> DataFrame:
    """Swaps of known migration pools."""
    known = pools.filter(F.col("migrated_from").isNotNull())
    known = known if kind is None else known.filter(F.col("migration_type") == kind)
    return swaps.join(known.select(F.col("address").alias("pool")), "pool", "left_semi")


#: The two events by which tokens tell of a transfer, and what their parameters are to it.
TRANSFER_SHAPES = {
    "Transfer(address indexed from, address indexed to, uint256 value)": {"from_address": "from", "to_address": "to", "value": "value"},
    "CoinTransfer(address indexed sender, address indexed recipient, uint256 amount, uint256 senderBalance, uint256 recipientBalance)": {"from_address": "sender", "to_address": "recipient", "value": "amount"},
}


def transfers_of(logs: DataFrame) -> DataFrame:
    """(token, block_number, log_index, ts, from_address, to_address, value) from raw logs of either shape.

    Rows sent by a precompiled contract do not count; values are decimal text. logs: also block_timestamp.
    """
    from ledgerloom.functions.words import u256_text
    from ledgerloom.operators.decode import decode_static, parse_event
    from ledgerloom.operators.matching import not_precompiled

    out = None
    for signature, names in TRANSFER_SHAPES.items():
        event = parse_event(signature)
        own = logs.filter(F.get("topics", F.lit(0)) == F.unhex(F.lit(event["topic0"].hex())))
        good, _ = decode_static(own, event)
        rows = good.select(F.col("address").alias("token"), "block_number", "log_index", *[F.col(f"`{old}`").alias(new) for new, old in names.items()])
        out = rows if out is None else out.unionByName(rows)
    out = out.filter(not_precompiled("from_address", binary=True)).withColumn("value", u256_text("value"))
    return out.join(logs.select("block_number", F.col("block_timestamp").alias("ts")).distinct(), "block_number")


def sightings(transfers: DataFrame) -> DataFrame:
    """(address, ts): senders and receivers."""
    side = F.explode(F.array("from_address", "to_address")).alias("address")
    return transfers.select(side, "ts")


def users(transfers: DataFrame) -> DataFrame:
    return sightings(transfers).groupBy("address").agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))


def moves(transfers: DataFrame, *columns: str) -> DataFrame:
    """(token, holder, value, and the columns): a transfer as what its receiver gets and its sender gives."""
    sides = F.array(F.struct(F.col("to_address").alias("holder"), F.col("value")), F.struct(F.col("from_address").alias("holder"), (-F.col("value")).alias("value")))
    return transfers.select("token", *columns, F.explode(sides).alias("m")).select("token", "m.holder", "m.value", *columns)


def balances(transfers: DataFrame) -> DataFrame:
    """(token, holder, balance) from transfers in and out."""
    return moves(transfers).groupBy("token", "holder").agg(F.sum("value").alias("balance"))


def portfolios(transfers: DataFrame) -> DataFrame:
    """Per holder and token: the balance, and when the holder first and last had to do with the token."""
    return moves(transfers, "ts").groupBy("holder", "token").agg(F.sum("value").alias("balance"), F.min("ts").alias("first_interacted"), F.max("ts").alias("last_interacted"))


def cumulated_fees(fees: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Totals per (pool, beneficiary) of fees (fee0, fee1: decimal text), added to those of earlier batches."""
    from ledgerloom.functions.words import sum_u256

    new = fees.select("pool", "beneficiary", F.col("fee0").alias("token0_fees"), F.col("fee1").alias("token1_fees"))
    both = new if totals is None else totals.select(new.columns).unionByName(new)
    return both.groupBy("pool", "beneficiary").agg(*[sum_u256(F.col(c)).alias(c) for c in ("token0_fees", "token1_fees")])


def holder_turns(transfers: DataFrame, at: str, bucket: int) -> DataFrame:
    """(token, at, turns): by how much the number of a token's holders changes at each value of `at` (a block, a day) that moves it.

    Moves are summed per (token, holder, at); running balances cross zero upwards (a holder more) or downwards (one less). They run by
    buckets of `at`: a holder with most of a token's moves is not ordered in one task.
    """
    steps = moves(transfers, at).groupBy("token", "holder", at).agg(F.sum("value").alias("_step"))
    held = running_sums(steps, ["token", "holder"], at, {"_balance": F.col("_step")}, bucket)
    turn = (F.col("_balance") > 0).cast("long") - (F.col("_balance") - F.col("_step") > 0).cast("long")
    return held.groupBy("token", at).agg(F.sum(turn).alias("turns"))


def holder_counts(transfers: DataFrame, at: str, bucket: int) -> DataFrame:
    """(token, at, holder_count): how many hold a token after each value of `at` at which their number changes."""
    turns = holder_turns(transfers, at, bucket).filter("turns <> 0")
    return running_sums(turns, ["token"], at, {"holder_count": F.col("turns")}, bucket).select("token", at, "holder_count")


def token_metrics(transfers: DataFrame, seconds: int = 86_400, bucket: int = 64) -> DataFrame:
    """Per token and day (of `seconds`) with transfers: their number and volume, and the number of holders at its end."""
    rows = transfers.withColumn("day", F.floor(F.col("ts") / seconds))
    daily = rows.groupBy("token", "day").agg(F.count(F.lit(1)).alias("transfers"), F.sum("value").alias("volume"))
    both = daily.join(holder_turns(rows, "day", bucket), ["token", "day"], "left")
    return running_sums(both, ["token"], "day", {"holder_count": F.col("turns")}, bucket).drop("turns")
