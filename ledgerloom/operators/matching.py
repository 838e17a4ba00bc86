"""Which logs are of interest: registry matches, factory contracts, pre-filters, triggers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Precompiled contracts 0x01 .. 0x11, which are neither senders nor tokens.
PRECOMPILES = tuple(range(1, 0x12))


def topic0(logs: DataFrame) -> DataFrame:
    """Logs without topics cannot match anything and go."""
    return logs.filter(F.size("topics") > 0).withColumn("topic0", F.col("topics")[0])


def match_events(logs: DataFrame, events: DataFrame) -> DataFrame:
    """Logs joined to registry events (address, topic0, start_block, ...) from their start block on; one log may match several.

    The registry is a configuration table; the planner broadcasts it by its size.
    """
    return topic0(logs).join(events, ["address", "topic0"]).filter("block_number >= start_block")


def match_factory_events(logs: DataFrame, events: DataFrame, created: DataFrame, *, respect_creation: bool = False) -> DataFrame:
    """Logs of contracts that a factory made: topic0 of a collection's event, and the emitter in that collection.

    respect_creation also asks that the contract was created no later than the log.
    """
    found = topic0(logs).join(events, "topic0").join(created.select("collection", "address", "created_block"), ["collection", "address"])
    return found.filter("block_number >= created_block") if respect_creation else found


def from_known(logs: DataFrame, *addresses: DataFrame) -> DataFrame:
    """Logs of any of the address tables."""
    all_ = addresses[0].select("address")
    for more in addresses[1:]:
        all_ = all_.unionByName(more.select("address"))
    return logs.join(all_.distinct(), "address", "left_semi")


def triggers(logs: DataFrame, matchers: DataFrame) -> DataFrame:
    """Event triggers (source): by address and topic0, or by topic0 alone where a matcher has no address; once per (block, log, source)."""
    rows = topic0(logs)
    m = matchers.withColumnRenamed("address", "only")
    hit = rows.join(m, "topic0").filter(F.col("only").isNull() | (F.col("only") == F.col("address"))).filter("block_number >= start_block")
    return hit.dropDuplicates(["block_number", "log_index", "source"]).drop("only")


def of_type(decoded: DataFrame, source: str, name: str, start_block: int = 0, address: Column | None = None) -> DataFrame:
    out = decoded.filter((F.col("source_name") == source) & (F.col("event_name") == name) & (F.col("block_number") >= start_block))
    return out if address is None else out.filter(F.col("contract_address") == address)


def query_events(decoded: DataFrame, *, source=None, event=None, address=None, from_block=None, to_block=None, limit=None) -> DataFrame:
    """Decoded events by any of source, name and address in the half-open block range; limit only if asked for."""
    out = decoded
    for column, value in (("source_name", source), ("event_name", event), ("contract_address", address)):
        if value is not None:
            out = out.filter(F.col(column) == value)
    if from_block is not None:
        out = out.filter(F.col("block_number") >= from_block)
    if to_block is not None:
        out = out.filter(F.col("block_number") < to_block)
    return out if limit is None else out.orderBy("block_number", "log_index").limit(limit)


def overlapping(ranges: DataFrame, from_block: int, to_block: int) -> DataFrame:
    """Files (start, end inclusive) that meet the half-open range [from_block, to_block)."""
    return ranges.filter((F.col("end") >= from_block) & (F.col("start") < to_block))


def not_precompiled(*columns: str, binary: bool = False) -> Column:
    """None of the columns is a precompiled contract's address, as a number or as its 20 bytes."""
    known = [F.unhex(F.lit(f"{n:040x}")) if binary else n for n in PRECOMPILES]
    keep = F.lit(True)
    for c in columns:
        keep = keep & ~F.col(c).isin(*known)
    return keep


def not_reverted(calls: DataFrame) -> DataFrame:
    return calls.filter(~F.coalesce(F.col("is_reverted"), F.lit(False)))


def repair_scope(ranges: DataFrame, *, from_block=None, to_block=None, sources=(), functions=()) -> DataFrame:
    """Ranges (start, end exclusive, source, function) within an optional scope; what is left open does not restrict."""
    out = ranges
    if from_block is not None:
        out = out.filter(F.col("end") - 1 >= from_block)
    if to_block is not None:
        out = out.filter(F.col("start") <= to_block)
    if sources:
        out = out.filter(F.col("source").isin(*sources))
    return out.filter(F.col("function").isin(*functions)) if functions else out


def role_of(df: DataFrame, address: str, roles: DataFrame) -> DataFrame:
    """df with `role`: of the first entry (least priority) of the ordered role list that has the address, else 'unknown'."""
    first = roles.groupBy("address").agg(F.min_by("role", "priority").alias("role"))
    return df.join(first.withColumnRenamed("address", address), address, "left").withColumn("role", F.coalesce("role", F.lit("unknown")))


def is_token0(asset: Column, numeraire: Column) -> Column:
    """Binary columns compare as unsigned bytes."""
    return asset < numeraire
