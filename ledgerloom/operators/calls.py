"""Which contract calls are due, and auditing the results that are there."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions import words


def parameter_grid(functions: DataFrame, params: str = "params") -> DataFrame:
    """One row per combination of static parameter values: params is an array of value arrays."""
    grid = F.aggregate(
        F.col(params), F.array(F.array().cast("array<string>")),
        lambda acc, values: F.flatten(F.transform(acc, lambda done: F.transform(values, lambda v: F.concat(done, F.array(v))))),
    )
    return functions.withColumn("args", F.explode(grid)).drop(params)


def every_n(blocks: DataFrame, n: int) -> DataFrame:
    return blocks.filter(F.col("number") % n == 0)


def _whole_groups(parts: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Batches of sorted rows -> one frame per run of equal keys, also where a run goes over several batches."""
    held: list[pd.DataFrame] = []
    for p in parts:
        if not len(p):
            continue
        change = (p[keys] != p[keys].shift()).any(axis=1).to_numpy()
        change[0] = bool(held) and tuple(held[-1][keys].iloc[-1]) != tuple(p[keys].iloc[0])
        for at in np.split(np.arange(len(p)), np.flatnonzero(change)):
            if held and (not len(at) or change[at[0]]):
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            if len(at):
                held.append(p.iloc[at])
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def throttle(blocks: DataFrame, seconds: int, last_taken: DataFrame | None = None, *, key: str = "key", span: int = 512) -> DataFrame:
    """Blocks to call at when a call is due `seconds` after the last taken one, per key, from `last_taken` (0 at first).

    Which blocks are taken depends on the one before, but only through its time. So a key's time is cut into buckets of `span` *
    seconds that are worked on apart: for every block that a bucket can begin with (those of its first `seconds`, and the first
    one after) it is found where it would leave the bucket, and blocks that lead to the same end are put together. Only these few
    rows are gone through in order, key by key; then each bucket takes its blocks from its known beginning.
    """
    rows = blocks.select(F.col(key).alias("key"), "number", "ts").filter(F.col("ts").isNotNull())
    if last_taken is not None:
        rows = rows.join(last_taken.select(F.col(key).alias("key"), "taken"), "key", "left")
    else:
        rows = rows.withColumn("taken", F.lit(None).cast("bigint"))
    rows = rows.withColumn("taken", F.coalesce(F.col("taken").cast("bigint"), F.lit(0).cast("bigint"))).filter(F.col("ts") >= F.col("taken") + seconds)
    width, kind = seconds * span, rows.schema["key"].dataType.simpleString()
    rows = rows.withColumn("bucket", F.floor(F.col("ts") / width))
    # dealt by a struct: a shuffle by the columns themselves is left out after a join by them, and nothing then keeps adaptive execution from
    # reading that join's other side where it lies, a group in as many parts as there were map tasks
    ordered = lambda df, by, *then: df.repartition(F.struct(*by)).sortWithinPartitions(*by, *then)

    def ends(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in _whole_groups(parts, ["key", "bucket"]):
            times = np.unique(p["ts"].to_numpy())
            after = times.searchsorted(times + seconds)
            end = np.where(after == len(times), np.arange(len(times)), after)
            while (end[end] != end).any():  # each step doubles the blocks skipped
                end = end[end]
            begin = int(p["bucket"].iloc[0]) * width
            first = times[: int(times.searchsorted(begin + seconds)) + 1]
            last = times[end[: len(first)]]
            keep = np.append(last[1:] != last[:-1], True)  # of blocks with one end the latest
            n = int(keep.sum())
            yield pd.DataFrame({"key": [p["key"].iloc[0]] * n, "bucket": [p["bucket"].iloc[0]] * n, "upto": first[keep], "end": last[keep], "taken": [p["taken"].iloc[0]] * n})

    steps = ordered(rows, ["key", "bucket"], "ts").mapInPandas(ends, f"key {kind}, bucket long, upto long, end long, taken long")

    def starts(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, taken = object(), 0
        for p in _whole_groups(parts, ["key", "bucket"]):
            if p["key"].iloc[0] != now:
                now, taken = p["key"].iloc[0], int(p["taken"].iloc[0])
            at = int(p["upto"].to_numpy().searchsorted(taken + seconds))
            if at < len(p):
                yield pd.DataFrame({"key": [now], "bucket": [p["bucket"].iloc[0]], "start": [taken]})
                taken = int(p["end"].iloc[at])

    known = ordered(steps, ["key"], "bucket", "upto").mapInPandas(starts, f"key {kind}, bucket long, start long")

    def walk(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in _whole_groups(parts, ["key", "bucket"]):
            times, taken, keep = p["ts"].to_numpy(), int(p["start"].iloc[0]), []
            while (at := int(times.searchsorted(taken + seconds))) < len(times):
                keep.append(at)
                taken = int(times[at])
            yield p.iloc[keep][["key", "number", "ts"]]

    both = ordered(rows.drop("taken").join(known, ["key", "bucket"]), ["key", "bucket"], "ts", "number")
    return both.mapInPandas(walk, f"key {kind}, number long, ts long").withColumnRenamed("key", key)


def once_per_address(addresses: DataFrame, done: DataFrame) -> DataFrame:
    """The first block of each address that has no result yet."""
    first = addresses.groupBy("address").agg(F.min("block_number").alias("block_number"))
    return first.join(done.select("address"), "address", "left_anti")


def event_plan(triggers: DataFrame, config: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """Triggered calls: trigger joined to call configuration on (source, topic0) from the start block.

    config: source, topic0, function, start_block, target (fixed, or null: the emitter, which must be in `members`).
    """
    hit = triggers.join(config, ["source", "topic0"]).filter("block_number >= start_block")
    fixed = hit.filter(F.col("target").isNotNull()).withColumn("call_target", F.col("target"))
    emitter = hit.filter(F.col("target").isNull()).withColumn("call_target", F.col("address"))
    if members is not None:
        emitter = emitter.join(members.select("address").distinct(), "address", "left_semi").select(*fixed.columns)
    return fixed.unionByName(emitter).select("block_number", "log_index", "source", "function", "call_target")


def event_parameters(events: DataFrame, place: str, index: int = 0) -> DataFrame:
    """The parameter taken from an event: 'emitter', 'topic' i, 'data' word i, 'pool_id' (the hash of the pool key in the first five
    data words) or 'pool_key' (the five words from word i on, encoded as a tuple). Events too short for it go.

    The pool id is computed once per distinct key.
    """
    if place == "pool_id":
        from ledgerloom.functions.keccak import with_hash

        short = events.filter(F.octet_length("data") >= 160)
        return with_hash(short.withColumn("_key", _pool_key(0)), "_key", "param").drop("_key")
    if place == "emitter":
        value = F.col("address")
    elif place == "pool_key":
        value = F.when(F.octet_length("data") >= (index + 5) * 32, _pool_key(index))
    else:
        value = F.get(F.col("topics"), F.lit(index)) if place == "topic" else words.word(F.col("data"), index)
    return events.withColumn("param", value).filter(F.col("param").isNotNull())


def _pool_key(at: int):
    """Five data words as the encoding of a pool key: addresses in 20 bytes, a fee in 3 and a signed spacing in 3, each in its word."""
    word = lambda i: words.word(F.col("data"), at + i)
    address = lambda w: F.concat(F.unhex(F.lit("00" * 12)), words.address(w))
    low = lambda w: F.substring(w, 30, 3)
    fee = F.concat(F.unhex(F.lit("00" * 29)), low(word(2)))
    fill = F.when(F.hex(F.substring(word(3), 30, 1)) >= "80", F.unhex(F.lit("FF" * 29))).otherwise(F.unhex(F.lit("00" * 29)))
    return F.concat(address(word(0)), address(word(1)), fee, F.concat(fill, low(word(3))), address(word(4)))


def audit(expected: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: expected and stored multiplicity, and what to do: none, index (present, only to be listed) or recollect."""
    e = expected.groupBy(*keys).agg(F.count(F.lit(1)).alias("expected"))
    s = stored.groupBy(*keys).agg(F.count(F.lit(1)).alias("stored"))
    both = e.join(s, keys, "full_outer").na.fill(0, ["expected", "stored"])
    action = F.when(F.col("expected") == F.col("stored"), "none").when((F.col("expected") < F.col("stored")) & (F.col("expected") > 0), "index").otherwise("recollect")
    return both.withColumn("action", action)


def merge_once(old: DataFrame, new: DataFrame, key: str = "contract_address") -> DataFrame:
    """New function columns into the wide table: old cells that are not null stay, nulls are filled, the row set is old's."""
    fresh = [c for c in new.columns if c != key]
    both = old.alias("o").join(new.alias("n"), key, "left")
    kept = [F.coalesce(f"o.{c}", f"n.{c}").alias(c) if c in fresh else F.col(f"o.{c}").alias(c) for c in old.columns if c != key]
    return both.select(key, *kept, *[F.col(f"n.{c}").alias(c) for c in fresh if c not in old.columns])


def null_cells(wide: DataFrame, key: str = "contract_address") -> DataFrame:
    """(key, function) of every cell without a value."""
    functions = [c for c in wide.columns if c != key]
    pairs = F.array(*[F.struct(F.lit(c).alias("function"), F.col(c).isNull().alias("missing")) for c in functions])
    return wide.select(key, F.explode(pairs).alias("p")).filter("p.missing").select(key, "p.function")


def fillable(wide: DataFrame, raw: DataFrame, key: str = "contract_address") -> DataFrame:
    """Functions whose null cells the raw table can fill, with how many."""
    functions = [c for c in wide.columns if c != key and c in raw.columns]
    parts = [
        wide.filter(F.col(c).isNull()).select(key).join(raw.filter(F.col(c).isNotNull()).select(key), key, "left_semi").agg(F.count(F.lit(1)).alias("cells")).select(F.lit(c).alias("function"), "cells")
        for c in functions
    ]
    return reduce(DataFrame.unionByName, parts).filter("cells > 0")


def reverted(calls: DataFrame) -> DataFrame:
    return calls.filter("is_reverted")
