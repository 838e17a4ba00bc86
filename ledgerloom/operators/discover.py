"""Contracts made by factories, and which contracts and ranges are covered."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions import words
from ledgerloom.operators.matching import topic0


#: Matchers that are counted and found no more than this go to all tasks. A table made from local rows has no size the planner knows of: logs
#: would be shuffled to it, and, where all are of one factory and topic, each part of them made once per part of the matchers.
FEW_MATCHERS = 10_000


def created(logs: DataFrame, matchers: DataFrame) -> DataFrame:
    """(collection, address, created_block): addresses in factory events, in a topic or in the data.

    matchers: factory address, topic0, collection, place ('topic' or 'data'), index, and optionally start_block and inner. data[i] is
    the i-th word. data[i][j] (inner = j) is the j-th word of the array or tuple that the i-th word points to: its offset in
    bytes, where an array begins with its length (dynamic_array: skip it; data past it gives nothing). Several events may feed one
    collection; an address counts from its first block.
    """
    few = matchers.limit(FEW_MATCHERS + 1).count() <= FEW_MATCHERS
    hit = topic0(logs).join(F.broadcast(matchers) if few else matchers, ["address", "topic0"])
    if "start_block" in matchers.columns:
        hit = hit.filter(F.col("start_block").isNull() | (F.col("block_number") >= F.col("start_block")))
    data = words.word(F.col("data"), F.col("index"))
    if "inner" in matchers.columns:
        array = F.coalesce(F.col("dynamic_array"), F.lit(False)) if "dynamic_array" in matchers.columns else F.lit(False)
        # data and offset are bound: each is named many times over, and evaluated as often otherwise
        data = F.when(F.col("inner").isNull(), data).otherwise(words.let(F.struct("data", "index", "inner", array.alias("array")), _inner))
    word = F.when(F.col("place") == "topic", F.get(F.col("topics"), F.col("index"))).otherwise(data)
    found = hit.select("collection", words.address(word).alias("address"), "block_number").filter(F.col("address").isNotNull())
    return found.groupBy("collection", "address").agg(F.min("block_number").alias("created_block"))


def _inner(c):
    """Word c.inner of what the word c.index of c.data points to; null for an offset that does not fit the data, which points nowhere."""
    data, size, n = c["data"], F.octet_length(c["data"]), c["inner"]

    def read(at):
        length = F.when(size >= at + 32, words.uint64(F.substring(data, at + 1, F.lit(32))))
        begin = at + F.when(c["array"], 32).otherwise(0) + n * 32
        there = (size >= begin + 32) & (~c["array"] | (n < length))
        return F.when(there, F.substring(data, begin + 1, F.lit(32)))

    offset = words.let(words.uint64(words.word(data, c["index"])), lambda o: F.when(o < size, o.cast("int")))
    return words.let(offset, read)


def as_of(factories: DataFrame, block: int) -> DataFrame:
    """Addresses known by a block, over all earlier ranges."""
    return factories.filter(F.col("block_number") <= block).groupBy("collection", "address").agg(F.min("block_number").alias("created_block"))


def collection_sizes(addresses: DataFrame) -> DataFrame:
    """Distinct addresses per collection; the addresses themselves stay a table, whatever a collection's size."""
    return addresses.groupBy("collection").agg(F.countDistinct("address").alias("addresses"))


def uncovered(expected: DataFrame, indexed: DataFrame, keys: list[str]) -> DataFrame:
    """Expected (contract, range) pairs that the index lacks."""
    return expected.join(indexed.select(*keys), keys, "left_anti")


def seen_contracts(logs: DataFrame, contracts: DataFrame, size: int) -> DataFrame:
    """Which configured contracts appear in which block range."""
    pairs = logs.select("address", F.expr(f"block_number div {size}").alias("range")).distinct()
    return pairs.join(contracts.select("address").distinct(), "address", "left_semi")


def union_all(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
