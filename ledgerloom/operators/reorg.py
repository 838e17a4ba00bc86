"""Chain reorganisations: finding them, retracting rows, rolling state back, readiness reports."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

DEPTH = 128


def broken_links(blocks: DataFrame) -> DataFrame:
    """Blocks whose parent hash is not the hash of the block before."""
    parent = blocks.select((F.col("number") + 1).alias("number"), F.col("hash").alias("before"))
    return blocks.join(parent, "number").filter("parent_hash <> before").select("number", "hash", "parent_hash", "before")


def canonical(blocks: DataFrame, *, chain: str | None = None, bucket: int = 10_000) -> DataFrame:
    """Blocks on the chain of the tip: (number, hash), with several hashes per number allowed; per value of the column `chain` if given.

    Consecutive heights of a bucket with a single hash each that fit together are one run; a contested height's blocks stand alone. Only runs and contested blocks are walked, by pointer doubling, so the number of joins is the
    logarithm of their number on the longest chain. A block that builds on the middle of a run takes in the run up to there.
    """
    from ledgerloom.sources.shared import cut

    by = [chain] if chain else []
    # dealt once: grouping by height and both windows go by the bucket that a row lies in
    rows = blocks.select(*by, F.floor(F.col("number") / bucket).alias("_b"), "number", "hash", "parent_hash").repartition(*by, "_b")
    heights = rows.groupBy(*by, "_b", "number").agg(F.sort_array(F.collect_set(F.struct("hash", "parent_hash"))).alias("all"))
    heights = heights.withColumns({"single": F.size("all") == 1, "only": F.col("all")[0]["hash"], "parent": F.col("all")[0]["parent_hash"]})
    before = lambda c: F.lag(c).over(Window.partitionBy(*by, "_b").orderBy("number"))
    fits = F.col("single") & before("single") & (before("number") == F.col("number") - 1) & (F.col("parent") == before("only"))
    heights = heights.withColumn("fits", F.coalesce(fits, F.lit(False)))
    upto = Window.partitionBy(*by, "_b").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    run = F.last(F.when(~F.col("fits"), F.col("only")), ignorenulls=True).over(upto)
    placed = heights.withColumn("run", run).withColumn("one", F.explode("all"))
    node = F.when(F.col("single"), F.col("run")).otherwise(F.col("one.hash"))
    placed = cut(placed.select(*by, "number", "one.hash", "one.parent_hash", node.alias("node"), (~F.col("fits")).alias("lowest")))
    parents = placed.select(*by, F.col("hash").alias("parent_hash"), F.col("node").alias("up"), F.col("number").alias("upto"))
    jump = cut(placed.filter("lowest").select(*by, "node", "parent_hash").join(parents, [*by, "parent_hash"]).select(*by, "node", "up", "upto"))
    tips = placed.groupBy(*by).agg(F.max_by(F.struct("node", "number"), F.struct("number", "hash")).alias("t"))
    reached, known = cut(tips.select(*by, F.col("t.node").alias("node"), F.col("t.number").alias("upto"))), -1
    while (n := reached.count()) != known:  # ends when nothing is added
        known = n
        step = jump.join(reached.select(*by, "node"), [*by, "node"]).select(*by, F.col("up").alias("node"), "upto")
        reached = cut(reached.unionByName(step).distinct())
        on = [F.col("a.up") == F.col("b.node"), *[F.col(f"a.{c}") == F.col(f"b.{c}") for c in by]]
        jump = cut(jump.alias("a").join(jump.alias("b"), on).select(*[f"a.{c}" for c in by], F.col("a.node").alias("node"), F.col("b.up").alias("up"), F.col("b.upto").alias("upto")))
    return placed.join(reached, [*by, "node"]).filter(F.col("number") <= F.col("upto")).select(*by, "number", "hash").distinct()


def orphans(blocks: DataFrame, chain: DataFrame) -> DataFrame:
    return blocks.join(chain, ["number", "hash"], "left_anti")


def retract(rows: DataFrame, orphaned: DataFrame) -> DataFrame:
    """Derived rows without those of orphaned blocks."""
    return rows.join(orphaned.select(F.col("number").alias("block")).distinct(), "block", "left_anti")


def capture_images(target: DataFrame, incoming: DataFrame, keys: list[str], block: str) -> DataFrame:
    """Before-images: for each incoming row the target's row of that key, or none, with the block that changes it."""
    rest = [c for c in target.columns if c not in keys]
    before = target.select(*keys, F.struct(*rest).alias("image"))
    return incoming.select(*keys, F.col(block).alias("changed_at")).distinct().join(before, keys, "left")


def roll_back(target: DataFrame, images: DataFrame, orphaned: DataFrame, keys: list[str]) -> DataFrame:
    """State before the orphaned blocks: per key the earliest image of an orphaned block; no image means the row was absent."""
    gone = images.join(orphaned.select(F.col("number").alias("changed_at")).distinct(), "changed_at", "left_semi")
    first = gone.groupBy(*keys).agg(F.min_by(F.struct("image"), "changed_at").alias("first"))
    kept = target.join(first.select(*keys), keys, "left_anti")
    back = first.filter("first.image is not null").select(*keys, "first.image.*").select(*target.columns)
    return kept.unionByName(back)


def recompute(spark: SparkSession, path: str, rows: DataFrame, orphaned: DataFrame, derive: Callable[[DataFrame], DataFrame], *, size: int = 10_000, behind: int = 0, ahead: int = 0) -> list[int]:
    """Bring a derived table up to date after a reorganisation, by rewriting its block ranges that the orphaned blocks touch.

    path: the derived table as scan.write_ranges lays it out in ranges of `size` blocks; rows: what it is derived from, without the
    orphaned blocks' rows and with those that took their place; derive: rows -> derived rows, with the same block column. A derived row
    may depend on rows up to `behind` blocks before its own and `ahead` blocks after it: ranges that far away are rewritten too, and
    their neighbours are read along. Ranges whose new content is empty go. Files of other ranges stay as they are. Returns the ranges
    that were rewritten: they are as many as a reorganisation reaches, a few.
    """
    from ledgerloom.sources.scan import BUCKET, block_of

    number = F.col("number")
    touched = F.sequence(F.floor((number - ahead) / size), F.floor((number + behind) / size))
    ranges = sorted(r[0] for r in orphaned.select(F.explode(touched).alias("r")).distinct().collect() if r[0] >= 0)
    if not ranges:
        return []
    own = F.col(block_of(rows))
    needed = [own.between(r * size - behind, (r + 1) * size - 1 + ahead) for r in ranges]
    made = derive(rows.filter(reduce(Column.__or__, needed)))
    made = made.withColumn(BUCKET, F.floor(F.col(block_of(made)) / size)).filter(F.col(BUCKET).isin(ranges))
    made.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    filled = {r[0] for r in made.select(BUCKET).distinct().collect()}
    folder = spark._jvm.org.apache.hadoop.fs.Path
    files = folder(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for r in set(ranges) - filled:
        files.delete(folder(f"{path}/{BUCKET}={r}"), True)
    return ranges


def uncovered_deletes(tables: DataFrame, orphaned: DataFrame, images: DataFrame) -> DataFrame:
    """(table, block) pairs to delete by block because no image covers them."""
    names = tables.agg(F.collect_set("table").alias("t"))  # the tables of a schema: one row
    pairs = orphaned.select(F.col("number").alias("block")).distinct().crossJoin(F.broadcast(names)).select(F.explode("t").alias("table"), "block")
    return pairs.join(images.select("table", F.col("changed_at").alias("block")).distinct(), ["table", "block"], "left_anti")


def settled_ranges(blocks: DataFrame, size: int, depth: int = DEPTH) -> DataFrame:
    """Ranges that are complete and end before the newest block less the reorg depth: those that may be compacted."""
    from ledgerloom.operators.merge import completeness

    latest = blocks.agg(F.max("number").alias("latest"))
    return completeness(blocks, "number", size).filter("complete").join(F.broadcast(latest)).filter(F.col("last") < F.col("latest") - depth).select("range", "n")


def waiting(events: DataFrame, calls: DataFrame, now: int, timeout: int = 300) -> DataFrame:
    """Events by whether their dependent call came: ready, waiting, or backlog after the timeout."""
    done = calls.select("block_number", "log_index").distinct().withColumn("done", F.lit(True))
    out = events.join(done, ["block_number", "log_index"], "left")
    state = F.when(F.col("done"), "ready").when(F.lit(now) - F.col("ts") > timeout, "backlog").otherwise("waiting")
    return out.withColumn("state", state).drop("done")


def stuck(status: DataFrame, expected: list[str], now: int, grace: int) -> DataFrame:
    """Blocks whose inputs are there but which some handlers have not done after the grace time, with the missing handlers."""
    missing = F.array_sort(F.array_except(F.array(*[F.lit(x) for x in expected]), F.col("done")))
    return status.filter(F.col("inputs_ready") & (F.lit(now) - F.col("ts") > grace)).withColumn("missing", missing).filter(F.size("missing") > 0)


def complete(status: DataFrame, stages: list[str]) -> DataFrame:
    """complete: every stage is done or not expected (columns <stage> and expect_<stage>)."""
    ok = F.lit(True)
    for s in stages:
        ok = ok & (~F.col(f"expect_{s}") | F.col(s))
    return status.withColumn("complete", ok)


def first_per_log(rows: DataFrame) -> DataFrame:
    """Idempotent replay: one row per (chain, block, log_index)."""
    return rows.dropDuplicates(["chain_id", "block", "log_index"])
