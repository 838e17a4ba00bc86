"""Derivations: tables made from others, declared once and run alike over batches and streams.

A derivation names its inputs and outputs; an output names its keys and what becomes of several rows of one key. `run` derives
everything from whole tables; `sink` does so for each micro-batch of a stream, as a fact table per output with a folder per batch, which
a replayed batch writes anew; `read` resolves the facts. Both give the same tables, as the policies do not depend on how rows are cut
into batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Output:
    """keys: what identifies a row. policy: which of a key's rows stays, the `first` or the `newest` by `order` (ties by all columns), or
    `all` distinct ones. block: the column by which orphaned blocks' rows are taken out."""

    keys: tuple[str, ...]
    order: str
    policy: str = "newest"
    block: str | None = None

    def __post_init__(self):
        if self.policy not in ("first", "newest", "all"):
            raise ValueError(f"unknown policy {self.policy}")


@dataclass(frozen=True)
class Derivation:
    """derive: tables by name (inputs: of a batch the new rows; other derivations' outputs: resolved) -> rows by output."""

    name: str
    inputs: tuple[str, ...]
    outputs: dict[str, Output]
    derive: Callable[[dict[str, DataFrame]], dict[str, DataFrame]] = field(repr=False)
    version: int = 1

    @property
    def key(self) -> str:
        """By which progress is kept: a new version starts anew."""
        return f"{self.name}_v{self.version}"


def ordered(derivations: Iterable[Derivation]) -> list[Derivation]:
    """Each after those whose outputs it reads. Two that make one output, or that wait for each other, are an error."""
    makers: dict[str, Derivation] = {}
    for d in derivations:
        for name in d.outputs:
            if name in makers:
                raise ValueError(f"{name} is made by {makers[name].name} and by {d.name}")
            makers[name] = d
    by_name = {d.name: d for d in derivations}
    graph = {d.name: {makers[i].name for i in d.inputs if i in makers} for d in by_name.values()}
    return [by_name[n] for n in TopologicalSorter(graph).static_order()]


def resolve(rows: DataFrame, output: Output) -> DataFrame:
    """One row per key by the output's policy."""
    if output.policy == "all":
        return rows.distinct()
    rest = [c for c in rows.columns if c not in output.keys]
    pick = F.min_by if output.policy == "first" else F.max_by
    best = rows.groupBy(*output.keys).agg(pick(F.struct(*rest), F.struct(output.order, *rest)).alias("_s"))
    return best.select(*output.keys, *[F.col(f"_s.{c}").alias(c) for c in rest]).select(*rows.columns)


def _made(d: Derivation, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    missing = set(d.inputs) - tables.keys()
    if missing:
        raise ValueError(f"{d.name} lacks {sorted(missing)}")
    made = d.derive({i: tables[i] for i in d.inputs})
    if made.keys() != d.outputs.keys():
        raise ValueError(f"{d.name} makes {sorted(made)}, not {sorted(d.outputs)}")
    return made


def run(derivations: Iterable[Derivation], tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All outputs from whole tables."""
    known, out = dict(tables), {}
    for d in ordered(derivations):
        for name, rows in _made(d, known).items():
            known[name] = out[name] = resolve(rows, d.outputs[name])
    return out


def _folder(path: str, d: Derivation, name: str) -> str:
    return f"{path}/{d.key}/{name}"


def sink(derivations: Iterable[Derivation], path: str, split: Callable[[DataFrame], dict[str, DataFrame]], block: str = "block") -> Callable[[DataFrame, int], None]:
    """For foreachBatch. split: a micro-batch -> the input tables' new rows; block: its column, whose span is noted as progress."""
    steps = ordered(derivations)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            tables = split(batch)
            for d in steps:
                for name, rows in _made(d, tables).items():
                    rows.write.mode("overwrite").parquet(f"{_folder(path, d, name)}/batch={batch_id}")
                    tables[name] = read(spark, path, d, name)
                span = batch.agg(F.min(block).alias("first"), F.max(block).alias("last")).filter(F.col("first").isNotNull())
                span.select(F.lit(d.key).alias("handler"), "first", "last").write.mode("overwrite").parquet(f"{path}/_progress/{d.key}/batch={batch_id}")
        finally:
            batch.unpersist()

    return write


def read(spark: SparkSession, path: str, d: Derivation, name: str, orphaned: DataFrame | None = None) -> DataFrame:
    """An output's table as of the last batch. orphaned (number): blocks whose rows do not count, where the output has a block column:
    what they had replaced is there again."""
    folder, output = _folder(path, d, name), d.outputs[name]
    rows = spark.read.option("basePath", folder).parquet(folder).drop("batch")
    if orphaned is not None and output.block is not None:
        rows = rows.join(orphaned.select(F.col("number").alias(output.block)).distinct(), output.block, "left_anti").select(rows.columns)
    return resolve(rows, output)


def progress(spark: SparkSession, path: str, d: Derivation) -> DataFrame:
    """handler, first, last: the blocks of each batch."""
    folder = f"{path}/_progress/{d.key}"
    return spark.read.option("basePath", folder).parquet(folder).select("handler", "first", "last")
