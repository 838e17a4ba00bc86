"""Running sums and next rows along an order, by buckets of it: no task orders more than a bucket of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def running_sums(rows: DataFrame, keys: list[str], at: str, sums: dict[str, Column], bucket: int, ties: tuple[str, ...] = ()) -> DataFrame:
    """rows with the sums over all rows of their key up to and with them, in order of `at` (a whole number) and the ties.

    Rows are summed per (key, bucket of `at`) first; what the buckets before hold is carried along, one row a bucket. Rows are then
    ordered within their bucket only. A key with a large share of all rows is as many tasks as it has buckets.
    """
    part = F.floor(F.col(at) / bucket).alias("_part")
    named = rows.select("*", part, *[c.alias(f"_v_{name}") for name, c in sums.items()])
    ends = named.groupBy(*keys, "_part").agg(*[F.sum(f"_v_{name}").alias(f"_s_{name}") for name in sums])
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, "_part", *[F.coalesce(F.sum(f"_s_{name}").over(before), F.lit(0)).alias(f"_c_{name}") for name in sums])
    upto = Window.partitionBy(*keys, "_part").orderBy(at, *ties).rowsBetween(Window.unboundedPreceding, 0)
    # what several rows of one key and bucket have in common is joined by equality, with nulls of a key meeting each other
    joined = named.alias("r").join(carried.alias("c"), [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in [*keys, "_part"]])
    out = joined.select("r.*", *[f"c._c_{name}" for name in sums])
    totals = [(F.col(f"_c_{name}") + F.coalesce(F.sum(f"_v_{name}").over(upto), F.lit(0))).alias(name) for name in sums]
    return out.select(*rows.columns, *totals)


def next_values(rows: DataFrame, keys: list[str], at: str, name: str, bucket: int) -> DataFrame:
    """rows with `name`: the next value of `at` that their key has (each once), null for the last."""
    named = rows.withColumn("_part", F.floor(F.col(at) / bucket))
    firsts = named.groupBy(*keys, "_part").agg(F.min(at).alias("_first"))
    after = firsts.select(*keys, "_part", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_part")).alias("_after"))
    inside = F.lead(at).over(Window.partitionBy(*keys, "_part").orderBy(at))
    return named.join(after, [*keys, "_part"]).withColumn(name, F.coalesce(inside, "_after")).select(*rows.columns, name)
