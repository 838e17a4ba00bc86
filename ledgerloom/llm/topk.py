"""Exact top-k search by inner product with pivot-table elimination.

Every vector's distances to a few pivots are computed once: the pivot table. For a query q and a row x the largest
|d(x, p) - d(q, p)| bounds their distance from below, and with the norms that bounds the inner product from above.

1. A row belongs to the region of its nearest pivot, and a region's rows are dealt to blocks. Per region the least and greatest
   distance to every pivot and the greatest norm are kept: PIVOTS rows in all.
2. Each query searches one block of its own region. Its k-th best score there is its threshold.
3. A query goes on only to the regions whose bound is not under its threshold. Within a block it looks at the rows of the greatest
   bounds first, drops all rows whose bound is under the k-th best score so far, and stops when none is left.

Blocks' best lists are then merged by rank: exact, with no limit on candidates. The pivots are chosen by farthest-first traversal of
a sample of at most PIVOT_SAMPLE rows; they decide the speed, never the result.

Defined cases: vectors that are null, empty, hold null or non-finite components, or have another length than most, and
rows without an id take no part; equal rows count once; a query's own id is never its candidate; ties go to the smaller
id; fewer than k candidates give fewer rows; an empty table gives none; other columns are ignored. Scores are exact integers; one
that does not fit a long becomes the nearest long.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.common import cut

PIVOTS, PIVOT_SAMPLE = 32, 1024
ROWS, QUERIES, STEP = 4096, 1024, 128
LONG = np.iinfo(np.int64)


def quantised(embedding: Column) -> Column:
    """floor(256 * x) of every component, null for a vector that takes no part."""
    x = F.transform(embedding, lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(~bad & (F.size(x) > 0), F.transform(x, lambda c: F.floor(256 * c)))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first: each next pivot has the largest distance to those before it."""
    picked, near = [0], np.linalg.norm(sample - sample[0], axis=1)
    while len(picked) < min(n, len(sample)):
        picked.append(int(near.argmax()))
        near = np.minimum(near, np.linalg.norm(sample - sample[picked[-1]], axis=1))
    return sample[picked]


def upper_bound(norms: np.ndarray, q_norm: float, gap: np.ndarray) -> np.ndarray:
    """The inner product of vectors with these squared norms whose distance is at least `gap`, rounding included."""
    size = norms + q_norm
    return (size - np.maximum(gap - 1e-7 * np.sqrt(size), 0) ** 2) / 2 + 1e-9 * size + 1e-3


def scores_of(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors: in doubles while they hold every sum, then in longs, then in Python's integers."""
    most = float(np.abs(x.astype(float)).max(initial=0)) * float(np.abs(q.astype(float)).max(initial=0)) * len(q)
    if most < 1 << 53:
        return (x.astype(float) @ q.astype(float)).astype(np.int64)
    if most < 1 << 62:
        return x @ q
    exact = x.astype(object) @ q.astype(object)
    return np.array([min(max(s, LONG.min), LONG.max) for s in exact], np.int64)


def search_block(q_id, q, q_piv, x_id, x, x_piv, k: int, floors=None) -> list[tuple[int, int, int]]:
    """(query, row, score) of each query's k best rows of the block, by elimination over the pivot table.

    floors: a score per query below which no row is of interest.
    """
    order = np.argsort(x_id, kind="stable")
    x_id, x, x_piv = x_id[order], x[order], x_piv[order]
    wide = x.astype(float)
    norms, out = (wide * wide).sum(axis=1), []
    wide_q = q.astype(float)
    small = float(np.abs(wide).max(initial=0)) * float(np.abs(wide_q).max(initial=0)) * x.shape[1] < 1 << 53
    by_pivot = np.ascontiguousarray(x_piv.T)
    for i in range(len(q_id)):
        gap = np.abs(by_pivot - q_piv[i][:, None]).max(axis=0)
        bound = upper_bound(norms, float(wide_q[i] @ wide_q[i]), gap)
        left = np.flatnonzero((x_id != q_id[i]) & (bound >= (-np.inf if floors is None else floors[i])))
        ids, scores, step = np.empty(0, np.int64), np.empty(0, np.int64), STEP
        while len(left):  # the rows of the greatest bounds first; the first few set the mark, and steps grow
            turn = np.argpartition(-bound[left], step)[:step] if len(left) > step else np.arange(len(left))
            some, rest = left[turn], np.delete(left, turn)
            if small:
                got = wide[some] @ wide_q[i] if 4 * len(some) < len(x) else (wide @ wide_q[i])[some]
                got = got.astype(np.int64)
            else:
                got = scores_of(x[some], q[i])
            ids, scores = np.concatenate([ids, x_id[some]]), np.concatenate([scores, got])
            if len(scores) > 64:
                least = np.partition(scores, len(scores) - k)[len(scores) - k]
                ids, scores = ids[scores >= least], scores[scores >= least]
            best = np.lexsort((ids, ~scores))[:k]
            ids, scores, step = ids[best], scores[best], step * 4
            left = rest[bound[rest] >= scores[-1]] if len(scores) == k else rest  # what is under the mark is out for good
        out += [(int(q_id[i]), int(a), int(s)) for a, s in zip(ids, scores)]
    return out


def _stack(s: pd.Series) -> np.ndarray:
    return np.stack(s.map(np.asarray))


def _pivot_table(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """rows (id, v, q) with d: the distances to the pivots, r: the nearest pivot, and norm: the squared norm."""

    def measure(parts):
        for p in parts:
            if len(p):
                x = _stack(p["v"]).astype(float)
                d = np.stack([np.linalg.norm(x - pivot, axis=1) for pivot in pivots], axis=1)
                yield p.assign(d=list(d), r=d.argmin(axis=1).astype(np.int32), norm=(x * x).sum(axis=1))[["id", "v", "q", "d", "r", "norm"]]

    return cut(rows.mapInPandas(measure, "id long, v array<long>, q boolean, d array<double>, r int, norm double"))


def _cogrouped(asked: DataFrame, data: DataFrame, k: int) -> DataFrame:
    """Each block of queries against its block of rows: (query_id, vec_id, score)."""

    def search(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(x):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        floors = q["floor"].astype("float64").fillna(-np.inf).to_numpy()
        out = search_block(q["id"].to_numpy(), _stack(q["v"]), _stack(q["d"]), x["id"].to_numpy(), _stack(x["v"]), _stack(x["d"]), k, floors)
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    on = ["r", "i", "j"]
    asked, data = (df.toDF(*df.columns) for df in (asked, data))  # both come from one table: each gets columns of its own
    return asked.groupBy(*on).cogroup(data.groupBy(*on)).applyInPandas(search, "query_id long, vec_id long, score long")


def _block(n, salt: int) -> Column:
    return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n) if isinstance(n, int) else n).cast("int")


def _dealt(table: DataFrame, asked: DataFrame, blocks: DataFrame, k: int, first_only: bool) -> DataFrame:
    """asked (id, v, d, floor, r: the region to search) against that region's blocks, or against its first block alone.

    A region's queries are dealt to blocks of about QUERIES; rows are copied once per block of queries of their region.
    """
    turns = asked.groupBy("r").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("turns"))
    sizes = F.broadcast(blocks.join(turns, "r").select("r", F.lit(1).alias("blocks") if first_only else "blocks", F.col("blocks").alias("all"), "turns"))
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    data = table.select("id", "v", "d", "r").join(sizes, "r").withColumn("i", _block(F.col("all"), 1))
    data = data.filter("i < blocks").withColumn("j", upto("turns")).select("r", "i", "j", "id", "v", "d")
    asked = asked.join(sizes, "r").withColumn("j", _block(F.col("turns"), 2)).withColumn("i", upto("blocks")).select("r", "i", "j", "id", "v", "d", "floor")
    return _cogrouped(asked, data, k)


def top_k(vectors: DataFrame, is_query: Column, *, key: str = "vec_id", vector: str = "embedding", k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row that is_query picks, its k best other rows."""
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), quantised(F.col(vector)).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull()).dropDuplicates(["id", "v"])
    usual = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if usual is None:
        found = vectors.sparkSession.createDataFrame([], "query_id long, vec_id long, score long")
    else:
        rows = rows.filter(F.size("v") == usual["d"])
        sample = rows.orderBy(F.xxhash64("id"), "id", "v").limit(PIVOT_SAMPLE).select("v").toPandas()["v"]
        pivots = choose_pivots(_stack(sample).astype(float), PIVOTS)
        table = _pivot_table(rows, pivots)
        n = len(pivots)
        ends = [f(F.col("d")[p]).alias(f"{name}{p}") for p in range(n) for name, f in (("lo", F.min), ("hi", F.max))]
        regions = cut(table.groupBy("r").agg(F.ceil(F.count(F.lit(1)) / ROWS).cast("int").alias("blocks"), F.max("norm").alias("norm"), *ends))
        summary = regions.orderBy("r").toPandas()  # at most PIVOTS rows
        lo, hi = (summary[[f"{name}{p}" for p in range(n)]].to_numpy() for name in ("lo", "hi"))
        number, norm = summary["r"].to_numpy(), summary["norm"].to_numpy()
        blocks = regions.select("r", "blocks")
        queries = table.filter("q").select("id", "v", "d", "norm", "r")

        first = _dealt(table, queries.withColumn("floor", F.lit(None).cast("long")), blocks, k, first_only=True)
        floors = first.groupBy("query_id").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == k)
        queries = queries.drop("r").join(cut(floors.select(F.col("query_id").alias("id"), "floor")), "id", "left")

        def ahead(parts):
            """Each query once per region that may hold one of its k best."""
            for p in parts:
                if len(p):
                    d, floor = _stack(p["d"]), p["floor"].astype("float64").fillna(-np.inf).to_numpy()
                    gap = np.maximum(lo[None] - d[:, None], d[:, None] - hi[None]).max(axis=2)
                    bound = np.stack([upper_bound(norm, own, g) for own, g in zip(p["norm"], gap)])
                    who, where = np.nonzero(bound >= floor[:, None])
                    yield p.iloc[who].assign(r=number[where])[["id", "v", "d", "floor", "r"]]

        spread = cut(queries.mapInPandas(ahead, "id long, v array<long>, d array<double>, floor long, r int"))
        found = _dealt(table, spread, blocks, k, first_only=False)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
