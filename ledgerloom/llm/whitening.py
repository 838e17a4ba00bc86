"""Whitening of embeddings by a polarisation covariance.

Components become integers x = floor(256 * c). Over the distinct vectors (n of them, sums S per dimension) the centred values
y = n * x - S are integers too. Summed exactly are y_i^2 of every dimension and (y_i + y_j)^2 of every sum of two: half of what the
latter has more than both former is the co-moment of i and j, so V = moments / n^3 comes from variances alone. V is rounded once, to
doubles, and taken apart by eigh on the driver. Tasks sum their rows' squares in longs of LIMB bits each and put out one row per sum,
whatever they have read; the driver gets d * (d + 1) / 2 sums.

Every row then gets its components: (x - S / n) along the unit eigenvector, over the square root of its eigenvalue.

Defined cases: vectors that are null, empty, hold null or non-finite entries, or have another length than most (of equally frequent
lengths the shorter counts) take no part; a vector counts once for the fit however many rows hold it, and every row gets its own
result, null or repeated ids included; components whose eigenvalue is no more than 1e-12 of the trace (constant or dependent
dimensions, a lone vector) are left out; an empty table gives none; other columns are ignored. A deviation that does not fit a long
becomes the greatest long, as does an entry's 256-fold that does not (the least where it is negative).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import col, cut

LIMB = 31
#: Rows whose squares are formed together.
ROWS = 512
LONG = np.iinfo(np.int64)
#: Eigenvalues up to this share of the trace are rounding.
NOTHING = 1e-12


def integers(embedding: Column) -> Column:
    """floor(256 * c) of every entry, null for a vector that takes no part."""
    c = F.transform(embedding, lambda e: e.cast("double"))
    bad = F.exists(c, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return F.when(~bad & (F.size(c) > 0), F.transform(c, lambda e: F.floor(256 * e)))


def limbs(total: int, n: int = 5) -> list[int]:
    """A whole number in digits of LIMB bits, the last of which has the sign."""
    out = []
    for _ in range(n - 1):
        out.append(total & (1 << LIMB) - 1)
        total >>= LIMB
    return [*out, total]


def whole(digits) -> int:
    return sum(int(d) << LIMB * i for i, d in enumerate(digits))


def sums_of_squares(z: np.ndarray) -> list[int]:
    """Exact sums of z * z down the columns. z: whole numbers, as longs or as Python's integers."""
    if z.dtype == object:
        return [int(t) for t in (z * z).sum(axis=0)]
    mask, h, low = (1 << LIMB) - 1, z >> LIMB, z & (1 << LIMB) - 1
    parts = [(0, low * low)]
    if h.any():  # |h| is under 2^31
        parts += [(LIMB + 1, h * low), (2 * LIMB, h * h)]
    total = [0] * z.shape[1]
    for shift, p in parts:
        for c, (hi, lo) in enumerate(zip((p >> LIMB).sum(axis=0).tolist(), (p & mask).sum(axis=0).tolist())):
            total[c] += (hi << LIMB) + lo << shift
    return total


def _vectors(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _centred(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """n * x - S, in longs while every sum of two stays under 2^61."""
    most = n * int(np.abs(x.astype(float)).max(initial=0) + 1) + max(map(abs, s))
    if most < 1 << 60:
        return n * x - np.array(s, np.int64)
    return n * x.astype(object) - np.array(s, object)


def _totals(df: DataFrame, run, d: int) -> dict[int, int]:
    """Sums by number: run gives (number, digits) of a task's part, Spark adds the digits, the driver puts them together."""
    digits = [f"d{i}" for i in range(5)]
    parts = df.mapInArrow(run, "number int, " + ", ".join(f"{c} long" for c in digits))
    return {r["number"]: whole(r[1:]) for r in parts.groupBy("number").agg(*[F.sum(c).alias(c) for c in digits]).collect()}


def _digit_rows(totals: list[int]) -> pa.RecordBatch:
    table = np.array([limbs(t) for t in totals], np.int64).reshape(-1, 5)
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(table), dtype=np.int32)), *[pa.array(table[:, i]) for i in range(5)]], names=["number", *[f"d{i}" for i in range(5)]])


def count_and_sums(vectors: DataFrame, d: int) -> tuple[int, list[int]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [0] * (d + 1)
        for b in batches:
            if b.num_rows:
                x, mask = _vectors(b, d), (1 << LIMB) - 1
                parts = zip((x >> LIMB).sum(axis=0).tolist(), (x & mask).sum(axis=0).tolist())
                totals = [t + p for t, p in zip(totals, [b.num_rows, *[(hi << LIMB) + lo for hi, lo in parts]])]
        if totals[0]:
            yield _digit_rows(totals)

    found = _totals(vectors, run, d)
    return found.get(0, 0), [found.get(i + 1, 0) for i in range(d)]


def squared_sums(vectors: DataFrame, n: int, s: list[int]) -> dict[int, int]:
    """Exact sums of y_i^2 (numbers 0 to d - 1) and of (y_i + y_j)^2 (from d on, pairs in the order of numpy's triangle)."""
    d = len(s)
    left, right = np.triu_indices(d, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(d + len(left), object)
        for b in batches:
            x = _vectors(b, d) if b.num_rows else np.empty((0, d), np.int64)
            for at in range(0, len(x), ROWS):
                y = _centred(x[at : at + ROWS], n, s)
                totals[:d] += sums_of_squares(y)
                for i in range(0, len(left), 4096):
                    pairs = slice(i, i + 4096)
                    totals[d + i : d + i + len(left[pairs])] += sums_of_squares(y[:, left[pairs]] + y[:, right[pairs]])
        if totals.any():
            yield _digit_rows(totals.tolist())

    return _totals(vectors, run, d)


def covariance(squares: dict[int, int], n: int, d: int) -> np.ndarray:
    """V from the sums of squares: each entry an exact fraction, rounded once."""
    v = np.zeros((d, d))
    own = [squares.get(i, 0) for i in range(d)]
    for i in range(d):
        v[i, i] = own[i] / n**3
    for number, (i, j) in enumerate(zip(*np.triu_indices(d, 1))):
        v[i, j] = v[j, i] = (squares.get(d + number, 0) - own[i] - own[j]) // 2 / n**3
    return v


def whiten(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", components: int = 4) -> DataFrame:
    """key, component, n, deviation, whitened, explained, identity_error: a row per taking-part row and component."""
    rows = vectors.select(col(key).alias("key"), integers(col(vector)).alias("x")).filter(F.col("x").isNotNull())
    usual = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    key_type = rows.schema["key"].dataType.simpleString()
    schema = "key " + key_type + ", component int, n long, deviation long, whitened double, explained double"
    if usual is None:
        none = vectors.sparkSession.createDataFrame([], schema + ", identity_error double")
        return none.withColumnRenamed("key", key)
    d = usual["d"]
    rows = rows.filter(F.size("x") == d)
    fit = cut(rows.select("x").distinct())
    n, s = count_and_sums(fit, d)
    v = covariance(squared_sums(fit, n, s), n, d)
    values, vectors_ = np.linalg.eigh(v)
    trace = float(np.trace(v))
    order = [i for i in np.argsort(-values, kind="stable")[:components] if values[i] > NOTHING * trace]
    axes, scale = vectors_[:, order], np.sqrt(values[order])
    explained = [float(values[i]) / trace for i in order]

    def of_rows(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n * x - S, whitened)."""
        y = _centred(x, n, s)
        return y, (y / n).astype(float) @ axes / scale

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                _, w = of_rows(_vectors(b, d))
                yield pa.RecordBatch.from_arrays([pa.array(w[:, i]) for i in range(len(order))], names=[f"w{i}" for i in range(len(order))])

    error = 0.0
    if order:  # the whitened values' own covariance, centred anew
        k = len(order)
        w = fit.mapInArrow(project, ", ".join(f"w{i} double" for i in range(k)))
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        got = w.agg(*[F.covar_pop(f"w{i}", f"w{j}") for i, j in pairs]).first()
        error = max(abs(c - (i == j)) for c, (i, j) in zip(got, pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            y, w = of_rows(_vectors(b, d))
            m, k = w.shape
            exact = y if y.dtype != object and float(np.abs(y).max(initial=0)) ** 2 * d < 1 << 62 else y.astype(object)
            deviation = np.array([min(int(t), LONG.max) for t in (exact * exact).sum(axis=1)], np.int64)
            names = [f.split(" ")[0] for f in schema.split(", ")]
            keys = b.column("key").take(pa.array(np.repeat(np.arange(m), k)))
            numbers = np.tile(np.arange(1, k + 1, dtype=np.int32), m)
            columns = [keys, numbers, np.full(m * k, n), np.repeat(deviation, k), w.ravel(), np.tile(np.array(explained, float), m)]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)

    return rows.mapInArrow(run, schema).withColumn("identity_error", F.lit(error)).withColumnRenamed("key", key)
