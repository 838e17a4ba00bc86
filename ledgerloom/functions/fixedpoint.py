"""Concentrated-liquidity mathematics: ticks, square-root prices, position amounts, prices.

Square-root prices are integers scaled by 2^96. Python integers carry the 256-bit steps inside Arrow-batched UDFs, which
callers apply to distinct values and join back.
"""

from __future__ import annotations

from decimal import Decimal, localcontext
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

Q96 = 1 << 96
MIN_TICK, MAX_TICK = -887_272, 887_272


def _ratios() -> list[int]:
    """2^128 / sqrt(1.0001)^(2^i) for the twenty bits of a tick, rounded the way the on-chain constants are."""
    with localcontext() as c:
        c.prec = 120
        return [int((Decimal(2**128) / (Decimal("1.0001") ** (Decimal(2**i) / 2))).to_integral_value(rounding="ROUND_HALF_UP")) for i in range(20)]


_RATIO = _ratios()


@lru_cache(maxsize=1 << 16)
def sqrt_price_at(tick: int) -> int:
    """Square-root price of a tick; raises outside the range."""
    if not MIN_TICK <= tick <= MAX_TICK:
        raise ValueError(f"tick {tick} is out of range")
    ratio, n = 1 << 128, abs(tick)
    for i, r in enumerate(_RATIO):
        if n >> i & 1:
            ratio = ratio * r >> 128
    if tick > 0:
        ratio = ((1 << 256) - 1) // ratio
    return (ratio >> 32) + (ratio & 0xFFFFFFFF > 0)


def tick_at(sqrt_price: int) -> int | None:
    """The greatest tick whose price is not above; None outside the range."""
    if not sqrt_price_at(MIN_TICK) <= sqrt_price < sqrt_price_at(MAX_TICK):
        return None
    lo, hi = MIN_TICK, MAX_TICK
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if sqrt_price_at(mid) <= sqrt_price else (lo, mid)
    return lo


def amount0(a: int, b: int, liquidity: int) -> int:
    a, b = min(a, b), max(a, b)
    return liquidity * Q96 * (b - a) // (a * b) if a else 0


def amount1(a: int, b: int, liquidity: int) -> int:
    return liquidity * abs(b - a) // Q96


def position_amounts(sqrt_price: int, lower: int, upper: int, liquidity: int) -> tuple[int, int]:
    """Both tokens' amounts of a position: all token0 below the range, all token1 above it, both within."""
    if lower >= upper:
        raise ValueError("the lower tick must be below the upper")
    a, b = sqrt_price_at(lower), sqrt_price_at(upper)
    if sqrt_price <= a:
        return amount0(a, b, liquidity), 0
    if sqrt_price >= b:
        return 0, amount1(a, b, liquidity)
    return amount0(sqrt_price, b, liquidity), amount1(a, sqrt_price, liquidity)


def price_of(sqrt_price: int, base_is_token0: bool, base_decimals: int, quote_decimals: int, digits: int = 60) -> Decimal | None:
    """Quote per base; None for zero."""
    if not sqrt_price:
        return None
    with localcontext() as c:
        c.prec = digits
        ratio = Decimal(sqrt_price) / Decimal(Q96)
        p = ratio * ratio if base_is_token0 else 1 / (ratio * ratio)
        return p.scaleb(base_decimals - quote_decimals)


@F.pandas_udf(T.StringType())
def sqrt_price_udf(tick: pd.Series) -> pd.Series:
    return tick.map(lambda t: None if pd.isna(t) or not MIN_TICK <= t <= MAX_TICK else str(sqrt_price_at(int(t)))).astype(object)


@F.pandas_udf(T.IntegerType())
def tick_udf(price: pd.Series) -> pd.Series:
    return price.map(lambda p: None if p is None else tick_at(int(p))).astype("Int32")


@F.pandas_udf(T.StructType().add("amount0", "string").add("amount1", "string"))
def position_udf(sqrt_price: pd.Series, lower: pd.Series, upper: pd.Series, liquidity: pd.Series) -> pd.DataFrame:
    def one(x: tuple) -> tuple:
        return (None, None) if any(pd.isna(v) for v in x) or x[1] >= x[2] else tuple(map(str, position_amounts(int(x[0]), int(x[1]), int(x[2]), int(x[3]))))

    asked = list(zip(sqrt_price.tolist(), lower.tolist(), upper.tolist(), liquidity.tolist()))
    found = {x: one(x) for x in set(asked)}
    return pd.DataFrame([found[x] for x in asked], columns=["amount0", "amount1"], dtype=object)


@F.pandas_udf(T.StringType())
def price_udf(sqrt_price: pd.Series, base_is_token0: pd.Series, base_decimals: pd.Series, quote_decimals: pd.Series) -> pd.Series:
    def one(s, b, d, q):
        p = None if s is None else price_of(int(s), bool(b), int(d), int(q))
        return None if p is None else format(p.normalize(), "f")

    return pd.Series([one(*x) for x in zip(sqrt_price, base_is_token0, base_decimals, quote_decimals)], dtype=object)


def approximate_price(sqrt_price: Column, base_is_token0: Column) -> Column:
    """The price as a double, for filters, without Python."""
    r = sqrt_price.cast("double") / F.lit(float(Q96))
    return F.when(r != 0, F.when(base_is_token0, r * r).otherwise(1 / (r * r)))


def with_sqrt_price(df: DataFrame, tick: str = "tick", name: str = "sqrt_price") -> DataFrame:
    """df with the square-root price of its tick, computed once per distinct tick."""
    return df.join(df.select(tick).distinct().withColumn(name, sqrt_price_udf(tick)), tick, "left")


def to_decimal(raw: Column, decimals: Column) -> Column:
    """Raw integer text by the token's decimals, exact as decimal text while it has up to 78 digits."""
    negative = raw.startswith("-")
    digits = F.regexp_replace(raw, "^-", "")
    padded = F.lpad(digits, F.greatest(F.length(digits), decimals + 1), F.lit("0"))
    whole = F.left(padded, F.length(padded) - decimals)
    part = F.regexp_replace(F.right(padded, decimals), "0+$", "")
    return F.concat(F.when(negative, "-").otherwise(""), whole, F.when(part == "", "").otherwise(F.concat(F.lit("."), part)))
