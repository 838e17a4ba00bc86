"""32-byte words, 256-bit integers and text, in built-in expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

#: 256-bit integers are decimal text at rest; sums run over three limbs of this many digits.
LIMB = 26
U256_MAX = (1 << 256) - 1


def per_value(udf, kind: str):
    """A pandas UDF for distinct values: a filter on what it gives stays above it. Otherwise the filter goes below the `distinct` and is
    answered by calling the function for every row."""
    return F.pandas_udf(udf.func, kind).asNondeterministic()


def word(data: Column, index: int | Column) -> Column:
    """The index-th 32-byte word (from 0); null where the data ends before it."""
    at = index if isinstance(index, Column) else F.lit(index)
    return F.when(F.octet_length(data) >= (at + 1) * 32, F.substring(data, at * 32 + 1, F.lit(32)))


def address(topic: Column) -> Column:
    """The last 20 bytes."""
    return F.substring(topic, 13, 20)


def uint64(value: Column) -> Column:
    """An unsigned word as decimal(20, 0), saturating at 2^64 - 1."""
    fits = F.substring(value, 1, 24) == F.lit(bytes(24))
    number = F.conv(F.hex(F.substring(value, 25, 8)), 16, 10).cast("decimal(20,0)")
    return F.when(fits, number).when(value.isNotNull(), F.lit(str((1 << 64) - 1)).cast("decimal(20,0)"))


def int64(value: Column) -> Column:
    """A signed word as bigint, saturating at the ends of the type."""
    high, low, half = F.substring(value, 1, 24), F.substring(value, 25, 8), F.lit(b"\x80")
    fits = ((high == F.lit(bytes(24))) & (low < half)) | ((high == F.lit(b"\xff" * 24)) & (low >= half))
    number = F.conv(F.hex(low), 16, -10).cast("bigint")
    return F.when(fits, number).when(value >= half, F.lit(-(1 << 63))).when(value.isNotNull(), F.lit((1 << 63) - 1))


def boolean(value: Column) -> Column:
    return F.hex(F.substring(value, 32, 1)) != "00"


def show(value: Column) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(value)))


def unshow(text: Column) -> Column:
    return F.unhex(F.regexp_replace(text, "^0x", ""))


def strip_nul(text: Column) -> Column:
    return F.replace(text, F.lit("\u0000"), F.lit(""))


def narrow(text: Column, bits: int, signed: bool = False) -> Column:
    """Numeric text to a type of `bits` <= 64; null where it is not a number or out of range."""
    number = text.try_cast("decimal(38,0)")
    lo, hi = (-(1 << (bits - 1)), (1 << (bits - 1)) - 1) if signed else (0, (1 << bits) - 1)
    fits = number.between(F.lit(str(lo)).cast("decimal(38,0)"), F.lit(str(hi)).cast("decimal(38,0)"))
    return F.when(fits, number.cast("decimal(20,0)"))


# -- 256-bit decimal text ------------------------------------------------------------------------------------------


def _limbs(text: Column) -> list[Column]:
    """The three limbs of unsigned decimal text, the highest first."""
    n, zero = F.length(text), F.lit(0).cast("decimal(38,0)")
    part = lambda begin, size: F.substring(text, begin, size).cast("decimal(38,0)")
    high = F.when(n > 2 * LIMB, part(F.lit(1), n - 2 * LIMB)).when(text.isNotNull(), zero)
    mid = F.when(n > 2 * LIMB, part(n - 2 * LIMB + 1, F.lit(LIMB))).when(n > LIMB, part(F.lit(1), n - LIMB)).when(text.isNotNull(), zero)
    low = F.when(n > LIMB, part(n - LIMB + 1, F.lit(LIMB))).when(n > 0, part(F.lit(1), F.lit(LIMB))).when(text.isNotNull(), zero)
    return [high, mid, low]


def _magnitude(text: Column) -> Column:
    return F.ltrim(text, F.lit("-"))


def _join(high: Column, mid: Column, low: Column) -> Column:
    """Limb sums with carries, as decimal text without leading zeros. Sums that stay within the lowest limb are written as they are: the carries
    name each sum over and over."""
    short = (high == 0) & (mid == 0) & (low < F.lit(_UNIT).cast("decimal(38,0)"))
    plain = low.cast("string")
    mid = mid + _div(low)
    high = high + _div(mid)
    digits = F.concat(high.cast("string"), F.lpad(_rem(mid).cast("string"), LIMB, "0"), F.lpad(_rem(low).cast("string"), LIMB, "0"))
    long = F.when(digits.isNotNull(), F.coalesce(F.nullif(F.ltrim(digits, F.lit("0")), F.lit("")), F.lit("0")))
    return F.when(short, plain).otherwise(long)


def _rem(x: Column) -> Column:
    """The last LIMB digits of a non-negative decimal."""
    return F.right(F.lpad(x.cast("string"), 38, "0"), F.lit(LIMB)).cast("decimal(38,0)")


def _div(x: Column) -> Column:
    """The digits before the last LIMB ones."""
    return F.left(F.lpad(x.cast("string"), 38, "0"), F.lit(38 - LIMB)).cast("decimal(38,0)")


def sum_u256(text: Column) -> Column:
    """Aggregate: exact sum of unsigned decimal text (up to 10^11 rows), as decimal text."""
    return _join(*[F.coalesce(F.sum(limb), F.lit(0).cast("decimal(38,0)")) for limb in _limbs(text)])


def sum_abs(text: Column) -> Column:
    """Aggregate: sum of the magnitudes of signed decimal text."""
    return sum_u256(_magnitude(text))


def sum_signed(text: Column) -> tuple[Column, Column]:
    """Aggregates: (sum of the positive ones, magnitude of the sum of the negative ones)."""
    negative = text.startswith("-")
    return sum_u256(F.when(negative, "0").otherwise(text)), sum_u256(F.when(negative, _magnitude(text)).otherwise("0"))


def window_u256(text: Column, upto, before) -> Column:
    """Sum of unsigned decimal text over the rows of one window frame that another, within it, lacks."""
    zero = F.lit(0).cast("decimal(38,0)")
    return _join(*[F.coalesce(F.sum(limb).over(upto), zero) - F.coalesce(F.sum(limb).over(before), zero) for limb in _limbs(text)])


_UNIT, _ZERO = "1" + "0" * LIMB, "0"


def _decimal(text: str) -> Column:
    return F.lit(text).cast("decimal(38,0)")


def _signed(d: Column) -> Column:
    """Whether limb differences (h, m, l) make a negative number."""
    return (d["h"] < 0) | ((d["h"] == 0) & ((d["m"] < 0) | ((d["m"] == 0) & (d["l"] < 0))))


def _sizes(d: Column) -> Column:
    sign = lambda c: F.when(_signed(d), -c).otherwise(c)
    return F.struct(*[sign(d[k]).alias(k) for k in "hml"], _signed(d).alias("negative"))


def _borrowed(m: Column) -> Column:
    """Signed decimal text of the limbs of a magnitude, some of them below zero."""
    one = lambda c: F.when(c, _decimal("1")).otherwise(_decimal(_ZERO))
    unit = lambda c: F.when(c, _decimal(_UNIT)).otherwise(_decimal(_ZERO))
    mid = m["m"] - one(m["l"] < 0)
    size = _join(m["h"] - one(mid < 0), mid + unit(mid < 0), m["l"] + unit(m["l"] < 0))
    return F.when(m["negative"], F.concat(F.lit("-"), size)).otherwise(size)


def let(value: Column, body) -> Column:
    """body(value), with value bound once. It is evaluated as it stands and adds nothing to the generated code."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_differences(df: DataFrame, names: dict[str, tuple[Column, Column]]) -> DataFrame:
    """df with name = a - b of unsigned decimal text, signed, for each name: (a, b). Up to 37 digits it is one decimal subtraction; the limbs of
    longer ones are bound step by step, as they would make the generated code too long to be compiled."""

    def long(a: Column, b: Column) -> Column:
        gaps = lambda t: F.struct(*[(x - y).alias(k) for k, x, y in zip("hml", _limbs(t["a"]), _limbs(t["b"]))])
        return let(F.struct(a.alias("a"), b.alias("b")), lambda t: let(gaps(t), lambda d: let(_sizes(d), _borrowed)))

    def difference(a: Column, b: Column) -> Column:
        short = F.length(a).between(1, 37) & F.length(b).between(1, 37)
        return F.when(short, (a.cast("decimal(37,0)") - b.cast("decimal(37,0)")).cast("string")).otherwise(long(a, b))

    return df.withColumns({n: difference(a, b) for n, (a, b) in names.items()})


@F.pandas_udf(T.StringType())
def u256_text(word: pd.Series) -> pd.Series:
    """An unsigned 32-byte word as decimal text, in Arrow batches: in built-in expressions the eight parts' products outgrow what is compiled."""
    return word.map(lambda w: None if w is None else str(int.from_bytes(w, "big"))).astype(object)


@F.pandas_udf(T.StringType())
def int256_text(word: pd.Series) -> pd.Series:
    """A signed 32-byte word (two's complement) as decimal text."""
    return word.map(lambda w: None if w is None else str(int.from_bytes(w, "big", signed=True))).astype(object)


def flexible(value: Column, bits: int = 256, signed: bool = False) -> Column:
    """A number of a narrower type, or numeric text, as decimal text of `bits`; null where it is no integer or out of range."""
    text = F.regexp_extract(F.trim(value.cast("string")), r"^\+?(-?)0*(\d+)$", 2)
    negative = F.trim(value.cast("string")).startswith("-")
    most = (1 << (bits - 1)) if signed else (1 << bits)
    fits = (text != "") & (F.length(text) <= 3 * LIMB) & F.when(negative & (text != "0"), F.lit(signed) & (sort_key(text) <= F.lit(str(most).zfill(3 * LIMB)))).otherwise(sort_key(text) < F.lit(str(most).zfill(3 * LIMB)))
    return F.when(fits, F.when(negative & (text != "0"), F.concat(F.lit("-"), text)).otherwise(text))


def sort_key(text: Column) -> Column:
    """Text that orders like the unsigned number."""
    return F.lpad(text, 3 * LIMB, "0")


def negate(text: Column) -> Column:
    return F.when(text == "0", text).when(text.startswith("-"), F.substring(text, 2, 100)).otherwise(F.concat(F.lit("-"), text))
