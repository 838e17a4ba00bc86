import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import fixedpoint as fp, keccak, words

Q96 = 1 << 96


def test_keccak_known_values():
    assert keccak.keccak256(b"").hex() == "c5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470"
    assert keccak.keccak256(b"Transfer(address,address,uint256)").hex() == "ddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
    assert len({keccak.keccak256(bytes(n)) for n in range(130, 280)}) == 150


def test_ticks():
    assert fp.sqrt_price_at(0) == Q96
    assert fp.sqrt_price_at(fp.MIN_TICK) == 4295128739
    assert fp.sqrt_price_at(fp.MAX_TICK) == 1461446703485210103287273052203988822378723970342
    assert fp.sqrt_price_at(-1) < Q96 < fp.sqrt_price_at(1)
    with pytest.raises(ValueError):
        fp.sqrt_price_at(fp.MAX_TICK + 1)
    for t in [fp.MIN_TICK, -5000, -1, 0, 1, 7, 123456, fp.MAX_TICK - 1]:
        assert fp.tick_at(fp.sqrt_price_at(t)) == t
        assert t == fp.MIN_TICK or fp.tick_at(fp.sqrt_price_at(t) - 1) == t - 1


def test_positions():
    lo, hi, liq = -600, 600, 10**18
    below, above = fp.sqrt_price_at(-700), fp.sqrt_price_at(700)
    assert fp.position_amounts(below, lo, hi, liq)[1] == 0 < fp.position_amounts(below, lo, hi, liq)[0]
    assert fp.position_amounts(above, lo, hi, liq)[0] == 0 < fp.position_amounts(above, lo, hi, liq)[1]
    assert all(fp.position_amounts(Q96, lo, hi, liq))
    assert fp.position_amounts(fp.sqrt_price_at(lo), lo, hi, liq)[1] == 0
    assert fp.position_amounts(fp.sqrt_price_at(hi), lo, hi, liq)[0] == 0
    with pytest.raises(ValueError):
        fp.position_amounts(Q96, 5, 5, liq)


def test_prices():
    assert fp.price_of(Q96, True, 18, 18) == 1 == fp.price_of(Q96, False, 18, 18)
    assert fp.price_of(Q96, True, 18, 6) == Decimal(10) ** 12
    assert fp.price_of(Q96 + 1, True, 18, 18) > 1
    assert fp.price_of(0, True, 18, 18) is None
    assert fp.price_of(2 * Q96, True, 0, 0) == 4 and fp.price_of(2 * Q96, False, 0, 0) == Decimal("0.25")


def test_u256_sums(spark):
    big = (1 << 256) - 1
    rng = random.Random(0)
    values = [big, big, big, 0, 1] + [rng.getrandbits(rng.randrange(1, 256)) for _ in range(200)]
    df = spark.createDataFrame([(str(v), rng.random() < 0.5) for v in values], "v string, m boolean")
    assert df.agg(words.sum_u256(F.col("v")).alias("s")).first()["s"] == str(sum(values))
    signed = [(v if i % 2 else -v) for i, v in enumerate(values)]
    df = spark.createDataFrame([(str(v),) for v in signed], "v string")
    plus, minus = words.sum_signed(F.col("v"))
    r = df.agg(plus.alias("p"), minus.alias("m"), words.sum_abs(F.col("v")).alias("a")).first()
    assert (int(r["p"]), int(r["m"]), int(r["a"])) == (sum(v for v in signed if v > 0), -sum(v for v in signed if v < 0), sum(map(abs, signed)))
    assert [int(x["v"]) for x in df.filter("v not like '-%'").orderBy(words.sort_key(F.col("v"))).collect()] == sorted(v for v in signed if v >= 0)
    assert spark.sql("select '5' a, '-5' b, '0' c").select(*[words.negate(F.col(c)) for c in "abc"]).first() == ("-5", "5", "0")


def test_words(spark):
    one = lambda n, signed=False: bytearray((n % (1 << 256)).to_bytes(32, "big"))
    df = spark.createDataFrame([(one(7), one(-7), one(1 << 70), one(-(1 << 70)), bytearray(range(32)))], "a binary, b binary, c binary, d binary, e binary")
    r = df.select(
        words.uint64(F.col("a")).alias("a"), words.int64(F.col("b")).alias("b"), words.uint64(F.col("c")).alias("c"), words.int64(F.col("d")).alias("d"),
        words.int64(F.col("c")).alias("c2"), words.address(F.col("e")).alias("e"), words.boolean(F.col("a")).alias("f"), words.word(F.col("e"), 1).alias("g"),
    ).first()
    assert (r["a"], r["b"], r["c"], r["d"], r["c2"]) == (7, -7, (1 << 64) - 1, -(1 << 63), (1 << 63) - 1)
    assert bytes(r["e"]) == bytes(range(12, 32)) and r["f"] is True and r["g"] is None


def test_raw_to_decimal(spark):
    df = spark.createDataFrame([("12345", 2), ("5", 3), ("-1500", 3), ("7", 0), ("1000", 3)], "r string, d int")
    got = [r[0] for r in df.select(fp.to_decimal(F.col("r"), F.col("d"))).collect()]
    assert got == ["123.45", "0.005", "-1.5", "7", "1"]


def test_approximate_price(spark):
    df = spark.createDataFrame([(str(fp.sqrt_price_at(5000)), True)], "s string, b boolean")
    assert math.isclose(df.select(fp.approximate_price(F.col("s"), F.col("b"))).first()[0], 1.0001**5000, rel_tol=1e-9)


def test_many_hashes_equal_single_ones():
    values = [b"", b"a", b"Transfer(address,address,uint256)", bytes(135), bytes(136), bytes(range(256)) * 3, *(i.to_bytes(160, "big") for i in range(50))]
    assert keccak.keccak256_all(values) == [keccak.keccak256(v) for v in values]
