from decimal import Decimal

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators import decode, discover


def enc(n):
    return (n % (1 << 256)).to_bytes(32, "big")


def text(s):
    raw = s.encode()
    return enc(len(raw)) + raw + bytes(-len(raw) % 32)


def test_signatures():
    e = decode.parse_event("Transfer(address indexed from, address indexed to, uint value)")
    assert e["signature"] == "Transfer(address,address,uint256)" and e["topic0"].hex().startswith("ddf252ad")
    e = decode.parse_event("Swap(address indexed s, (address c0, uint24 fee, (int24 a, int24 b) r) indexed key, (int256 x, bool y) p, bytes32[] ids)")
    assert e["signature"] == "Swap(address,(address,uint24,(int24,int24)),(int256,bool),bytes32[])"
    assert decode.flat_columns(e["params"]) == [("s", "address"), ("key.hash", "bytes32"), ("p.x", "int256"), ("p.y", "bool"), ("ids", "bytes32[]")]


def test_interleaved_parameters_keep_their_order(spark):
    e = decode.parse_event("E(uint64 a, address indexed b, int32 c, bool indexed d)")
    row = (1, 0, bytearray(20), [bytearray(32), bytearray(enc(5)), bytearray(enc(1))], bytearray(enc(9) + enc(-4)))
    short = (2, 0, bytearray(20), [bytearray(32)], bytearray(enc(9)))
    logs = spark.createDataFrame([row, short], "block_number long, log_index long, address binary, topics array<binary>, data binary")
    good, bad = decode.decode_static(logs, e)
    assert good.columns[3:] == ["a", "b", "c", "d"]
    r = good.collect()
    assert len(r) == 1 and (r[0]["a"], bytes(r[0]["b"])[-1], r[0]["c"], r[0]["d"]) == (9, 5, -4, True)
    assert [x["block_number"] for x in bad.collect()] == [2]


def test_dynamic_round_trip(spark):
    params = decode.parse_event("R(string name, (int256 x, string y) t, uint64[] n, bytes raw, uint128[2] two)")["params"]
    t = enc(-5) + enc(64) + text("né\0st")
    n = enc(3) + enc(1) + enc(2) + enc(3)
    head = 32 * 6
    parts = [text("Ann"), t, n, enc(2) + b"\x01\x02" + bytes(30)]
    at, offsets = head, []
    for p in parts:
        offsets.append(at)
        at += len(p)
    data = enc(offsets[0]) + enc(offsets[1]) + enc(offsets[2]) + enc(offsets[3]) + enc(1 << 100) + enc(7) + b"".join(parts)
    rows = spark.createDataFrame([(1, 0, bytearray(20), bytearray(data)), (2, 0, bytearray(20), bytearray(data[:100])), (3, 0, bytearray(20), None)], "block_number long, log_index long, address binary, data binary")
    got = decode.decode_dynamic(rows, params).collect()
    assert len(got) == 1
    r = got[0]
    assert (r["name"], r["t.x"], r["t.y"], r["n"], bytes(r["raw"]), r["two"]) == ("Ann", "-5", "nést", [1, 2, 3], b"\x01\x02", [str(1 << 100), "7"])


def test_position_arrays_and_lone_tuples(spark):
    params = decode.parse_event("P((int24 lo, int24 hi, uint128 l) pos)")["params"]
    data = bytearray(enc(-60) + enc(60) + enc(1000))
    rows = spark.createDataFrame([(1, 0, bytearray(20), data)], "block_number long, log_index long, address binary, data binary")
    r = decode.decode_dynamic(rows, params).first()
    assert (r["pos.lo"], r["pos.hi"], r["pos.l"]) == (-60, 60, "1000")
    assert decode.result_names("slot0", decode.parse_event("x(uint256)")["params"]) == ["slot0"]
    assert decode.result_names("getState", params) == ["pos.lo", "pos.hi", "pos.l"]


SHAPES = "block_number long, log_index long, address binary, data binary"


def test_arrays_of_tuples_are_arrays_of_structs(spark):
    params = decode.parse_event("P((int24 lo, int24 hi, uint128 l)[] pos)")["params"]
    data = enc(32) + enc(2) + enc(-60) + enc(60) + enc(5) + enc(-120) + enc(120) + enc(1 << 100)
    rows = spark.createDataFrame([(1, 0, bytearray(20), bytearray(data)), (2, 0, bytearray(20), bytearray(enc(32) + enc(0)))], SHAPES)
    got = decode.decode_dynamic(rows, params)
    assert got.schema["pos"].dataType.simpleString() == "array<struct<lo:bigint,hi:bigint,l:string>>"
    assert [[tuple(p) for p in r["pos"]] for r in got.orderBy("block_number").collect()] == [[(-60, 60, "5"), (-120, 120, str(1 << 100))], []]


def reference_encoding(kind, value):
    """The encoding of a value by its definition, one value at a time."""
    if kind.endswith("]"):
        inner, count = kind[: kind.rindex("[")], kind[kind.rindex("[") + 1 : -1]
        return (b"" if count else enc(len(value))) + reference_tuple([inner] * len(value), value)
    if kind.startswith("("):
        return reference_tuple(decode.split_top(kind[1:-1]), value)
    if kind == "string":
        return text(value)
    if kind == "bytes":
        return enc(len(value)) + value + bytes(-len(value) % 32)
    return enc(int(value))


def reference_tuple(kinds, values):
    heads, tails = [], []
    size = sum(32 if decode.is_dynamic(k) else len(reference_encoding(k, v)) for k, v in zip(kinds, values))
    for k, v in zip(kinds, values):
        raw = reference_encoding(k, v)
        if decode.is_dynamic(k):
            heads.append(enc(size + sum(map(len, tails))))
            tails.append(raw)
        else:
            heads.append(raw)
    return b"".join(heads + tails)


KINDS = ["int24", "uint256", "int256", "uint64", "bool", "string", "bytes"]


@st.composite
def typed_values(draw, depth=2):
    """(type text with names, type, value, decoded value)."""
    form = draw(st.sampled_from(["plain", "array", "fixed", "tuple"] if depth else ["plain"]))
    if form == "plain":
        kind = draw(st.sampled_from(KINDS))
        if kind == "string":
            v = draw(st.text(st.characters(exclude_characters="\0", exclude_categories=["Cs"]), max_size=40))
            return kind, kind, v, v
        if kind == "bytes":
            v = draw(st.binary(max_size=40))
            return kind, kind, v, v
        if kind == "bool":
            v = draw(st.booleans())
            return kind, kind, v, v
        bits, signed = int(kind.lstrip("uint")), kind[0] == "i"
        v = draw(st.integers(-(1 << bits - 1) if signed else 0, (1 << bits - signed) - 1))
        return kind, kind, v, str(v) if bits > 64 else v
    if form == "tuple":
        parts = [draw(typed_values(depth=depth - 1)) for _ in range(draw(st.integers(1, 3)))]
        named = "(" + ", ".join(f"{p[0]} m{i}" for i, p in enumerate(parts)) + ")"
        return named, "(" + ",".join(p[1] for p in parts) + ")", [p[2] for p in parts], [p[3] for p in parts]
    one = draw(typed_values(depth=depth - 1))
    n = draw(st.integers(1 if form == "fixed" else 0, 3))
    suffix = f"[{n}]" if form == "fixed" else "[]"
    return one[0] + suffix, one[1] + suffix, [one[2]] * n, [one[3]] * n


def listed(v):
    """What Arrow gives, with tuples as lists."""
    if isinstance(v, dict):
        return [listed(x) for x in v.values()]
    return [listed(x) for x in v] if isinstance(v, list) else int(v) if isinstance(v, Decimal) else v


@settings(max_examples=150, deadline=None)
@given(st.lists(typed_values(), min_size=1, max_size=3), st.integers(0, 200))
def test_any_nested_value_round_trips(values, cut):
    params = decode.parse_event("E(" + ", ".join(f"{v[0]} p{i}" for i, v in enumerate(values)) + ")")["params"]
    data = reference_tuple([v[1] for v in values], [v[2] for v in values])
    e = decode.Encoded(pa.array([data, None, data[:cut], data], pa.binary()))
    got = decode.decode_members(e, np.arange(4), np.zeros(4, np.int64), params)
    assert not e.bad[0] and e.bad[1] and not e.bad[3]
    assert [listed(c[0].as_py()) for c in got] == [listed(c[3].as_py()) for c in got] == [listed(v[3]) for v in values]


def test_encodings_that_claim_more_than_they_hold_are_dropped(spark):
    """Ten offsets to one place on each of four levels: 45 words that claim ten thousand numbers."""
    params = decode.parse_event("B(uint256[][][][] x)")["params"]
    bomb = enc(32) + (enc(10) + enc(320) * 10) * 4
    rows = spark.createDataFrame([(1, 0, bytearray(20), bytearray(bomb)), (2, 0, bytearray(20), bytearray(enc(32) + enc(1 << 200)))], SHAPES)
    assert decode.decode_dynamic(rows, params).count() == 0


def test_catalogue_and_pool_id(spark):
    c = decode.catalogue(spark, [("v3", "Mint(address indexed owner, int24 lo, uint128 amount)")]).first()
    assert c["columns"] == ["owner binary", "lo bigint", "amount string"] and len(c["topic0"]) == 32
    key = [(bytearray(20), bytearray(b"\x01" * 20), 3000, -60, bytearray(b"\x02" * 20))] * 2
    got = decode.pool_ids(spark.createDataFrame(key, "currency0 binary, currency1 binary, fee int, tick_spacing int, hooks binary")).collect()
    want = decode.keccak256(bytes(32) + bytes(12) + b"\x01" * 20 + enc(3000) + enc(-60) + bytes(12) + b"\x02" * 20)
    assert [bytes(r["pool_id"]) for r in got] == [want, want]


def test_factory_addresses_from_earlier_ranges(spark):
    topic = bytearray(b"\x09" * 32)
    logs = spark.createDataFrame([(5, 0, bytearray(b"\x0f" * 20), [topic, bytearray(enc(77))], bytearray())], "block_number long, log_index long, address binary, topics array<binary>, data binary")
    m = spark.createDataFrame([(bytearray(b"\x0f" * 20), topic, "coins", "topic", 1), (bytearray(b"\x0f" * 20), topic, "data", "data", 0)], "address binary, topic0 binary, collection string, place string, index int")
    got = discover.created(logs, m).collect()
    assert [(r["collection"], bytes(r["address"])[-1], r["created_block"]) for r in got] == [("coins", 77, 5)]
    later = spark.createDataFrame([(50, bytearray(b"\x00" * 19 + b"\x4d"))], "block_number long, address binary")
    assert later.join(discover.created(logs, m), "address").filter(F.col("created_block") <= F.col("block_number")).count() == 1
