"""Logs and call results to typed tables: the event catalogue, native static decoding, dynamic decoding into nested Arrow columns."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.functions import words
from ledgerloom.functions.keccak import keccak256

# -- signatures ----------------------------------------------------------------------------------------------------


def split_top(text: str) -> list[str]:
    """Parts of a parameter list at commas outside brackets."""
    parts, depth, start = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            parts.append(text[start:i])
            start = i + 1
    return [p.strip() for p in [*parts, text[start:]] if p.strip()]


def parse_param(text: str, place: int) -> dict:
    """One parameter: `type [indexed] [name]`, tuples as `(..)` or `tuple(..)`, arrays with []."""
    m = re.match(r"(?:tuple)?\((.*)\)((?:\[\d*\])*)\s*(.*)$", text)
    if m:
        inner, arrays, rest = m.groups()
        parts = [parse_param(p, i) for i, p in enumerate(split_top(inner))]
        kind = "(" + ",".join(p["type"] for p in parts) + ")" + arrays
    else:
        kind, _, rest = text.partition(" ")
        kind = re.sub(r"^(u?int)(?=$|\[)", r"\g<1>256", kind)
        parts = []
    words_ = rest.split()
    names = [w for w in words_ if w != "indexed"]
    return {"name": names[0] if names else f"arg{place}", "type": kind, "indexed": "indexed" in words_, "parts": parts}


def parse_event(signature: str) -> dict:
    name, _, rest = signature.partition("(")
    params = [parse_param(p, i) for i, p in enumerate(split_top(rest.rstrip()[:-1]))]
    canonical = f"{name.strip()}({','.join(p['type'] for p in params)})"
    return {"name": name.strip(), "signature": canonical, "topic0": keccak256(canonical.encode()), "params": params}


def flat_params(params: list[dict], prefix: str = "") -> list[tuple[str, dict]]:
    """(column, parameter): tuples become dotted columns; an indexed value that is hashed on chain becomes `<name>.hash`."""
    out = []
    for p in params:
        name = prefix + p["name"]
        if p["indexed"] and (p["parts"] or p["type"] in ("string", "bytes") or p["type"].endswith("]")):
            out.append((name + ".hash" if p["parts"] else name, {"name": name, "type": "bytes32", "indexed": True, "parts": []}))
        elif p["parts"] and not p["type"].endswith("]"):
            out += flat_params(p["parts"], name + ".")
        else:
            out.append((name, p))
    return out


def flat_columns(params: list[dict]) -> list[tuple[str, str]]:
    return [(name, p["type"]) for name, p in flat_params(params)]


def column_type(param: dict) -> str:
    """The Spark type of a parameter: arrays of arrays of structs as they are nested."""
    kind = param["type"]
    if kind.endswith("]"):
        return f"array<{column_type(dict(param, type=kind[: kind.rindex('[')]))}>"
    if param["parts"]:
        return "struct<" + ",".join(f"`{p['name']}`:{column_type(p)}" for p in param["parts"]) + ">"
    return spark_type(kind)


def spark_type(kind: str) -> str:
    """The Spark type of an elementary type."""
    m = re.fullmatch(r"(u?)int(\d+)", kind)
    if m:
        bits = int(m.group(2))
        return "string" if bits > 64 else "decimal(20,0)" if m.group(1) and bits > 32 else "bigint"
    return {"bool": "boolean", "string": "string"}.get(kind, "binary")


def catalogue(spark: SparkSession, signatures: list[tuple[str, str]]) -> DataFrame:
    """(source, event): one row per configured event with its topic and columns. A configuration table."""
    rows = []
    for source, text in signatures:
        e = parse_event(text)
        rows.append((source, e["name"], e["signature"], bytearray(e["topic0"]), [f"{c} {column_type(q)}" for c, q in flat_params(e["params"])]))
    return spark.createDataFrame(rows, "source string, event_name string, signature string, topic0 binary, columns array<string>")


# -- native decoding of static words -------------------------------------------------------------------------------


def static(value: Column, kind: str) -> Column:
    """A 32-byte word or topic as its type, without Python; 256-bit integers stay as words."""
    m = re.fullmatch(r"(u?)int(\d+)", kind)
    if kind == "address":
        return words.address(value)
    if kind == "bool":
        return words.boolean(value)
    if m and int(m.group(2)) <= 64:
        return words.uint64(value) if m.group(1) else words.int64(value)
    m = re.fullmatch(r"bytes(\d+)", kind)
    return F.substring(value, 1, int(m.group(1))) if m else value


def is_dynamic(kind: str) -> bool:
    if kind.endswith("]"):
        return kind.endswith("[]") or is_dynamic(kind[: kind.rindex("[")])
    return kind in ("string", "bytes") or kind.startswith("(") and any(is_dynamic(p) for p in split_top(kind[1:-1]))


def decode_static(logs: DataFrame, event: dict, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(decoded, rejected) for an event whose data words are all static: topics and data in signature order, in one projection.

    keep: further columns of the logs that the decoded rows keep. A log with too few topics or too little data is rejected as a whole; the others go on.
    """
    columns, topic, at, needed = [], 1, 0, F.lit(True)
    for p in event["params"]:
        if p["indexed"]:
            name, kind = flat_columns([p])[0]
            columns.append(static(F.get(F.col("topics"), F.lit(topic)), kind).alias(name))
            topic += 1
        else:
            for name, kind in flat_columns([p]):
                columns.append(static(words.word(F.col("data"), at), kind).alias(name))
                at += 1
    needed = (F.size("topics") >= topic) & (F.octet_length("data") >= 32 * at)
    base = ["block_number", "log_index", "address"]
    return logs.filter(needed).select(*base, *keep, *columns), logs.filter(~needed).select(*base, "topics", "data")


# -- dynamic decoding ----------------------------------------------------------------------------------------------
# A batch of encodings is one run of bytes. A type is decoded for all rows at once: whatever lies at the places of its values
# becomes one Arrow array, and arrays and tuples put their children's arrays together with offsets. A row that points outside its
# data, or claims more elements than its bytes hold, is marked and left out at the end.


def _size(kind: str) -> int:
    """Head bytes of a static type."""
    if kind.endswith("]"):
        return int(kind[kind.rindex("[") + 1 : -1]) * _size(kind[: kind.rindex("[")])
    return sum(_size(p) for p in split_top(kind[1:-1])) if kind.startswith("(") else 32


class Encoded:
    """Encodings of many rows and which of them have turned out to be wrong."""

    def __init__(self, payloads: pa.Array):
        parts = [p or b"" for p in payloads.to_pylist()]
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(parts) + bytes(64), np.uint8)
        self.windows = np.lib.stride_tricks.sliding_window_view(self.bytes, 32)
        self.bad = np.array(payloads.is_null())

    def inside(self, row: np.ndarray, at: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        """Whether n bytes from `at` lie in their row; rows where not are wrong."""
        ok = (at >= 0) & (at + n <= self.sizes[row])
        self.bad[row[~ok]] = True
        return ok

    def words(self, row: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The 32 bytes from each place; zeros outside."""
        ok = self.inside(row, at, 32)
        return np.where(ok[:, None], self.windows[np.where(ok, self.first[row] + at, 0)], 0).astype(np.uint8)

    def count(self, row: np.ndarray, at: np.ndarray) -> np.ndarray:
        """An unsigned word that counts bytes or elements; 0 where it exceeds its row's bytes."""
        w = self.words(row, at)
        n = _low(w).astype(np.int64)
        ok = ~w[:, :24].any(axis=1) & (n >= 0) & (n <= self.sizes[row])
        self.bad[row[~ok]] = True
        return np.where(ok, n, 0)


def _low(w: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(w[:, 24:]).view(">u8").ravel().astype(np.uint64)


def _numbers(w: np.ndarray, signed: bool, bits: int) -> pa.Array:
    """Words as numbers, saturating where the type has 64 bits at most; decimal text beyond."""
    low, fill = _low(w), np.where(signed & (w[:, 0] >= 128), 255, 0).astype(np.uint8)
    narrow = (w[:, :24] == fill[:, None]).all(axis=1) & (not signed or ((low >> np.uint64(63)) == (fill == 255)))
    if bits > 64:
        fits = narrow & ((low < 1 << 63) | signed)
        out = low.view(np.int64).astype(str).astype(object)
        for i in np.flatnonzero(~fits):
            out[i] = str(int.from_bytes(w[i].tobytes(), "big", signed=signed))
        return pa.array(out, pa.string())
    if signed:
        return pa.array(np.where(narrow, low.view(np.int64), np.where(fill == 255, -(1 << 63), (1 << 63) - 1)))
    whole = np.where(narrow, low, np.uint64((1 << 64) - 1))
    return pa.array(whole).cast(pa.decimal128(20, 0)) if bits > 32 else pa.array(np.minimum(whole, np.uint64((1 << 63) - 1)).astype(np.int64))


def _elementary(w: np.ndarray, kind: str) -> pa.Array:
    m = re.fullmatch(r"(u?)int(\d+)", kind)
    if m:
        return _numbers(w, not m.group(1), int(m.group(2)))
    if kind == "bool":
        return pa.array(w[:, 31] != 0)
    lo, n = (12, 20) if kind == "address" else (0, int(kind[5:] or 32))
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(n), len(w), [None, pa.py_buffer(np.ascontiguousarray(w[:, lo : lo + n]))]).cast(pa.binary())


def decode_column(e: Encoded, row: np.ndarray, at: np.ndarray, param: dict) -> pa.Array:
    """The values of one type whose encodings begin at the places `at` (from their row's start)."""
    kind = param["type"]
    if kind.endswith("]"):
        inner, count = dict(param, type=kind[: kind.rindex("[")]), kind[kind.rindex("[") + 1 : -1]
        n = np.full(len(row), int(count)) if count else e.count(row, at)
        base = at if count else at + 32
        # elements take 32 bytes each of their own: a row with more of them points to the same bytes over and over
        e.bad |= np.bincount(row, n, len(e.sizes)) * 32 > e.sizes + 32
        n = np.where(e.bad[row], 0, n)
        own = np.repeat(row, n)
        place = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
        start = np.repeat(base, n)
        begin = start + e.count(own, start + 32 * place) if is_dynamic(inner["type"]) else start + _size(inner["type"]) * place
        ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), decode_column(e, own, begin, inner))
    if param["parts"]:
        members = decode_members(e, row, at, param["parts"])
        return pa.StructArray.from_arrays(members, names=[p["name"] for p in param["parts"]])
    if kind in ("string", "bytes"):
        n = e.count(row, at)
        n = np.where(e.inside(row, at + 32, n), n, 0)
        begin = e.first[row] + at + 32
        own = np.repeat(np.where(n > 0, begin, 0), n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        raw, ends = e.bytes[own].tobytes(), np.cumsum(n).tolist()
        parts = [raw[lo:hi] for lo, hi in zip([0, *ends], ends)]
        return pa.array(parts, pa.binary()) if kind == "bytes" else pa.array([x.decode("utf-8", "replace").replace("\0", "") for x in parts], pa.string())
    return _elementary(e.words(row, at), kind)


def decode_members(e: Encoded, row: np.ndarray, at: np.ndarray, params: list[dict]) -> list[pa.Array]:
    """The members of tuples that begin at `at`: static ones in place, dynamic ones where their offsets point."""
    out, head = [], at
    for p in params:
        moving = is_dynamic(p["type"])
        out.append(decode_column(e, row, at + e.count(row, head) if moving else head, p))
        head = head + (32 if moving else _size(p["type"]))
    return out


def _flat(columns: list[pa.Array], params: list[dict]) -> list[pa.Array]:
    """Tuples outside arrays as a column per member."""
    out = []
    for c, p in zip(columns, params):
        out += _flat(c.flatten(), p["parts"]) if p["parts"] and not p["type"].endswith("]") else [c]
    return out


def decode_dynamic(rows: DataFrame, params: list[dict], *, payload: str = "data", keep: tuple[str, ...] = ("block_number", "log_index", "address")) -> DataFrame:
    """Typed columns of dynamic data, built as nested Arrow columns; rows that cannot be decoded are dropped.

    Arrays of tuples become arrays of structs with the tuples' names. A lone tuple is read as parameters first, then as one plain value.
    """
    plain = [dict(p, indexed=False) for p in params]
    columns = flat_params(plain)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema] + [f"`{c}` {column_type(p)}" for c, p in columns])
    lone = len(plain) == 1 and plain[0]["type"].startswith("(") and not plain[0]["type"].endswith("]")

    def decoded(batch: pa.RecordBatch, as_value: bool) -> tuple[pa.RecordBatch, np.ndarray]:
        e = Encoded(batch.column(payload))
        row, at = np.arange(len(batch)), np.zeros(len(batch), np.int64)
        got = [decode_column(e, row, at, plain[0])] if as_value else decode_members(e, row, at, plain)
        made = pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], *_flat(got, plain)], names=[*keep, *[c for c, _ in columns]])
        return made, e.bad

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, bad = decoded(batch, False)
            if lone and bad.any():
                second, worse = decoded(batch.filter(pa.array(bad)), True)
                yield second.filter(pa.array(~worse))
            yield made.filter(pa.array(~bad))

    return rows.select(*keep, payload).mapInArrow(run, schema)


def pool_ids(keys: DataFrame) -> DataFrame:
    """keys (currency0, currency1, hooks binary(20); fee, tick_spacing) with pool_id: the hash of the five encoded words, per distinct key.

    Keys meet as structs, and those with a null go by their missing hash: a join by the five columns asks each for null, and that filter
    goes below the decoding, where it decodes every word again as often as its expression names it. For the same reason the hash is one
    `per_value`.
    """
    from ledgerloom.functions.keccak import keccak_udf

    pad = lambda c: F.concat(F.unhex(F.lit("00" * 12)), F.col(c))
    number = lambda c: F.unhex(F.concat(F.when(F.col(c) < 0, "F" * 48).otherwise("0" * 48), F.lpad(F.hex(F.col(c).cast("bigint")), 16, "0")))
    names = ["currency0", "currency1", "fee", "tick_spacing", "hooks"]
    keyed = keys.withColumn("_key", F.struct(*names))
    encoded = F.concat(pad("currency0"), pad("currency1"), number("fee"), number("tick_spacing"), pad("hooks"))
    distinct = keyed.select("_key").distinct().select("_key", "_key.*").select("_key", words.per_value(keccak_udf, "binary")(encoded).alias("pool_id"))
    return keyed.join(distinct, "_key").filter(F.col("pool_id").isNotNull()).select(*names, *[f"`{c}`" for c in keys.columns if c not in names], "pool_id")


def result_names(function: str, params: list[dict]) -> list[str]:
    """Columns of a call result: a named value by its name, a tuple by its fields, a lone scalar by the function."""
    if len(params) == 1 and not params[0]["parts"] and re.fullmatch(r"arg\d+", params[0]["name"]):
        return [function]
    return [c for c, _ in flat_columns([dict(p, indexed=False) for p in params])]
