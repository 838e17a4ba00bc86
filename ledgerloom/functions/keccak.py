"""Keccak-256 (the pre-standard padding) for event topics and pool ids, with an Arrow UDF over distinct values."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, types as T

_MASK = (1 << 64) - 1


def _tables() -> tuple[list[int], list[int]]:
    """Round constants from the degree-8 LFSR and rotation offsets from the (x, y) walk, as the specification defines them."""
    constants, r = [], 1
    for _ in range(24):
        c = 0
        for j in range(7):
            if r & 1:
                c |= 1 << ((1 << j) - 1)
            r = (r << 1) ^ (0x171 if r & 0x80 else 0)
        constants.append(c)
    offsets, x, y = [0] * 25, 1, 0
    for t in range(24):
        offsets[x + 5 * y] = (t + 1) * (t + 2) // 2 % 64
        x, y = y, (2 * x + 3 * y) % 5
    return constants, offsets


_ROUND, _ROTATE = _tables()


def _permute(a: list) -> list:
    """The 24 rounds over 25 lanes: integers, or arrays that hold a lane of many messages each."""
    for constant in _ROUND:
        parity = [a[x] ^ a[x + 5] ^ a[x + 10] ^ a[x + 15] ^ a[x + 20] for x in range(5)]
        mixed = [parity[(x - 1) % 5] ^ ((parity[(x + 1) % 5] << 1 | parity[(x + 1) % 5] >> 63) & _MASK) for x in range(5)]
        moved = [0] * 25
        for x in range(5):
            for y in range(5):
                v, n = a[x + 5 * y] ^ mixed[x], _ROTATE[x + 5 * y]
                moved[y + 5 * ((2 * x + 3 * y) % 5)] = (v << n | v >> (64 - n)) & _MASK if n else v
        a = [moved[i] ^ (~moved[(i + 1) % 5 + i // 5 * 5] & moved[(i + 2) % 5 + i // 5 * 5]) & _MASK for i in range(25)]
        a[0] = a[0] ^ constant
    return a


RATE = 136


def _padded(data: bytes) -> bytearray:
    padded = bytearray(data) + b"\x01" + bytes(-(len(data) + 1) % RATE)
    padded[-1] |= 0x80
    return padded


def keccak256(data: bytes) -> bytes:
    state, padded = [0] * 25, _padded(data)
    for at in range(0, len(padded), RATE):
        for i in range(RATE // 8):
            state[i] ^= int.from_bytes(padded[at + 8 * i : at + 8 * i + 8], "little")
        state = _permute(state)
    return b"".join(w.to_bytes(8, "little") for w in state[:4])


def keccak256_all(values: list[bytes]) -> list[bytes]:
    """The hashes of many messages: those of one number of blocks go through the rounds together."""
    padded = [_padded(v) for v in values]
    out: list[bytes] = [b""] * len(values)
    for size in {len(p) for p in padded}:
        mine = [i for i, p in enumerate(padded) if len(p) == size]
        lanes = np.frombuffer(b"".join(padded[i] for i in mine), "<u8").reshape(len(mine), size // RATE, RATE // 8).astype(np.uint64)
        state = [np.zeros(len(mine), np.uint64) for _ in range(25)]
        for block in range(size // RATE):
            state = _permute([s ^ lanes[:, block, i] if i < RATE // 8 else s for i, s in enumerate(state)])
        digests = np.stack(state[:4], axis=1).astype("<u8")
        for i, row in zip(mine, digests):
            out[i] = row.tobytes()
    return out


@F.pandas_udf(T.BinaryType())
def keccak_udf(data: pd.Series) -> pd.Series:
    there = data.notna()
    out = pd.Series([None] * len(data), dtype=object)
    out[there.to_numpy()] = keccak256_all([bytes(d) for d in data[there]])
    return out


def with_hash(df, column: str, name: str):
    """df with the hash of a binary column, computed once per distinct value."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return df.join(values.withColumn(name, keccak_udf(column)), column, "left")
