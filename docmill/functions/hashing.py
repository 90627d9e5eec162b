"""Published content hashes: ``xxh64:`` and 16 hex digits of XXH64 with seed 0.

Spark's own ``xxhash64`` uses seed 42, so it serves as an internal change key only.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MASK = (1 << 64) - 1
_P1, _P2, _P3, _P4, _P5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5


def _rotate(x: int, n: int) -> int:
    return ((x << n) | (x >> (64 - n))) & _MASK


def _lane(acc: int, value: int) -> int:
    return _rotate((acc + value * _P2) & _MASK, 31) * _P1 & _MASK


def _xxh64(data: bytes) -> int:
    """XXH64 with seed 0, after the published specification."""
    n, at = len(data), 0
    word = lambda k, size: int.from_bytes(data[k : k + size], "little")
    if n >= 32:
        lanes = [(_P1 + _P2) & _MASK, _P2, 0, -_P1 & _MASK]
        while at <= n - 32:
            lanes = [_lane(lane, word(at + 8 * k, 8)) for k, lane in enumerate(lanes)]
            at += 32
        h = sum(_rotate(lane, r) for lane, r in zip(lanes, (1, 7, 12, 18))) & _MASK
        for lane in lanes:
            h = ((h ^ _lane(0, lane)) * _P1 + _P4) & _MASK
    else:
        h = _P5
    h = (h + n) & _MASK
    while at <= n - 8:
        h = (_rotate(h ^ _lane(0, word(at, 8)), 27) * _P1 + _P4) & _MASK
        at += 8
    if at <= n - 4:
        h = (_rotate(h ^ (word(at, 4) * _P1 & _MASK), 23) * _P2 + _P3) & _MASK
        at += 4
    for byte in data[at:]:
        h = _rotate(h ^ (byte * _P5 & _MASK), 11) * _P1 & _MASK
    h = (h ^ (h >> 33)) * _P2 & _MASK
    h = (h ^ (h >> 29)) * _P3 & _MASK
    return h ^ (h >> 32)


try:
    import xxhash

    def _digest(data: bytes) -> int:
        return xxhash.xxh64_intdigest(data, seed=0)

except ImportError:
    _digest = _xxh64


def hash_bytes(data: bytes) -> str:
    """The published hash of some bytes."""
    return f"xxh64:{_digest(data):016x}"


def hash_file(path: str) -> str:
    with open(path, "rb") as f:
        return hash_bytes(f.read())


@F.pandas_udf(T.StringType())
def _hash_udf(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield s.map(lambda v: None if v is None else hash_bytes(v.encode("utf-8") if isinstance(v, str) else bytes(v)))


def content_hash(column: Column | str) -> Column:
    """The published hash of a string (as UTF-8) or binary column; null stays null."""
    return _hash_udf(F.col(column) if isinstance(column, str) else column)
