"""Cutting heavy values into content-addressed chunks: whole fields, or content-defined by a gear hash."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import in_arrow

CHUNKS = "pos int, hash string, data binary"


@dataclass(frozen=True)
class GearConfig:
    """Bounds of a chunk in bytes. Up to the average a strict mask decides, from there on a lax one."""

    least: int = 2048
    average: int = 4096
    most: int = 8192


@lru_cache(1)
def gear() -> np.ndarray:
    """Weights of the 256 bytes. The rule is fixed, as another table would cut, and so address, differently."""
    return np.array([int.from_bytes(hashlib.sha256(bytes([b, 0x9E, 0x37, 0x79, 0xB9])).digest()[:8], "big") for b in range(256)], np.uint64)


def top_bits(k: int) -> np.uint64:
    return np.uint64(0 if k <= 0 else (2**64 - 1) ^ (2 ** max(0, 64 - k) - 1))


def cut_points(data: bytes, config: GearConfig = GearConfig()) -> list[int]:
    """Ends of all chunks.

    The hash starts anew at the least size of each chunk, and a byte leaves it after 64 shifts; so all hashes of a chunk's
    window come from doubling: shifted by 1, 2, 4, ... and added, in six vector steps.
    """
    raw = np.frombuffer(data, np.uint8)
    bits = config.average.bit_length() - 1
    strict, lax = top_bits(bits + 2), top_bits(bits - 2)
    ends, start = [], 0
    while start < len(raw):
        n = min(len(raw) - start, config.most)
        end = n
        if len(raw) - start > config.least:
            h = gear()[raw[start + config.least : start + n]]
            for k in (1, 2, 4, 8, 16, 32):
                if k < len(h):
                    shifted = h.copy()
                    shifted[k:] += h[:-k] << np.uint64(k)
                    h = shifted
            turn = max(0, min(config.average, n) - config.least)
            hit = np.flatnonzero((h[:turn] & strict) == 0)
            if len(hit):
                end = config.least + int(hit[0])
            elif len(hit := np.flatnonzero((h[turn:] & lax) == 0)):
                end = config.least + turn + int(hit[0])
        start += end
        ends.append(start)
    return ends


def _cut_rows(config: GearConfig) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                row, pos, sha, data = [], [], [], []
                for i, v in enumerate(part.column(part.num_columns - 1).to_pylist()):
                    a = 0
                    for p, e in enumerate(cut_points(v or b"", config)):
                        row.append(i)
                        pos.append(p)
                        data.append(v[a:e])
                        sha.append(hashlib.sha256(v[a:e]).hexdigest())
                        a = e
                kept = pa.RecordBatch.from_arrays(part.columns[:-1], names=part.schema.names[:-1]).take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(pos, pa.int32()), pa.array(sha, pa.string()), pa.array(data, pa.binary())], names=[*kept.schema.names, "pos", "hash", "data"])

    return run


def _keys(values: DataFrame) -> tuple[list[str], str]:
    keys = [c for c in values.columns if c != "value"]
    kinds = dict(values.dtypes)
    return keys, "".join(f"`{c}` {kinds[c]}, " for c in keys)


def whole_field(values: DataFrame) -> DataFrame:
    """values: key columns and ``value`` (binary). One chunk for each value, by built-in expressions only."""
    keys, _ = _keys(values)
    return values.select(*keys, F.lit(0).alias("pos"), F.sha2("value", 256).alias("hash"), F.col("value").alias("data"))


def gear_chunks(values: DataFrame, config: GearConfig = GearConfig()) -> DataFrame:
    """The same with content-defined cuts; an empty value has no chunk."""
    keys, kinds = _keys(values)
    return in_arrow(values.select(*keys, "value"), _cut_rows(config), kinds + CHUNKS)


def template_aware(values: DataFrame) -> DataFrame:
    """Templates aren't known to the store yet, so their texts are cut by content like all others."""
    return gear_chunks(values)


CHUNKERS: dict[str, Callable[[DataFrame], DataFrame]] = {"wholefield": whole_field, "fastcdc": gear_chunks, "template": template_aware}


def chunker(kind: str) -> Callable[[DataFrame], DataFrame]:
    if kind not in CHUNKERS:
        raise ValueError(f"unknown chunker {kind!r}; there are {', '.join(sorted(CHUNKERS))}")
    return CHUNKERS[kind]
