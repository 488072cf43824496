"""Words as byte spans and 64-bit hashes, computed per text with numpy inside tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_BASE, _INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def modest_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Keep Arrow batches small, so a run of very long texts still fits in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown by doubling as longer texts come."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            step = np.uint64(len(self.up))
            self.up = np.concatenate([self.up, self.up * _power(_BASE, step)])
            self.down = np.concatenate([self.down, self.down * _power(_INVERSE, step)])
        return self.up[:n], self.down[:n]


def _power(base: np.uint64, exponent: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), int(exponent), 1 << 64))


_powers = _Powers()


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX1
    h = (h ^ (h >> np.uint64(33))) * _MIX2
    return h ^ (h >> np.uint64(33))


def word_spans(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end bytes of the words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes."""
    edge = np.diff(np.concatenate(([1], SPACE[np.frombuffer(raw, dtype=np.uint8)], [1])).astype(np.int8))
    return np.flatnonzero(edge < 0), np.flatnonzero(edge > 0)


def _range_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of each values[start:end], from one prefix sum."""
    up, down = _powers.get(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


def word_hashes(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    letters = np.frombuffer(raw, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    return mix(_range_sums(letters, starts, ends))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """One hash for every run of ``width`` word hashes."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    starts = np.arange(n)
    return mix(_range_sums(words, starts, starts + width))


def lower_ascii(raw: bytes) -> bytes:
    """A-Z lower-cased; bytes.lower() leaves all other bytes alone."""
    return raw.lower()
