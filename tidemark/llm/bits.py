"""A bit array of bounded size over 64-bit keys, built by Spark and broadcast.

It answers "not among the keys" for certain, "maybe" otherwise. Its size is
capped whatever the number of keys: a fuller array only lets more rows through
to the join that follows, which decides."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_BITS, MAX_BITS, PROBES = 1 << 20, 1 << 26, 3
#: Bits for each key, below the cap.
PER_KEY = 64

_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


def places(h: np.ndarray, bits: int, k: int) -> np.ndarray:
    step = (h * _MIX) >> np.uint64(17) | np.uint64(1)
    return ((h >> np.uint64(7)) + np.uint64(k) * step) & np.uint64(bits - 1)


def size_for(keys: int, per_key: int = PER_KEY) -> int:
    bits = MIN_BITS
    while bits < MAX_BITS and bits < per_key * keys:
        bits *= 2
    return bits


def build(keys: DataFrame, column: str, per_key: int = PER_KEY) -> np.ndarray:
    """The array (as bytes) over a long column; at most MAX_BITS / 8 bytes reach the driver."""
    bits = size_for(keys.count(), per_key)

    def run(batches):
        for b in batches:
            h = b.column("h").to_numpy(zero_copy_only=False).view(np.uint64)
            for k in range(PROBES):
                p = places(h, bits, k)
                yield pa.RecordBatch.from_arrays([pa.array((p >> np.uint64(6)).astype(np.int64)),
                                                  pa.array((np.uint64(1) << (p & np.uint64(63))).view(np.int64))], names=["word", "bit"])

    got = keys.select(F.col(column).alias("h")).mapInArrow(run, "word long, bit long") \
        .groupBy("word").agg(F.bit_or("bit").alias("m")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[got.column("word").to_numpy()] = got.column("m").to_numpy().view(np.uint64)
    return words


def maybe(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Positions of ``h`` that may be among the keys."""
    at, bits = np.arange(len(h)), 64 * len(words)
    for k in range(PROBES):
        p = places(h, bits, k)
        ok = (words[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1
        h, at = h[ok], at[ok]
        if not len(h):
            break
    return at


def among(df: DataFrame, column: str, words: np.ndarray) -> DataFrame:
    """The rows of ``df`` whose long column may be among the keys."""
    shared = df.sparkSession.sparkContext.broadcast(words)

    def run(batches):
        for b in batches:
            at = maybe(shared.value, b.column(column).to_numpy(zero_copy_only=False).view(np.uint64))
            if len(at):
                yield b.take(pa.array(at))

    return df.mapInArrow(run, df.schema)
