"""Sharding: a Feistel permutation with cycle walking over global row numbers.

Row r of n goes to place p(r) of a keyed permutation of 0..n-1; shard p mod k, slot p div k.  Both are
computable from r, n, the seed and k alone, and so is the inverse.  Shards differ by one row at most.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from panelwright.llm.common import numbered

ROUNDS = 4


def round_keys(seed: int) -> list[int]:
    """Keys of the rounds from the seed (a multiplicative sequence modulo 2**32)."""
    keys, x = [], (seed * 2654435761 + 1) % 2**32
    for _ in range(ROUNDS):
        x = (x * 1664525 + 1013904223) % 2**32
        keys.append(x)
    return keys


def _mix(half: np.ndarray, key: int, mask: int) -> np.ndarray:
    m32 = np.uint64(0xFFFFFFFF)
    t = (half * np.uint64(0x9E3779B1) + np.uint64(key)) & m32
    t ^= t >> np.uint64(15)
    t = (t * np.uint64(0x85EBCA6B)) & m32
    t ^= t >> np.uint64(13)
    t = (t * np.uint64(0xC2B2AE35)) & m32
    return (t ^ (t >> np.uint64(16))) & np.uint64(mask)


def permute(rows: np.ndarray, n: int, seed: int = 0, inverse: bool = False) -> np.ndarray:
    """The places of the given row numbers in the permutation of 0..n-1, or the other way round.

    The cipher works on the next even power of two (under 4n); a value of n or more is enciphered again
    until it falls below n, which keeps the map one to one.
    """
    x = np.asarray(rows, dtype=np.uint64).copy()
    if n < 2:
        return x.astype(np.int64)
    bits = max(1, (int(n - 1).bit_length() + 1) // 2)
    mask, half = (1 << bits) - 1, np.uint64(bits)
    keys = round_keys(seed)
    walking = np.arange(len(x))
    while len(walking):
        left, right = x[walking] >> half, x[walking] & np.uint64(mask)
        if inverse:
            for key in reversed(keys):
                left, right = right ^ _mix(left, key, mask), left
        else:
            for key in keys:
                left, right = right, left ^ _mix(right, key, mask)
        x[walking] = (left << half) | right
        walking = walking[x[walking] >= np.uint64(n)]
    return x.astype(np.int64)


def place(row_no: Column, n: int, seed: int = 0) -> Column:
    """Column of places in the permutation."""

    def places(rows: pd.Series) -> pd.Series:
        return pd.Series(permute(rows.to_numpy(), n, seed))

    return F.pandas_udf(places, LongType())(row_no)


def assign(df: DataFrame, *order: Column | str, shards: int, seed: int = 0) -> DataFrame:
    """The rows with `row_no`, `shard` and `slot` (instead of columns of those names).

    `order` fixes the row numbers; rows that tie in all of it are interchangeable.  An empty table gives
    an empty table.  Only the given columns travel, so pass narrow rows and join the rest by key.
    """
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    rows, n = numbered(df.drop("row_no", "shard", "slot", "_place"), *order)
    return (
        rows.withColumn("_place", place(F.col("row_no"), n, seed))
        .withColumn("shard", (F.col("_place") % shards).cast("int"))
        .withColumn("slot", F.expr(f"_place div {shards}"))
        .drop("_place")
    )


def write_shards(df: DataFrame, path: str) -> None:
    """One folder per shard with its rows in slot order, and at most as many files as shuffle partitions."""
    df.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
