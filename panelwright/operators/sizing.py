"""Joins of a large table with one that is expected to be small, decided by its measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.operators.ranking import checkpointed

BROADCAST_ROWS = 200_000


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join with `small` broadcast when it has at most `max_rows` rows, else as a shuffled join.

    `small` is checkpointed and counted up to the limit, so its size is known before the large side
    moves: adaptive execution alone would learn it only after shuffling both sides by a key that may
    be skewed.  Beyond the limit its skew handling splits the hot partitions.
    """
    kept = checkpointed(small)
    fits = kept.limit(max_rows + 1).count() <= max_rows
    return big.join(F.broadcast(kept) if fits else kept, on, how)
