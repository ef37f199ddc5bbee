"""Joins of a skewed side with a table of unique keys: hot keys by broadcast, all others by shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot above this share of the rows; there are at most twice as many candidates as that allows.
HOT_SHARE = 0.001


class Sketch:
    """Misra-Gries: with k counters a value that is in more than one of k rows is kept; its count is never too high."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.values, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, values: np.ndarray) -> None:
        new, times = np.unique(values, return_counts=True)
        all_values, where = np.unique(np.concatenate([self.values, new]), return_inverse=True)
        counts = np.zeros(len(all_values), np.int64)
        np.add.at(counts, where, np.concatenate([self.counts, times]))
        if len(counts) > self.size:
            # The (size + 1)-th count goes off all of them, so at most size stay.
            counts -= np.partition(counts, -self.size - 1)[-self.size - 1]
        kept = counts > 0
        self.values, self.counts = all_values[kept], counts[kept]


def key_hash(on: list[str]) -> Column:
    return F.xxhash64(*on)


def hot_hashes(df: DataFrame, on: list[str], share: float = HOT_SHARE) -> list[int]:
    """Hashes of all keys in more than ``share`` of the rows, and of no more than 2 / ``share`` keys.

    Each task sends one bounded sketch; the driver gets the sums that pass.
    """
    size = int(np.ceil(2 / share))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, rows = Sketch(size), 0
        for batch in batches:
            own.add(batch.column(0).to_numpy())
            rows += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *own.values.tolist()], pa.int64()), pa.array([rows, *own.counts.tolist()], pa.int64())], ["h", "n"]
        )

    # The row without a hash has the number of rows; each sketch is short by less than its rows / size.
    sums = df.select(key_hash(on).alias("h")).mapInArrow(sketch, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    total = sums.filter("h IS NULL").select(F.col("n").alias("todas"))
    found = sums.filter("h IS NOT NULL").crossJoin(F.broadcast(total)).filter(F.col("n") >= F.col("todas") * (share - 1 / size))
    return [r.h for r in found.select("h").collect()]


def join_unique(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", share: float = HOT_SHARE) -> DataFrame:
    """``left.join(right, on, how)`` for ``inner``, ``left``, ``left_semi`` or ``left_anti``; ``right`` has each key once.

    Rows of ``left`` with a hot key stay in their tasks and meet a broadcast of these keys' rows, at most 2 / ``share``;
    only the others are shuffled. ``left`` is read three times, so it should be a written table. NULL keys match nothing.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("how is inner, left, left_semi or left_anti")
    hashes = hot_hashes(left, on, share)
    if not hashes:
        return left.join(right, on, how)
    hot = key_hash(on).isin(hashes)
    return left.filter(hot).join(F.broadcast(right.filter(hot)), on, how).unionByName(
        left.filter(~hot).join(right.filter(~hot), on, how)
    )
