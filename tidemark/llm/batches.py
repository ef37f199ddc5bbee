"""Small shared steps: Arrow batches in tasks, whole words, scratch tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: A word is a run of characters other than these six (space, tab, line feed, vertical tab, form feed, return).
WORD = r"[^\x20\x09-\x0D]+"
#: Rows are handed to Python in parts of about this many bytes, so that a batch of long texts stays small.
PART_BYTES = 4 << 20


def words_of(text: str | None) -> list[bytes]:
    """Words of a whole text as UTF-8; ``bytes.split`` cuts at exactly the six characters of WORD."""
    return text.encode().split() if text else []


def parts(batches: Iterator[pa.RecordBatch], size: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each part has few bytes; a single row is never cut."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        step = max(1, min(rows, rows * size // max(batch.nbytes, 1)))
        for start in range(0, rows, step):
            yield batch.slice(start, step)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` over every part of every partition; it carries nothing from one part to the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            yield fn(part)

    return df.mapInArrow(run, schema)


def runs_of(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[pa.Table]:
    """The rows of each value of a column as one table; the rows come sorted by it, so one is held at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        values = batch.column(column).to_numpy()
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and held[0].column(column)[0].as_py() != values[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def spanning(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the classes of a[i] and b[i] in an array of parents; each then points at its least member."""
    while len(a):
        parent = pointed(parent)
        a, b = parent[a], parent[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
    return pointed(parent)


def pointed(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up
