"""What both substring operators share: segments of windows, first occurrences, spans by document.

A window is a fixed number of symbols of one document. Each window has a key that follows from its
own symbols alone, so equal windows have equal keys. Neighbouring windows that have one key from one place form a
segment. A segment travels as (key, hash of its symbols, document, start, number of windows):

* of segments with one key and hash, all windows but those of the first start earlier elsewhere: they are ``gone``;
* a key with one segment hash is then settled; the first segments of the others are ``open`` and are compared further.

Documents stand for their ``doc_id``; rows that share one are taken for the same document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.session import materialise

SCHEMA = "key long, seg long, doc long, start int, n int"
FIELDS = ["key", "seg", "doc", "start", "n"]
KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
#: Windows of a segment at most; a longer stretch with one key is cut, which changes no result.
LONGEST = 128
#: Stands for a NULL document id, before all others.
NO_ID = -(1 << 63)
GOLD, MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def stirred(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit value of each."""
    x = (x + GOLD).astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= MIX1
    x ^= x >> np.uint64(27)
    x *= MIX2
    x ^= x >> np.uint64(31)
    return x


class Rolling:
    """Hashes of any stretch of a row of 64-bit values: sums of value times power, moved back to power 0."""

    def __init__(self, values: np.ndarray, base: int) -> None:
        odd = np.uint64(base | 1)
        back = np.uint64(pow(int(odd), -1, 1 << 64))
        n = len(values)
        self.back = np.full(n + 1, back, np.uint64)
        power = np.full(n + 1, odd, np.uint64)
        power[:1] = self.back[:1] = 1
        np.multiply.accumulate(power, out=power)
        np.multiply.accumulate(self.back, out=self.back)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * power[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return stirred((self.sums[end] - self.sums[start]) * self.back[start])


def segments_of(key: np.ndarray, valid: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first window, number of windows) of the segments in a row of window keys.

    ``left`` marks windows that have just left a symbol which gave the key. A segment ends there, so
    no two windows of a segment are equal: the first such symbol would stand at the same distance in both.
    """
    if not len(key):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    same = valid[1:] & valid[:-1] & (key[1:] == key[:-1]) & ~left[1:]
    fresh = np.concatenate([[True], ~same])
    begin = np.flatnonzero(fresh)
    run = np.arange(len(key)) - np.repeat(begin, np.diff(np.append(begin, len(key))))
    first = np.flatnonzero(valid & (run % LONGEST == 0))
    ends = np.flatnonzero(np.concatenate([~same | (run[1:] % LONGEST == 0), [True]])) + 1
    return first, ends[np.searchsorted(ends, first, side="right")] - first


def joined(doc: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of windows that touch or overlap, as one; input sorted by (doc, start)."""
    if not len(doc):
        return doc, start, n
    reach = np.maximum.accumulate(start + n + np.concatenate([[0], np.cumsum(doc[1:] != doc[:-1])]) * (1 << 40))
    gap = (start + np.concatenate([[0], np.cumsum(doc[1:] != doc[:-1])]) * (1 << 40))[1:] > reach[:-1]
    first = np.concatenate([[0], np.flatnonzero(gap) + 1])
    last = np.append(first[1:], len(doc)) - 1
    level = np.concatenate([[0], np.cumsum(doc[1:] != doc[:-1])])[last] * (1 << 40)
    return doc[first], start[first], reach[last] - level - start[first]


def rows(key, seg, doc, start, n) -> pa.RecordBatch:
    made = [None if x is None else np.ascontiguousarray(x) for x in (key, seg, doc, start, n)]
    count = len(made[2])
    return pa.RecordBatch.from_arrays(
        [
            pa.nulls(count, k) if x is None else pa.array(x.view(np.int64) if x.dtype == np.uint64 else x, k)
            for x, k in zip(made, KINDS)
        ],
        FIELDS,
    )


def combined(key, seg, doc, start, n) -> Iterator[pa.RecordBatch]:
    """Segments of one part: the first of each kind as they are, the others as gone windows (NULL key)."""
    order = np.lexsort((start, doc, seg, key))
    key, seg, doc, start, n = (x[order] for x in (key, seg, doc, start, n))
    again = np.concatenate([[False], (key[1:] == key[:-1]) & (seg[1:] == seg[:-1])]) if len(key) else np.empty(0, bool)
    if again.any():
        head = np.flatnonzero(~again)[np.cumsum(~again) - 1]
        itself = again & (doc == doc[head]) & (start == start[head])
        gone = again & ~itself
        by_place = np.lexsort((start[gone], doc[gone]))
        d, s, m = joined(*(x[gone][by_place] for x in (doc, start, n)))
        yield rows(None, None, d, s, m)
    yield rows(*(x[~again] for x in (key, seg, doc, start, n)))


def settle(segments: DataFrame, keep_open: bool = True) -> DataFrame:
    """Rows (key, seg, doc, start, n): gone windows with NULL key, and open segments with their key.

    One shuffle by key; rows come sorted, so a key with any number of rows is read as a stream.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None  # the last first segment: its row, whether its key began with it
        for batch in batches:
            if not batch.num_rows:
                continue
            passed = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            if passed.any():
                yield batch.filter(pa.array(passed))
            own = batch.filter(pa.array(~passed))
            if not own.num_rows:
                continue
            key, seg, doc, start, n = (own.column(i).to_numpy() for i in range(5))
            lead = 0
            if head is not None:
                lead = 1
                key, seg, doc, start, n = (np.concatenate([[h], x]) for h, x in zip(head[0], (key, seg, doc, start, n)))
            new_key = np.concatenate([[True], key[1:] != key[:-1]])
            new_seg = new_key | np.concatenate([[True], seg[1:] != seg[:-1]])
            if lead:
                new_key[0] = head[1]
            at = np.flatnonzero(new_seg)
            first = at[np.cumsum(new_seg) - 1]
            gone = ~new_seg & ~((doc == doc[first]) & (start == start[first]))
            if gone.any():
                yield rows(None, None, doc[gone], start[gone], n[gone])
            if keep_open:
                # A first segment is settled if its key begins with it and the next one has another key.
                open_ = ~new_key[at[:-1]] | ~new_key[at[1:]]
                if (own_open := at[:-1][open_]).size:
                    yield rows(*(x[own_open] for x in (key, seg, doc, start, n)))
            last = at[-1]
            head = ([x[last] for x in (key, seg, doc, start, n)], bool(new_key[last]))
        if head is not None and keep_open and not head[1]:
            yield rows(*(np.array([x]) for x in head[0]))

    dealt = segments.repartition(F.coalesce("key", F.xxhash64("doc", "start"))).sortWithinPartitions("key", "seg", "doc", "start")
    return dealt.mapInArrow(run, SCHEMA)


def by_document(spans: DataFrame) -> DataFrame:
    """(doc, spans): the stretches of windows of each document, as one row; bounded by the document's length."""
    return spans.groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("spans"))


def id_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.coalesce("text", F.lit("")).alias("text"))


def span_lists(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(starts, counts) for each row of a list column of (start, n)."""
    out = []
    for x in column:
        values = x.values
        if values is None:
            out.append((np.empty(0, np.int64), np.empty(0, np.int64)))
        else:
            # flatten() minds the slice of the list; field() does not
            out.append(tuple(x.to_numpy(zero_copy_only=False).astype(np.int64) for x in values.flatten()))
    return out


def covered(length: int, start: np.ndarray, n: np.ndarray, window: int) -> np.ndarray:
    """Which of ``length`` symbols lie in one of the windows."""
    edge = np.zeros(length + 1, np.int32)
    np.add.at(edge, np.minimum(start, length), 1)
    np.add.at(edge, np.minimum(start + n + window - 1, length), -1)
    return np.cumsum(edge[:-1]) > 0


def written(df: DataFrame, label: str) -> DataFrame:
    return materialise(df, label)
