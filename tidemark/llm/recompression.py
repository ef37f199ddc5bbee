"""Repeated passages of words by recompression.

In each round neighbouring symbols get a common name: runs of one word in the first round, then pairs. Which
symbols pair follows from their names alone, and a name is a hash of what it stands for, so it is the
same in every document without a table of names. Each symbol knows which words have decided on it.
A window of words holds all symbols that only its own words have decided on: in every other place where the same
words stand, the same symbols arise. The key of a window is the least of its symbols of the highest level, each
taken with the words that have decided on it, so equal windows meet under equal keys, whatever surrounds them, and
few others do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import repeats
from tidemark.llm.batches import parts
from tidemark.llm.repeats import Rolling, stirred

WINDOW = 20
ROUNDS = 2
#: Hashes of words that a task remembers.
REMEMBERED = 1_000_000
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
BASES = (0xD1B54A32D192ED03, 0xAEF17502108EF2D9)


def named(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return stirred(a * repeats.MIX2 + stirred(b))


def runs(sym, low, high, edge):
    """Runs of one symbol as one; that a run ends is known from its neighbours."""
    fresh = np.concatenate([[True], (sym[1:] != sym[:-1]) | edge[1:] | edge[:-1]])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(sym)) - 1
    length = (last - first + 1).astype(np.uint64)
    name = np.where(length > 1, named(sym[first], length), sym[first])
    return name, low[np.maximum(first - 1, 0)], high[np.minimum(last + 1, len(sym) - 1)], edge[first]


def pairs(sym, low, high, edge):
    """A symbol of the left half of all names and a following one of the right half as one."""
    right = (stirred(sym ^ repeats.GOLD) >> np.uint64(63)).astype(bool)
    left = ~right & ~edge
    right &= ~edge
    joins = left & np.concatenate([right[1:], [False]])
    second = np.concatenate([[False], joins[:-1]])
    after, before = np.append(sym[1:], sym[:1]), np.concatenate([low[:1], low[:-1]])
    name = np.where(joins, named(sym, after), sym)
    new_high = np.where(left, np.append(high[1:], high[-1:]), high)
    new_low = np.where(right, before, low)
    kept = ~second
    return name[kept], new_low[kept], new_high[kept], edge[kept]


def spread_least(n: int, first: np.ndarray, last: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The least value whose range [first, last] holds a position, for each of ``n``."""
    width = last - first + 1
    level = np.frexp(width.astype(np.float64))[1] - 1
    top = int(level.max(initial=0))
    table = [np.full(n, NONE) for _ in range(top + 1)]
    for k in range(top + 1):
        of = level == k
        np.minimum.at(table[k], first[of], value[of])
        np.minimum.at(table[k], last[of] - (1 << k) + 1, value[of])
    for k in range(top, 0, -1):
        half = 1 << (k - 1)
        np.minimum(table[k - 1], table[k], out=table[k - 1])
        np.minimum(table[k - 1][half:], table[k][:-half], out=table[k - 1][half:])
    return table[0]


def window_keys(words: np.ndarray, edge: np.ndarray, window: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """A key for the window at each place of a row of words, and whether a symbol that gave a key has just left.

    ``edge`` marks what stands between documents.
    """
    n = len(words)
    place = np.arange(n)
    sym, low, high = words, place, place + 1
    levels = [(sym, low, high, edge)]
    for turn in range(rounds):
        if turn == 0:
            sym, low, high, edge = runs(sym, low, high, edge)
        sym, low, high, edge = pairs(sym, low, high, edge)
        levels.append((sym, low, high, edge))
    key, left, said = np.full(n, NONE), np.zeros(n + 1, bool), Rolling(words, BASES[0])
    for level in range(rounds, -1, -1):
        sym, low, high, edge = levels[level]
        fits = ~edge & (high - low <= window)
        if not fits.any():
            continue
        value = named(sym[fits] ^ np.uint64(level + 1), said.of(low[fits], high[fits]))
        least = spread_least(n, np.maximum(high[fits] - window, 0), low[fits], value)
        key = np.where(key == NONE, least, key)
        gave = value == key[low[fits]]
        left[low[fits][gave] + 1] = True
    return key, left[:n]


class Words:
    """64-bit hashes of the words of many texts side by side, an edge before, between and after them."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, digest = self.known, xxhash.xxh3_64_intdigest
        out, counts = [0], []
        for text in texts:
            words = text.encode().split()
            counts.append(len(words))
            for w in words:
                h = known.get(w)
                if h is None:
                    h = known[w] = digest(w)
                out.append(h)
            out.append(0)
        counts = np.array(counts, np.int64)
        begin = 1 + np.concatenate([[0], np.cumsum(counts + 1)[:-1]]).astype(np.int64)
        return np.array(out, np.uint64), begin, counts


def passage_segments(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """Segments (and gone windows) of ``docs(doc, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Words()
        for part in parts(batches):
            ids = part.column(0).to_numpy()
            hashes, begin, counts = reader.of(part.column(1).to_pylist())
            edge = np.zeros(len(hashes), bool)
            edge[0] = True
            edge[begin + counts] = True
            keys, left = window_keys(hashes, edge, window, rounds)
            windows = np.maximum(counts - window + 1, 0)
            valid = np.zeros(len(hashes), bool)
            own = np.repeat(begin, windows) + np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
            valid[own] = True
            first, n = repeats.segments_of(keys, valid, left)
            seg = Rolling(hashes, BASES[0]).of(first, first + n + window - 1)
            doc = np.searchsorted(begin, first, side="right") - 1
            yield from repeats.combined(keys[first], seg, ids[doc], first - begin[doc], n)

    return docs.mapInArrow(run, repeats.SCHEMA)


def window_rows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every window of the open segments of ``docs(doc, text, spans)`` as a row under two hashes of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Words()
        for part in parts(batches):
            ids = part.column(0).to_numpy()
            hashes, begin, _ = reader.of(part.column(1).to_pylist())
            a, b = Rolling(hashes, BASES[0]), Rolling(stirred(hashes), BASES[1])
            spans = repeats.span_lists(part.column(2))
            starts = np.concatenate([s + begin[i] for i, (s, _) in enumerate(spans)])
            counts = np.concatenate([n for _, n in spans])
            doc = np.repeat(np.arange(len(ids)), [len(s) for s, _ in spans])
            at = np.repeat(starts, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            doc = np.repeat(doc, counts)
            yield from repeats.combined(
                a.of(at, at + window), b.of(at, at + window), ids[doc], at - begin[doc], np.ones(len(at), np.int64)
            )

    return docs.mapInArrow(run, repeats.SCHEMA)


def repeated_windows(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """(doc, start, n): stretches of windows whose words also start earlier."""
    texts = repeats.id_of(docs)
    settled = repeats.written(repeats.settle(passage_segments(texts, window, rounds)), "passages")
    gone, open_ = settled.where("key IS NULL"), settled.where("key IS NOT NULL")
    again = texts.join(repeats.by_document(open_), "doc")
    more = repeats.settle(window_rows(again, window), keep_open=False)
    return gone.select("doc", "start", "n").union(more.select("doc", "start", "n"))


def without_repeats(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept (remaining words, one space between) of every row of ``docs``.

    A word goes if a window of ``window`` words that covers it also starts earlier: in a document with a
    smaller ``doc_id`` (NULL before all), or earlier in the same one. Windows are judged on the input.
    NULL and empty texts have no words. Rows that share a ``doc_id`` are one document and lose the same
    windows. Texts are read whole and by words only; further columns are left out.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            counts, removed, kept = [], [], []
            for text, (start, n) in zip(part.column(1).to_pylist(), repeats.span_lists(part.column(2))):
                words = text.encode().split()
                if len(start):
                    gone = repeats.covered(len(words), start, n, window)
                    removed.append(int(gone.sum()))
                    kept.append(b" ".join(w for w, g in zip(words, gone.tolist()) if not g).decode())
                else:
                    removed.append(0)
                    kept.append(b" ".join(words).decode())
                counts.append(len(words))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc", "n_words", "n_removed", "kept"],
            )

    spans = repeats.by_document(repeated_windows(docs, window, rounds))
    met = repeats.id_of(docs).join(spans, "doc", "left").select("doc", "text", "spans")
    made = met.mapInArrow(cut, "doc long, n_words long, n_removed long, kept string")
    return made.select(F.nullif("doc", F.lit(repeats.NO_ID)).alias("doc_id"), "n_words", "n_removed", "kept")
