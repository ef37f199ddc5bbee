"""Repeated byte strings from the Burrows-Wheeler transform and common prefixes of a collection.

1. One pass cuts every text into segments of windows that share an anchor (the least hash of ANCHOR bytes in the
   window). Equal windows share it too. Segments that occur more than once as a whole are settled there; of the
   others only those whose anchor stands in different surroundings are left, mostly the rims of repeats.
2. These are fetched from their texts and dealt by anchor into collections of bounded size. An anchor with more bytes
   than a collection may have is hot: its windows are keyed one by one by hashes of all their bytes, and those that
   share both hashes are equal. They are read as a sorted stream, so no number of them is held at once.
3. A collection is built column by column, from the last symbol of all its strings to the first. A round inserts the
   next suffix of every string at once: its place follows from the rank of its first symbol in the transform so
   far, and its common prefix with the neighbours from the least common prefix back to the previous and on to the
   next occurrence of that symbol. Each round reads the two columns (symbols, common prefixes) from a
   file and writes them to a new one, both in sequence; the files lie in the shared folder.
4. Stretches of common prefixes of a whole window or more are equal windows. All but the earliest are gone.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import repeats
from tidemark.llm.batches import parts
from tidemark.llm.repeats import Rolling, stirred
from tidemark.session import scratch_uri

WINDOW = 100
#: Bytes of an anchor; longer anchors are rarer and stand for fewer windows.
ANCHOR = 32
#: Bytes of text that a task hashes at once; longer texts are hashed in overlapping pieces.
PIECE = 1 << 20
#: Bytes of the strings of one anchor at most, and from which on a collection takes no further anchor.
COLLECTION = 2 << 20
BASE = 0x9FB21C651E98DF25
VALUE_OF_BYTE = stirred(np.arange(256, dtype=np.uint64) + np.uint64(BASE))
OTHER_BASE = 0xD1B54A32D192ED03
OTHER_VALUE_OF_BYTE = stirred(np.arange(256, dtype=np.uint64) + np.uint64(OTHER_BASE))


def least_ahead(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` values from each place on; shorter by width - 1."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def pieces_of(ids: np.ndarray, texts: list[str], window: int) -> Iterator[tuple[int, int, bytes]]:
    """(document, offset, bytes): texts, those of more than PIECE bytes in pieces that overlap by a window less one."""
    for doc, text in zip(ids.tolist(), texts):
        raw = text.encode()
        for offset in range(0, max(len(raw) - window + 1, 0), PIECE):
            yield doc, offset, raw[offset : offset + PIECE + window - 1]


def side_by_side(pieces: Iterator[tuple[int, int, bytes]]) -> Iterator[list[tuple[int, int, bytes]]]:
    held, size = [], 0
    for piece in pieces:
        held.append(piece)
        size += len(piece[2])
        if size >= PIECE:
            yield held
            held, size = [], 0
    if held:
        yield held


def text_segments(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Segments (and gone windows) of ``docs(doc, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            for group in side_by_side(pieces_of(part.column(0).to_numpy(), part.column(1).to_pylist(), window)):
                raw = np.frombuffer(b"".join(x for _, _, x in group), np.uint8)
                sizes = np.array([len(x) for _, _, x in group])
                begin = np.cumsum(sizes) - sizes
                rolling = Rolling(VALUE_OF_BYTE[raw], BASE)
                at = np.arange(len(raw) - anchor + 1)
                hashes = rolling.of(at, at + anchor)
                key = least_ahead(hashes, window - anchor + 1)
                left = np.concatenate([[False], hashes[: len(key) - 1] == key[:-1]])
                valid = np.zeros(len(raw), np.int8)
                np.add.at(valid, begin, 1)
                np.add.at(valid, (begin + sizes - window + 1)[:-1], -1)
                valid = np.cumsum(valid, dtype=np.int8)[: len(key)] > 0
                first, n = repeats.segments_of(key, valid, left)
                seg = rolling.of(first, first + n + window - 1)
                of = np.searchsorted(begin, first, side="right") - 1
                doc = np.array([d for d, _, _ in group], np.int64)[of]
                start = first - begin[of] + np.array([o for _, o, _ in group], np.int64)[of]
                yield from repeats.combined(key[first], seg, doc, start, n)

    return docs.mapInArrow(run, repeats.SCHEMA)


class Columns:
    """The transform and common prefixes of a collection, one file per round and column, written in sequence."""

    def __init__(self, folder: str) -> None:
        self.store, base = arrow_fs.FileSystem.from_uri(folder)
        self.store.create_dir(base, recursive=True)
        self.name, self.round = f"{base}/{uuid.uuid4().hex}", 0

    def path(self, column: str) -> str:
        return f"{self.name}-{column}-{self.round}"

    def read(self) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for column in ("symbols", "prefixes"):
            with self.store.open_input_stream(self.path(column), compression=None) as file:
                out.append(np.frombuffer(file.read(), np.uint8))
        return out[0], out[1]

    def write(self, symbols: np.ndarray, prefixes: np.ndarray) -> None:
        self.clear()
        self.round += 1
        for column, values in (("symbols", symbols), ("prefixes", prefixes)):
            with self.store.open_output_stream(self.path(column), compression=None) as file:
                file.write(memoryview(np.ascontiguousarray(values)))

    def clear(self) -> None:
        if self.round:
            for column in ("symbols", "prefixes"):
                self.store.delete_file(self.path(column))


def least_between(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of values[low..high] (low <= high) of each pair."""
    if not len(low):
        return np.empty(0, values.dtype)
    # From the right to the left, so that what lies between one pair and the next is never gone over.
    order = np.argsort(-low, kind="stable")
    bounds = np.stack([low[order], high[order] + 1], axis=1).ravel()
    out = np.empty(len(low), values.dtype)
    out[order] = np.minimum.reduceat(np.append(values, values[-1:]), bounds)[::2]
    return out


def collection_order(strings: list[bytes], window: int, columns: Columns) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and common prefixes (at most ``window``) of all suffixes of the strings, in their order.

    Symbols are numbered from 1 in byte order; 0 stands before a string's first byte. The empty suffixes come
    first, by string, and count as different.
    """
    count = len(strings)
    lengths = np.array([len(x) for x in strings], np.int64)
    ends = np.cumsum(lengths)
    raw = np.frombuffer(b"".join(strings), np.uint8)
    number = np.zeros(256, np.uint8)
    used = np.unique(raw)
    number[used] = np.arange(1, len(used) + 1)
    raw = number[raw]
    columns.write(raw[ends - 1], np.zeros(count, np.uint8))
    active, place = np.arange(count), np.arange(count)
    for done in range(1, int(lengths.max()) + 1):
        symbols, prefixes = columns.read()
        order = np.argsort(symbols, kind="stable")
        below = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=257))])
        own = symbols[place]
        rank = np.empty(len(place), np.int64)
        by_symbol = np.argsort(own, kind="stable")
        cuts = np.flatnonzero(np.diff(own[by_symbol])) + 1
        for some in np.split(by_symbol, cuts):
            c = own[some[0]]
            rank[some] = below[c] + np.searchsorted(order[below[c] : below[c + 1]], place[some])
        new_place = count + rank - below[1]
        before = np.flatnonzero(rank > below[own])
        after = np.flatnonzero(rank + 1 < below[own.astype(np.int64) + 1])
        prefix = np.zeros(len(place), np.int64)
        prefix[before] = 1 + least_between(prefixes, order[rank[before] - 1] + 1, place[before]).astype(np.int64)
        next_prefix = 1 + least_between(prefixes, place[after] + 1, order[rank[after] + 1]).astype(np.int64)
        old = np.ones(len(symbols) + len(place), bool)
        old[new_place] = False
        new_symbols, new_prefixes = np.empty(len(old), np.uint8), np.empty(len(old), np.uint8)
        new_symbols[old], new_prefixes[old] = symbols, prefixes
        rest = lengths[active] - done
        ahead = np.where(rest > 0, raw[np.maximum(ends[active] - done - 1, 0)], 0)
        new_symbols[new_place] = ahead
        new_prefixes[new_place] = np.minimum(prefix, window)
        new_prefixes[new_place[after] + 1] = np.minimum(next_prefix, window)
        columns.write(new_symbols, new_prefixes)
        going = rest > 0
        active, place = active[going], new_place[going]
    return columns.read()


def suffix_array(symbols: np.ndarray, count: int, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(string, length of suffix) at each place, by walking every string from its end through the transform."""
    order = np.argsort(symbols, kind="stable")
    ended = int((symbols == 0).sum())
    moves = np.zeros(len(symbols), np.int64)
    moves[order[ended:]] = count + np.arange(len(symbols) - ended)
    string, length = np.zeros(len(symbols), np.int64), np.zeros(len(symbols), np.int64)
    active = place = np.arange(count)
    string[place] = active
    for done in range(1, int(lengths.max()) + 1):
        going = lengths[active] >= done
        active, place = active[going], moves[place[going]]
        string[place], length[place] = active, done
    return string, length


def equal_windows(strings: list[bytes], doc: np.ndarray, start: np.ndarray, window: int, columns: Columns):
    """(doc, start) of every window of the strings that also starts earlier."""
    symbols, prefixes = collection_order(strings, window, columns)
    lengths = np.array([len(x) for x in strings], np.int64)
    string, length = suffix_array(symbols, len(strings), lengths)
    group = np.cumsum(prefixes < window)
    full = length >= window
    string, length, group = string[full], length[full], group[full]
    d, s = doc[string], start[string] + lengths[string] - length
    order = np.lexsort((s, d, group))
    d, s, group = d[order], s[order], group[order]
    again = np.concatenate([[False], group[1:] == group[:-1]])
    head = np.flatnonzero(~again)[np.cumsum(~again) - 1] if len(again) else again
    again &= ~((d == d[head]) & (s == s[head]))
    return d[again], s[again]


def compared(strings: DataFrame, folder: str, window: int = WINDOW) -> DataFrame:
    """Gone windows (doc, start, n) of ``strings(key, doc, start, raw)``; strings that share a key meet in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def finish() -> pa.RecordBatch:
            columns = Columns(folder)
            try:
                _, doc, start, raw = zip(*held)
                d, s = equal_windows(list(raw), np.array(doc, np.int64), np.array(start, np.int64), window, columns)
            finally:
                columns.clear()
            by_place = np.lexsort((s, d))
            d, s, n = repeats.joined(d[by_place], s[by_place], np.ones(len(d), np.int64))
            return pa.RecordBatch.from_arrays(
                [pa.array(d, pa.int64()), pa.array(s, pa.int32()), pa.array(n, pa.int32())], ["doc", "start", "n"]
            )

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if size >= COLLECTION and row[0] != held[-1][0]:
                    yield finish()
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield finish()

    dealt = strings.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "doc long, start int, n int")


def windows_of(spans: list[dict], doc: int, raw: bytes, window: int) -> Iterator[pa.RecordBatch]:
    """A row for each window of the spans, keyed by two hashes of its bytes."""
    for at in range(0, len(spans), 1024):
        some = spans[at : at + 1024]
        n = np.array([x["n"] for x in some], np.int64)
        own = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        cut = np.frombuffer(b"".join(raw[x["start"] : x["start"] + x["n"] + window - 1] for x in some), np.uint8)
        first = own + np.repeat(np.cumsum(n + window - 1) - (n + window - 1), n)
        start = own + np.repeat(np.array([x["start"] for x in some], np.int64), n)
        key = Rolling(VALUE_OF_BYTE[cut], BASE).of(first, first + window)
        seg = Rolling(OTHER_VALUE_OF_BYTE[cut], OTHER_BASE).of(first, first + window)
        yield repeats.rows(key, seg, np.full(len(start), doc), start, np.ones(len(start), np.int64)).append_column(
            "raw", pa.nulls(len(start), pa.binary())
        )


def fetched(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Bytes of the open segments of ``docs(doc, text, spans)``, spans with their keys; windows without bytes of hot ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            for doc, text, spans in zip(*(part.column(i).to_pylist() for i in range(3))):
                raw = text.encode()
                yield from windows_of([x for x in spans if x["hot"]], doc, raw, window)
                cool = [x for x in spans if not x["hot"]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x["key"] for x in cool], pa.int64()),
                        pa.nulls(len(cool), pa.int64()),
                        pa.array([doc] * len(cool), pa.int64()),
                        pa.array([x["start"] for x in cool], pa.int32()),
                        pa.array([x["n"] for x in cool], pa.int32()),
                        pa.array([raw[x["start"] : x["start"] + x["n"] + window - 1] for x in cool], pa.binary()),
                    ],
                    [*repeats.FIELDS, "raw"],
                )

    return docs.mapInArrow(run, f"{repeats.SCHEMA}, raw binary")


def repeated_windows(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc, start, n): stretches of windows of bytes that also start earlier."""
    texts = repeats.id_of(docs)
    settled = repeats.written(repeats.settle(text_segments(texts, window, anchor)), "segments")
    gone, open_ = settled.where("key IS NULL"), settled.where("key IS NOT NULL")
    size = F.sum(F.col("n") + F.lit(window - 1))
    hot = open_.groupBy("key").agg(size.alias("bytes")).where(F.col("bytes") > COLLECTION).select("key", F.lit(True).alias("hot"))
    told = open_.join(hot, "key", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    wanted = told.groupBy("doc").agg(F.collect_list(F.struct("key", "start", "n", "hot")).alias("spans"))
    strings = repeats.written(fetched(texts.join(wanted, "doc"), window), "strings")
    cool = strings.where("raw IS NOT NULL").select("key", "doc", "start", "raw")
    more = compared(cool, scratch_uri(docs.sparkSession, "columns"), window)
    again = repeats.settle(strings.where("raw IS NULL").drop("raw"), keep_open=False)
    return gone.select("doc", "start", "n").union(more).union(again.select("doc", "start", "n"))


def without_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (remaining bytes) of every row of ``docs``.

    A byte goes if a string of ``window`` bytes that covers it also starts earlier: in a document with a
    smaller ``doc_id`` (NULL before all), or earlier in the same one, overlapping or not. Strings are judged on
    the input. A span is a maximal run of removed bytes. NULL and empty texts have no bytes. Rows that share
    a ``doc_id`` are one document and lose the same windows. Further columns are left out.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            out = []
            for text, (start, n) in zip(part.column(1).to_pylist(), repeats.span_lists(part.column(2))):
                raw = text.encode()
                if not len(start):
                    out.append((len(raw), 0, 0, raw))
                    continue
                gone = repeats.covered(len(raw), start, n, window)
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((len(raw), int(gone.sum()), spans, np.frombuffer(raw, np.uint8)[~gone].tobytes()))
            a, b, c, kept = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(x, pa.int64()) for x in (a, b, c)), pa.array(kept, pa.binary())],
                ["doc", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    spans = repeats.by_document(repeated_windows(docs, window, anchor))
    met = repeats.id_of(docs).join(spans, "doc", "left").select("doc", "text", "spans")
    made = met.mapInArrow(cut, "doc long, n_bytes long, n_removed long, n_spans long, kept binary")
    return made.select(
        F.nullif("doc", F.lit(repeats.NO_ID)).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept"
    )
