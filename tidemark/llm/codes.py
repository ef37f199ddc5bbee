"""Vector code compression: per-part codebooks fitted in integers, nearest entries found by a GNAT.

Components become integers once, so sums, means and distances are exact and every order of the rows gives
the same codebooks. A geometric near-neighbour access tree stands over the entries of each part: some entries are
its split points, every other one belongs to its nearest split, and for each pair (split i, child j) the least and
greatest distance from i to the members of j are kept. Once a query's distance to split i and the best distance
so far are known, child j is left out if the triangle inequality puts all of it strictly further away.
Distances of those tests are doubles, rounded so that a child is rather kept; which entry is nearest is decided
by integers, ties by the lower index.

A round is one pass over the vectors: each task adds up what it assigned to every entry, and only these sums are
shuffled. The driver holds the codebooks, whose size is given by the parameters alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.batches import parts as bounded
from tidemark.session import materialise

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Split points of a node of the tree; children of up to so many entries have no node of their own.
DEGREE = 4
#: Room for the roundings of a square root and a sum of doubles, relative.
ROOM = 1e-12
#: Larger components count as this; it keeps sums over any table within 38 digits.
MOST = 2.0**63
#: A label with more than one in so many rows is hot; there are fewer of them than that.
HOT_SHARE = 1000
LONG = (1 << 63) - 1


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return (gap * gap).sum(axis=-1)


def roots(square: np.ndarray) -> np.ndarray:
    return np.sqrt(np.asarray(square).astype(np.float64))


class Gnat:
    """Near-neighbour tree over the given entries (number, point); numbers are in ascending order."""

    def __init__(self, points: np.ndarray, numbers: np.ndarray | None = None, degree: int = DEGREE) -> None:
        self.numbers = np.arange(len(points)) if numbers is None else numbers
        self.points, self.splits, self.children = points, np.arange(len(points)), []
        if len(points) <= degree:
            return
        # Split points far from each other, the first one far from the first entry.
        near = squared(points, points[0])
        chosen = [int(np.argmax(near))]
        near = squared(points, points[chosen[0]])
        while len(chosen) < degree:
            chosen.append(int(np.argmax(near)))
            near = np.minimum(near, squared(points, points[chosen[-1]]))
        self.splits = np.array(sorted(set(chosen)))
        away = np.array([squared(points, points[s]) for s in self.splits])
        home = np.argmin(away, axis=0)
        home[self.splits] = np.arange(len(self.splits))
        distance = roots(away)
        # A split point is a member of its own set, so a set that is left out takes its split point along.
        shape = (len(self.splits), len(self.splits))
        self.low, self.high = np.zeros(shape), np.zeros(shape)
        for j in range(len(self.splits)):
            own = distance[:, home == j]
            self.low[:, j], self.high[:, j] = own.min(axis=1) * (1 - ROOM), own.max(axis=1) * (1 + ROOM)
            rest = np.setdiff1d(np.flatnonzero(home == j), self.splits)
            self.children.append(Gnat(points[rest], self.numbers[rest], degree) if len(rest) else None)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(entry, squared distance) of every query, and how many distances were taken."""
        best = np.full(len(queries), -1)
        least = np.zeros(len(queries), queries.dtype)
        taken = self.search(queries, np.arange(len(queries)), best, least)
        return best, least, taken

    def search(self, queries: np.ndarray, at: np.ndarray, best: np.ndarray, least: np.ndarray) -> int:
        """Better what ``best`` and ``least`` hold for the queries ``at``."""
        taken = 0
        open_ = np.ones((len(at), len(self.splits)), bool)
        for i, split in enumerate(self.splits):
            line = np.flatnonzero(open_[:, i])
            rows = at[line]
            if not len(rows):
                continue
            taken += len(rows)
            away = squared(queries[rows], self.points[split])
            number = self.numbers[split]
            better = (best[rows] < 0) | (away < least[rows]) | ((away == least[rows]) & (number < best[rows]))
            best[rows[better]], least[rows[better]] = number, away[better]
            if self.children:
                distance, reach = roots(away), roots(least[rows]) * (1 + ROOM)
                nearest, furthest = distance * (1 - ROOM) - reach, distance * (1 + ROOM) + reach
                out = (nearest[:, None] > self.high[i]) | (furthest[:, None] < self.low[i])
                open_[line] &= ~out
        for j, child in enumerate(self.children):
            rows = at[open_[:, j]]
            if child is not None and len(rows):
                taken += child.search(queries, rows, best, least)
        return taken


def whole(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), as int64, or as Python integers where squares would not fit."""
    values = np.clip(np.asarray(values, np.float64), -MOST, MOST)
    floors = np.floor(values * scale)
    width = values.shape[-1] if values.ndim else 1
    most = float(np.abs(floors).max()) if floors.size else 0.0
    if (2 * most + 2) ** 2 * max(width, 1) < 2.0**62:
        return floors.astype(np.int64)
    return np.array([int(x) for x in floors.ravel()], object).reshape(floors.shape)


def cut(rows: np.ndarray, count: int) -> list[np.ndarray]:
    return np.array_split(rows, count, axis=1)


def usable(vectors: DataFrame) -> DataFrame:
    """Rows whose vector is neither NULL nor holds a NULL or non-finite component, as array<double>."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col("embedding").isNotNull() & ~bad).withColumn("embedding", F.col("embedding").cast("array<double>"))


def blocks(batches: Iterator[pa.RecordBatch], column: int, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(part, which of its rows have the width, their integers)."""
    for part in bounded(batches):
        vectors = part.column(column)
        fits = np.flatnonzero(vectors.value_lengths().to_numpy() == width)
        flat = vectors.take(pa.array(fits)).flatten().to_numpy(zero_copy_only=False)
        yield part, fits, whole(flat.reshape(len(fits), width))


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Codebooks of ``usable`` vectors, one per part position: (entry, position) integers.

    They start as the parts of the ``entries`` vectors that come first by ``vec_id`` (NULL last, equal ones by vector);
    fewer vectors give fewer entries. The first vector's length is the length of all; vectors of another one take no
    part. Where it is no multiple of ``parts``, the first parts are longer by one component.
    """
    order = [F.asc_nulls_last("vec_id"), F.col("embedding")]
    width_row = vectors.orderBy(*order).select(F.size("embedding")).first()
    if width_row is None:
        return []
    width = width_row[0]
    first = vectors.where(F.size("embedding") == width).orderBy(*order).limit(entries).select("embedding").collect()
    books = [
        np.array(b.tolist(), object).reshape(b.shape)
        for b in cut(whole(np.array([r[0] for r in first], np.float64).reshape(len(first), width)), parts)
    ]
    for _ in range(rounds):
        fixed = books

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees = trees_of(fixed)
            sums = [np.zeros(b.shape, object) for b in fixed]
            counts = np.zeros((len(fixed), len(fixed[0])), np.int64)
            for _, _, rows in blocks(batches, 0, width):
                for p, (own, tree) in enumerate(zip(cut(rows, parts), trees)):
                    code, _, _ = tree(own)
                    some = np.zeros(sums[p].shape, own.dtype)
                    np.add.at(some, code, own)
                    sums[p] += some
                    counts[p] += np.bincount(code, minlength=counts.shape[1])
            made = [
                (p, e, i, str(sums[p][e, i]), int(counts[p, e]))
                for p in range(len(fixed)) for e in np.flatnonzero(counts[p]).tolist() for i in range(sums[p].shape[1])
            ]
            columns = list(zip(*made)) if made else [()] * 5
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["p", "e", "i", "s", "n"])

        partial = vectors.select("embedding").mapInArrow(added, "p int, e int, i int, s string, n long")
        totals = partial.groupBy("p", "e", "i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
        books = [b.copy() for b in books]
        for r in totals.collect():
            books[r.p][r.e, r.i] = int(r.s) // r.n
    return books


def trees_of(books: list[np.ndarray]) -> list:
    """For each part a function from its rows to (entry, squared distance, distances taken)."""

    def searcher(book: np.ndarray):
        most = max((abs(x) for x in book.ravel()), default=0)
        exact = Gnat(book)
        small = Gnat(book.astype(np.int64)) if (2 * most + 2) ** 2 * max(book.shape[1], 1) < 1 << 62 else None

        def nearest(rows: np.ndarray):
            # Integers of both sides are small in every sane table; the other way is slow and as exact.
            if small is not None and rows.dtype != object:
                return small.nearest(rows)
            return exact.nearest(rows.astype(object))

        return nearest

    return [searcher(b) for b in books]


def encode(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code, error of every row of ``usable`` vectors.

    ``code`` has two hex digits per part, ``error`` is the squared distance to the entries. A vector of another length
    than the codebooks has neither. An error beyond a long counts as the greatest long.
    """
    width = sum(b.shape[1] for b in books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = trees_of(books)
        for part, fits, rows in blocks(batches, 2, width):
            codes = np.zeros((len(fits), len(books)), np.uint8)
            error = np.zeros(len(fits), object)
            for p, (own, tree) in enumerate(zip(cut(rows, len(books)), trees)):
                code, away, _ = tree(own)
                codes[:, p] = code
                error = error + away
            code, off = [None] * part.num_rows, [None] * part.num_rows
            for at, c, e in zip(fits.tolist(), codes, error.tolist()):
                code[at], off[at] = c.tobytes().hex(), min(int(e), LONG)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(code, pa.string()), pa.array(off, pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    kinds = {c: vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    return vectors.select("vec_id", "label", "embedding").mapInArrow(
        run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    )


def decode(encoded: DataFrame, books: list[np.ndarray], scale: int = SCALE) -> DataFrame:
    """``encoded`` with ``approximation``, the vector of its code's entries; NULL where there is no code."""
    values = F.array(*[F.array(*[F.array(*[F.lit(float(x) / scale) for x in e]) for e in b]) for b in books])
    digits = F.sequence(F.lit(0), F.lit(len(books) - 1))
    entry = lambda p: F.conv(F.substr("code", 2 * p + 1, F.lit(2)), 16, 10).cast("int")
    return encoded.withColumn(
        "approximation", F.when(F.col("code").isNotNull(), F.flatten(F.transform(digits, lambda p: values[p][entry(p)])))
    )


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' integers by part, entry and position, with commas between."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def with_label_error(encoded: DataFrame) -> DataFrame:
    """``encoded`` (a written table) with the sum of its errors over equal labels, NULLs together.

    Hot labels are fewer than HOT_SHARE, so their sums are broadcast and their rows stay where they are;
    the rows of all others meet their sums by a shuffle.
    """
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("long")
    sums = materialise(
        encoded.groupBy("label").agg(total.alias("label_error"), F.count("*").alias("n")).withColumnRenamed("label", "of"),
        "label-errors",
    )
    rows = encoded.count()
    hot = F.broadcast(sums.where(F.col("n") * HOT_SHARE > rows).drop("n"))
    same = F.col("label").eqNullSafe(F.col("of"))
    busy = encoded.join(hot, same).drop("of")
    calm = encoded.join(hot.select("of"), same, "left_anti").join(
        sums.where(F.col("n") * HOT_SHARE <= rows).drop("n"), same
    ).drop("of")
    return busy.unionByName(calm)


def compress(embeddings: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row with a usable vector.

    A NULL vector, and one with a NULL or non-finite component, is left out. An empty vector is kept: it has only
    empty parts, all at distance zero. Repeated rows stay repeated, a NULL ``vec_id`` comes after all others. Components
    count as at most 2**63 in size. Further columns are left out.
    """
    kept = usable(embeddings.select("vec_id", "label", "embedding"))
    books = fit(kept)
    if not books:
        kind = embeddings.schema["vec_id"].dataType.simpleString()
        return embeddings.sparkSession.createDataFrame(
            [], f"vec_id {kind}, code string, error long, label_error long, codebooks_sha256 string"
        )
    encoded = materialise(encode(kept, books), "codes")
    return with_label_error(encoded).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
