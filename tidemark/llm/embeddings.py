"""Embedding near duplicates: every pair of a label that can reach the least cosine is compared.

1. Equal vectors of one label become one class. Vectors that can link with nothing are set aside.
2. Centres are fitted on a bounded sample. The home of a class is its nearest centre, within its label.
3. A class also goes, as a guest, to each centre whose home vectors it can be linked with: those lie beyond the plane
   halfway between both centres, and a vector further from that plane than the least cosine allows reaches none.
   Of two centres only one takes guests of the other, so that each pair is compared once.
4. A home with too many classes is split into parts by hash; its guests go to all of them.
5. The home vectors of a part are held and its guests stream past. Products are in single precision; what is too near
   to the least cosine to be told so is decided in double precision.
6. Parts give counts and spanning forests, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.batches import pointed, runs_of, spanning
from tidemark.llm.components import components
from tidemark.session import materialise

LEAST_COSINE = 0.93
#: Centres of the largest label while its homes are small, and the size from which on homes do not grow further: more
#: centres mean more copies of guests, fewer mean fewer tasks.
SPREAD = 8
LEAST_SHARD, MOST_SHARD = 1024, 32768
#: Components that the home vectors of one part are aimed at, at most.
MOST_VALUES = 1 << 21
#: Vectors on which the centres are fitted.
SAMPLE = 16384
MOST_CENTRES = 4096
#: Rows that are compared with a part, or with the centres, at once.
BLOCK = 256
#: Classes that are held against all rows of their label by the audit.
AUDIT = 256
#: Pairs that are merged at once.
MOST_PAIRS = 1 << 20


def unit(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled by the largest component first, so that no square overflows."""
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.linalg.norm(wide, axis=1, keepdims=True)


def classes(embeddings: DataFrame) -> DataFrame:
    """(cid, label, size, vec_id, vector): one row per label and vector, ``vec_id`` the least; linkable ones only."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists("embedding", lambda x: x != 0)
    good = embeddings.where(F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(finite & some)
    # -0.0 and 0.0 are the same component.
    plain = good.select("vec_id", "label", F.transform("embedding", lambda x: x + F.lit(0.0).cast("float")).alias("vector"))
    return plain.groupBy("label", "vector").agg(F.count("*").alias("size"), F.min("vec_id").alias("vec_id")).select(
        F.xxhash64("label", "vector").alias("cid"), "label", "size", "vec_id", "vector"
    )


def centres_of(sample: np.ndarray, count: int) -> np.ndarray:
    """Directions of ``count`` clusters of unit vectors, after a few rounds of spherical k-means."""
    centres = sample[np.linspace(0, len(sample) - 1, count).astype(int)].copy()
    for _ in range(6):
        nearest = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.maximum(length, 1e-12), centres)
    return centres


def vectors_in(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def home_size(most: int, dim: int) -> int:
    """Classes that a home is aimed at, where the largest label has ``most``."""
    return max(min(max(LEAST_SHARD, -(-most // SPREAD)), MOST_SHARD, MOST_VALUES // dim), 1)


def takes(centre: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether ``centre`` takes guests of ``other``; it holds for one of two, and for about half of all others."""
    return (centre != other) & ((centre < other) == ((centre + other) % 2 == 0))


def reached(vectors: np.ndarray, centres: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The home of each vector, and which centres have home vectors that it can be linked with.

    A home vector y of c has y.(c_h - c) <= 0. If x is at the sine s above that plane, its cosine with y is at most
    the root of 1 - s * s.
    """
    close = vectors @ centres.T
    home = close.argmax(axis=1)
    gap = close[np.arange(len(home)), home][:, None] - close
    own, which = np.unique(home, return_inverse=True)
    squares = np.einsum("id,id->i", centres, centres)
    apart = np.sqrt(np.maximum(squares[own][:, None] + squares - 2 * centres[own] @ centres.T, 0))
    sine = 1.0 if least <= 0 else float(np.sqrt(max(1 - least * least, 0)))
    # The second term covers single precision, also that of the homes of others and of the distances.
    return home, gap <= sine * apart[which] + 1e-3


def assigned(table: DataFrame, least: float) -> DataFrame:
    """(label, dim, centre, part, guest, cid, size, vector): a row for each part that a class has to be compared in.

    The sample and the homes that are split come to the driver: at most one of the latter for each ``home_size`` classes.
    """
    keyed = table.withColumn("dim", F.size("vector"))
    sizes = keyed.groupBy("dim", "label").count().groupBy("dim").agg(F.max("count").alias("most")).collect()
    fitted: dict[int, np.ndarray] = {}
    aim: dict[int, int] = {}
    for dim, most in sorted(tuple(r) for r in sizes):
        own = keyed.where(F.col("dim") == dim).orderBy(F.xxhash64("cid"), "cid").limit(SAMPLE).select("vector")
        sample = unit(np.array([r[0] for r in own.collect()], np.float64))
        aim[dim] = home_size(most, dim)
        fitted[dim] = centres_of(sample, min(MOST_CENTRES, len(sample), -(-most // aim[dim]))).astype(np.float32)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table, np.ndarray]]:
        for batch in batches:
            for rows in runs_of(iter([batch]), 0):
                for at in range(0, len(rows), BLOCK):
                    some = rows.slice(at, BLOCK).combine_chunks()
                    yield rows.column(0)[0].as_py(), some, unit(vectors_in(some.column("vector"))).astype(np.float32)

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, rows, vectors in blocks(batches):
            home = (vectors @ fitted[dim].T).argmax(axis=1)
            yield from pa.table({"label": rows["label"], "dim": rows["dim"], "centre": pa.array(home, pa.int32())}).to_batches()

    # Labels of any type are keyed by their hash.
    plain = keyed.select("dim", F.xxhash64("label").alias("label"), "cid", "size", "vector")
    counted: dict[tuple[int, int], list[tuple[int, int]]] = {}
    if any(len(x) > 1 for x in fitted.values()):
        at_least = F.create_map(*(F.lit(x) for pair in aim.items() for x in pair))[F.col("dim")]
        crowded = plain.mapInArrow(homes, "label long, dim int, centre int").groupBy("label", "dim", "centre").count()
        for label, dim, centre, count in crowded.where(F.col("count") > 2 * at_least).collect():
            counted.setdefault((label, dim), []).append((centre, -(-count // aim[dim])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, rows, vectors in blocks(batches):
            home, near = reached(vectors, fitted[dim], least)
            label, cid = rows["label"].to_numpy(), rows["cid"].to_numpy()
            many = np.ones((len(rows), len(fitted[dim])), np.int64)
            for name in np.unique(label).tolist():
                for centre, count in counted.get((name, dim), ()):
                    many[label == name, centre] = count
            line = np.arange(len(rows))
            part = cid % many[line, home]
            near &= takes(np.arange(near.shape[1])[None, :], home[:, None])
            # The other parts of its own home are visited like those of another centre.
            near[line, home] = many[line, home] > 1
            row, centre = np.nonzero(near)
            times = many[row, centre]
            first = np.cumsum(times) - times
            row, centre, to = np.repeat(row, times), np.repeat(centre, times), np.arange(times.sum()) - np.repeat(first, times)
            wanted = (centre != home[row]) | takes(to, part[row])
            row, centre, to = row[wanted], centre[wanted], to[wanted]
            row, centre, to = np.concatenate([line, row]), np.concatenate([home, centre]), np.concatenate([part, to])
            for at in range(0, len(row), 8192):
                cut = slice(at, at + 8192)
                taken = rows.take(pa.array(row[cut]))
                guest = np.arange(at, at + len(taken)) >= len(line)
                yield from pa.table({
                    "label": taken["label"], "dim": taken["dim"], "centre": pa.array(centre[cut], pa.int32()),
                    "part": pa.array(to[cut], pa.int32()), "guest": pa.array(guest), "cid": taken["cid"],
                    "size": taken["size"], "vector": taken["vector"],
                }).combine_chunks().to_batches()

    kind = table.schema["vector"].dataType.simpleString()
    return plain.mapInArrow(
        run, f"label long, dim int, centre int, part int, guest boolean, cid long, size long, vector {kind}"
    )


def weighed(linked: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rows that each row of ``linked`` is linked with, where column i stands for size[i] of them."""
    many = np.flatnonzero(size > 1)
    return np.count_nonzero(linked, axis=1) + (linked[:, many] * (size[many] - 1)).sum(axis=1, dtype=np.int64)


class Part:
    """The home vectors of one part, their counts, and the forest of what they were linked by."""

    def __init__(self, batches: list[pa.RecordBatch], least: float) -> None:
        rows = pa.Table.from_batches(batches)
        self.least, self.cid, self.size = least, rows["cid"].to_numpy(), rows["size"].to_numpy()
        self.exact = unit(vectors_in(rows["vector"]))
        self.vectors = self.exact.astype(np.float32)
        self.count, self.parent = np.zeros(len(rows), np.int64), np.arange(len(rows))
        self.doubt = 1e-6 + self.vectors.shape[1] * 2.0**-23
        for at in range(0, len(rows), BLOCK):
            line = np.arange(at, min(at + BLOCK, len(rows)))
            linked = self.linked(self.exact[line], self.vectors[line])
            if linked is not None:
                linked[line - at, line] = False
                self.count[line] += weighed(linked, self.size)
                self.merge(linked)
                first = linked.argmax(axis=1)
                some = linked[line - at, first]
                self.parent = spanning(self.parent, line[some], first[some])

    def linked(self, exact: np.ndarray, vectors: np.ndarray) -> np.ndarray | None:
        """Which home vectors each of the given ones is linked with; None if there is no pair."""
        close = vectors @ self.vectors.T
        linked = close >= self.least - self.doubt
        if not linked.any():
            return None
        a, b = np.nonzero(linked & (close < self.least + self.doubt))
        for at in range(0, len(a), BLOCK * BLOCK):
            x, y = a[at : at + BLOCK * BLOCK], b[at : at + BLOCK * BLOCK]
            linked[x, y] = np.einsum("id,id->i", exact[x], self.exact[y]) >= self.least
        return linked

    def merge(self, linked: np.ndarray) -> None:
        """Home vectors that one vector is linked with belong together."""
        first = linked.argmax(axis=1)
        while True:
            apart = linked & (self.parent[None, :] != self.parent[first][:, None])
            each = np.count_nonzero(apart, axis=1)
            if not each.any():
                return
            if each.sum() <= MOST_PAIRS:
                a, b = np.nonzero(apart)
                self.parent = spanning(self.parent, first[a], b)
                return
            most = int(each.argmax())
            b = np.flatnonzero(apart[most])
            self.parent = spanning(self.parent, np.full(len(b), first[most]), b)

    def visited(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, rows.num_rows, BLOCK):
            some = pa.Table.from_batches([rows.slice(at, BLOCK)])
            exact = unit(vectors_in(some["vector"]))
            linked = self.linked(exact, exact.astype(np.float32))
            if linked is None:
                continue
            cid, size = some["cid"].to_numpy(), some["size"].to_numpy()
            self.merge(linked)
            self.count += weighed(linked.T, size)
            first = linked.argmax(axis=1)
            met = linked[np.arange(len(cid)), first]
            yield found_rows(cid[met], self.cid[first[met]], np.zeros(met.sum(), np.int64))
            yield found_rows(cid[met], None, weighed(linked, self.size)[met])

    def finish(self) -> Iterator[pa.RecordBatch]:
        top, counted = pointed(self.parent), np.flatnonzero(self.count)
        moved = np.flatnonzero(top != np.arange(len(top)))
        yield found_rows(self.cid[moved], self.cid[top[moved]], np.zeros(len(moved), np.int64))
        yield found_rows(self.cid[counted], None, self.count[counted])


def found_rows(u: np.ndarray, v: np.ndarray | None, n: np.ndarray) -> pa.RecordBatch:
    """(u, v, n): v NULL with n linked rows of u, or an edge u-v with n 0."""
    other = pa.nulls(len(u), pa.int64()) if v is None else pa.array(v, pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), other, pa.array(n, pa.int64())], ["u", "v", "n"])


def searched(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Counts and forests of the parts in ``batches(block, guest, cid, size, vector)``, sorted by block and guest."""
    held: list[pa.RecordBatch] = []
    part, key = None, None
    for batch in batches:
        block, guest = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((block[1:] != block[:-1]) | (guest[1:] != guest[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)]):
            if a == b:
                continue
            if key != block[a]:
                if held or part:
                    yield from (part or Part(held, least)).finish()
                held, part, key = [], None, block[a]
            if not guest[a]:
                held.append(batch.slice(a, b - a))
            elif held or part:  # guests of a home without classes meet nothing
                if part is None:
                    part, held = Part(held, least), []
                yield from part.visited(batch.slice(a, b - a))
    if held or part:
        yield from (part or Part(held, least)).finish()


def near_duplicates(embeddings: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``embeddings(vec_id, embedding, label)``.

    Rows of one label whose vectors have a cosine of ``least`` or more are linked. A NULL label, a NULL or empty
    vector, and one that is zero or has a NULL or non-finite component link with nothing. Vectors of
    different lengths are never linked. Equal vectors are linked without search. A NULL ``vec_id`` is no
    component's least unless it has no other. Further columns are left out. Labels are of any type that can be
    grouped by, components of any floating type.
    """
    known = materialise(classes(embeddings), "classes")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from searched(batches, least)

    members = assigned(known, least).select(
        F.xxhash64("label", "dim", "centre", "part").alias("block"), "guest", "cid", "size", "vector"
    )
    dealt = members.repartition("block").sortWithinPartitions("block", "guest")
    found = materialise(dealt.mapInArrow(search, "u long, v long, n long"), "found")
    counts = found.groupBy(F.col("u").alias("cid")).agg(F.sum("n").alias("others"))
    roots = components(found.where("v IS NOT NULL").select("u", "v")).withColumnRenamed("u", "cid")
    placed = known.drop("vector").join(counts, "cid", "left").join(roots, "cid", "left").withColumn(
        "root", F.coalesce("root", "cid")
    )
    named = placed.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    of_class = placed.join(named, "root").select(
        "cid", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"
    )
    plain = F.transform("embedding", lambda x: x + F.lit(0.0).cast("float"))
    given = embeddings.select("vec_id", F.when(F.col("label").isNotNull(), F.xxhash64("label", plain)).alias("cid"))
    out = given.join(of_class, "cid", "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def audit(embeddings: DataFrame, links: DataFrame, least: float = LEAST_COSINE, queries: int = AUDIT) -> DataFrame:
    """label, n_queries, wanted, found, recall of ``links(vec_id, n_links)``, as ``near_duplicates`` gives them.

    Query vectors are the ``queries`` classes with the least hash of their vector. They come to the driver and are held
    in double precision against all rows of their label, without centres. ``vec_id`` is unique.
    """
    known = materialise(classes(embeddings), "classes")
    known = known.withColumn("key", F.xxhash64("label"))
    asked = known.where("vec_id IS NOT NULL").orderBy(F.xxhash64("cid"), "cid").limit(queries).collect()
    groups: dict[tuple[int, int], list] = {}
    for r in asked:
        groups.setdefault((r.key, len(r.vector)), []).append(r)
    of = {k: (np.array([r.vec_id for r in v]), unit(np.array([r.vector for r in v], np.float64))) for k, v in groups.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, dim = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for (name, length), (vec_id, vectors) in of.items():
                rows = pa.Table.from_batches([batch.filter(pa.array((key == name) & (dim == length)))])
                if len(rows):
                    n = (vectors @ unit(vectors_in(rows["vector"])).T >= least) @ rows["size"].to_numpy()
                    given = [pa.array([name] * len(n), pa.int64()), pa.array(vec_id, pa.int64()), pa.array(n, pa.int64())]
                    yield pa.RecordBatch.from_arrays(given, ["key", "vec_id", "n"])

    rows = known.select("key", F.size("vector").alias("dim"), "size", "vector")
    summed = rows.mapInArrow(run, "key long, vec_id long, n long").groupBy("key", "vec_id").agg((F.sum("n") - 1).alias("n"))
    wanted = summed.join(known.select("label", "key").distinct(), "key")
    met = wanted.join(links.select("vec_id", "n_links"), "vec_id", "left")
    sums = met.groupBy("label").agg(
        F.count("*").alias("n_queries"), F.sum("n").alias("wanted"),
        F.sum(F.least("n", F.coalesce("n_links", F.lit(0)))).alias("found"),
    )
    recall = F.when(F.col("wanted") > 0, F.col("found") / F.col("wanted")).otherwise(F.lit(1.0))
    return sums.withColumn("recall", recall)
