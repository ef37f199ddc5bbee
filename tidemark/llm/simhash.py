"""SimHash near duplicates: fingerprints, vantage-point trees for all pairs within a few bits, components.

1. One Arrow pass gives every whole text its 64-bit fingerprint.
2. The distinct fingerprints are cut into shards by the top of a vantage-point tree, which is grown on
   a bounded sample and is all that the tasks are sent. A fingerprint has one home shard; where a ball
   of the radius around it crosses a boundary, the inner side also visits the outer one.
3. Each shard is searched with a vantage-point tree of its own. Branches that the triangle inequality
   excludes are not entered. The shard's links are reduced to a spanning forest, so that a group of
   many alike fingerprints gives as many edges as members, never its pairs.
4. Components of the forests give the classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.batches import map_batches, pointed, runs_of, spanning
from tidemark.llm.columns import apart
from tidemark.llm.components import components
from tidemark.session import materialise

SEED = 42
#: Fingerprints on which the top of the tree is grown; a fixed bound, drawn by hash.
SAMPLE = 1 << 15
#: Fingerprints that a shard is aimed at; the number of shards grows with the table.
SHARD = 4096
#: The top of the tree ends where its sample does; beyond that the shards grow.
TOP_DEPTH = 12
LEAF = 24
#: Entries of a search frontier that are worked on at once.
FRONTIER = 1 << 19


def shingle_hashes(text: str | None, size: int = 3) -> np.ndarray:
    """XXH64 of every shingle (repeats included) of the text in lower-case ASCII; one for a short text."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-size]]).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(line[a:b], SEED) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist())), np.uint64, len(words) - size + 1
    )


def fingerprint(text: str | None) -> int:
    """Signed 64-bit form of the fingerprint; a bit is 1 if it is set in over half the hashes."""
    hashes = shingle_hashes(text)
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp long) of every row."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        made = pa.array([fingerprint(x.as_py()) for x in part.column(1)], pa.int64())
        return pa.RecordBatch.from_arrays([part.column(0), made], ["doc_id", "fp"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, fp long")


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


class Tree:
    """A vantage-point tree over fingerprints, its nodes in arrays; node i has children 2i+1 (inner) and 2i+2."""

    def __init__(self, points: np.ndarray, depth: int) -> None:
        self.depth = depth
        self.vantage = np.zeros((1 << depth) - 1, np.uint64)
        self.radius = np.zeros((1 << depth) - 1, np.int16)
        held = [points]
        for node in range(len(self.vantage)):
            own = held[node]
            if len(own):
                # A point far from the first one: distances from it spread, as they do from any outlier.
                self.vantage[node] = own[int(distance(own, own[0]).argmax())]
                d = distance(own, self.vantage[node])
                self.radius[node] = np.median(d)
                held += [own[d <= self.radius[node]], own[d > self.radius[node]]]
            else:
                held += [own, own]
            held[node] = own[:0]

    def home(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (distance(points, self.vantage[node]) > self.radius[node])
        return node - len(self.vantage)

    def routes(self, points: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which point, leaf, visiting): every leaf a point belongs to or has to be searched in.

        Of two points that part at a node, the inner one visits the outer side; as a visitor it takes
        every branch that the triangle inequality leaves open.
        """
        which = np.arange(len(points))
        node, visiting = np.zeros(len(points), np.int64), np.zeros(len(points), bool)
        for _ in range(self.depth):
            d, r = distance(points[which], self.vantage[node]), self.radius[node]
            inner, outer = d <= r, d > r
            also_out = inner & (d + reach > r)
            also_in = outer & visiting & (d - reach <= r)
            which = np.concatenate([which, which[also_out], which[also_in]])
            node = np.concatenate([2 * node + 1 + outer, 2 * node[also_out] + 2, 2 * node[also_in] + 1])
            visiting = np.concatenate([visiting, np.ones(also_out.sum() + also_in.sum(), bool)])
        return which, node - len(self.vantage), visiting


def linked(home: np.ndarray, guests: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (u, v) of all links home-home and guest-home of one shard."""
    everyone = np.concatenate([home, guests])
    parent = np.arange(len(everyone))
    depth = max(0, int(np.ceil(np.log2(max(len(home), 1) / LEAF))))
    tree = Tree(home, depth)
    leaf_of = tree.home(home)
    order = np.argsort(leaf_of, kind="stable")
    first = np.searchsorted(leaf_of[order], np.arange((1 << depth) + 1))
    count = np.diff(first)
    for at in range(0, len(everyone), FRONTIER // 64):
        asked = everyone[at : at + FRONTIER // 64]
        which, leaf = search(tree, asked, reach)
        for cut in range(0, len(which), FRONTIER // 8):
            w, low = which[cut : cut + FRONTIER // 8], leaf[cut : cut + FRONTIER // 8]
            # Members of the leaves side by side, in blocks; a leaf of alike points may be large.
            done = np.zeros(len(w), np.int64)
            live = np.flatnonzero(count[low])
            while len(live):
                take = np.minimum(count[low[live]] - done[live], 4 * LEAF)
                rep = np.repeat(live, take)
                step = np.arange(len(rep)) - np.repeat(np.cumsum(take) - take, take)
                member = order[first[low[rep]] + done[rep] + step]
                near = (distance(asked[w[rep]], home[member]) <= reach) & (w[rep] + at != member)
                if near.any():
                    parent = spanning(parent, w[rep][near] + at, member[near])
                done[live] += take
                live = live[done[live] < count[low[live]]]
    top = pointed(parent)
    moved = np.flatnonzero(top != np.arange(len(top)))
    return everyone[moved], everyone[top[moved]]


def search(tree: Tree, asked: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(which query, leaf) for all leaves that can hold a point within reach."""
    which, node = np.arange(len(asked)), np.zeros(len(asked), np.int64)
    for _ in range(tree.depth):
        d, r = distance(asked[which], tree.vantage[node]), tree.radius[node]
        inner, outer = d - reach <= r, d + reach > r
        node = np.concatenate([2 * node[inner] + 1, 2 * node[outer] + 2])
        which = np.concatenate([which[inner], which[outer]])
    return which, node - len(tree.vantage)


def links(distinct: DataFrame, reach: int) -> DataFrame:
    """(u, v) whose components are those of all fingerprints within ``reach`` bits of each other."""
    total = distinct.count()
    depth = min(TOP_DEPTH, max(0, int(np.ceil(np.log2(max(total, 1) / SHARD)))))
    drawn = [r[0] for r in distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()]
    top = Tree(np.array(drawn, np.int64).view(np.uint64), depth)

    def route(part: pa.RecordBatch) -> pa.RecordBatch:
        points = part.column(0).to_numpy()
        which, leaf, visiting = top.routes(points.view(np.uint64), reach)
        return pa.RecordBatch.from_arrays(
            [pa.array(leaf), pa.array(visiting), pa.array(points[which])], ["shard", "visiting", "fp"]
        )

    def search_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs_of(batches):
            fp = rows.column("fp").to_numpy().view(np.uint64)
            guest = rows.column("visiting").to_numpy()
            u, v = linked(fp[~guest], fp[guest], reach)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    routed = map_batches(distinct, route, "shard long, visiting boolean, fp long")
    dealt = routed.repartition(1 << depth, "shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(search_shards, "u long, v long")


def near_duplicates(docs: DataFrame, reach: int = 2) -> DataFrame:
    """Every row of ``docs`` with ``fingerprint`` (16 hex digits), ``component_id`` and ``fp`` beside its ``doc_id``.

    Rows whose fingerprints differ in at most ``reach`` bits are linked; ``component_id`` is the least
    ``doc_id`` reachable. NULL and empty texts have fingerprint zero and are linked like any other.
    A NULL ``doc_id`` is never the least one unless a class has no other. Repeated rows stay repeated.
    """
    marked = materialise(fingerprints(docs), "fingerprints")
    own = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    classes = components(materialise(links(own.select("fp"), reach), "links"))
    placed = own.join(classes.withColumnRenamed("u", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    class_of = placed.join(named, "root").select("fp", "component_id")
    return marked.join(class_of, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "fp"
    )


def representatives(docs: DataFrame, reach: int = 2) -> DataFrame:
    """One document of each class, the one with the least ``doc_id``; columns as in ``docs``.

    A row with a NULL ``doc_id`` stays only if its class has no other; of repeated rows with that
    ``doc_id`` all stay. Other columns may have any name.
    """
    given = apart(docs, "doc_id", "text")
    found = near_duplicates(given, reach)
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    kept = found.where(first).select(F.col("doc_id").alias("__kept")).distinct()
    return given.join(kept, F.col("doc_id").eqNullSafe(F.col("__kept")), "left_semi").toDF(*docs.columns)
