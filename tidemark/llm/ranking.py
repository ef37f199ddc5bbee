"""Exact ranked lexical search: sparse ball trees over the documents, searched best-first by inner product.

A score is the inner product of a document's vector (what each of its terms is worth there) and an item's
vector (the weights of its terms), both integers. Only terms of the items can count, so documents are
projected onto those, which changes no score.

1. Items are dealt into blocks of a bounded number of terms; the steps below run for each block.
2. One Arrow pass tells every whole text's length and how often it holds each of the block's terms. The
   counts are written once; the corpus' sums and the terms' document frequencies are aggregates of them.
3. Each task cuts its documents into chunks of bounded size and grows a ball tree over each: a node has the
   centroid of its documents and a radius. By Cauchy-Schwarz no document below a node scores more than
   q.centroid + |q| * radius; all roundings go up, so a subtree is only left out if none of it can enter.
4. An item enters the node with the highest bound first and stops at the first bound below its k-th score.
   Documents of a leaf are scored exactly in 64-bit integers.
5. The k-th scores of a hashed sample of the documents are floors to start from. They only save work: every
   document, those of the sample too, is in a tree and reached unless a bound rules it out.

Nothing is shuffled but each task's best k of every item.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.batches import map_batches, parts
from tidemark.session import materialise

TOP = 50
#: Distinct terms that a block of items is aimed at; an item with more of them is not cut.
BLOCK_TERMS = 1 << 14
#: A chunk is closed at so many documents or values.
CHUNK_ROWS = 1 << 13
CHUNK_VALUES = 1 << 21
LEAF = 64
#: Documents that the floors are taken from; a number, not a share.
FLOOR_ROWS = 1 << 14
#: Relative room for the roundings of sums of doubles: over 2**20 addends of 2**-53 each.
ROOM = 1e-9

#: Bytes as they count: A-Z lower-cased, digits, a-z and all bytes of characters above ASCII stay, the rest separates.
FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c > 0x7F else 0x20 for c in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """All terms of a whole text, in order; ``bytes.split`` cuts at ASCII white space only."""
    return text.encode().translate(FOLD).split() if text else []


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, times) of the documents with at least one term; ``terms`` are numbers of the vocabulary."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        row, length, ends, terms, times = [], [], [0], [], []
        get = vocabulary.get
        for at, text in enumerate(part.column(1)):
            words = terms_of(text.as_py())
            if words:
                held = Counter(map(get, words))
                held.pop(None, None)
                terms += held.keys()
                times += held.values()
                row.append(at)
                length.append(len(words))
                ends.append(len(terms))
        cuts = pa.array(ends, pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                part.column(0).take(pa.array(row, pa.int64())), pa.array(length, pa.int64()),
                pa.ListArray.from_arrays(cuts, pa.array(terms, pa.int32())),
                pa.ListArray.from_arrays(cuts, pa.array(times, pa.int64())),
            ],
            ["doc_id", "n", "terms", "times"],
        )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(slim, run, "doc_id long, n long, terms array<int>, times array<long>")


def weight(n_docs: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding + 1)))


def worth(n: np.ndarray, times: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What ``times`` occurrences of a term are worth in a document of ``n`` terms."""
    if len(n) and 50 * int(n.max()) * n_docs >= 1 << 63:
        raise OverflowError("the lengths of the documents are beyond 64-bit arithmetic")
    m = 100 - 50 + (50 * n * n_docs) // n_terms
    return (1_000_000_000 * times) // (1000 * times + 20 * m)


class Rows:
    """Sparse rows: ``term`` and ``value`` of row i are at ``ptr[i]:ptr[i + 1]``; no row is empty."""

    def __init__(self, ptr: np.ndarray, term: np.ndarray, value: np.ndarray) -> None:
        self.ptr, self.term, self.value = ptr, term, value

    def __len__(self) -> int:
        return len(self.ptr) - 1

    def take(self, rows: np.ndarray) -> Rows:
        size = self.ptr[rows + 1] - self.ptr[rows]
        ptr = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(ptr[-1]) + np.repeat(self.ptr[rows] - ptr[:-1], size)
        return Rows(ptr, self.term[at], self.value[at])

    def dot(self, dense: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.value * dense[self.term], self.ptr[:-1])


class BallTree:
    """Nodes with centroid, radius and a range of rows; children come after their parent.

    ``order`` tells which given row stands at each place of ``rows``.
    """

    def __init__(self, given: Rows, width: int, leaf: int = LEAF) -> None:
        square = np.add.reduceat(given.value.astype(np.float64) ** 2, given.ptr[:-1])
        order = np.arange(len(given))
        self.low, self.high, self.left, self.right, self.parent = [0], [len(given)], [-1], [-1], [-1]
        centroids, radii = [], []
        node = 0
        while node < len(self.low):
            low, high = self.low[node], self.high[node]
            own = order[low:high]
            rows, squares = given.take(own), square[own]
            centroid = np.bincount(rows.term, rows.value, minlength=width) / len(own)
            length = centroid @ centroid
            away = squares - 2 * rows.dot(centroid) + length
            # The three terms may cancel; what they can be wrong by goes into the radius.
            radius = np.sqrt(max(away.max(), 0) + ROOM * (squares.max() + length)) * (1 + ROOM)
            centroids.append(centroid)
            radii.append(radius)
            if high - low > leaf:
                far = int(away.argmax())
                from_far = self.apart(rows, squares, far)
                other = int(from_far.argmax())
                lean = from_far - self.apart(rows, squares, other)
                left = lean <= 0
                if not len(own) / 8 <= left.sum() <= len(own) * 7 / 8:
                    # Copies, or one outlier: halves by the same measure.
                    left = np.zeros(len(own), bool)
                    left[np.argsort(lean, kind="stable")[: len(own) // 2]] = True
                middle = low + int(left.sum())
                order[low:high] = np.concatenate([own[left], own[~left]])
                for start, end, side in ((low, middle, self.left), (middle, high, self.right)):
                    side[node] = len(self.low)
                    self.low.append(start)
                    self.high.append(end)
                    self.left.append(-1)
                    self.right.append(-1)
                    self.parent.append(node)
            node += 1
        self.order, self.rows = order, given.take(order)
        self.centroids, self.radii = np.array(centroids), np.array(radii)

    @staticmethod
    def apart(rows: Rows, squares: np.ndarray, one: int) -> np.ndarray:
        """Squared distances from one row."""
        at = slice(rows.ptr[one], rows.ptr[one + 1])
        dense = np.zeros(int(rows.term.max()) + 1)
        dense[rows.term[at]] = rows.value[at]
        return squares - 2 * rows.dot(dense) + squares[one]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """(node, query): no row below the node has a greater inner product with the query.

        A query's length is taken over the terms that the node's rows have; the rest meets nothing there.
        """
        wide = queries.astype(np.float64).T
        length = np.sqrt((self.centroids > 0).astype(np.float64) @ (wide * wide))
        most = (self.centroids @ wide + length * self.radii[:, None]) * (1 + ROOM) + 1
        for node, up in enumerate(self.parent[1:], 1):
            np.minimum(most[node], most[up], out=most[node])
        return most

    def leaf_scores(self, node: int, query: np.ndarray) -> np.ndarray:
        ptr = self.rows.ptr[self.low[node] : self.high[node] + 1]
        at = slice(ptr[0], ptr[-1])
        return np.add.reduceat(self.rows.value[at] * query[self.rows.term[at]], ptr[:-1] - ptr[0])


class Best:
    """The best k of each item so far: score descending, then doc_id ascending, NULL last."""

    def __init__(self, floors: np.ndarray, k: int) -> None:
        self.floor, self.k = floors.copy(), k
        none = np.empty(0, np.int64)
        self.held = [(none, none, np.empty(0, bool)) for _ in floors]

    def add(self, item: int, score: np.ndarray, doc_id: np.ndarray, missing: np.ndarray) -> None:
        score, doc_id, missing = (np.concatenate(x) for x in zip(self.held[item], (score, doc_id, missing)))
        if len(score) > self.k:
            first = np.lexsort((doc_id, missing, -score))[: self.k]
            score, doc_id, missing = score[first], doc_id[first], missing[first]
        if len(score) == self.k:
            self.floor[item] = max(self.floor[item], score.min())
        self.held[item] = score, doc_id, missing

    def search(self, tree: BallTree, queries: np.ndarray, doc_id: np.ndarray, missing: np.ndarray) -> int:
        """Best-first over one tree for every item; gives the number of leaves that were scored."""
        most = tree.bounds(queries)
        visited = 0
        for item in np.flatnonzero(most[0] >= self.floor).tolist():
            heap = [(-most[0, item], 0)]
            while heap:
                bound, node = heapq.heappop(heap)
                if -bound < self.floor[item]:
                    break
                if tree.left[node] >= 0:
                    for child in (tree.left[node], tree.right[node]):
                        if most[child, item] >= self.floor[item]:
                            heapq.heappush(heap, (-most[child, item], child))
                    continue
                visited += 1
                score = tree.leaf_scores(node, queries[item])
                good = np.flatnonzero(score >= self.floor[item])
                if len(good):
                    at = tree.order[good + tree.low[node]]
                    self.add(item, score[good], doc_id[at], missing[at])
        return visited

    def rows(self) -> pa.RecordBatch:
        sizes = [len(x[0]) for x in self.held]
        score, doc_id, missing = (np.concatenate(x) if x else np.empty(0) for x in zip(*self.held)) if sizes else [np.empty(0)] * 3
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(sizes)), sizes), pa.int32()),
                pa.array(doc_id.astype(np.int64), pa.int64(), mask=missing.astype(bool)), pa.array(score.astype(np.int64), pa.int64()),
            ],
            ["item", "doc_id", "score"],
        )


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of a partition in tables of at most CHUNK_ROWS documents and, but for the last one, CHUNK_VALUES values."""
    held, rows, values = [], 0, 0
    for batch in batches:
        for part in parts(iter([batch])):
            for start in range(0, part.num_rows, CHUNK_ROWS):
                some = part.slice(start, CHUNK_ROWS)
                if held and rows + some.num_rows > CHUNK_ROWS:
                    yield pa.Table.from_batches(held)
                    held, rows, values = [], 0, 0
                held.append(some)
                rows += some.num_rows
                values += len(some.column("terms").flatten())
                if values >= CHUNK_VALUES:
                    yield pa.Table.from_batches(held)
                    held, rows, values = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def block_search(
    vectors: DataFrame, items: list[np.ndarray], weights: np.ndarray, floors: np.ndarray, n_docs: int, n_terms: int, k: int
) -> DataFrame:
    """(item, doc_id, score): each task's best k of every item, none below the item's floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(floors, k)
        for chunk in chunks(batches):
            chunk = chunk.combine_chunks()
            sizes = chunk["terms"].combine_chunks().value_lengths().to_numpy()
            term = chunk["terms"].combine_chunks().flatten().to_numpy()
            times = chunk["times"].combine_chunks().flatten().to_numpy()
            value = worth(np.repeat(chunk["n"].to_numpy(), sizes), times, n_docs, n_terms)
            here, term = np.unique(term, return_inverse=True)
            queries = np.zeros((len(items), len(here)), np.int64)
            for at, wanted in enumerate(items):
                column = np.searchsorted(here, wanted)
                known = column < len(here)
                known[known] = here[column[known]] == wanted[known]
                queries[at, column[known]] = weights[wanted[known]]
            tree = BallTree(Rows(np.concatenate([[0], np.cumsum(sizes)]), term, value), len(here))
            ids = chunk["doc_id"].combine_chunks()
            best.search(tree, queries, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))
        yield best.rows()

    return vectors.where(F.size("terms") > 0).mapInArrow(run, "item int, doc_id long, score long")


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item with a score above 0.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are not looked at. A NULL or empty text
    has no terms: such a document is no one's result and counts for nothing, such an item has no result.
    Equal scores go by ``doc_id``, NULL last. Every row of ``docs`` is a document, also if its ``doc_id`` comes
    twice. Equal rows of ``items`` are one item; rows that share an ``item_id`` alone are ranked each for itself.

    The texts of the items come to the driver block by block; what a block holds does not grow with ``docs``.
    """
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    asked = items.select("item_id", "text").where(F.length("text") > 0).distinct()
    size = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-size // (4 * BLOCK_TERMS)))
    dealt = materialise(asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(count))), "items")
    results = []
    for block in range(count):
        own = dealt.where(F.col("block") == block).orderBy("item_id", "text").collect()
        words = [sorted(set(terms_of(r.text))) for r in own]
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*words)))}
        if not vocabulary:
            continue
        wanted = [np.array([vocabulary[t] for t in w], np.int64) for w in words]
        vectors = materialise(counted(docs, vocabulary), "vectors")
        n_docs, n_terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        holding = np.zeros(len(vocabulary), np.int64)
        for term, holders in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            holding[term] = holders
        weights = np.array([weight(n_docs, int(x)) for x in holding], np.int64)
        floors = np.ones(len(own), np.int64)
        if n_docs > 2 * FLOOR_ROWS:
            some = vectors.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(n_docs // FLOOR_ROWS)) == 0)
            first = ranked(block_search(some, wanted, weights, floors, n_docs, n_terms, k), k)
            for item, score in first.where(F.col("rank") == k).select("item", "score").collect():
                floors[item] = score
        best = ranked(block_search(vectors, wanted, weights, floors, n_docs, n_terms, k), k)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(own)], f"item int, item_id {kind}")
        results.append(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not results:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, results)
