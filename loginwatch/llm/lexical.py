"""Ranked lexical search: exact inner products, found through ball trees of sparse vectors."""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush, heapreplace
from math import ceil, log, sqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loginwatch.llm.common import stored
from loginwatch.llm.decontamination import words_of

TOP = 50
#: Documents of a leaf and of a tree, and entries of a tree from which a new one begins.
LEAF, TREE, ENTRIES = 64, 4096, 2_000_000
#: (item, term) pairs that are searched together; more pairs, more passes over documents.
BLOCK = 1 << 16
#: Documents of the first round, and how much each later round grows.
FIRST, GROWTH = 16_384, 16
#: What a bound in doubles may be too small by: a share, and a number.
SLACK, STEP = 1e-9, 1.0
#: Sums up to this are exact as doubles.
EXACT = 1 << 53
_NO_ID = 1 << 63

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# --------------------------------------------------------------------------- ball trees

class Vectors(NamedTuple):
    """Sparse rows: entries of row i are at ``start[i]:start[i + 1]``, terms ascending."""
    ids: list
    start: np.ndarray
    terms: np.ndarray
    values: np.ndarray


class BallTree:
    """A binary tree of balls over sparse vectors of whole numbers.

    Every node has a centre and a radius that holds all its vectors. A node is split at
    the two vectors found by going to the farthest one twice; what lies nearer to either
    goes there. Leaves have at most ``LEAF`` vectors, or vectors that are all alike are cut
    in the order given. Node 0 is the root.
    """

    def __init__(self, vectors: Vectors, leaf: int = LEAF):
        self.ids = vectors.ids
        self.leaf_size = leaf
        # Terms that occur here, as columns.
        self.columns, columns = np.unique(vectors.terms, return_inverse=True)
        self.width = len(self.columns)
        self._cols, self._vals, self._start = columns, vectors.values, vectors.start
        self._float = vectors.values.astype(np.float64)
        self._norms = self._rowsums(np.arange(len(self.ids)), self._float**2)
        self.centres, self.radii, self.children, self.members = [], [], [], []
        self._grow(np.arange(len(self.ids)))
        self.centres, self.radii = np.array(self.centres), np.array(self.radii)
        self._leaves()

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the entries of some rows, and where each row begins among them."""
        sizes = self._start[rows + 1] - self._start[rows]
        at = np.concatenate([[0], np.cumsum(sizes)])
        return np.repeat(self._start[rows] - at[:-1], sizes) + np.arange(at[-1]), at

    def _rowsums(self, rows: np.ndarray, values: np.ndarray) -> np.ndarray:
        places, at = self._entries(rows)
        sums = np.concatenate([[0.0], np.cumsum(values[places])])
        return sums[at[1:]] - sums[at[:-1]]

    def _distances(self, rows: np.ndarray, point: np.ndarray) -> np.ndarray:
        """Squared distances of rows to a dense point, entry by entry: what a row has none of
        counts in full, and differences are taken before squaring."""
        places, at = self._entries(rows)
        cols = self._cols[places]
        square = point * point
        apart = (self._float[places] - point[cols]) ** 2 - square[cols]
        total = np.add.reduceat(np.append(apart, 0.0), at[:-1])
        total[at[1:] == at[:-1]] = 0.0
        return np.maximum(total + square.sum(), 0.0)

    def _dense(self, row: int) -> np.ndarray:
        point = np.zeros(self.width)
        part = slice(self._start[row], self._start[row + 1])
        point[self._cols[part]] = self._float[part]
        return point

    def _grow(self, rows: np.ndarray) -> int:
        node = len(self.radii)
        places, _ = self._entries(rows)
        centre = np.bincount(self._cols[places], self._float[places], self.width) / max(1, len(rows))
        far = self._distances(rows, centre)
        # Squared distances are differences of sums: what these may have lost is added.
        lost = (centre @ centre + self._norms[rows].max(initial=0)) * SLACK
        self.centres.append(centre)
        self.radii.append(sqrt(far.max(initial=0) + lost))
        self.children.append(())
        self.members.append(rows)
        if len(rows) > self.leaf_size:
            one = self._distances(rows, self._dense(rows[far.argmax()]))
            two = self._distances(rows, self._dense(rows[one.argmax()]))
            left = one < two
            if not 0 < left.sum() < len(rows):
                left = np.arange(len(rows)) < len(rows) // 2
            self.members[node] = None
            self.children[node] = (self._grow(rows[left]), self._grow(rows[~left]))
        return node

    def _leaves(self) -> None:
        """Entries by leaf and column, and for every leaf where its columns begin."""
        self.leaf = {}
        places, owners, leaves = [], [], []
        for node, rows in enumerate(self.members):
            if rows is not None:
                found, at = self._entries(rows)
                places.append(found)
                owners.append(np.repeat(np.arange(len(rows)), np.diff(at)))
                leaves.append(np.full(len(found), len(self.leaf)))
                self.leaf[node] = len(self.leaf)
        places, owners, leaves = map(np.concatenate, (places, owners, leaves))
        key = leaves * self.width + self._cols[places]
        order = np.argsort(key, kind="stable")
        self.owner, self.value = owners[order], self._vals[places][order]
        counts = np.bincount(key, minlength=len(self.leaf) * self.width)
        self.offset = np.concatenate([[0], np.cumsum(counts)])
        self._small = int(self._float.max(initial=0)) * max(1, self.width) < EXACT

    def bounds(self, columns: np.ndarray) -> np.ndarray:
        """No vector below a node has a larger sum over ``columns`` than its bound.

        The sum is an inner product with a query of ones, so it is at most that of the
        centre plus the radius times the query's length, made larger by what doubles lose.
        """
        plain = self.centres[:, columns].sum(axis=1) + sqrt(len(columns)) * self.radii
        return plain * (1 + SLACK) + STEP

    def scores(self, node: int, columns: np.ndarray) -> np.ndarray:
        """Exact sums of the vectors of a leaf over ``columns``."""
        first = self.leaf[node] * self.width + columns
        start, size = self.offset[first], self.offset[first + 1] - self.offset[first]
        at = np.cumsum(size)
        places = np.repeat(start - at + size, size) + np.arange(at[-1])
        rows = len(self.members[node])
        if self._small:
            return np.bincount(self.owner[places], self.value[places], rows).astype(np.int64)
        total = np.zeros(rows, np.int64)
        np.add.at(total, self.owner[places], self.value[places])
        return total

    def search(self, terms: np.ndarray, best: Best) -> int:
        """Offers ``best`` all that may be among the highest, best subtree first; returns
        how many vectors were scored."""
        at = np.searchsorted(self.columns, terms)
        columns = at[np.append(self.columns, -1)[at] == terms]
        if not len(columns):
            return 0
        bounds = self.bounds(columns)
        open_nodes, scored = [(-bounds[0], 0)], 0
        while open_nodes:
            bound, node = heappop(open_nodes)
            if -bound < best.least:
                break
            if self.children[node]:
                for child in self.children[node]:
                    if bounds[child] >= best.least:
                        heappush(open_nodes, (-bounds[child], child))
                continue
            found = self.scores(node, columns)
            scored += len(found)
            for k in np.flatnonzero(found >= max(best.least, 1)):
                best.offer(int(found[k]), self.ids[self.members[node][k]])
        return scored


class Best:
    """The highest scores offered, equal ones by ascending id, null ids last.

    ``least``: a score below it is of no use. Given by an earlier round at first: the last
    of the ``top`` found so far, whose score and id must be beaten.
    """

    def __init__(self, top: int, least: tuple[int, int] | None = None):
        self.top, self.heap, self.given = top, [], least
        self.least = least[0] if least else 1

    def offer(self, score: int, doc_id: int | None) -> None:
        entry = (score, -(_NO_ID if doc_id is None else doc_id))
        if self.given and entry <= self.given:
            return
        if len(self.heap) < self.top:
            heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapreplace(self.heap, entry)
        if len(self.heap) == self.top:
            self.least = max(self.least, self.heap[0][0])


# ------------------------------------------------------------------------- Spark stages

def item_terms(items: DataFrame) -> DataFrame:
    """``item_id`` and ``term``: the distinct terms of an item, of all rows with its id."""
    found = F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(_TERM), F.lit(0))
    return items.select("item_id", F.explode(found).alias("term")).distinct()


def _vectors(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id``, ``n`` (all terms), and the terms of the vocabulary with their counts."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            n, terms, counts, keep = [], [], [], []
            for i, text in enumerate(batch.column("text")):
                words = words_of(text.as_py())
                if words:
                    ids, times = np.unique([known[w] for w in words if w in known], return_counts=True)
                    keep.append(i)
                    n.append(len(words))
                    terms.append(ids.astype(np.int32))
                    counts.append(times.astype(np.int64))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()),
                pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64())),
            ], ["doc_id", "n", "terms", "counts"])

    rows = documents.selectExpr("bigint(doc_id) AS doc_id", "text").where("text IS NOT NULL")
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>")


class Search(NamedTuple):
    """What the tasks need of a block of items; bounded by ``BLOCK``."""
    items: list[np.ndarray]
    weights: np.ndarray
    documents: int
    length: int
    least: list[tuple[int, int] | None]
    top: int


def _scaled(batches: Iterator[pa.RecordBatch], how: Search) -> Iterator[Vectors]:
    """The vectors of a tree each, with the weights of their terms in them."""
    ids, parts, size = [], [], 0

    def tree() -> Vectors:
        n, lengths, terms, counts = (np.concatenate(x) for x in zip(*parts))
        mean = 50 + (50 * n * how.documents) // how.length
        times = counts.astype(np.int64)
        values = how.weights[terms] * ((1_000_000_000 * times) // (1000 * times + 20 * np.repeat(mean, lengths)))
        return Vectors(ids, np.concatenate([[0], np.cumsum(lengths)]), terms, values)

    for batch in batches:
        for at in range(0, batch.num_rows, TREE // 4):
            part = batch.slice(at, TREE // 4)
            terms, counts = part.column("terms"), part.column("counts")
            ids += part.column("doc_id").to_pylist()
            parts.append((
                part.column("n").to_numpy(), np.diff(terms.offsets.to_numpy()).astype(np.int64),
                terms.flatten().to_numpy(), counts.flatten().to_numpy(),
            ))
            size += len(parts[-1][2])
            if len(ids) >= TREE or size >= ENTRIES:
                yield tree()
                ids, parts, size = [], [], 0
    if ids:
        yield tree()


def _round(vectors: DataFrame, how: Search) -> DataFrame:
    """The best documents of each task for every item of the block."""
    shared = vectors.sparkSession.sparkContext.broadcast(how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        how = shared.value
        best = [Best(how.top, least) for least in how.least]
        for rows in _scaled(batches, how):
            tree = BallTree(rows)
            for terms, own in zip(how.items, best):
                tree.search(terms, own)
        found = [(i, s, None if -x == _NO_ID else -x) for i, own in enumerate(best) for s, x in own.heap]
        item, score, doc_id = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array(score, pa.int64()), pa.array(doc_id, pa.int64())], ["item", "score", "doc_id"]
        )

    return vectors.where("size(terms) > 0").mapInArrow(run, "item int, score long, doc_id long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _shares(documents: int, first: int = FIRST) -> list[float]:
    """Ends of the rounds as shares of all documents; the last is 1."""
    rounds = max(0, ceil(log(max(1, documents) / first, GROWTH)))
    return [float(GROWTH) ** -k for k in range(rounds, -1, -1)]


def _block(documents: DataFrame, pairs: DataFrame, top: int, first: int) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score`` of a block of items."""
    spark = documents.sparkSession
    by_item: dict = {}
    vocabulary: dict[bytes, int] = {}
    for item_id, term in pairs.toLocalIterator():
        by_item.setdefault(item_id, []).append(vocabulary.setdefault(term.encode(), len(vocabulary)))
    vectors = stored(_vectors(documents, vocabulary), "term_vectors")
    total = vectors.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    # One row for each term of the block, at most.
    weight = F.floor(F.lit(1000) * F.log((2 * F.lit(total["n"]) + 2) / (2 * F.col("df") + 1)))
    held = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = np.zeros(max(1, len(vocabulary)), np.int64)
    for term, w in held.select("term", weight).toLocalIterator():
        weights[term] = w
    items = [np.sort(np.array(t, np.int32)) for t in by_item.values()]
    how = Search(items, weights, total["n"], max(1, total["terms"]), [None] * len(items), top)
    # Rounds over growing shares of the documents, each told what it has to beat.
    place = F.expr(f"pmod(xxhash64(doc_id), {1 << 30}L) / {float(1 << 30)}D")
    best, start = None, 0.0
    for end in _shares(total["n"], first):
        found = _round(vectors.where((place >= start) & (place < end)), how)
        best = stored(_ranked(found if best is None else found.unionByName(best.drop("rank")), top), "best_documents")
        if end < 1:
            least = list(how.least)
            for row in best.where(F.col("rank") == top).toLocalIterator():
                least[row["item"]] = (row["score"], -(_NO_ID if row["doc_id"] is None else row["doc_id"]))
            how, start = how._replace(least=least), end
    names = spark.createDataFrame(
        [(i, item_id) for i, item_id in enumerate(by_item)], f"item int, item_id {pairs.schema['item_id'].dataType.simpleString()}"
    )
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")


def ranked_documents(
    documents: DataFrame, items: DataFrame, top: int = TOP, block: int = BLOCK, first: int = FIRST
) -> DataFrame:
    """The result of the query: the ``top`` documents of each item with a score above 0.

    ``documents`` has ``doc_id`` and ``text``, ``items`` has ``item_id`` and ``text``; other
    columns are not looked at. Every row of ``documents`` is a document, repeated rows and
    null ids (last among equal scores) included; rows of one ``item_id`` are one item, and
    a null id is one too. Null texts and texts without a term have no part in it; without
    documents or items there are no rows.

    Items are the query set. They are taken in blocks of some ``block`` (item, term) pairs,
    so that what is broadcast is bounded; each block reads the documents once, keeps the
    counts of its own terms, and searches those. Tasks build one ball tree after the other
    from what they read, so documents are not shuffled, and hold the best of each item.
    Rounds over a sixteenth, then the next sixteenth of the documents (by a hash of the
    id) give later ones a score to beat, so that few rows reach the merge.
    """
    pairs = stored(item_terms(items), "item_terms")
    blocks = max(1, ceil(pairs.count() / block))
    placed = pairs.withColumn("_block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    done = None
    for k in range(blocks):
        part = _block(documents, placed.where(F.col("_block") == k).drop("_block"), top, first)
        done = part if done is None else done.unionByName(part)
    return done
