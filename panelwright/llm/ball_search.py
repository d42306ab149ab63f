"""Ranked lexical search: exact largest inner products by sparse ball trees.

A document is a sparse vector of whole numbers, one a term; a query is its terms' weights, so a score is their
inner product.  Documents are dealt to trees of bounded size.  A node of a tree is a ball: a centre (the
mean of its documents, rounded to whole numbers) and the largest squared distance of a document to that centre, both
exact in 64-bit integers.  No document in a ball scores more than

    query . centre + |query| * radius,

whose square root is rounded upwards.  A query opens the nodes of a tree by falling bound and ends when the bound is
below its k-th score so far, which it keeps from tree to tree; leaves are scored in integers.  Documents that tie with
the k-th score are only left out if no id in their ball is smaller, so the ranking is exact.

Coordinates of terms that no query of the block uses add nothing to a score, yet would widen every ball, so the
vectors leave them out.  Queries come in blocks of `QUERIES`, which bounds what is broadcast; every block meets
every document.

Terms are maximal runs of ASCII letters (A to Z lower-cased), digits and characters beyond ASCII.  Null and empty texts
have none: such documents are not counted, such queries have no results.  Rows that repeat an id are separate
documents or queries.  Ids are integers; rows without one rank behind equal scores with one.  An empty table
of documents or queries gives no results.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import cut, numbered

K = 10
#: Queries in a block, documents in a leaf, and coordinates in a tree, about.
QUERIES, LEAF, TREE = 256, 64, 1 << 19
#: Stands for an absent id: it ranks last.
_NO_ID = 2**63 - 1
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_BYTES).split()


def weight(df: int, n: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def vectors(docs: DataFrame, id: str, text: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document with terms: id, n (its terms with repeats), and numbers (ascending) and counts of those in the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # the terms of one block of queries

    def counted(parts):
        known = shared.value
        for batch in parts:
            ids, sizes, numbers, counts = [], [], [], []
            for i, t in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                words = terms(t.as_py() or b"")
                if words:
                    found = sorted((known[w], c) for w, c in Counter(filter(known.__contains__, words)).items())
                    ids.append(_NO_ID if i is None else i)
                    sizes.append(len(words))
                    numbers.append([x for x, _ in found])
                    counts.append([c for _, c in found])
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
            columns = [pa.array(c, t) for c, t in zip((ids, sizes, numbers, counts), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "numbers", "counts"])

    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(counted, "id long, n long, numbers array<int>, counts array<long>")


class Rows:
    """Sparse vectors, one after the other."""

    def __init__(self, ids: np.ndarray, ptr: np.ndarray, at: np.ndarray, values: np.ndarray):
        self.ids, self.ptr, self.at, self.values = ids, ptr, at, values

    def of(self, rows: np.ndarray) -> Rows:
        sizes = np.diff(self.ptr)[rows]
        ptr = np.append(0, np.cumsum(sizes))
        places = np.repeat(self.ptr[rows] - ptr[:-1], sizes) + np.arange(ptr[-1])
        return Rows(self.ids[rows], ptr, self.at[places], self.values[places])

    def dot(self, dense: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.values * dense[self.at], self.ptr[:-1])  # no row is empty


NODES = ("first", "upto", "left", "right", "least_id", "radius2", "centre_ptr", "centre_at", "centre_values")


def ball_tree(rows: Rows, width: int) -> tuple[Rows, dict[str, np.ndarray]]:
    """The rows in the order of the leaves, and the nodes; the root is node 0, leaves have no left child (-1)."""
    norms = np.add.reduceat(rows.values * rows.values, rows.ptr[:-1])
    order = np.arange(len(rows.ids))
    nodes: dict[str, list] = {name: [] for name in NODES[:6]}
    centres = []
    open_nodes = [(0, len(order), -1, "")]
    while open_nodes:
        first, upto, parent, side = open_nodes.pop()
        own = rows.of(order[first:upto])
        own_norms = norms[order[first:upto]]
        number = len(centres)
        if parent >= 0:
            nodes[side][parent] = number
        mean = np.rint(np.bincount(own.at, own.values, width) / (upto - first)).astype(np.int64)
        distance = own_norms - 2 * own.dot(mean) + mean @ mean
        for name, value in zip(NODES, (first, upto, -1, -1, int(own.ids.min()), int(distance.max())), strict=False):
            nodes[name].append(value)
        support = np.flatnonzero(mean)
        centres.append((support, mean[support]))
        if upto - first <= LEAF or not distance.max():
            continue
        one = _row(own, int(distance.argmax()), width)
        to_one = own_norms - 2 * own.dot(one) + one @ one
        two = _row(own, int(to_one.argmax()), width)
        nearer = to_one - (own_norms - 2 * own.dot(two) + two @ two)  # below 0: nearer to the first pivot
        by = np.argsort(nearer, kind="stable")
        split = int((nearer <= 0).sum())
        if min(split, len(by) - split) * 8 < len(by):  # far-off rows alone would make a tree of any depth
            split = len(by) // 2
        order[first:upto] = order[first:upto][by]
        open_nodes += [(first, first + split, number, "left"), (first + split, upto, number, "right")]
    out = {name: np.array(v, np.int64) for name, v in nodes.items()}
    out["centre_ptr"] = np.append(0, np.cumsum([len(s) for s, _ in centres]))
    out["centre_at"] = np.concatenate([s for s, _ in centres])
    out["centre_values"] = np.concatenate([v for _, v in centres])
    return rows.of(order), out


def _row(rows: Rows, k: int, width: int) -> np.ndarray:
    out = np.zeros(width, np.int64)
    span = slice(rows.ptr[k], rows.ptr[k + 1])
    out[rows.at[span]] = rows.values[span]
    return out


TREES = "ids array<long>, ptr array<long>, at array<int>, values array<long>, " + ", ".join(f"{name} array<long>" for name in NODES)


def trees(counted: DataFrame, documents: int, total: int, width: int) -> DataFrame:
    """The index: a row per tree, of the vectors of all documents that hold a term of the vocabulary.

    documents, total: how many documents have terms, and how many terms those are with repeats.
    """

    def built(parts):
        held: list[tuple] = []
        size = 0
        for batch in parts:
            for row in zip(*(batch.column(c).to_pylist() for c in ("id", "n", "numbers", "counts")), strict=True):
                if row[2]:
                    held.append(row)
                    size += len(row[2])
                if size >= TREE:
                    yield _tree_row(held, documents, total, width)
                    held, size = [], 0
        if held:
            yield _tree_row(held, documents, total, width)

    return counted.mapInArrow(built, TREES)


def _tree_row(held: list[tuple], documents: int, total: int, width: int) -> pa.RecordBatch:
    sizes = np.array([len(r[2]) for r in held])
    # whole numbers of any size: the product may pass 64 bits
    lengths = np.repeat(np.array([100 - 90 + 90 * r[1] * documents // total for r in held], np.int64), sizes)
    tf = np.concatenate([r[3] for r in held]).astype(np.int64)
    values = 1_000_000_000 * tf // (1000 * tf + 8 * lengths)
    rows = Rows(np.array([r[0] for r in held], np.int64), np.append(0, np.cumsum(sizes)), np.concatenate([r[2] for r in held]).astype(np.int32), values)
    rows, nodes = ball_tree(rows, width)
    columns = {"ids": rows.ids, "ptr": rows.ptr, "at": rows.at, "values": rows.values, **nodes}
    return pa.RecordBatch.from_arrays([pa.array([c], pa.list_(pa.from_numpy_dtype(c.dtype))) for c in columns.values()], names=list(columns))


class Best:
    """The k best (score, id) that a query has met."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def closed_to(self, bound: int, least_id: int) -> bool:
        """Whether no document with such a bound and such ids can enter."""
        if bound <= 0:
            return True
        if len(self.scores) < self.k:
            return False
        return bound < self.scores[-1] or (bound == self.scores[-1] and least_id > self.ids[-1])

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        use = scores >= max(1, int(self.scores[-1]) if len(self.scores) == self.k else 1)
        if use.any():
            scores, ids = np.append(self.scores, scores[use]), np.append(self.ids, ids[use])
            by = np.lexsort((ids, -scores))[: self.k]
            self.scores, self.ids = scores[by], ids[by]


def search(rows: Rows, nodes: dict[str, np.ndarray], query: np.ndarray, norm2: int, best: Best) -> int:
    """Let the query (dense weights, |query|^2) meet the documents of one tree; returns how many were scored."""
    ptr, at, values = nodes["centre_ptr"], nodes["centre_at"], nodes["centre_values"]

    def bound(node: int) -> int:
        span = slice(ptr[node], ptr[node + 1])
        return int((query[at[span]] * values[span]).sum()) + math.isqrt(norm2 * int(nodes["radius2"][node])) + 1

    scored = 0
    heap = [(-bound(0), 0)]
    while heap:
        top, node = heapq.heappop(heap)
        if best.closed_to(-top, int(nodes["least_id"][node])):
            continue
        left = int(nodes["left"][node])
        if left >= 0:
            for child in (left, int(nodes["right"][node])):
                heapq.heappush(heap, (max(top, -bound(child)), child))
            continue
        first, upto = int(nodes["first"][node]), int(nodes["upto"][node])
        a, b = rows.ptr[first], rows.ptr[upto]
        scores = np.add.reduceat(rows.values[a:b] * query[rows.at[a:b]], rows.ptr[first:upto] - a)
        best.take(scores, rows.ids[first:upto])
        scored += upto - first
    return scored


def best_of_trees(index: DataFrame, queries: list[tuple[int, np.ndarray, np.ndarray]], width: int, k: int) -> DataFrame:
    """(query, id, score): the k best of every query (number, terms, weights) among the documents of each task."""
    shared = index.sparkSession.sparkContext.broadcast(queries)  # one block

    def met(parts):
        best = {number: Best(k) for number, _, _ in shared.value}
        dense = np.zeros(width, np.int64)
        for batch in parts:
            for i in range(batch.num_rows):
                column = lambda c: batch.column(c)[i].values.to_numpy(zero_copy_only=False)  # noqa: B023, E731
                rows = Rows(*map(column, ("ids", "ptr", "at", "values")))
                nodes = {name: column(name) for name in NODES}
                for number, terms_of, weights in shared.value:
                    dense[terms_of] = weights
                    search(rows, nodes, dense, int(weights @ weights), best[number])
                    dense[terms_of] = 0
        numbers = np.repeat(list(best), [len(b.ids) for b in best.values()]).astype(np.int64)
        found = [np.concatenate([x, *parts_of]) for x, parts_of in ((np.zeros(0, np.int64), [b.ids for b in best.values()]), (np.zeros(0, np.int64), [b.scores for b in best.values()]))]
        yield pa.RecordBatch.from_arrays([pa.array(numbers), *map(pa.array, found)], names=["query", "id", "score"])

    return index.mapInArrow(met, "query long, id long, score long")


def ranked(docs: DataFrame, queries: DataFrame, id: str = "doc_id", text: str = "text", query_id: str = "item_id", query_text: str = "text", k: int = K) -> DataFrame:
    """Per query its k highest-scoring documents with a score above 0: query_id, rank (from 1), id, score.

    N counts the documents with terms, L all their terms with repeats, df the documents with a term.  A term weighs
    floor(1000 ln((2 N + 2) / (2 df + 1))); a document of n terms scores weight * ((10^9 tf) div (1000 tf + 8 m))
    a term, m = 10 + (90 n N) div L.  Equal scores rank by ascending id.
    """
    numbered_queries, n_queries = numbered(queries.select(F.col(query_id).alias("query_id"), F.col(query_text).cast("binary").alias("_text")), "query_id", "_text", name="query")
    found = None
    for block in range(max(1, -(-n_queries // QUERIES))):
        of_block = F.col("query").between(block * QUERIES, (block + 1) * QUERIES - 1)
        asked = [(r["query"], sorted(set(terms(bytes(r["_text"] or b""))))) for r in numbered_queries.where(of_block).select("query", "_text").collect()]
        words = sorted(set().union(*(t for _, t in asked)))
        vocabulary = {w: k for k, w in enumerate(words)}
        counted = cut(vectors(docs, id, text, vocabulary))
        n, total = counted.agg(F.count("*"), F.sum("n")).first()  # one row
        df = dict(counted.select(F.explode("numbers").alias("at")).groupBy("at").count().collect())  # one block's terms
        weights = np.array([weight(df.get(at, 0), n) for at in range(len(words))], np.int64)
        number_of = [np.array([vocabulary[w] for w in t], np.int64) for _, t in asked]
        block_queries = [(q, at, weights[at]) for (q, _), at in zip(asked, number_of, strict=True) if len(at)]
        index = cut(trees(counted, n, total or 1, len(words)))
        part = best_of_trees(index, block_queries, max(1, len(words)), k)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.join(numbered_queries.drop("_text"), "query").select(
        F.col("query_id").alias(query_id), "rank", F.when(F.col("id") != _NO_ID, F.col("id")).alias(id), "score"
    )
