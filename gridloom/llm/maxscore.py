"""Exact top-k search by inner product with MaxScore, over shards.

Components of a vector are terms and their values weights; a shard holds the postings of each term and the largest and
smallest weight in them. For a query, terms are ordered by how much they can add to a score at most. The last ones, which
together cannot lift a candidate above the k-th best score so far, are non-essential: only the postings of the others
are traversed, and what they leave short of the score is dropped; for those still competitive the non-essential terms
are probed, a few at a time, as long as they can make it. The shards' results are merged. Scores are exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import groups_of

#: Queries and candidates in one piece of work; bounds the memory of a task.
QUERIES, CANDIDATES = 1024, 8192
#: Postings are traversed this many candidates at a time, and non-essential terms probed this many at a time.
STRIDE, PROBE = 2048, 8


class Shard:
    """Postings of ``vectors``, one row per candidate, in order of ``ids``; a term's postings are a row, with zero for a
    candidate that lacks it."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.postings = np.ascontiguousarray(vectors[order].T)
        self.blocks = [slice(i, min(i + STRIDE, len(ids))) for i in range(0, len(ids), STRIDE)]
        self.most = np.array([self.postings[:, b].max(1) for b in self.blocks])
        self.least = np.array([self.postings[:, b].min(1) for b in self.blocks])

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best candidates other than ``query_id`` itself: ids and scores, best first, ties to smaller ids."""
        best_ids, best = np.zeros(0, np.int64), np.zeros(0, query.dtype)
        own = np.searchsorted(self.ids, query_id, "left"), np.searchsorted(self.ids, query_id, "right")
        for n, block in enumerate(self.blocks):
            bounds = np.maximum(np.maximum(query * self.most[n], query * self.least[n]), 0)
            order = np.argsort(-bounds, kind="stable")
            # What the terms from each place on can add.
            rest = np.r_[np.cumsum(bounds[order][::-1])[::-1], 0]
            full = len(best) == k
            bar = best[-1] if full else None
            # Candidates come in order of id, so one that only equals the k-th best loses to it.
            essential = int(np.argmax(rest <= bar)) if full and (rest <= bar).any() else len(order)
            terms = order[:essential]
            score = query[terms] @ self.postings[terms, block] if essential else np.zeros(block.stop - block.start, query.dtype)
            alive = np.arange(block.start, block.stop)
            if full:
                keep = score + rest[essential] > bar
                alive, score = alive[keep], score[keep]
            at = essential
            while at < len(order) and len(alive):
                terms = order[at : at + PROBE]
                score = score + query[terms] @ self.postings[np.ix_(terms, alive)]
                at += len(terms)
                keep = score + rest[min(at, len(order))] > bar
                alive, score = alive[keep], score[keep]
            other = (alive < own[0]) | (alive >= own[1])
            alive, score = alive[other], score[other]
            if len(alive):
                ids, scores = np.r_[best_ids, self.ids[alive]], np.r_[best, score]
                top = np.lexsort((ids, -scores))[:k]
                best_ids, best = ids[top], scores[top]
        return best_ids, best


def usable(vector: Column) -> Column:
    """Whether ``vector`` is there and all its components are finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(vector, finite), F.lit(False))


def quantised(vector: Column, scale: int = 64) -> Column:
    """Components as integers, ``floor(scale * x)``."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def dense(column: pa.ChunkedArray) -> np.ndarray:
    """Lists as rows of a matrix, short ones filled with zeros."""
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), int(sizes.max(initial=0))), np.int64)
    out[np.repeat(np.arange(len(lists)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy()
    return out


def fitting(queries: np.ndarray, vectors: np.ndarray) -> type:
    """Floating point where all sums stay exact in it, as it is faster; else integers."""
    reach = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(vectors.shape[1], 1)
    return np.float64 if reach < 2.0**52 else np.int64


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each of ``queries(id, vector)`` the ``k`` candidates of largest inner
    product, all if there are fewer, ties to the smaller id, ranks from 1. Vectors are arrays of integers.

    A candidate with the query's id is left out. Null ids or vectors take no part; nor does a query without
    candidates. A vector shorter than another counts as zero beyond its end. Repeated rows are candidates each; repeated
    queries count once. Sums must stay within 64 bits. Other columns are ignored.

    Every query must meet every candidate's shard: queries and candidates are dealt into blocks by a hash of their id,
    each pair of blocks is a piece of work of bounded size, and only the k best of a piece leave it.
    """
    queries = queries.select("id", "vector").where("id IS NOT NULL AND vector IS NOT NULL").distinct()
    candidates = candidates.select("id", "vector").where("id IS NOT NULL AND vector IS NOT NULL")
    n_queries, n_candidates = queries.count(), candidates.count()
    q_blocks, c_blocks = max(1, -(-n_queries // QUERIES)), max(1, -(-n_candidates // CANDIDATES))
    block = lambda n: F.pmod(F.xxhash64("id"), F.lit(n))
    piece = lambda q, c: (q * c_blocks + c).alias("piece")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = queries.withColumns({"q": block(q_blocks), "c": every(c_blocks)}).select(piece(F.col("q"), F.col("c")), F.lit(True).alias("is_query"), "id", "vector")
    held = candidates.withColumns({"c": block(c_blocks), "q": every(q_blocks)}).select(piece(F.col("q"), F.col("c")), F.lit(False).alias("is_query"), "id", "vector")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, "piece"):
            is_query = group.column("is_query").to_numpy()
            ids, vectors = group.column("id").to_numpy(), dense(group.column("vector"))
            if not is_query.any() or is_query.all():
                continue
            kind = fitting(vectors[is_query], vectors[~is_query])
            found, shard = [], Shard(ids[~is_query], vectors[~is_query].astype(kind))
            for query_id, query in zip(ids[is_query], vectors[is_query].astype(kind), strict=True):
                found.append((query_id, *shard.search(query_id, query, k)))
            sizes = [len(x[1]) for x in found]
            columns = np.repeat([x[0] for x in found], sizes), np.concatenate([x[1] for x in found]), np.concatenate([x[2] for x in found])
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["query_id", "vec_id", "score"])

    n = max(int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    pieces = asked.union(held).repartition(n, "piece").sortWithinPartitions("piece")
    found = pieces.mapInArrow(work, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
