"""Exact top-k inner products with MaxScore over an inverted index of vector components.

A component x becomes floor(256 x).  A term is a dimension with a sign, and its posting list holds the rows whose value
has that sign, with the value.  For a query, only lists of its own sign can add to a score; the others subtract,
and are probed last.  Lists are taken by falling score bound (query weight times the largest value).  While the rest of
the bounds could still lift an unseen row to the k-th best score, the list is *essential* and is traversed; after
that, the remaining lists are only probed, a few at a time, for rows that are still competitive.  Rows are indexed in shards; every
shard answers every block of queries and the k best of all shards are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wharfline.session import cut

SHARD_ROWS, BLOCK_QUERIES, FEW = 4096, 1024, 256
PROBED = 8  # lists that are probed between two looks at the bounds
EXACT = 1 << 53  # whole numbers that doubles hold
LONG = 8  # a list of more than a row in so many is long


class Shard:
    """Posting lists of some rows: dense columns, and by dimension the rows with a positive and a negative value."""

    def __init__(self, ids: np.ndarray, rows: list[np.ndarray]):
        order = np.argsort(ids, kind="stable")  # ties go to the smaller id: rows are in that order
        self.ids = ids[order]
        width = max((len(r) for r in rows), default=0)
        self.columns = np.zeros((width, len(ids)), dtype=np.int64)
        for k, r in enumerate(order):
            self.columns[: len(rows[r]), k] = rows[r]
        self.largest = int(np.abs(self.columns).max(initial=0))
        # values of one sign, with zeros for the other: a posting list that holds many rows is read as such a column
        self.parts = np.stack((np.maximum(self.columns, 0), np.minimum(self.columns, 0)))
        self.doubles = self.columns.astype(np.float64), self.parts.astype(np.float64)
        self.postings = [[self._posting(c > 0), self._posting(c < 0)] for c in self.columns]
        self.most = [(int(c.max(initial=0)), int(-c.min(initial=0))) for c in self.columns]

    @staticmethod
    def _posting(held: np.ndarray) -> np.ndarray:
        """Rows of a list, or for a long one a mark for each row."""
        rows = np.flatnonzero(held)
        return held if len(rows) * LONG >= len(held) else rows

    def search(self, query: np.ndarray, own: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows other than ``own`` (by score, then id)."""
        n = len(self.ids)
        dims = np.flatnonzero(query[: len(self.columns)])
        bound = np.array([abs(int(query[d])) * self.most[d][int(query[d] < 0)] for d in dims], dtype=np.int64)
        dims = dims[np.argsort(-bound, kind="stable")]
        bound = np.sort(bound)[::-1]
        rest = np.concatenate((np.cumsum(bound[::-1])[::-1], [0]))  # what lists from here on can add
        largest = int(np.abs(query).max(initial=0))
        exact = largest * self.largest * max(1, len(dims)) < EXACT
        weights, (columns, parts) = (query.astype(np.float64), self.doubles) if exact else (query, (self.columns, self.parts))
        side = (query < 0).astype(np.int64)
        partial, term = np.zeros(n, dtype=columns.dtype), np.empty(n, dtype=columns.dtype)
        seen = np.zeros(n, dtype=bool)
        threshold = self._seed(query, own, k)
        at = 0
        while at < len(dims) and rest[at] >= threshold and not seen.all():
            d = dims[at]
            rows = self.postings[d][side[d]]
            if rows.dtype == bool:
                np.multiply(parts[side[d], d], weights[d], out=term)
                partial += term
                seen |= rows
            else:
                partial[rows] += weights[d] * parts[side[d], d, rows]
                seen[rows] = True
            at += 1
        if rest[at] >= threshold and at == len(dims):
            seen[:] = True  # a score of zero or less may be among the best
        live = np.flatnonzero(seen if at == len(dims) or rest[at] < threshold else np.ones(n, dtype=bool))
        # probes: what the traversed dimensions subtract, then the other dimensions by falling bound, both signs at once
        score = partial[live]
        for lo, hi in [(0, at), *((j, min(j + PROBED, len(dims))) for j in range(at, len(dims), PROBED))]:
            keep = score + rest[max(lo, at)] >= threshold
            if 2 * np.count_nonzero(keep) < len(keep):  # reading whole columns is cheaper than picking most of their rows
                live, score = live[keep], score[keep]
            if len(live) <= FEW and lo >= at:
                hi = len(dims)  # the rest at once
            own_dims = dims[lo:hi]
            if len(live) == n:  # column by column: no copy of many of them
                for d in own_dims:
                    np.multiply(parts[1 - side[d], d] if lo < at else columns[d], weights[d], out=term)
                    score += term
            else:
                values = parts[(1 - side[own_dims])[:, None], own_dims[:, None], live] if lo < at else columns[np.ix_(own_dims, live)]
                score = score + np.einsum("i,ij->j", weights[own_dims], values)
            if hi == len(dims) and lo >= at:
                break
        wanted = score >= threshold
        if own is not None:
            wanted &= self.ids[live] != own
        live, score = live[wanted], score[wanted].astype(np.int64)
        best = np.lexsort((self.ids[live], -score))[:k]
        return self.ids[live[best]], score[best]

    def _seed(self, query: np.ndarray, own: int | None, k: int) -> int:
        """A lower bound of the k-th best score: that of the rows with the largest values in the heaviest dimensions."""
        if len(self.ids) <= k:
            return -(2**62)
        q = query[: len(self.columns)]
        heavy = np.argsort(-np.abs(q), kind="stable")[:8]
        rough = np.zeros(len(self.ids), dtype=np.int64)  # only dimensions that both have
        for d in heavy:
            rough += q[d] * self.columns[d]
        take = min(len(rough), 4 * k + 1)
        probe = np.argpartition(-rough, take - 1)[:take]
        if own is not None:
            probe = probe[self.ids[probe] != own]
        if len(probe) < k:
            return -(2**62)
        return int(np.sort(q @ self.columns[: len(q), probe])[-k])


def quantised(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): rows whose vector is there and finite in every component, as floor(256 x)."""
    x = F.col(vector)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.filter(F.col(key).isNotNull() & x.isNotNull()).filter(~bad).select(
        F.col(key).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c.cast("double") * 256)).alias("v"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding",
          shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``vectors`` of the highest integer inner product with each query.

    A row with the query's own id is no candidate; ties go to the smaller id.  Null vectors, vectors with null or
    non-finite components and null ids take no part.  Vectors of other lengths meet in their common dimensions; an empty
    one scores 0.  Repeated ids are rows of their own as candidates; a repeated query answers once, by its first vector.
    Components up to 2^20 in absolute value keep sums in 64 bits.  Fewer candidates than k: all.  Other columns are ignored.
    """
    rows = cut(quantised(vectors, key, vector), "topk-rows")
    asked = cut(quantised(queries, key, vector).groupBy("id").agg(F.min("v").alias("v")), "topk-queries")
    shards = max(1, -(-rows.count() // shard_rows))
    parts = max(1, -(-asked.count() // block_queries))
    salt = F.xxhash64("id", "v", F.monotonically_increasing_id())
    packed = cut(rows.withColumn("shard", F.pmod(salt, F.lit(shards))).groupBy("shard").agg(
        F.collect_list(F.struct("id", "v")).alias("rows")), "topk-shards")
    blocks = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(parts))).groupBy("block").agg(F.collect_list(F.struct("id", "v")).alias("asked"))
    # every shard meets every block of queries: the stated query set against all rows
    work = packed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("block", F.col("block").cast("long")).join(blocks, "block")
    spread = work.repartition(max(1, min(shards * parts, 4096)), "shard", "block") if shards * parts > 1 else work

    def vectors_of(lists: pa.Array, at: int) -> tuple[np.ndarray, list[np.ndarray]]:
        own = lists[at].values
        values = own.field(1)
        bounds = np.concatenate(([0], np.cumsum(values.value_lengths().to_numpy())))
        flat = values.flatten().to_numpy(zero_copy_only=False)
        return own.field(0).to_numpy(zero_copy_only=False), [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                shard = Shard(*vectors_of(batch.column(0), r))
                ids, scores, whose = [], [], []
                for q, v in zip(*vectors_of(batch.column(1), r), strict=True):
                    found, score = shard.search(v, int(q), k)
                    ids.append(found), scores.append(score), whose.append(np.full(len(found), q))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)) for x in (whose, ids, scores)],
                                                 names=["query_id", "vec_id", "score"])

    local = spread.select("rows", "asked").mapInArrow(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return local.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
