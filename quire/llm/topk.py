"""Exact top-k inner products by no-random-access aggregation over sorted lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from quire.llm.common import materialize

#: Queries of one pass; vectors whose lists are sorted together; entries of each list read in the first round.
QUERIES, BLOCK, FIRST = 8192, 8192, 64
_TILE = 256
_EXACT, _LONG = 1 << 53, 1 << 63


class Best:
    """The k best (score, -vec_id) of each query so far, and how many list entries were read of how many."""

    def __init__(self, n: int, k: int) -> None:
        self.k, self.n = k, np.zeros(n, np.int64)
        self.score, self.vec = np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)
        self.read, self.entries = np.zeros(n, np.int64), np.zeros(n, np.int64)

    def add(self, q: int, score: np.ndarray, vec: np.ndarray) -> None:
        had = self.n[q]
        score, vec = np.concatenate((self.score[q, :had], score)), np.concatenate((self.vec[q, :had], vec))
        top = np.lexsort((vec, -score))[: self.k]
        self.n[q] = len(top)
        self.score[q, : len(top)], self.vec[q, : len(top)] = score[top], vec[top]

    def floor(self, at: int, stop: int) -> np.ndarray:
        """The k-th best score so far, which a candidate has to reach; none where there are fewer."""
        return np.where(self.n[at:stop] == self.k, self.score[at:stop, self.k - 1].astype(np.float64), -np.inf)


def search_block(queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, ids: np.ndarray, best: Best, first: int = FIRST) -> None:
    """Merge a block's vectors (integers) into ``best``.

    Each dimension is a list sorted by value, read from the top for positive weights and from the bottom for negative
    ones, so each query has one sequential read per list. A round reads on in all lists, at first ``first`` entries and
    then as many as before, and adds what it reads to the candidates' partial scores. What a candidate's unread lists
    can add lies between the far end of a list and the value read last: that bounds its score from below and above.
    A candidate whose upper bound is under the k-th best lower bound (of this block or of results so far) is out. A
    query stops once few candidates are left, whose scores are then resolved, or when its lists are read to the end.
    Ties with the k-th score stay in. Bounds are exact to 2**53 and wider by a margin beyond; scores are exact integers.
    """
    n, d = vectors.shape
    k = best.k
    most = int((np.abs(vectors).max(axis=0, initial=0).astype(object) * np.abs(queries).max(axis=0, initial=0).astype(object)).sum()) if n and len(queries) else 0
    if most >= _LONG:
        raise ValueError("scores beyond 64 bits; use a smaller scale")
    v = vectors.astype(np.float64)
    order = np.argsort(v, axis=0, kind="stable")
    ordered, rank = np.take_along_axis(v, order, 0), np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(n)[:, None], 0)
    slack = 0.0 if most < _EXACT else most * 2.0**-40
    for at in range(0, len(queries), _TILE):
        q = queries[at : at + _TILE].astype(np.float64)
        plus, minus, reading = np.maximum(q, 0), np.minimum(q, 0), np.arange(len(q))
        floor, alive = best.floor(at, at + _TILE), ids[None, :] != own[at : at + _TILE, None]
        partial, depth = np.zeros((len(q), n)), 0
        while len(reading):
            upto = min(n, max(first, 2 * depth))
            w, u = plus[reading], minus[reading]
            # The entries at places depth to upto of each list, from either end, are what this round reads.
            partial += w @ np.where((rank >= n - upto) & (rank < n - depth), v, 0).T + u @ np.where((rank >= depth) & (rank < upto), v, 0).T
            depth = upto
            upper = lower = partial
            if depth < n:
                above, below = (rank < n - depth).T.astype(np.float64), (rank >= depth).T.astype(np.float64)
                upper = partial + (w * ordered[n - depth]) @ above + (u * ordered[depth - 1]) @ below
                lower = partial + (w * ordered[0]) @ above + (u * ordered[-1]) @ below
            if n > k:
                floor = np.maximum(floor, np.partition(np.where(alive, lower, -np.inf), n - k, axis=1)[:, n - k])
            alive &= upper + slack >= floor[:, None] - slack
            done = (alive.sum(axis=1) <= 2 * k) | (depth == n)
            for c in np.flatnonzero(done):
                left, i = np.flatnonzero(alive[c]), at + reading[c]
                best.add(i, vectors[left] @ queries[i], ids[left])
                best.read[i] += depth
                best.entries[i] += n
            if done.any():
                reading, floor, alive, partial = reading[~done], floor[~done], alive[~done], partial[~done]


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(id, v): components as floor(scale * x); rows with null ids, null vectors, or null or non-finite components are left out."""
    source = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(ArrayType(DoubleType())).alias("x"))
    fine = F.col("id").isNotNull() & F.col("x").isNotNull() & F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return source.where(fine).select("id", F.transform("x", lambda x: F.floor(x * scale)).alias("v"))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows as 64-bit integers, shorter ones filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.values.slice(column.offsets[0].as_py(), int(sizes.sum())).to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), max(width, int(sizes.max(initial=0)))), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def top_k(vectors: DataFrame, *, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score, depth): each query's ``k`` highest integer inner products, ties to the smaller id.

    ``depth`` is the share of its sorted lists that the task which found the row had to read for the query. Queries are the rows whose id is divisible by ``every``, candidates all rows but those with the query's id; a
    query has fewer results only if there are fewer candidates. Vectors with unusable components take no part,
    shorter ones count as filled with zeros, repeated candidate rows each count, and of rows that repeat a query id
    the least vector is the query. Queries are broadcast ``queries`` at a time, one pass over the vectors for each
    such set; each task merges its blocks, so k rows per query and task meet in the shuffle.
    """
    spark, rows = vectors.sparkSession, quantised(vectors, id_col, vector_col, scale)
    asked = materialize(rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v")), "topk-asked")
    n = asked.count()
    parts, found = -(-n // queries), []
    schema = "query_id long, vec_id long, score long, read long, entries long"
    for p in range(parts):
        chosen = asked.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == p) if parts > 1 else asked
        held = sorted((r["id"], r["v"]) for r in chosen.collect())
        width = max((len(v) for _, v in held), default=0)
        shared = spark.sparkContext.broadcast((np.array([i for i, _ in held], np.int64), np.array([v + [0] * (width - len(v)) for _, v in held], np.int64).reshape(len(held), width)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            own, q = shared.value
            best, waiting = Best(len(own), k), []

            def merge() -> None:
                ids = np.concatenate([i for i, _ in waiting])
                width = max(q.shape[1], *(m.shape[1] for _, m in waiting))
                grown = np.concatenate([np.pad(m, ((0, 0), (0, width - m.shape[1]))) for _, m in waiting])
                waiting.clear()
                search_block(np.pad(q, ((0, 0), (0, width - q.shape[1]))), own, grown, ids, best)

            for b in batches:
                if b.num_rows and len(own):
                    waiting.append((b.column(0).to_numpy(), _matrix(b.column(1), q.shape[1])))
                    if sum(len(i) for i, _ in waiting) >= block:
                        merge()
            if waiting:
                merge()
            query, place = np.nonzero(np.arange(k)[None, :] < best.n[:, None])
            columns = (own[query], best.vec[query, place], best.score[query, place], best.read[query], best.entries[query])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score", "read", "entries"])

        found.append(rows.mapInArrow(run, schema))
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long, depth double")
    if parts > 1:
        found = [materialize(f, "topk") for f in found]
    union = found[0]
    for f in found[1:]:
        union = union.unionByName(f)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return union.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", (F.col("read") / F.col("entries")).alias("depth"))


def query(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    """op1: the five best matches of each query vector."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).drop("depth")


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
