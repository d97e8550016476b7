"""Exact top-k search by inner product with MaxScore.

Components are integers, floor(256 * x). A dimension is a term, a vector's
component its posting. Vectors lie in shards of bounded size, which hold their
postings dimension by dimension and each dimension's smallest and largest
component. For a query and a shard a dimension adds at most the larger of the
products with these two bounds. Dimensions are ordered by how far their bounds
lie apart; the first of them, whose bounds together can't lift a vector over the
k-th best score so far, are non-essential. The postings of the essential
dimensions are traversed for all vectors of the shard; the others are probed,
block after block, only for vectors that can still reach the threshold. Ties
with the threshold stay, so smaller ids win among equals.

A task holds a bucket of about BUCKET_SHARDS shards and gets each block of
queries once. A query goes through them one after another and takes its k-th
best score along as the threshold; a bucket yields at most k rows for a query,
and these are merged by a window whose input Spark cuts to k rows for each query
and task.

Cases: vectors that are null, empty, or hold null or non-finite components take
no part, nor do null ids; vectors of other lengths than the query's don't match
it; a vector never matches a query of its own id, repeated rows included; fewer
candidates than k give fewer rows; an empty table gives none; other columns are
ignored, whatever their names. Scores are exact while they stay below 2**53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelake.llm.common import keep, table

K = 5
EVERY = 50
SHARD_ROWS, BUCKET_SHARDS = 4096, 8
BLOCK_QUERIES = 256
PROBE = 8


class Shard:
    """Postings by dimension, with their bounds."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.postings = np.ascontiguousarray(vectors[order].T.astype(np.float64))
        self.low, self.high = self.postings.min(axis=1), self.postings.max(axis=1)

    def search(self, query_id: int, query: np.ndarray, k: int, least: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the k best of at least ``least``, ties to smaller ids; all vectors that could be among them are scored whole."""
        top, bottom = np.maximum(query * self.low, query * self.high), np.minimum(query * self.low, query * self.high)
        others = np.flatnonzero(self.ids != query_id)
        if len(others) <= k:
            return self._best(others, query @ self.postings[:, others], k)
        # The threshold starts with the k best of a few vectors that are scored whole.
        seeds = others[:: max(1, len(others) // 64)]
        floor = max(least, np.partition(query @ self.postings[:, seeds], -k)[-k]) if len(seeds) >= k else least
        order = np.argsort(top - bottom, kind="stable")
        reach_first = np.concatenate([[0], np.cumsum(top[order])])  # what order[:i] add at most
        # Non-essential: as many as can't lift a vector over the threshold, even with the most from all others.
        # An essential posting counts from its dimension's lower bound, so a vector without one has that much.
        base = bottom.sum()
        split = int(np.searchsorted(base + np.cumsum((top - bottom)[order]) >= floor, True))
        essential = order[split:]
        alive = others
        score = query[essential] @ self.postings[essential] if len(essential) else np.zeros(len(self.ids))
        score = score[alive]
        at = split
        while True:
            able = score + reach_first[at] >= floor
            alive, score = alive[able], score[able]
            if not at or len(alive) <= k:
                break
            probed = order[max(0, at - PROBE) : at]
            score = score + query[probed] @ self.postings[np.ix_(probed, alive)]
            at = max(0, at - PROBE)
            if len(alive) > k:  # what the best have for sure lifts the threshold
                least = score + bottom[order[:at]].sum()
                floor = max(floor, np.partition(least, -k)[-k])
        if at:
            probed = order[:at]
            score = score + query[probed] @ self.postings[np.ix_(probed, alive)]
        return self._best(alive, score, k)

    def _best(self, alive: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        pick = np.lexsort((self.ids[alive], -score))[:k]
        return alive[pick], score[pick]


def integers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): components as floor(256 * x), of the vectors that take part."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vectors.filter(F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * 256).cast("long")).alias("v"))


def _packed(size: int):
    """Packs the rows of a task into arrays of up to ``size`` vectors of one length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        n = 0
        task = int(np.random.default_rng().integers(1 << 40))

        def out(dim: int, rows: list) -> pa.RecordBatch:
            nonlocal n
            n += 1
            ids, values = np.array([x[0] for x in rows], np.int64), np.array([x[1] for x in rows], np.int64)
            return pa.RecordBatch.from_pydict({"dim": [dim], "name": [f"{task}-{n}"], "ids": [ids.tobytes()], "vectors": [values.tobytes()]})

        for batch in batches:
            for i, v in zip(batch["id"].to_pylist(), batch["v"].to_pylist(), strict=True):
                rows = held.setdefault(len(v), [])
                rows.append((i, v))
                if len(rows) == size:
                    yield out(len(v), held.pop(len(v)))
        for dim, rows in held.items():
            yield out(dim, rows)

    return run


PACKED = "dim long, name string, ids binary, vectors binary"


def best_of(shards: list[Shard], query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best over some shards, each searched with the k-th best so far."""
    ids, scores, least = np.zeros(0, np.int64), np.zeros(0), -np.inf
    for shard in shards:
        at, score = shard.search(query_id, query, k, least)
        ids, scores = np.concatenate([ids, shard.ids[at]]), np.concatenate([scores, score])
        if len(ids) >= k:
            pick = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[pick], scores[pick]
            least = scores[-1]
    return ids, scores


def _search(k: int):
    """Rows come sorted by bucket, its shards first: then blocks of queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, shards = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["dim"], row["bucket"]) != bucket:
                    bucket, shards = (row["dim"], row["bucket"]), []
                ids = np.frombuffer(row["ids"], np.int64)
                vectors = np.frombuffer(row["vectors"], np.int64).reshape(len(ids), -1)
                if row["kind"] == 0:
                    shards.append(Shard(ids, vectors))
                    continue
                found = []
                for query_id, query in zip(ids, vectors.astype(np.float64), strict=True):
                    best, score = best_of(shards, query_id, query, k)
                    found.append((np.full(len(best), query_id), best, score.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], ["query_id", "vec_id", "score"])

    return run


def search(queries: DataFrame, vectors: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES, bucket_shards: int = BUCKET_SHARDS) -> DataFrame:
    """``queries``, ``vectors``: (id, v) of integers. Returns (query_id, rank, vec_id, score)."""
    shards = keep(vectors.mapInArrow(_packed(shard_rows), PACKED), "topk-shards")
    blocks = keep(queries.distinct().mapInArrow(_packed(block_queries), PACKED), "topk-queries")
    # A row for each length of vectors; n different lengths need n^2 / 2 components at least, so these are few.
    buckets = F.broadcast(shards.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / bucket_shards).alias("buckets")))
    held = shards.join(buckets, "dim").withColumn("bucket", F.pmod(F.xxhash64("name"), F.col("buckets"))).withColumn("kind", F.lit(0))
    asked = blocks.join(buckets, "dim").withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1))).withColumn("kind", F.lit(1))
    stream = held.unionByName(asked).select("dim", "bucket", "kind", "ids", "vectors").repartition("dim", "bucket").sortWithinPartitions("dim", "bucket", "kind")
    found = stream.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_exact_top_k(spark, sf_dir: str) -> DataFrame:
    vectors = integers(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return search(vectors.filter(F.col("id") % EVERY == 0), vectors)


ORACLE = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
