"""A stated query set against all vectors, in blocks.

Candidates are dealt by the hash of their id to shards of about SHARD_ROWS
rows and queries to blocks of about QUERY_ROWS; each (shard, block) pair is
one group of one task, and gives its best k per query, which are then merged.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 8192
QUERY_ROWS = 4096


def finite(vector: str) -> Column:
    """True for vectors that are not null and hold finite numbers only."""
    return F.col(vector).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def matrix(column: pa.ChunkedArray, width: int, dtype) -> np.ndarray:
    """A list column as rows of one matrix; shorter lists end in zeros."""
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks else pa.array([], column.type)
    out = np.zeros((len(column), width), dtype=dtype)
    lengths = np.asarray(pc.list_value_length(column)) if len(column) else np.zeros(0, int)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(column):
        at = np.arange(width)[None, :] < lengths[:, None]
        out[at] = flat
    return out


def search(vectors: DataFrame, queries: Column, k: int, best: Callable, score_type: str) -> DataFrame:
    """(query_id, rank, vec_id, score) of ``best`` over all (shard, block)
    pairs; ``vectors`` has vec_id (not null) and v, a list of numbers.

    ``best(ids, matrix, query_ids, query_matrix, k)`` returns index arrays
    (query, candidate) and scores, the k best of a shard for each query at
    least.  A row is no candidate of queries with its own id.
    """
    n, width, n_queries = vectors.agg(
        F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0)), F.count(F.when(queries, 1))).first()
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-n_queries // QUERY_ROWS))
    shard = F.pmod(F.xxhash64("vec_id", F.lit("shard")), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = vectors.select(shard.alias("shard"), every(blocks).alias("block"), "vec_id", "v")
    right = vectors.where(queries).select(every(shards).alias("shard"), block.alias("block"), "vec_id", "v")
    types = {"bigint": pa.int64(), "double": pa.float64()}

    def run(candidates: pa.Table, asked: pa.Table) -> pa.Table:
        ids = np.asarray(candidates.column("vec_id").combine_chunks(), dtype=np.int64)
        asked_ids = np.asarray(asked.column("vec_id").combine_chunks(), dtype=np.int64)
        dtype = np.float64 if score_type == "double" else np.int64
        if len(ids) and len(asked_ids):
            q, c, s = best(ids, matrix(candidates.column("v"), width, dtype),
                           asked_ids, matrix(asked.column("v"), width, dtype), k)
        else:
            q, c, s = np.zeros(0, int), np.zeros(0, int), np.zeros(0, dtype)
        return pa.table({"query_id": pa.array(asked_ids[q], pa.int64()), "vec_id": pa.array(ids[c], pa.int64()),
                         "score": pa.array(s, types[score_type])})

    found = (left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))
             .applyInArrow(run, f"query_id bigint, vec_id bigint, score {score_type}"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def top(ids: np.ndarray, at: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k of ``at`` with the highest scores, ties to smaller ids."""
    if len(at) > 4 * k:
        level = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = scores >= level
        at, scores = at[keep], scores[keep]
    order = np.lexsort((ids[at], -scores))[:k]
    return at[order], scores[order]
