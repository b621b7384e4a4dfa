"""Exact top-k search by MaxScore over quantised vectors.

A vector is a bag of terms (dimension, sign) with its quantised component as
weight.  For a query, a term of the query's own sign raises scores, by
|query weight| times the term's largest weight in the shard at most; a term of
the other sign only lowers them.  With the k-th best score so far as threshold,
the weakest raising terms whose bounds together stay below it are
non-essential: whatever occurs in no essential posting cannot get in.
Essential postings are traversed, the other terms are probed for candidates
that can still compete, and the shards' best are merged.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.vector_blocks import finite, search, top

SCALE = 1024
#: Rows of a shard whose postings are traversed together; the threshold rises
#: from one part to the next.
PART_ROWS = 1024
PROBE_TERMS = 8


class Postings:
    """Postings by (dimension, sign) of one part of a shard."""

    def __init__(self, rows: np.ndarray, start: int):
        self.rows, self.start = rows, start
        self.up = [np.flatnonzero(rows[:, j] > 0) for j in range(rows.shape[1])]
        self.down = [np.flatnonzero(rows[:, j] < 0) for j in range(rows.shape[1])]
        self.highest = np.maximum(rows.max(axis=0), 0)
        self.lowest = np.minimum(rows.min(axis=0), 0)

    def competitive(self, q: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of all rows whose score is ``threshold`` or more,
        perhaps with some others."""
        everything = np.arange(len(self.rows))
        if threshold <= 0:  # a row without any raising term may get in
            return everything, self.rows @ q
        bound = np.where(q > 0, q * self.highest, q * self.lowest)
        order = np.argsort(bound, kind="stable")
        total = np.cumsum(bound[order])
        spare = int(np.searchsorted(total, threshold, side="left"))  # non-essential terms
        if spare == len(order):
            return everything[:0], np.zeros(0, dtype=np.int64)
        partial, seen = np.zeros(len(self.rows), dtype=np.int64), np.zeros(len(self.rows), dtype=bool)
        for j in order[spare:]:
            docs = self.up[j] if q[j] > 0 else self.down[j]
            partial[docs] += self.rows[docs, j] * q[j]
            seen[docs] = True
        rest = int(total[spare - 1]) if spare else 0
        at = np.flatnonzero(seen & (partial + rest >= threshold))
        # Essential terms of the other sign lower the score.
        essential = order[spare:]
        score = self.rows[np.ix_(at, essential)] @ q[essential]
        for low in range(spare, 0, -PROBE_TERMS):
            left = int(total[low - 1])
            keep = score + left >= threshold
            at, score = at[keep], score[keep]
            if not len(at):
                break
            probed = order[max(0, low - PROBE_TERMS):low]
            score = score + self.rows[np.ix_(at, probed)] @ q[probed]
        return at, score


def _best(ids, rows, query_ids, queries, k):
    order = np.argsort(ids, kind="stable")
    parts = [Postings(rows[order[a:a + PART_ROWS]], a) for a in range(0, len(order), PART_ROWS)]
    out = []
    for n, (own, q) in enumerate(zip(query_ids, queries, strict=True)):
        at, score, threshold = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), -np.inf
        for part in parts:
            new, gained = part.competitive(q, threshold)
            new = order[new + part.start]
            other = ids[new] != own
            at, score = top(ids, np.concatenate([at, new[other]]), np.concatenate([score, gained[other]]), k)
            if len(at) == k:
                threshold = score[-1]
        out.append((np.full(len(at), n), at, score))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def top_k(vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``queries`` holds,
    the k rows with the largest integer inner product of the components
    floor(scale * x), ties to smaller ids; fewer rows give all.

    Rows whose id or vector is null, or whose vector holds a null or a
    non-finite component, take no part.  Shorter vectors count as ending in
    zeros.  Of repeated ids each row is a candidate, and none of the queries
    of its own id; each repeated query row adds to one ranking.  Empty tables
    give an empty result.  Other columns are not read.
    """
    ready = vectors.where(F.col(id_col).isNotNull() & finite(vector_col)).select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.transform(vector_col, lambda x: F.floor(x.cast("double") * float(scale)).cast("bigint")).alias("v"))
    return search(ready, queries, k, _best, "bigint")
