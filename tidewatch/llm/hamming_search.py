"""Approximate nearest neighbours by multi-index hashing.

A rotation learned on a bounded sample (principal directions, then iterative
quantisation) turns vectors into binary codes.  Codes are cut into substrings
and each substring is indexed: a code within Hamming distance r of the query
agrees with it up to floor(r / m) bits in one of the m substrings, so probing
the index within that many bits finds every code within r.  What is found is
ranked by the inner product of the original vectors, in double precision.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.vector_blocks import finite, matrix, search, top

#: Bounds of the sample on which rotation and radius are fitted.
SAMPLE_ROWS = 20_000
SAMPLE_QUERIES = 400
BITS, SUBSTRINGS = 64, 4
#: Share of the sample queries' true neighbours that the radius must reach.
REACH = 0.985


@dataclass
class Coder:
    mean: np.ndarray
    rotation: np.ndarray
    longest: float
    radius: int

    def codes(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """(rows, SUBSTRINGS) 16-bit substrings of the codes.  Candidates get
        a component that makes all of one length, queries a zero there, so
        that the largest inner product is also the smallest angle."""
        length = (x * x).sum(axis=1)
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.longest ** 2 - length, 0))
        scale = np.sqrt(np.maximum(length, 1e-300)) if query else np.full(len(x), self.longest)
        y = np.column_stack([x, more]) / scale[:, None] - self.mean
        bits = (y @ self.rotation) > 0
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint16).reshape(len(x), -1)


def _flips(errors: int) -> np.ndarray:
    """All 16-bit masks of up to ``errors`` bits."""
    masks = [0]
    for n in range(1, errors + 1):
        masks += [sum(1 << b for b in bits) for bits in itertools.combinations(range(16), n)]
    return np.array(masks, dtype=np.uint16)


def fit(sample: np.ndarray, longest: float, k: int, seed: int = 7) -> Coder:
    """Learn rotation and radius from rows of ``sample``."""
    rng = np.random.default_rng(seed)
    n, width = sample.shape
    coder = Coder(np.zeros(width + 1), np.zeros((width + 1, BITS)), max(longest, 1e-300), BITS)
    length = (sample * sample).sum(axis=1)
    x = np.column_stack([sample, np.sqrt(np.maximum(coder.longest ** 2 - length, 0))]) / coder.longest
    coder.mean = x.mean(axis=0) if n else coder.mean
    x = x - coder.mean
    directions = min(BITS, width + 1)
    if n > 1:
        principal = np.linalg.svd(x, full_matrices=True)[2] if n < width + 1 else np.linalg.eigh(x.T @ x)[1].T[::-1]
    else:
        principal = np.eye(width + 1)
    principal = principal[:directions].T
    v = x @ principal
    turn = np.linalg.qr(rng.standard_normal((directions, directions)))[0]
    for _ in range(30):
        u, _, w = np.linalg.svd(np.where(v @ turn > 0, 1.0, -1.0).T @ v)
        turn = (u @ w).T
    rotation = principal @ turn
    if directions < BITS:  # few dimensions: random directions fill the code
        extra = rng.standard_normal((width + 1, BITS - directions))
        rotation = np.column_stack([rotation, extra / np.linalg.norm(extra, axis=0)])
    coder.rotation = rotation
    asked = np.arange(min(SAMPLE_QUERIES, n))
    if n > 1:
        scores = sample[asked] @ sample.T
        scores[asked, asked] = -np.inf
        near = np.argsort(-scores, axis=1, kind="stable")[:, :min(k, n - 1)]
        own, others = coder.codes(sample[asked], query=True), coder.codes(sample)
        apart = np.bitwise_count(own[:, None, :] ^ others[near]).sum(axis=2)
        coder.radius = int(np.quantile(apart, REACH, method="higher"))
    return coder


def _searcher(coder: Coder):
    def best(ids, rows, query_ids, queries, k):
        codes, asked = coder.codes(rows), coder.codes(queries, query=True)
        errors = coder.radius // SUBSTRINGS
        flips = _flips(errors) if errors <= 4 else None
        index = []
        for s in range(SUBSTRINGS):
            order = np.argsort(codes[:, s], kind="stable")
            values, start = np.unique(codes[order, s], return_index=True)
            index.append((order, values, np.append(start, len(order))))
        out = []
        for n, (own, q, code) in enumerate(zip(query_ids, queries, asked, strict=True)):
            hit = np.zeros(len(ids), dtype=bool)
            for s, (order, values, start) in enumerate(index):
                if flips is not None and len(flips) < len(values):  # enumerate buckets
                    probes = flips ^ code[s]
                    at = np.searchsorted(values, probes)
                    at = at[(at < len(values)) & (values[np.minimum(at, len(values) - 1)] == probes)]
                else:  # fewer buckets than probes: go through the directory
                    at = np.flatnonzero(np.bitwise_count(values ^ code[s]) <= errors)
                first, many = start[at], start[at + 1] - start[at]
                if many.sum():
                    step = np.repeat(first - np.append(0, np.cumsum(many)[:-1]), many)
                    hit[order[step + np.arange(many.sum())]] = True
            found = np.flatnonzero(hit & (ids != own))
            found = found[np.bitwise_count(codes[found] ^ code).sum(axis=1) <= coder.radius]
            if len(found) < k:  # a lonely query: widen to the k nearest codes
                apart = np.bitwise_count(codes ^ code).sum(axis=1).astype(np.int64)
                apart[ids == own] = BITS + 1
                found = np.lexsort((ids, apart))[:k]
                found = found[ids[found] != own]
            at, score = top(ids, found, rows[found] @ q, k)
            out.append((np.full(len(at), n), at, score))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))
    return best


def nearest(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``queries`` holds,
    the k nearest rows found, largest inner product first, ties to smaller ids.

    Rows whose id or vector is null, whose vector is zero or holds a null or
    non-finite component, take no part.  Shorter vectors count as ending in
    zeros; repeated ids are rows of their own and never their own neighbours.
    Every row is indexed; the sample (SAMPLE_ROWS rows in hash order) only
    fits rotation and radius.  A query with fewer than k codes in its radius
    gets the k nearest codes of each shard, so none comes back short.
    """
    ready = vectors.where(F.col(id_col).isNotNull() & finite(vector_col)).select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.transform(vector_col, lambda x: x.cast("double")).alias("v")).where(F.exists("v", lambda x: x != 0))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    longest, width = ready.agg(F.max(F.sqrt(square)), F.max(F.size("v"))).first()
    sample = ready.orderBy(F.xxhash64("vec_id", F.lit("sample")), "vec_id").limit(SAMPLE_ROWS).select("v").toArrow()
    coder = fit(matrix(sample.column("v"), width or 0, np.float64), longest or 1.0, k)
    return search(ready, queries, k, _searcher(coder), "double")
