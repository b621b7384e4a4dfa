"""Gram matrices of many columns in blocks, with pairwise complete rows.

For every pair of columns the sums that correlations, covariances and normal
equations need (rows, both sums, both sums of squares, the sum of products) are
taken over the rows in which neither is NULL.  Columns are cut into blocks;
each task turns its batches into matrices and multiplies block by block, with
0 for NULL and a mask beside it, so a pair costs a few multiplications a row
instead of an aggregate of its own.  Partial sums are one row per pair of blocks
and task; a pass takes PAIRS pairs of blocks and reads only their columns, so
memory is bounded whatever the number of columns.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clip
from ..session import ship_package

#: Columns of a block, and pairs of blocks that one pass holds in a task.
BLOCK, PAIRS = 128, 64
_SUMS = ("n", "sum_a", "sum_b", "sum_aa", "sum_bb", "sum_ab")
_PARTIAL = "i int, j int, sums binary"


def _partial_sums(pairs: list[tuple[int, int]], width: dict[int, int], first: dict[int, int], shift: np.ndarray):
    """Task body: (i, j, six matrices) of its rows for each pair of blocks.
    ``first``: where a block starts among the columns read."""
    def run(batches):
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            columns = [np.asarray(c.to_numpy(zero_copy_only=False), dtype=np.float64) for c in batch.columns]
            known = [~np.isnan(c) for c in columns]
            for i, j in pairs:
                side = []
                for b in (i, j):
                    at = range(first[b], first[b] + width[b])
                    mask = np.stack([known[c] for c in at], axis=1).astype(np.float64)
                    x = np.stack([np.where(known[c], columns[c] - shift[c], 0.0) for c in at], axis=1)
                    side.append((x, mask))
                (x, m), (y, o) = side
                sums = np.stack([m.T @ o, x.T @ o, m.T @ y, (x * x).T @ o, m.T @ (y * y), x.T @ y])
                total[i, j] = total[i, j] + sums if (i, j) in total else sums
        for (i, j), sums in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([sums.tobytes()])], names=["i", "j", "sums"])
    return run


def _added(t: pa.Table) -> pa.Table:
    parts = [np.frombuffer(b, dtype=np.float64) for b in t.column("sums").to_pylist()]
    return pa.table({"i": t.column("i")[:1], "j": t.column("j")[:1], "sums": pa.array([np.sum(parts, axis=0).tobytes()])})


def pair_sums(df: DataFrame, cols: list[str], block: int = BLOCK) -> tuple[DataFrame, dict[str, float]]:
    """((col_a, col_b, n, sum_a, sum_b, sum_aa, sum_bb, sum_ab), shifts) of all
    pairs a <= b in the order of ``cols``.  Values are taken relative to the
    column's shift, its mean, so that no digits cancel.  NaN counts as NULL."""
    ship_package(df.sparkSession)
    value = lambda c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double"))
    row = df.agg(*[F.avg(value(c)) for c in cols]).first()
    shift = {c: 0.0 if v is None or np.isinf(v) else float(v) for c, v in zip(cols, row, strict=True)}
    blocks = [cols[i:i + block] for i in range(0, len(cols), block)]
    every = [(i, j) for i in range(len(blocks)) for j in range(i, len(blocks))]
    out = None
    for low in range(0, len(every), PAIRS):
        pairs = every[low:low + PAIRS]
        used = sorted({b for pair in pairs for b in pair})
        read = [c for b in used for c in blocks[b]]
        first, at = {}, 0
        for b in used:
            first[b], at = at, at + len(blocks[b])
        width = {b: len(blocks[b]) for b in used}
        run = _partial_sums(pairs, width, first, np.array([shift[c] for c in read]))
        part = (df.select(*[value(c).alias(f"c{n}") for n, c in enumerate(read)]).mapInArrow(run, _PARTIAL)
                .groupBy("i", "j").applyInArrow(_added, _PARTIAL))
        out = part if out is None else out.unionByName(part)

    def rows(batches):
        for batch in batches:
            for r in batch.to_pylist():
                a, b = blocks[r["i"]], blocks[r["j"]]
                sums = np.frombuffer(r["sums"], dtype=np.float64).reshape(6, len(a), len(b))
                x, y = np.triu_indices(len(a), m=len(b)) if r["i"] == r["j"] else np.indices((len(a), len(b))).reshape(2, -1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a[k] for k in x]), pa.array([b[k] for k in y]),
                     pa.array(np.rint(sums[0][x, y]).astype(np.int64)), *(pa.array(sums[k][x, y]) for k in range(1, 6))],
                    names=["col_a", "col_b", *_SUMS])

    schema = "col_a string, col_b string, n bigint, " + ", ".join(f"{s} double" for s in _SUMS[1:])
    return out.mapInArrow(rows, schema), shift


def correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """(col_a, col_b, corr): Pearson correlation of each pair over the rows
    that have both, clipped to [-1, 1]; NULL where either does not vary."""
    sums, _ = pair_sums(df, cols)
    n = F.col("n").cast("double")
    a = F.col("sum_aa") - F.try_divide(F.col("sum_a") * F.col("sum_a"), n)
    b = F.col("sum_bb") - F.try_divide(F.col("sum_b") * F.col("sum_b"), n)
    ab = F.col("sum_ab") - F.try_divide(F.col("sum_a") * F.col("sum_b"), n)
    corr = F.when((F.col("n") > 1) & (a > 0) & (b > 0), ab / F.sqrt(a) / F.sqrt(b))
    return sums.select("col_a", "col_b", F.when(corr.isNotNull(), clip(corr, -1.0, 1.0)).alias("corr"))


def ridge_solution(df: DataFrame, features: list[str], target: str, alpha: float) -> tuple[list[float], float]:
    """(coefficients, intercept) of the exact minimum of the squared error +
    alpha ||w||^2 over the rows without NULL; the intercept is not penalised.
    The matrix that is solved has one row per feature."""
    complete = df.na.drop(subset=[*features, target])
    cols = [*features, target]
    sums, shift = pair_sums(complete, cols)
    at = {c: i for i, c in enumerate(cols)}
    gram, total, n = np.zeros((len(cols), len(cols))), np.zeros(len(cols)), 0
    for r in sums.collect():  # a row per pair of columns
        i, j = at[r["col_a"]], at[r["col_b"]]
        gram[i, j] = gram[j, i] = r["sum_ab"]
        total[i], total[j], n = r["sum_a"], r["sum_b"], r["n"]
    if not n:
        raise ValueError("no row without NULL to fit on")
    centred = gram - np.outer(total, total) / n
    k = len(features)
    w = np.linalg.solve(centred[:k, :k] + alpha * np.eye(k), centred[:k, k]) if k else np.zeros(0)
    mean = np.array([shift[c] for c in cols]) + total / n
    return [float(x) for x in w], float(mean[k] - w @ mean[:k])
