"""Helpers shared by the operators: table access, written intermediates,
vectorised word hashing over Arrow text columns, connected components."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import materialize, scratch_path

__all__ = ["materialize", "scratch_path", "ship_code", "table", "text_key", "tidy", "give_back", "text_slices",
           "whole_row", "binary_buffers",
           "white_space", "word_spans", "word_hashes", "mix64", "connected_components"]

#: Bytes of text that one numpy pass handles; bounds a Python worker's memory.
SLICE_BYTES = 1 << 20
#: Bytes of rows that travel to a Python worker at a time.
BATCH_BYTES = 4 << 20

_WS = np.zeros(256, dtype=bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package's source to the executors, once per application, for
    sessions that were started without it on their workers' path; and see that
    batches for Python workers hold BATCH_BYTES at most (a row of more comes
    alone), whatever number of rows the session allows them."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(limit).rstrip("b")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(limit, str(BATCH_BYTES))
    package = Path(__file__).resolve().parents[1]
    application = spark.sparkContext.applicationId
    if application in _shipped or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="tidewatch-code-")) / "tidewatch_code.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text_col: str) -> Column:
    """Tells apart the texts of a repeated id."""
    return F.xxhash64(F.col(text_col).cast("string"))


def whole_row(docs: DataFrame, but: str | None = None) -> Column:
    """All columns of ``docs`` (without one) as one struct, so that no name of
    theirs can clash with those of an operator's own columns."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != but])


def give_back() -> None:
    """Give memory that this process no longer uses back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable) -> Callable:
    """``run`` over a task's batches, which gives the memory that it no longer
    uses back at the end: workers live on and other tasks use them."""
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return tidied


def text_slices(batch: pa.RecordBatch, text_col: int | str,
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold about ``limit`` bytes
    (one row at least), so that buffers derived from texts stay bounded."""
    n = batch.num_rows
    if n == 0:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text_col)), 0))
    total = np.cumsum(sizes.astype(np.int64))
    at = 0
    while at < n:
        before = int(total[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def binary_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is empty."""
    col = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if col.null_count:
        col = pc.fill_null(col, b"")
    buffers = col.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = int(offsets[0]) if len(offsets) else 0
    return data[first:int(offsets[-1])] if len(offsets) else data[:0], offsets - first


def white_space(data: np.ndarray) -> np.ndarray:
    """True for the bytes 0x20 and 0x09-0x0D."""
    return _WS[data]


def word_spans(data: np.ndarray, offsets: np.ndarray,
               blank: np.ndarray = _WS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of each run of bytes other than white space
    (0x20, 0x09-0x0D, or the bytes that ``blank`` marks); runs end with their
    document."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    solid = ~blank[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | edge[1:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (wrapping multiplications)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        step = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        step[0] = 1
        have = _POWERS[base] = np.cumprod(step, dtype=np.uint64)
    return have[:n]


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray,
                lower: bool = True, base: int = _BASE) -> np.ndarray:
    """64-bit hash of each word: a polynomial over its bytes taken from one
    prefix sum, then mixed.  Words are handled in runs of about SLICE_BYTES."""
    out = np.empty(len(start), dtype=np.uint64)
    inverse = pow(base, -1, 1 << 64)
    at = 0
    while at < len(start):
        low = int(start[at])
        to = max(at + 1, int(np.searchsorted(end, low + SLICE_BYTES, side="right")))
        part = data[low:int(end[to - 1])]
        part = (_LOWER[part] if lower else part).astype(np.uint64) + np.uint64(1)
        part *= _powers(base, len(part))
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part, out=total[1:])
        s, e = start[at:to] - low, end[at:to] - low
        out[at:to] = (total[e] - total[s]) * _powers(inverse, len(part) + 1)[s] + (e - s).astype(np.uint64)
        at = to
    return mix64(out)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``edges`` (columns a, b, any
    orderable type); component = smallest node reachable.

    Alternating large-star and small-star steps; each is one aggregation to
    the smallest neighbour and one join back, so a hub's neighbours never
    meet in one row.  Every round is a written table in the shared folder.
    """
    spark = edges.sparkSession
    e = materialize(edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(max_rounds):
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = (both.join(low, both.u == low.k).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        down = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = (large.join(down, large.u == down.k)
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .unionByName(down.select(F.col("k").alias("u"), F.col("m").alias("v")))
                 .distinct())
        new = materialize(small)
        # Settled when no edge is new; then none is gone either, as each node
        # keeps one edge, to the smallest node of its component.
        settled = new.count() == e.count() and not new.join(e, ["u", "v"], "left_anti").head(1)
        e = new
        if settled:
            break
    else:
        raise RuntimeError("connected components did not settle")
    members = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)
