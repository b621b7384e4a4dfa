"""Exact removal of byte strings that start at two places, by suffix sorting.

Every MATCH-byte window is filed under its minimizer, the smallest hash of
SEED neighbouring bytes in it; consecutive windows of one minimizer form a
segment.  Equal windows have equal minimizers at equal offsets, so segments
alone decide, wherever they come from.  Segments of equal content are folded
(a folded segment's windows all recur), and segments whose minimizer occurs
once cannot recur.  What is left is dealt to shards by minimizer; a hot
minimizer's segments are cut at fixed offsets and dealt out further; where all
that is filed at one part of the offsets still exceeds a shard, its windows
are counted one by one by a 128-bit hash instead of sorted together.  Each
shard is suffix-sorted (``induced_sorting``), and a common prefix of MATCH
bytes with a neighbour in suffix order marks a window.  Marked windows go back
to their documents, which remove what they cover.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import _BASE, _powers, binary_buffers, materialize, mix64, text_slices, tidy
from tidewatch.llm.induced_sorting import suffix_array

MATCH, SEED = 200, 64
SPREAD = MATCH - SEED + 1
#: Bytes of segments that are suffix-sorted together.
SHARD_BYTES = 2 << 20
_PLACE = 22


def segments(data: np.ndarray, offsets: np.ndarray, contents: bool = True) -> tuple[np.ndarray, ...]:
    """(document, start, windows, offset of the minimizer in the first window,
    minimizer, content hash) of the segments of some documents' bytes; without
    ``contents``, the hashes are left out (zero)."""
    out = []
    piece = (1 << _PLACE) - MATCH
    for low in range(0, max(0, len(data) - MATCH + 1), piece):
        out.append(_segments(data, offsets, low, min(low + piece + MATCH - 1, len(data)), contents))
    if not out:
        return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _segments(data, offsets, low, high, contents):
    part = data[low:high]
    key, base, width = part.astype(np.uint64) + np.uint64(1), _BASE, 1
    while width < SEED:  # polynomial hashes of SEED bytes, by doubling
        key = key[:-width] * np.uint64(base) + key[width:]
        base, width = base * base % (1 << 64), width * 2
    key = mix64(key)
    best = (key >> np.uint64(_PLACE) << np.uint64(_PLACE)) | np.arange(len(key), dtype=np.uint64)
    width = 1
    while width < SPREAD:  # running minimum with its place, by doubling
        step = min(width, SPREAD - width)
        best = np.minimum(best[:-step], best[step:])
        width += step
    place = (best & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
    at = np.arange(low, low + len(place))
    doc = np.searchsorted(offsets, at, side="right") - 1
    inside = at + MATCH <= offsets[doc + 1]
    new = inside.copy()
    new[1:] &= (place[1:] != place[:-1]) | ~inside[:-1]
    start = np.flatnonzero(new)
    ends = np.append(start[1:], len(place))
    counted = np.append(0, np.cumsum(inside))
    windows = counted[ends] - counted[start]
    content = np.zeros(len(start), dtype=np.uint64)
    if contents:
        content = _content(part, start, start + windows + MATCH - 1)
    return (doc[start], start + low - offsets[doc[start]], windows, place[start] - start, key[place[start]],
            content)


def _content(part: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of stretches of bytes, from one prefix sum."""
    total = np.zeros(len(part) + 1, dtype=np.uint64)
    np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(part)), out=total[1:])
    content = (total[end] - total[start]) * _powers(pow(_BASE, -1, 1 << 64), len(part) + 1)[start]
    return mix64(content + (end - start).astype(np.uint64))


def recurring(texts: list[bytes], windows: list[int]) -> list[np.ndarray]:
    """For each segment (bytes, number of windows) the marks of the windows
    that start a string of MATCH bytes which another window starts too."""
    joined = np.frombuffer(b"\x00".join(texts) + b"\x00", dtype=np.uint8)
    # Symbols: 0 ends the text, 1 a segment, then the bytes.
    symbols = joined.astype(np.uint16) + 2
    length = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    first = np.append(0, np.cumsum(length))[:-1]
    symbols[first + length - 1] = 1
    order = suffix_array(np.append(symbols, 0).astype(np.uint16))
    starts = np.zeros(len(symbols) + 1, dtype=bool)
    edge = np.zeros(len(symbols) + 2, dtype=np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + np.array(windows, dtype=np.int64), -1)
    starts[:] = np.cumsum(edge)[:-1] > 0
    order = order[starts[order]]
    # Common prefixes of neighbours, eight bytes at a time, up to MATCH.
    words = np.ndarray((max(0, len(joined) - 7),), dtype="<u8", buffer=joined, strides=(1,))
    alike = np.arange(len(order) - 1)
    for depth in range(0, MATCH, 8):
        alike = alike[words[order[alike] + depth] == words[order[alike + 1] + depth]]
    marked = np.zeros(len(symbols) + 1, dtype=bool)
    marked[order[alike]] = True
    marked[order[alike + 1]] = True
    return [marked[a:a + w] for a, w in zip(first, windows, strict=True)]


def _runs(marks: np.ndarray) -> np.ndarray:
    """Flat [start, end) pairs of the runs of True."""
    return np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]]))).astype(np.int32)


def _packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, doc_id, packed): a key of each row and its text, compressed for
    the shuffles to come (null: empty)."""
    def run(batches):
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in text_slices(batch, 2):
                text = part.column(2).cast(pa.large_binary())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:2], pa.array([packer.compress(t.as_buffer() if t.is_valid else b"") for t in text],
                                                 pa.binary())], names=["row", "doc_id", "packed"])

    return _rows(docs, id_col, text_col).mapInArrow(tidy(run), "row bigint, doc_id bigint, packed binary")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.xxhash64(F.col(id_col).cast("bigint"), text).alias("row"),
                       F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))


def _all_segments(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, content, row, start, shape): shape holds the number of windows
    and, above 16 bits, the minimizer's offset in the first one."""
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, 1, 1 << 20):
                rows = np.asarray(part.column(0))
                doc, start, windows, offset, key, content = segments(*binary_buffers(part.column(1)))
                yield pa.RecordBatch.from_arrays([
                    pa.array(key.view(np.int64)), pa.array(content.view(np.int64)), pa.array(rows[doc]),
                    pa.array(start.astype(np.int32)), pa.array((windows + (offset << 16)).astype(np.int32))],
                    names=["key", "content", "row", "start", "shape"])

    return _rows(docs, id_col, text_col).select("row", "text").mapInArrow(
        tidy(run), "key bigint, content bigint, row bigint, start int, shape int")


def _keys(docs: DataFrame, text_col: str) -> DataFrame:
    """The minimizer of each segment."""
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, 0, 1 << 20):
                key = segments(*binary_buffers(part.column(0)), contents=False)[4]
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], names=["key"])

    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(tidy(run), "key bigint")


def _cut_out(batches):
    """Rows (shard, key, content, base, windows, times, text) of the segments
    that a document stands for; ``base`` counts from the segment's start."""
    unpacker = zstandard.ZstdDecompressor()
    for batch in batches:
        for i in range(batch.num_rows):
            text = unpacker.decompress(batch.column(0)[i].as_py())
            rows = []
            for s in batch.column(1)[i].as_py():
                windows, offset, parts = s["shape"] & 0xFFFF, s["shape"] >> 16, s["parts"]
                # Windows whose minimizer lies in one part of the offsets.
                part = (offset - np.arange(windows)) * parts // SPREAD
                cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1])).tolist()
                for a, b in zip(cuts, [*cuts[1:], windows], strict=True):
                    if part[a] in s["large"]:
                        continue
                    low = s["start"] + a
                    mine = zlib.crc32(f"{s['key']} {part[a]}".encode()) % s["shards"]
                    rows.append((mine, s["key"], s["content"], a, b - a, s["times"], text[low:low + b - a + MATCH - 1]))
            columns = zip(*rows, strict=True) if rows else [()] * 7
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[
                "shard", "key", "content", "base", "windows", "times", "text"])


def _single_windows(batches):
    """Rows (key, content, at, times, digest) of the windows in parts that are
    too large for a shard; ``at`` counts from the segment's start."""
    unpacker = zstandard.ZstdDecompressor()
    for batch in batches:
        for i in range(batch.num_rows):
            text = unpacker.decompress(batch.column(0)[i].as_py())
            rows = []
            for s in batch.column(1)[i].as_py():
                windows, offset, parts = s["shape"] & 0xFFFF, s["shape"] >> 16, s["parts"]
                part = (offset - np.arange(windows)) * parts // SPREAD
                for a in np.flatnonzero(np.isin(part, s["large"])).tolist():
                    low = s["start"] + a
                    rows.append((s["key"], s["content"], a, s["times"],
                                 hashlib.blake2b(text[low:low + MATCH], digest_size=16).digest()))
            columns = zip(*rows, strict=True) if rows else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[
                "key", "content", "at", "times", "digest"])


def _sort_shard(t: pa.Table) -> pa.Table:
    """(key, content, spans) of a shard; segments of a repeated row come in
    twice and are folded here."""
    held = {}
    for key, content, base, windows, times, text in zip(*(t.column(c).to_pylist() for c in (
            "key", "content", "base", "windows", "times", "text")), strict=True):
        held[key, content, base] = (windows, times, text)
    marks = recurring([x[2] for x in held.values()], [x[0] for x in held.values()]) if held else []
    keys, contents, spans = [], [], []
    for (key, content, base), (windows, times, _), mark in zip(held, held.values(), marks, strict=True):
        runs = np.array([0, windows], dtype=np.int32) if times > 1 else _runs(mark)
        if len(runs):
            keys.append(key)
            contents.append(content)
            spans.append((runs + base).tolist())
    return pa.table({"key": pa.array(keys, pa.int64()), "content": pa.array(contents, pa.int64()),
                     "spans": pa.array(spans, pa.list_(pa.int32()))})


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   keep_text: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256,
    and with ``keep_text`` the remaining bytes (kept).

    A byte goes if it is covered by a string of MATCH bytes that also starts
    at any other place, in this document or another; overlaps count, and
    strings are judged on the input.  A null text is empty.  Repeated rows
    are documents of their own, so each removes what the others have; null
    and repeated ids are allowed.  An empty table gives an empty result;
    other columns are not read.
    """
    found = _all_segments(docs, id_col, text_col)
    # Written first, so that Spark can split a hot minimizer in the join.
    shared = materialize(_keys(docs, text_col).groupBy("key").count().where("count > 1").select("key"))
    repeated = materialize(found.join(shared, "key"))
    folded = materialize(repeated.groupBy("key", "content").agg(
        F.count("*").alias("times"), F.min("row").alias("row"),
        F.min_by(F.struct("start", "shape"), "row").alias("place")))
    size = (F.col("place.shape").bitwiseAND(0xFFFF) + (MATCH - 1)).cast("long")
    keys = folded.groupBy("key").agg(F.count("*").alias("contents"), F.sum(size).alias("bytes"))
    several = keys.where("contents > 1")
    total = several.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    shards = max(1, -(-total // SHARD_BYTES))
    parts = F.least(F.lit(SPREAD), F.ceil(F.col("bytes") / F.lit(SHARD_BYTES))).cast("int")
    several = several.select("key", parts.alias("parts"))
    # Parts of a hot minimizer that still hold more than a shard.
    windows, offset = F.col("place.shape").bitwiseAND(0xFFFF), F.shiftright("place.shape", 16)
    part_of = lambda x: F.floor(x * F.col("parts") / F.lit(SPREAD)).cast("int")
    longest = F.least(windows, F.ceil(F.lit(SPREAD) / F.col("parts")).cast("int")) + (MATCH - 1)
    large = materialize(
        folded.join(several.where("parts > 1"), "key")
        .select("key", longest.cast("long").alias("bytes"),
                F.explode(F.sequence(part_of(offset - windows + 1), part_of(offset))).alias("part"))
        .groupBy("key", "part").agg(F.sum("bytes").alias("bytes")).where(F.col("bytes") > SHARD_BYTES)
        .groupBy("key").agg(F.collect_list("part").alias("large")))
    asked = materialize(
        folded.join(several, "key").join(large, "key", "left")
        .groupBy("row").agg(F.collect_list(F.struct(
            "key", "content", "times", "place.start", "place.shape", "parts", F.lit(shards).alias("shards"),
            F.coalesce("large", F.array().cast("array<int>")).alias("large"))).alias("asked")))
    sorted_ = (_packed(docs, id_col, text_col).join(asked, "row").select("packed", "asked")
               .mapInArrow(tidy(_cut_out), "shard int, key bigint, content bigint, base int, windows int, times bigint, text binary")
               .groupBy("shard").applyInArrow(_sort_shard, "key bigint, content bigint, spans array<int>"))
    # A repeated row comes in twice.
    single = materialize(
        _packed(docs, id_col, text_col)
        .join(asked.where(F.exists("asked", lambda s: F.size(s["large"]) > 0)), "row").select("packed", "asked")
        .mapInArrow(tidy(_single_windows), "key bigint, content bigint, at int, times bigint, digest binary")
        .dropDuplicates(["key", "content", "at"]))
    again = materialize(single.groupBy("key", "digest").agg(F.sum("times").alias("n")).where("n > 1").drop("n"))
    counted = (single.join(again, ["key", "digest"]).groupBy("key", "content")
               .agg(F.flatten(F.collect_list(F.array("at", F.col("at") + 1))).alias("spans")))
    # A minimizer with one content: its segments are copies of each other.
    alone = (folded.join(keys.where("contents = 1"), "key")
             .select("key", "content", F.array(F.lit(0), F.col("place.shape").bitwiseAND(0xFFFF)).alias("spans")))
    marked = materialize(sorted_.unionByName(alone).unionByName(counted))
    spans = (repeated.join(marked, ["key", "content"])
             .groupBy("row").agg(F.collect_list(F.struct("start", "spans")).alias("spans")))

    def run(batches):
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                text = unpacker.decompress(batch.column(1)[i].as_py())
                kept, removed, n = _remove(text, batch.column(2)[i])
                rows.append((batch.column(0)[i].as_py(), len(text), removed, n, hashlib.sha256(kept).hexdigest(),
                             kept if keep_text else None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            columns = zip(*rows, strict=True) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[
                "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    out = (_packed(docs, id_col, text_col).join(spans, "row", "left").select("doc_id", "packed", "spans")
           .mapInArrow(tidy(run), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"))
    return out if keep_text else out.drop("kept")


def _remove(text: bytes, spans) -> tuple[bytes, int, int]:
    """(remaining bytes, bytes removed, runs removed)."""
    if not spans.is_valid:
        return text, 0, 0
    data = np.frombuffer(text, dtype=np.uint8)
    edge = np.zeros(len(data) + 1, dtype=np.int64)
    for segment in spans.as_py():
        runs = np.array(segment["spans"]) + segment["start"]
        np.add.at(edge, runs[::2], 1)
        np.add.at(edge, runs[1::2] + MATCH - 1, -1)
    gone = np.cumsum(edge)[:-1] > 0
    return data[~gone].tobytes(), int(gone.sum()), len(_runs(gone)) // 2
