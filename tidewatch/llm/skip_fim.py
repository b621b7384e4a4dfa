"""Fill-in-middle transformation over an indexable skip list.

A text is cut into units (a run of white space and the word after it, or the
white space at its end).  The units of a text make a skip list: the bottom lane
links every unit, each lane above about every fourth node of the lane below,
and every link carries the units and the code points that it spans.  A cut after
r units is reached by descending from the top lane while the spanned units
still fit; the code points summed up on the way are the exact place of the cut.
The ranks of the two cuts are drawn from a hash of the document's id, so a
document's form does not depend on partitions, order or retries.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import binary_buffers, mix64, text_slices, tidy, white_space

#: Fixed values of the format: markers of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
#: Of 100 documents, those transformed, and of 100 of them those whose suffix
#: comes first.
RATE, SUFFIX_FIRST = 50, 80
#: A node goes on to the lane above with a chance of one in 2**FAN_BITS.
FAN_BITS = 2


@dataclass
class Lane:
    """Links of one lane: the units and code points that each spans, and the
    link of the lane below at which each starts."""
    units: np.ndarray
    chars: np.ndarray
    below: np.ndarray


class SkipList:
    """Lanes over the units of a text, the top one first."""

    def __init__(self, chars: np.ndarray, seed: int = 0):
        n = len(chars)
        height = mix64(np.arange(n, dtype=np.uint64) + np.uint64(seed & 0xFFFFFFFF))
        lane = Lane(np.ones(n, dtype=np.int64), chars.astype(np.int64), np.arange(n))
        self.lanes = [lane]
        for level in range(1, 32):
            # A lane's first link starts at the head, whatever its height.
            keep = height & np.uint64((1 << (FAN_BITS * level)) - 1) == 0
            keep[:1] = True
            starts = np.flatnonzero(keep)
            if len(starts) < 2 or len(lane.units) <= 4:
                break
            links = starts if level == 1 else np.searchsorted(nodes, starts)
            nodes = starts
            lane = Lane(np.add.reduceat(lane.units, links), np.add.reduceat(lane.chars, links), links)
            self.lanes.insert(0, lane)

    def offset(self, rank: int) -> int:
        """Code points before the unit of this rank (all, at the end)."""
        left, chars, link = rank, 0, 0
        for depth, lane in enumerate(self.lanes):
            units = lane.units
            while left and link < len(units) and units[link] <= left:
                left -= int(units[link])
                chars += int(lane.chars[link])
                link += 1
            if not left:
                return chars
            # Past the last link only its end is left, which is left == 0.
            link = int(lane.below[link]) if depth + 1 < len(self.lanes) else link
        raise IndexError(f"rank {rank} is beyond the last unit")


def unit_widths(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points of each unit, first unit of each text); texts are the
    UTF-8 bytes between ``offsets``."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    blank = white_space(data)
    new = np.zeros(len(data), dtype=bool)
    new[1:] = blank[1:] & ~blank[:-1]
    new[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    start = np.flatnonzero(new)
    # Bytes other than continuation bytes begin a code point.
    chars = np.add.reduceat(((data & 0xC0) != 0x80).astype(np.int64), start)
    return chars, np.searchsorted(start, offsets)


def draws(doc_id, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four 32-bit numbers from the hash of seed and id (null: empty)."""
    key = f"{seed}:{'' if doc_id is None else doc_id}".encode()
    digest = hashlib.sha256(key).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in range(0, 16, 4))


def _transform(doc_id, text: str, chars: np.ndarray, seed: int, rate: int, suffix_first: int):
    """(form, prefix code points, middle code points, output)."""
    h1, h2, h3, h4 = draws(doc_id, seed)
    n = len(chars)
    if not text or h3 % 100 >= rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    units = SkipList(chars, h1)
    a, b = units.offset(low), units.offset(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < suffix_first:
        return "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
                   rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """One row per row of ``docs``: doc_id, n (units), form (plain, psm or
    spm), prefix_chars, middle_chars (code points; null if plain), output.

    Whole texts are cut, at units.  A null text is empty, and empty texts and
    those that contain a marker stay plain.  A null id draws from the empty id;
    repeated rows and rows of one id draw alike.  An empty table gives an empty
    result; other columns are not read, so their names cannot clash.
    """
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, 1):
                ids, data = part.column(0).to_pylist(), part.column(1)
                chars, first = unit_widths(*binary_buffers(data))
                rows = [_transform(ids[i], data[i].as_py() or "", chars[first[i]:first[i + 1]], seed, rate, suffix_first)
                        for i in range(part.num_rows)]
                form, before, middle, output = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(first)), pa.array(form), pa.array(before, pa.int64()),
                     pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        tidy(run), "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from, by its form alone.  Markers are
    found from the left: no part that precedes one contains it."""
    def between(low: Column, high: Column) -> Column:
        return F.substring(output, low, F.greatest(high - low, F.lit(0)))

    def place(marker: str) -> Column:
        return F.instr(output, marker)

    end = F.length(output) + 1
    psm = F.concat(between(F.lit(4), place(SUFFIX)), between(place(MIDDLE) + 3, end),
                   between(place(SUFFIX) + 3, place(MIDDLE)))
    spm = F.concat(between(place(PREFIX) + 3, place(MIDDLE)), between(place(MIDDLE) + 3, end),
                   between(F.lit(4), place(PREFIX)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
