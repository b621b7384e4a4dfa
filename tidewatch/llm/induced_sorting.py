"""Suffix sorting by external induced sorting.

Suffixes are of type S (smaller than their right neighbour) or L.  The
leftmost S-type ones are sorted by their substrings and, where substrings
recur, by a recursion on the string of the substrings' ranks.  From them all
L-type suffixes are induced in ascending order, and from those all S-type ones
in descending order: whoever leaves the queue pushes its left neighbour.

The queue is monotone and holds suffix tuples in runs sorted by character; in
a run tuples keep the order in which they came, which is the order of their
right neighbours.  Runs beyond a bound of tuples are written to disk and
mapped back, so memory holds the runs that are being filled only.  Tuples are
moved in numpy blocks: a range of characters at a time while few tuples are in
it, else one character at a time.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

#: Tuples that a queue keeps in memory before it writes a run to disk.
MEMORY_TUPLES = 1 << 22
#: Tuples of a range of characters that are ordered together.
RANGE_TUPLES = 1 << 20


class DiskQueue:
    """A monotone priority queue of (character, position) tuples; equal
    characters leave in the order of their arrival."""

    def __init__(self, folder: str, memory: int = MEMORY_TUPLES):
        self.folder, self.memory = folder, memory
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = self.written = 0

    def push(self, chars: np.ndarray, positions: np.ndarray) -> None:
        if not len(chars):
            return
        order = np.argsort(chars, kind="stable")
        self.held.append((chars[order], positions[order]))
        self.size += len(chars)
        if self.size > self.memory:
            self._write()
        elif len(self.held) > 512:
            self.held = [self._merged()]

    def _merged(self):
        chars, positions = (np.concatenate(x) for x in zip(*self.held, strict=True))
        order = np.argsort(chars, kind="stable")
        return chars[order], positions[order]

    def _write(self) -> None:
        run = []
        for n, column in enumerate(self._merged()):
            path = os.path.join(self.folder, f"{id(self)}-{self.written}-{n}.npy")
            np.save(path, column)
            run.append(np.load(path, mmap_mode="r"))
        self.runs.append(tuple(run))
        self.held, self.size = [], 0
        self.written += 1

    def pop(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """(characters, positions) of all tuples with a character in [low,
        high]; equal characters are in order of arrival."""
        out = []
        for chars, positions in self.runs + self.held:
            a, b = np.searchsorted(chars, np.array([low, high + 1], dtype=np.int64))
            if a < b:
                out.append((np.asarray(chars[a:b]), np.asarray(positions[a:b])))
        if not out:
            empty = np.zeros(0, dtype=np.int64)
            return empty, empty
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def count(self, low: int, high: int) -> int:
        return sum(int(np.diff(np.searchsorted(c, np.array([low, high + 1], dtype=np.int64)))[0])
                   for c, _ in self.runs + self.held)


def types(text: np.ndarray) -> np.ndarray:
    """True for S-type positions; the text ends in its unique smallest symbol."""
    n = len(text)
    up = np.zeros(n, dtype=bool)
    up[-1] = True
    if n > 1:
        change = np.flatnonzero(text[1:] != text[:-1])  # text[i] differs from text[i + 1]
        rises = text[change] < text[change + 1]
        reach = np.diff(np.append(-1, change))
        up[:-1][:int(reach.sum())] = np.repeat(rises, reach)
    return up


def _names(text: np.ndarray, up: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Dense ranks of the substrings from each leftmost S-type position to
    the next, by symbol and type; some symbols are packed into one word and
    compared at once, and only ties go on to the next word."""
    length = np.append(np.diff(at) + 1, 1)
    top = int(text.max()) * 2 + 2
    bits = top.bit_length()
    per = max(1, 63 // bits)

    def word(positions, left, depth):
        out = np.zeros(len(positions), dtype=np.int64)
        for j in range(per):
            place = np.minimum(positions + depth + j, len(text) - 1)
            symbol = text[place].astype(np.int64) * 2 + up[place] + 1
            out = (out << bits) | np.where(left > depth + j, symbol, 0)
        return out

    key = word(at, length, 0)
    order = np.argsort(key)
    rank = np.empty(len(at), dtype=np.int64)
    new = np.append(True, key[order][1:] != key[order][:-1])
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    depth, active = per, order
    while True:
        group = rank[active]
        tied = np.zeros(len(active), dtype=bool)
        tied[1:] = group[1:] == group[:-1]
        tied[:-1] |= tied[1:]
        active = active[tied & (length[active] > depth)]
        if not len(active):
            break
        key = word(at[active], length[active], depth)
        order = np.lexsort((key, rank[active]))
        active, key = active[order], key[order]
        group = rank[active]
        fresh = np.append(True, group[1:] != group[:-1])
        new = fresh | np.append(True, key[1:] != key[:-1])
        place = np.arange(len(active))
        first = np.maximum.accumulate(np.where(fresh, place, 0))
        rank[active] = group + np.maximum.accumulate(np.where(new, place, 0)) - first
        depth += per
    return np.unique(rank, return_inverse=True)[1]


def _induce(text: np.ndarray, wanted: np.ndarray, given: np.ndarray, folder: str, memory: int):
    """Yield (induced, induced and given) blocks of positions in ascending
    order; under one character the induced suffixes come first.  ``given`` is
    sorted; a suffix's left neighbour is induced if ``wanted``."""
    queue = DiskQueue(folder, memory)
    top = int(text.max())
    chars = text[given]
    low = 0
    while low <= top:
        high = low
        step = 1
        while high < top:  # widen while few tuples are in range
            wider = min(top, low + step)
            a, b = np.searchsorted(chars, [low, wider + 1])
            if queue.count(low, wider) + b - a > RANGE_TUPLES:
                break
            high, step = wider, step * 2
        a, b = np.searchsorted(chars, [low, high + 1])
        if low == high:
            induced, merged = _one(text, wanted, queue, low), given[a:b]
            _push_left(text, wanted, queue, merged, high)
            merged = np.concatenate([induced, merged])
        else:
            induced, merged = _range(text, wanted, queue, low, high, given[a:b])
            _push_left(text, wanted, queue, merged, high)
        yield induced, merged
        low = high + 1


def _push_left(text, wanted, queue, positions, above) -> None:
    left = positions[positions > 0] - 1
    left = left[wanted[left]]
    chars = text[left]
    over = chars > above
    queue.push(chars[over].astype(np.int64), left[over])


def _one(text, wanted, queue, char) -> np.ndarray:
    """Suffixes induced for one character: those in the queue, then what they
    induce under the same character, round by round."""
    level = queue.pop(char, char)[1]
    out = []
    while len(level):
        out.append(level)
        left = level[level > 0] - 1
        left = left[wanted[left]]
        chars = text[left]
        same = chars == char
        queue.push(chars[~same].astype(np.int64), left[~same])
        level = left[same]
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def _range(text, wanted, queue, low, high, given):
    """(induced, induced and given), both in order, for a range of characters.

    The order of an induced suffix is (character, order of its right
    neighbour).  The neighbour lies below the range (the suffix came from the
    queue, its arrival is the neighbour's order), is given, or was induced in
    this range as well; ties of the last kind are resolved by following
    neighbours at doubling distance.
    """
    chars, positions = queue.pop(low, high)
    m = len(positions)
    nodes, codes = [positions, given], [chars * 2, text[given].astype(np.int64) * 2 + 1]
    follow = [np.full(m, -1, dtype=np.int64), np.full(len(given), -1, dtype=np.int64)]
    total = m + len(given)
    source, source_id = np.concatenate(nodes), np.arange(total)
    while True:
        inner = source > 0
        left, ids = source[inner] - 1, source_id[inner]
        ok = wanted[left]
        ok[ok] = text[left[ok]] <= high
        left, ids = left[ok], ids[ok]
        if not len(left):
            break
        nodes.append(left)
        codes.append(text[left].astype(np.int64) * 2)
        follow.append(ids)
        source, source_id = left, np.arange(total, total + len(left))
        total += len(left)
    nodes, code, follow = (np.concatenate(x) for x in (nodes, codes, follow))
    later = follow >= 0
    # Under one code the queue's suffixes are in order of arrival and the
    # given ones in their own order, so a stable sort by code keeps it.
    code = code * 2 + later
    code -= low * 4
    if int(code.max(initial=0)) < 1 << 16:
        code = code.astype(np.uint16)
    order = np.argsort(code, kind="stable")
    new = np.ones(total, dtype=bool)
    new[1:] = (code[order][1:] != code[order][:-1]) | ~later[order][1:]
    place = np.arange(total)
    rank = np.empty(total, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, place, 0))
    follow = np.where(later, follow, place)
    tied = order
    while True:
        group = rank[tied]
        twin = np.zeros(len(tied), dtype=bool)
        twin[1:] = group[1:] == group[:-1]
        twin[:-1] |= twin[1:]
        tied = tied[twin]
        if not len(tied):
            break
        key = rank[follow[tied]]
        by = np.argsort(rank[tied] * total + key)
        tied, key = tied[by], key[by]
        group = rank[tied]
        fresh = np.append(True, group[1:] != group[:-1])
        new = fresh | np.append(True, key[1:] != key[:-1])
        here = np.arange(len(tied))
        first = np.maximum.accumulate(np.where(fresh, here, 0))
        further = follow[follow[tied]]
        rank[tied] = group + np.maximum.accumulate(np.where(new, here, 0)) - first
        follow[tied] = further
    merged = np.empty(total, dtype=np.int64)
    merged[rank] = nodes
    is_given = np.zeros(total, dtype=bool)
    is_given[rank[m:m + len(given)]] = True
    return merged[~is_given], merged


def suffix_array(text: np.ndarray, folder: str | None = None, memory: int = MEMORY_TUPLES) -> np.ndarray:
    """Positions of ``text`` in the order of their suffixes.  The text is an
    integer array that ends in its unique smallest symbol, 0.  Runs of the
    queues are written below ``folder`` (default: a folder of its own in the
    task's temporary directory, removed at the end)."""
    if folder is None:
        with tempfile.TemporaryDirectory() as own:
            return suffix_array(text, own, memory)
    n = len(text)
    if n == 1:
        return np.zeros(1, dtype=np.int64)
    up = types(text)
    at = np.flatnonzero(up[1:] & ~up[:-1]) + 1
    names = _names(text, up, at)
    if int(names.max()) + 1 < len(at):
        order = suffix_array(names.astype(np.int32), folder, memory)
    else:
        order = np.argsort(names, kind="stable")
    lower = np.concatenate([x for x, _ in _induce(text, ~up, at[order], folder, memory)])
    top = int(text.max())
    flipped = (top - text.astype(np.int64)).astype(text.dtype)
    both = [merged for _, merged in _induce(flipped, up, lower[::-1], folder, memory)]
    found = np.concatenate(both)[::-1]
    return np.concatenate([[n - 1], found[found != n - 1]])

