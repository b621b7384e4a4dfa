"""Counting quotient filters of packed keys.

A key is a row of 64-bit words (an n-gram of word ids).  :func:`permute` scrambles it
invertibly, so that its bits are evenly spread and no bit is lost: the top bits
of the permuted key name a shard, those after them (the quotient) a home slot
in the shard's filter, and all the others (the remainder) are stored in full.
Remainders of one quotient lie together, in order, at their home slot or
pushed to the right of it; three bits a slot (home slot taken, continues a run,
shifted) tell which is whose.  A filter therefore is a sorted, exact table of
keys and counts: filters merge like sorted runs, and keys come back whole.
"""

from __future__ import annotations

import struct

import numpy as np

from tidewatch.llm.common import mix64

_HEAD = struct.Struct("<BBBBQQ")


def _other(words: list[np.ndarray], i: int) -> np.ndarray:
    """A hash of all words but the i-th."""
    out = np.full(len(words[0]), np.uint64(0x9E3779B97F4A7C15 * (i + 1) & (2 ** 64 - 1)))
    for j, w in enumerate(words):
        if j != i:
            out = mix64(out + w)
    return out


def permute(words: list[np.ndarray]) -> list[np.ndarray]:
    """An invertible mix of the words of keys, given column by column."""
    out = [mix64(w) for w in words]
    for i in range(len(out) - 1, -1, -1):
        out[i] = out[i] ^ _other(out, i)
    return out


def _unmix64(x: np.ndarray) -> np.ndarray:
    inverse = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
    x = x ^ (x >> np.uint64(32))
    for _ in range(2):
        x = x * inverse
        x = x ^ (x >> np.uint64(32))
    return x


def restore(words: list[np.ndarray]) -> list[np.ndarray]:
    """The keys that :func:`permute` made ``words`` of."""
    out = list(words)
    for i in range(len(out)):
        out[i] = out[i] ^ _other(out, i)
    return [_unmix64(w) for w in out]


def fold(keys: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct permuted keys, ascending, with the sums of their counts."""
    if not len(counts):
        return keys, counts
    order = np.argsort(keys[0], kind="stable")
    keys, counts = [k[order] for k in keys], counts[order]
    new = np.ones(len(counts), dtype=bool)
    new[1:] = keys[0][1:] != keys[0][:-1]
    if len(keys) > 1:
        tied = ~new
        mixed = np.zeros(len(new), dtype=bool)
        for k in keys[1:]:
            mixed[1:] |= tied[1:] & (k[1:] != k[:-1])
        if mixed.any():  # equal first words, other keys: sort by all of them
            order = np.lexsort(keys[::-1])
            keys, counts = [k[order] for k in keys], counts[order]
            new[1:] = False
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(new)
    return [k[first] for k in keys], np.add.reduceat(counts, first)


class CountingQuotientFilter:
    """Counts of permuted keys of one shard: all keys whose top ``shard_bits``
    bits are equal."""

    def __init__(self, keys: list[np.ndarray], counts: np.ndarray, shard_bits: int = 0):
        """From distinct keys in ascending order."""
        n = len(counts)
        self.width, self.shard_bits, self.n = len(keys), shard_bits, n
        self.quotient_bits = min(max(1, int(n * 4 // 3).bit_length()), 64 - shard_bits)
        self.shard = int(keys[0][0] >> np.uint64(64 - shard_bits)) if n and shard_bits else 0
        quotient = self._quotient(keys[0]).astype(np.int64)
        # Each key at its home slot or at the next free one after it.
        at = np.arange(n)
        slot = at + np.maximum.accumulate(quotient - at) if n else at
        self.slots = max(1 << self.quotient_bits, int(slot[-1]) + 1 if n else 0)
        self.occupied, self.continues, self.shifted = (np.zeros(self.slots, dtype=bool) for _ in range(3))
        self.occupied[quotient] = True
        self.continues[slot[1:]] = quotient[1:] == quotient[:-1]
        self.shifted[slot] = slot != quotient
        self.used = np.zeros(self.slots, dtype=bool)
        self.used[slot] = True
        self.remainders = [self._rest(keys[0]), *keys[1:]]
        self.counts = counts.astype(np.int64)

    def _quotient(self, first: np.ndarray) -> np.ndarray:
        whole = first << np.uint64(self.shard_bits) if self.shard_bits else first
        return whole >> np.uint64(64 - self.quotient_bits)

    def _rest_bits(self) -> int:
        return 64 - self.shard_bits - self.quotient_bits

    def _rest(self, first: np.ndarray) -> np.ndarray:
        return first & np.uint64((1 << self._rest_bits()) - 1)

    def _quotients(self) -> np.ndarray:
        """The quotient of each stored remainder, from the three bits: the
        i-th run belongs to the i-th occupied home slot."""
        runs = np.cumsum(~self.continues[self.used]) - 1
        return np.flatnonzero(self.occupied)[runs] if self.n else runs

    def items(self) -> tuple[list[np.ndarray], np.ndarray]:
        """(keys, counts), ascending; keys are put together from shard,
        quotient and remainder."""
        first = self.remainders[0] | (self._quotients().astype(np.uint64) << np.uint64(self._rest_bits()))
        if self.shard_bits:
            first = first | np.uint64(self.shard << (64 - self.shard_bits))
        return [first, *self.remainders[1:]], self.counts

    def count(self, key: list[int]) -> int:
        """The count of one permuted key, by walking from its home slot."""
        first = np.array([key[0]], dtype=np.uint64)
        if self.shard_bits and key[0] >> (64 - self.shard_bits) != self.shard:
            return 0
        home = int(self._quotient(first)[0])
        if not self.occupied[home]:
            return 0
        # To the start of the cluster, then run by run to the home's own.
        start = home
        while self.shifted[start]:
            start -= 1
        runs = int(self.occupied[start:home].sum())
        slot = start
        while runs:
            slot += 1
            runs -= not self.continues[slot]
        wanted = [int(self._rest(first)[0]), *key[1:]]
        at = int(self.used[:slot].sum())
        while True:
            if [int(r[at]) for r in self.remainders] == wanted:
                return int(self.counts[at])
            at, slot = at + 1, slot + 1
            if slot >= self.slots or not self.continues[slot]:
                return 0

    def to_bytes(self) -> bytes:
        """Three bits a slot, then each used slot's remainder in as many bytes
        as it needs and its counter in one byte (255: eight more follow)."""
        low = -(-self._rest_bits() // 8)
        rest = self.remainders[0].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :low]
        small = np.minimum(self.counts - 1, 255).astype(np.uint8)
        large = self.counts[self.counts > 255].astype("<i8")
        bits = [np.packbits(b).tobytes() for b in (self.occupied, self.continues, self.shifted)]
        return b"".join([_HEAD.pack(self.width, self.shard_bits, self.quotient_bits, low, self.n, self.slots),
                         self.shard.to_bytes(8, "little"), *bits, np.ascontiguousarray(rest).tobytes(),
                         *(r.astype("<u8").tobytes() for r in self.remainders[1:]), small.tobytes(), large.tobytes()])

    @classmethod
    def from_bytes(cls, data) -> CountingQuotientFilter:
        out = cls.__new__(cls)
        data = memoryview(data)
        out.width, out.shard_bits, out.quotient_bits, low, out.n, out.slots = _HEAD.unpack_from(data)
        at = _HEAD.size
        out.shard = int.from_bytes(data[at:at + 8], "little")
        at += 8

        def take(size: int) -> np.ndarray:
            nonlocal at
            at += size
            return np.frombuffer(data[at - size:at], dtype=np.uint8)
        bits = [np.unpackbits(take(-(-out.slots // 8)), count=out.slots).astype(bool) for _ in range(3)]
        out.occupied, out.continues, out.shifted = bits
        # A slot is empty if its three bits are 0; a taken home slot always
        # holds a remainder, be it of another run.
        out.used = out.occupied | out.continues | out.shifted
        rest = np.zeros((out.n, 8), dtype=np.uint8)
        rest[:, :low] = take(out.n * low).reshape(out.n, low)
        out.remainders = [rest.view("<u8").reshape(-1)]
        out.remainders += [take(8 * out.n).view("<u8") for _ in range(out.width - 1)]
        counts = take(out.n).astype(np.int64) + 1
        large = counts == 256
        counts[large] = take(8 * int(large.sum())).view("<i8")
        out.counts = counts
        return out


def merge(filters: list[CountingQuotientFilter]) -> tuple[list[np.ndarray], np.ndarray]:
    """(keys, counts) of filters of one shard, as one sorted run."""
    runs = [f.items() for f in filters]
    keys = [np.concatenate([r[0][i] for r in runs]) for i in range(filters[0].width)]
    return fold(keys, np.concatenate([r[1] for r in runs]))
