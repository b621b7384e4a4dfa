"""Passages that recur across documents, by collinear chaining.

Seeds are k-word shingles picked by minimizers (the smallest of every WINDOW
neighbours), so equal stretches pick equal seeds.  Long seeds, of half a
passage's words, are picked likewise.  Seeds are joined on their hash; every
occurrence is matched with the seed's first document only, so a seed of many
documents makes as many matches and never all pairs.  Per pair
of documents, matches on one diagonal form segments, and Fenwick trees over
the first document's positions chain segments that are ordered in both
documents, at a cost for the words between them.  Chains are aligned word by
word and carried on at both ends; what is alike enough is a passage.  As the
first document may differ from seed to seed, a document's aligned stretches
are joined where they meet before their length is judged.

What is not covered then is matched again, by pairs of neighbouring seeds and
with the document before it that has the same pair, so that single seeds that
other documents have first do not hide a passage.  Last, windows of a passage's
length that are still not covered and hold a recurring long seed are matched,
whole, with the first place that has them: exact passages are found whichever
documents their seeds occur in.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import (binary_buffers, materialize, mix64, ship_code, text_key, text_slices, tidy, whole_row,
                                  word_hashes, word_spans)
from tidewatch.operators.ranks import dense_rank_of

K, WINDOW = 5, 12
MIN_WORDS, MIN_SIMILARITY = 50, 0.8
#: Shortest aligned stretch, longest gap between segments, and how far ends
#: are carried on, in words.
MIN_STRETCH, MAX_GAP, CARRY = 16, 32, 48
GAP_COST, MISS = 0.25, 1
#: Most words between two segments of a chain, in either document.
LIMIT = 2 * MAX_GAP
#: Stretches of a document that are no more than so many words apart meet.
MEET = 4


def _short_keys(words: np.ndarray) -> np.ndarray:
    n = len(words) - K + 1
    key = np.zeros(max(0, n), dtype=np.uint64)
    for j in range(K if n > 0 else 0):
        key = mix64(key * np.uint64(0xA24BAED4963EE407) + words[j:j + n])
    return key


def _long_keys(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k-word shingles, by doubling; the last two parts overlap."""
    if len(words) < k:
        return words[:0]
    key, width = mix64(words + np.uint64(k)), 1
    while width < k:
        step = min(width, k - width)
        key = mix64(key[:-step] * np.uint64(0x9FB21C651E98DF25) + key[step:])
        width += step
    return key


def _places(key: np.ndarray, doc: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(first shingle, picked shingle) of every window of ``window`` shingles
    of ``k`` words that lies within one document."""
    starts, picked = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    piece = 1 << 22
    for low in range(0, len(key) - window + 1, piece):
        part = key[low:low + piece + window - 1]
        ranked = (part >> np.uint64(24) << np.uint64(24)) | np.arange(len(part), dtype=np.uint64)
        best, width = ranked, 1
        while width < window:  # running minimum by doubling
            step = min(width, window - width)
            best = np.minimum(best[:-step], best[step:])
            width += step
        at = np.arange(low, low + len(best))
        inside = doc[at] == doc[at + window + k - 2]
        starts.append(at[inside])
        picked.append((best[inside] & np.uint64((1 << 24) - 1)).astype(np.int64) + low)
    return np.concatenate(starts), np.concatenate(picked)


def pick_seeds(words: np.ndarray, doc: np.ndarray, long: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(index, key) of the picked shingles of hashed words; a shingle and a
    window lie within one document.  With ``long``, shingles of half as many
    words, one at least of any ``long`` words."""
    key = _long_keys(words, half(long)) if long else _short_keys(words)
    k, window = (half(long), long - half(long) + 1) if long else (K, WINDOW)
    index = np.unique(_places(key, doc, k, window)[1])
    return index, key[index]


def half(n: int) -> int:
    """Words of a long seed of passages of ``n`` words."""
    return (n + 1) // 2


def seeds(docs: DataFrame, long: int = 0) -> DataFrame:
    """(key, doc, pos, first) of the picked seeds of doc_id, text; ``first``
    marks a key's first occurrence in its document."""
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, 1):
                ids = np.asarray(part.column(0))
                data, offsets = binary_buffers(part.column(1))
                start, end, doc = word_spans(data, offsets)
                words = word_hashes(data, start, end)
                index, key = pick_seeds(words, doc, long)
                first_word = np.searchsorted(doc, np.arange(len(ids)))
                of = doc[index]
                order = np.lexsort((index, key, of))
                new = np.ones(len(order), dtype=bool)
                new[1:] = (key[order][1:] != key[order][:-1]) | (of[order][1:] != of[order][:-1])
                first = np.zeros(len(order), dtype=bool)
                first[order[new]] = True
                yield pa.RecordBatch.from_arrays([
                    pa.array(key.view(np.int64)), pa.array(ids[of]),
                    pa.array((index - first_word[of]).astype(np.int32)), pa.array(first)],
                    names=["key", "doc", "pos", "first"])

    return docs.mapInArrow(tidy(run), "key bigint, doc bigint, pos int, first boolean")


class Fenwick:
    """Largest value over a prefix of positions, among those put in at a place
    that has not been left behind.  Places of puts and of queries ascend, so
    each node keeps only values that a later one does not exceed."""

    def __init__(self, n: int):
        self.best = [deque() for _ in range(n + 1)]

    def put(self, at: int, value: float, place: int, item: int) -> None:
        at += 1
        while at < len(self.best):
            held = self.best[at]
            while held and held[-1][0] <= value:
                held.pop()
            held.append((value, place, item))
            at += at & -at

    def upto(self, at: int, since: int) -> tuple[float, int]:
        """(value, item) of the largest at positions up to ``at`` that was put
        in at place ``since`` or later."""
        out, at = (-1e18, -1), at + 1
        while at > 0:
            held = self.best[at]
            while held and held[0][1] < since:
                held.popleft()
            if held and held[0][0] > out[0]:
                out = (held[0][0], held[0][2])
            at -= at & -at
        return out


def chain(segments: list[tuple[int, int, int, int, int]]) -> list[list[int]]:
    """Chains of segments (start, end, start there, end there, seeds), as
    lists of indexes; every segment is in one chain.

    A segment may follow another that ends before it in both documents, by
    LIMIT words at most; its score is its own words, plus the other's score,
    less GAP_COST for each word between them in either document.  With a cost
    linear in both positions the best predecessor has the largest score + cost *
    (end + end there) among those within the limit.  The other document is
    cut into blocks of LIMIT words with a Fenwick tree over prefixes and one
    over suffixes each: a query takes a prefix of its own block and a suffix of
    the block before, of what ended within the limit in the first document.
    """
    n = len(segments)
    if n == 1:
        return [[0]]
    trees: dict[int, tuple[Fenwick, Fenwick]] = {}
    score, back = [0.0] * n, [-1] * n
    ends = sorted(range(n), key=lambda i: segments[i][1])
    done = 0
    for i in sorted(range(n), key=lambda i: segments[i][0]):
        start, end, there, _, _ = segments[i]
        while done < n and segments[ends[done]][1] <= start:  # all that end before this one begins
            j = ends[done]
            _, end_j, _, end_there, _ = segments[j]
            block, at = divmod(end_there, LIMIT)
            if block not in trees:
                trees[block] = (Fenwick(LIMIT), Fenwick(LIMIT))
            value = score[j] + GAP_COST * (end_j + end_there)
            trees[block][0].put(at, value, end_j, j)
            trees[block][1].put(LIMIT - 1 - at, value, end_j, j)
            done += 1
        block, at = divmod(there, LIMIT)
        best, j = trees[block][0].upto(at, start - LIMIT) if block in trees else (-1e18, -1)
        if block - 1 in trees:
            best, j = max((best, j), trees[block - 1][1].upto(LIMIT - 1 - at, start - LIMIT))
        score[i] = float(end - start)
        gain = best - GAP_COST * (start + there)
        if j >= 0 and gain > 0:
            score[i] += gain
            back[i] = j
    out, used = [], [False] * n
    for i in sorted(range(n), key=lambda i: -score[i]):
        path = []
        while i >= 0 and not used[i]:
            used[i] = True
            path.append(i)
            i = back[i]
        if path:
            out.append(path[::-1])
    return out


def _segments(t: pa.Table) -> tuple[np.ndarray, ...]:
    """Segments of matches: one pair, one diagonal, no gap over MAX_GAP."""
    doc, head, pos, there, size = (np.asarray(t.column(i).combine_chunks()).astype(np.int64) for i in range(5))
    diagonal = pos - there
    order = np.lexsort((pos, diagonal, head, doc))
    doc, head, pos, there, diagonal, size = (x[order] for x in (doc, head, pos, there, diagonal, size))
    new = np.ones(len(doc), dtype=bool)
    new[1:] = ((doc[1:] != doc[:-1]) | (head[1:] != head[:-1]) | (diagonal[1:] != diagonal[:-1])
               | (pos[1:] - pos[:-1] > MAX_GAP))
    at = np.flatnonzero(new)
    end = np.maximum.reduceat(pos + size, at) if len(at) else at
    # A long seed counts as two.
    n = np.add.reduceat(1 + (size > K), at) if len(at) else at
    return doc[at], head[at], pos[at], end, there[at], end - diagonal[at], n


def _pair_chains(t: pa.Table):
    doc, head, start, end, there, end_there, n = _segments(t)
    new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (head[1:] != head[:-1])))
    out = []
    for a, b in zip(new, np.append(new[1:], len(doc)), strict=True):
        rows = list(zip(*(x[a:b].tolist() for x in (start, end, there, end_there, n)), strict=True))
        for path in chain(rows):
            out.append((int(doc[a]), int(head[a]), [v for i in path for v in rows[i][:4]]))
    return out


def chains(links: DataFrame) -> DataFrame:
    """(doc, head, parts): chains of each pair of documents; parts holds four
    positions per segment.  Rows of a pair arrive together and sorted."""
    def run(batches):
        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            doc = np.asarray(batch.column(0))
            cut = int(np.searchsorted(doc, doc[-1], side="left"))
            t = pa.Table.from_batches([batch])
            if cut == 0 and (not held or held[-1].column(0)[-1].as_py() == doc[0]):
                held.append(t)  # still the same document
                continue
            yield _chain_batch(_pair_chains(pa.concat_tables([*held, t.slice(0, cut)])))
            held = [t.slice(cut)]
        if held:
            yield _chain_batch(_pair_chains(pa.concat_tables(held)))

    return (links.repartition("doc", "head").sortWithinPartitions("doc")
            .mapInArrow(tidy(run), "doc bigint, head bigint, parts array<int>"))


def _chain_batch(rows: list[tuple]) -> pa.RecordBatch:
    doc, head, parts = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(head, pa.int64()),
                                       pa.array(parts, pa.list_(pa.int32()))], names=["doc", "head", "parts"])


def _carry_on(a: np.ndarray, b: np.ndarray) -> int:
    """Words by which a stretch goes on: the best-scoring prefix, a match
    counting 1 and a difference -MISS."""
    n = min(len(a), len(b), CARRY)
    if not n:
        return 0
    total = np.cumsum(np.where(a[:n] == b[:n], 1, -MISS))
    best = int(np.argmax(total))
    return best + 1 if total[best] > 0 else 0


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Words aligned between two gaps: longest common subsequence, one row of
    the table at a time."""
    if not len(a) or not len(b):
        return 0
    row = np.zeros(len(b) + 1, dtype=np.int64)
    for x in a:
        gain = np.where(b == x, row[:-1] + 1, 0)
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], gain))
    return int(row[-1])


def align(a: np.ndarray, b: np.ndarray, parts: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Stretches (start, end, start there, end there, words aligned) of a
    chain that are alike enough: the whole chain or, failing that, each of
    its segments.  ``a`` and ``b`` hold the hashed words of both documents."""
    segments = [parts[i:i + 4] for i in range(0, len(parts), 4)]
    equal = [int((a[s:e] == b[t:t + e - s]).sum()) for s, e, t, _ in segments]

    def stretch(first: int, last: int):
        s, t = segments[first][0], segments[first][2]
        e, u = segments[last][1], segments[last][3]
        words = sum(equal[first:last + 1])
        for (_, e0, _, u0), (s1, _, t1, _) in zip(segments[first:last], segments[first + 1:last + 1], strict=True):
            words += _common(a[e0:s1], b[u0:t1])
        n = _carry_on(a[max(0, s - CARRY):s][::-1], b[max(0, t - CARRY):t][::-1])
        words += int((a[s - n:s] == b[t - n:t]).sum())
        s, t = s - n, t - n
        n = _carry_on(a[e:e + CARRY], b[u:u + CARRY])
        words += int((a[e:e + n] == b[u:u + n]).sum())
        return s, e + n, t, u + n, words

    def alike(x):
        return x[4] >= MIN_SIMILARITY * max(x[1] - x[0], x[3] - x[2]) and x[1] - x[0] >= MIN_STRETCH

    whole = stretch(0, len(segments) - 1)
    if alike(whole):
        return [whole]
    return [x for i in range(len(segments)) if len(segments) > 1 and alike(x := stretch(i, i))]


def _beside_text(batches):
    """From batches sorted by k and kind, with a text (kind 0) before the rows
    (kind 1) of each k: (rows, words, first, last) per batch, the hashed words
    of the texts that have rows and where each row's text lies among them."""
    held: tuple[int | None, pa.Array | None] = (None, None)
    for batch in batches:
        k, kind = np.asarray(batch.column("k")), np.asarray(batch.column("kind"))
        text = batch.column("text")
        texts, rows = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
        if len(rows):
            at = np.searchsorted(texts, rows) - 1  # -1: in a batch before
            own = np.append(k[texts], 0 if held[0] is None else held[0])[at]
            known = (own == k[rows]) & ((at >= 0) | (held[0] is not None))
            rows, at = rows[known], at[known]
        if len(rows):
            used, which = np.unique(at, return_inverse=True)
            parts = text.take(pa.array(texts[used[used >= 0]])).cast(pa.large_binary())
            if used[0] < 0:
                parts = pa.concat_arrays([held[1], parts])
            data, offsets = binary_buffers(parts)
            start, end, doc = word_spans(data, offsets)
            words = (word_hashes(data, start, end) >> np.uint64(32)).astype(np.uint32)
            edge = np.searchsorted(doc, np.arange(len(used) + 1))
            yield batch.take(pa.array(rows)), words, edge[which], edge[which + 1]
        if len(texts):
            held = (int(k[texts[-1]]), pa.array([text[int(texts[-1])].as_py()], pa.large_binary()))


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions of ranges, one range after the other."""
    total = np.cumsum(size)
    return np.arange(int(total[-1]) if len(total) else 0) - np.repeat(total - size - start, size)


def _carried(a, b, at_a, at_b, room, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(words, equal words) by which each stretch goes on from at_a and at_b,
    for ``room`` words at most, forwards or backwards: :func:`_carry_on` of many."""
    words, equal = np.zeros(len(at_a), np.int64), np.zeros(len(at_a), np.int64)
    for low in range(0, len(at_a), 4096):
        part = slice(low, low + 4096)
        j = np.arange(CARRY)
        inside = j[None, :] < room[part, None]
        i_a = np.where(inside, at_a[part, None] + step * j, 0)
        i_b = np.where(inside, at_b[part, None] + step * j, 0)
        same = inside & (a[i_a] == b[i_b])
        total = np.cumsum(np.where(inside, np.where(same, 1, -MISS), -1000), axis=1)
        best = total.argmax(axis=1)
        row = np.arange(len(best))
        n = np.where(total[row, best] > 0, best + 1, 0)
        words[part], equal[part] = n, np.where(n > 0, np.cumsum(same, axis=1)[row, best], 0)
    return words, equal


def align_single(a, b, first_a, last_a, first_b, last_b, part) -> tuple[np.ndarray, ...]:
    """:func:`align` of many chains of one segment each: (start, end, start
    there, end there, words aligned, alike).  The words of chain i are
    a[first_a[i]:last_a[i]] and b[first_b[i]:last_b[i]]; ``part`` has four
    positions a row, relative to these."""
    s, e, t, u = (part[:, i] for i in range(4))
    size = e - s
    same = a[_spread(first_a + s, size)] == b[_spread(first_b + t, size)]
    filled = size > 0
    words = np.zeros(len(s), np.int64)
    words[filled] = np.add.reduceat(same, (np.cumsum(size) - size)[filled], dtype=np.int64) if filled.any() else 0
    n, equal = _carried(a, b, first_a + s - 1, first_b + t - 1, np.minimum(np.minimum(s, t), CARRY), -1)
    s, t, words = s - n, t - n, words + equal
    room = np.minimum(np.minimum(last_a - first_a - e, last_b - first_b - u), CARRY)
    n, equal = _carried(a, b, first_a + e, first_b + u, room, 1)
    e, u, words = e + n, u + n, words + equal
    return s, e, t, u, words, (words >= MIN_SIMILARITY * np.maximum(e - s, u - t)) & (e - s >= MIN_STRETCH)


#: Chains that one task aligns with the same first document.
HEAD_CHAINS = 20_000
_CHAIN = "k bigint, kind int, doc bigint, head bigint, parts array<int>, base int, words binary"


def aligned(chained: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc, start, end, head, head_start, head_end, words) of all stretches.

    Each side's texts travel once, sorted before the chains that need them.
    The document's side is cut out first, so that only the chained stretch
    travels to the other document.  The text of a first document of very many
    chains travels to as many tasks as it has HEAD_CHAINS of them."""
    def cut_out(batches):
        for rows, words, first, last in _beside_text(batches):
            parts = rows.column("parts")
            values, edge = np.asarray(parts.flatten()).astype(np.int64), np.append(0, np.cumsum(np.asarray(pc.list_value_length(parts))))
            low = np.maximum(0, values[edge[:-1]] - CARRY)
            size = np.maximum(np.minimum(last - first, values[edge[1:] - 3] + CARRY) - low, 0)
            cut = words[_spread(first + low, size)]
            binary = pa.Array.from_buffers(pa.large_binary(), len(size), [
                None, pa.py_buffer(np.append(0, np.cumsum(4 * size))), pa.py_buffer(np.ascontiguousarray(cut))]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [rows.column("head"), pa.array(np.ones(rows.num_rows, np.int32)), rows.column("doc"), rows.column("head"),
                 parts, pa.array(low.astype(np.int32)), binary], names=["k", "kind", "doc", "head", "parts", "base", "words"])

    def line_up(batches):
        for rows, b, first_b, last_b in _beside_text(batches):
            data, offsets = binary_buffers(rows.column("words"))
            a, edge_a = np.frombuffer(data.tobytes(), dtype=np.uint32), offsets // 4
            parts, base = rows.column("parts"), np.asarray(rows.column("base")).astype(np.int64)
            length = np.asarray(pc.list_value_length(parts))
            doc, head = np.asarray(rows.column("doc")), np.asarray(rows.column("head"))
            values, edge = np.asarray(parts.flatten()).astype(np.int64), np.append(0, np.cumsum(length))
            one = np.flatnonzero(length == 4)
            part = values[edge[one][:, None] + np.arange(4)] if len(one) else np.zeros((0, 4), np.int64)
            part[:, :2] -= base[one][:, None]
            s, e, t, u, n, alike = align_single(a, b, edge_a[one], edge_a[one + 1], first_b[one], last_b[one], part)
            one = one[alike]
            found = [(doc[one], s[alike] + base[one], e[alike] + base[one], head[one], t[alike], u[alike], n[alike])]
            for i in np.flatnonzero(length > 4):
                own, there = a[edge_a[i]:edge_a[i + 1]], b[first_b[i]:last_b[i]]
                p = values[edge[i]:edge[i + 1]].copy()
                for j in (0, 1):
                    p[j::4] -= base[i]
                got = align(own, there, p.tolist())
                if got:
                    s, e, t, u, n = np.array(got).T
                    found.append((np.full(len(s), doc[i]), s + base[i], e + base[i], np.full(len(s), head[i]), t, u, n))
            columns = [np.concatenate(x) for x in zip(*found, strict=True)]
            kinds = (np.int64, np.int32, np.int32, np.int64, np.int32, np.int32, np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(kind)) for c, kind in zip(columns, kinds, strict=True)],
                names=["doc", "start", "end", "head", "head_start", "head_end", "words"])

    def beside(texts, rows, *by):
        none = [F.lit(None).cast(kind).alias(name) for name, kind in (
            ("doc", "bigint"), ("head", "bigint"), ("parts", "array<int>"), ("base", "int"), ("words", "binary"))]
        texts = texts.select("k", F.lit(0).alias("kind"), *none, "text", *by)
        rows = rows.select("k", "kind", "doc", "head", "parts", "base", "words", F.lit(None).cast("string").alias("text"), *by)
        return texts.unionByName(rows).repartition("k", *by).sortWithinPartitions("k", *by, "kind")

    texts = docs.select(F.col("doc_id").alias("k"), "text")
    rows = chained.select(F.col("doc").alias("k"), F.lit(1).alias("kind"), "doc", "head", "parts",
                          F.lit(None).cast("int").alias("base"), F.lit(None).cast("binary").alias("words"))
    own = beside(texts, rows).mapInArrow(tidy(cut_out), _CHAIN)
    shares = materialize(chained.groupBy(F.col("head").alias("of")).count().where(F.col("count") > HEAD_CHAINS)
                         .select("of", F.ceil(F.col("count") / HEAD_CHAINS).cast("int").alias("shares")))
    own = (own.join(shares, F.col("k") == F.col("of"), "left")
           .withColumn("share", F.pmod(F.xxhash64("doc"), F.coalesce("shares", F.lit(1))).cast("int")).drop("of", "shares"))
    texts = (texts.join(shares, F.col("k") == F.col("of"), "left")
             .withColumn("share", F.explode(F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1))))
    return beside(texts, own, "share").mapInArrow(
        tidy(line_up), "doc bigint, start int, end int, head bigint, head_start int, head_end int, words int")


def _first_places(occurrences: DataFrame, *key: str) -> DataFrame:
    """(key, head, there) of each key that several documents have.  Written
    first: a join with it then reads plain exchanges on both sides, whose hot
    keys Spark can split."""
    return materialize(occurrences.groupBy(*key)
                       .agg(F.min("doc").alias("head"), F.min_by("pos", F.struct("doc", "pos")).alias("there"),
                            F.max("doc").alias("last"))
                       .where("head <> last").drop("last"))


def _runs(found: DataFrame, min_words: int) -> DataFrame:
    """Stretches with the run of meeting stretches that each is part of
    (passage_start, passage_end), where that has ``min_words``."""
    by_start = Window.partitionBy("doc").orderBy("start", "end", "head", "head_start").rowsBetween(
        Window.unboundedPreceding, -1)
    runs = found.withColumn("new", (F.col("start") > F.coalesce(F.max("end").over(by_start), F.lit(-MEET - 1)) + MEET)
                            .cast("int"))
    runs = runs.withColumn("run", F.sum("new").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy("doc", "run")
    return (runs.withColumn("passage_start", F.min("start").over(run))
            .withColumn("passage_end", F.max("end").over(run))
            .where(F.col("passage_end") - F.col("passage_start") >= min_words))


def _uncovered(rows: DataFrame, covered: DataFrame, start, end) -> DataFrame:
    """Rows of ``doc`` from ``start`` to ``end`` that no passage covers."""
    return rows.join(covered, (rows["doc"] == covered["of"]) & (start >= F.col("passage_start"))
                     & (end <= F.col("passage_end")), "left_anti")


def _previous(places: DataFrame, blocks: int = 256) -> DataFrame:
    """(pair, doc, head, there): for each (pair, doc, pos) the document before
    it with the same pair, and the place there.  Documents are cut into blocks
    of their range, so a pair of very many documents is many windows."""
    known = places.agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).first()
    if known["lo"] is None:
        known = {"lo": 0, "hi": 0}
    low, width = float(known["lo"]), (float(known["hi"]) - float(known["lo"])) / blocks + 1.0
    placed = places.withColumn("block", F.floor((F.col("doc").cast("double") - low) / width).cast("int"))
    inside = Window.partitionBy("pair", "block").orderBy("doc")
    near = placed.select("pair", "doc", "block", F.lag("doc").over(inside).alias("head"), F.lag("pos").over(inside).alias("there"))
    # The last document of each block, for the first one of the next.
    last = placed.groupBy("pair", "block").agg(F.max("doc").alias("top"), F.max_by("pos", "doc").alias("top_pos"))
    over = Window.partitionBy("pair").orderBy("block")
    before = last.select("pair", "block", F.lag("top").over(over).alias("top"), F.lag("top_pos").over(over).alias("top_pos"))
    return (near.join(before, ["pair", "block"])
            .select("pair", "doc", F.coalesce("head", "top").alias("head"), F.coalesce("there", "top_pos").alias("there"))
            .where("head is not null"))


def _pair_links(recurring: DataFrame, covered: DataFrame) -> DataFrame:
    """(doc, head, pos, there, size): seeds of a document that no passage
    covers, matched where the document before it that has the same two seeds
    in a row has them.  ``recurring``: (doc, pos, key) of all seeds that
    several documents have."""
    order = Window.partitionBy("doc").orderBy("pos", "key")
    rows = (_uncovered(recurring, covered, F.col("pos"), F.col("pos") + K)
            .select("doc", "pos", "key", F.lead("pos").over(order).alias("next"), F.lead("key").over(order).alias("next_key"))
            .where(F.col("next") - F.col("pos") <= 2 * WINDOW)
            .select("doc", "pos", "next", F.xxhash64("key", "next_key", F.col("next") - F.col("pos")).alias("pair")))
    rows = materialize(rows)
    before = _previous(rows.groupBy("pair", "doc").agg(F.min("pos").alias("pos")))
    both = F.explode(F.array(F.lit(0), F.col("next") - F.col("pos"))).alias("step")
    return (rows.join(before, ["pair", "doc"]).select("doc", "head", "pos", "there", both)
            .select("doc", "head", (F.col("pos") + F.col("step")).alias("pos"), (F.col("there") + F.col("step")).alias("there"),
                    F.lit(K).alias("size")).distinct())


def _whole_windows(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(key, whole, doc, pos) of the windows of ``n`` words whose long seed is
    one of those ``wanted`` (doc, keys) of their document."""
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, 2):
                ids = np.asarray(part.column(0))
                data, offsets = binary_buffers(part.column(2))
                start, end, doc = word_spans(data, offsets)
                words = word_hashes(data, start, end)
                key = _long_keys(words, half(n))
                at, place = _places(key, doc, half(n), n - half(n) + 1)
                whole = _long_keys(words, n)
                first_word = np.searchsorted(doc, np.arange(len(ids) + 1))
                edge = np.searchsorted(at, first_word)
                for i in range(len(ids)):
                    asked = np.asarray(part.column(1)[i].values).view(np.uint64)
                    own = slice(edge[i], edge[i + 1])
                    mine = np.isin(key[place[own]], asked)
                    pos, seed = at[own][mine], place[own][mine]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(key[seed].view(np.int64)), pa.array(whole[pos].view(np.int64)),
                        pa.array(np.full(len(pos), ids[i])), pa.array((pos - first_word[i]).astype(np.int32))],
                        names=["key", "whole", "doc", "pos"])

    return (docs.join(wanted, docs["doc_id"] == wanted["doc"]).select("doc_id", "keys", "text")
            .mapInArrow(tidy(run), "key bigint, whole bigint, doc bigint, pos int"))


def _exact(docs: DataFrame, longs: DataFrame, covered: DataFrame, n: int) -> DataFrame:
    """Stretches of the windows of ``n`` words that recur in a document of
    smaller id and that no passage covers.  ``longs``: the occurrences (key,
    doc, head, pos) of recurring long seeds."""
    around = n - half(n)
    open_ = materialize(_uncovered(longs.where("doc <> head"), covered, F.greatest(F.col("pos") - around, F.lit(0)),
                                   F.col("pos") + n).select("key").distinct())
    wanted = longs.join(open_, "key").groupBy("doc").agg(F.collect_set("key").alias("keys"))
    windows = materialize(_whole_windows(docs, wanted, n))
    heads = _first_places(windows, "key", "whole")
    same = windows.join(heads, ["key", "whole"]).where("doc <> head").select("doc", "head", "pos", "there")
    same = _uncovered(same, covered, F.col("pos"), F.col("pos") + n).withColumn("diagonal", F.col("pos") - F.col("there"))
    # Windows one after the other on a diagonal are one stretch.
    row = F.row_number().over(Window.partitionBy("doc", "head", "diagonal").orderBy("pos"))
    return (same.distinct().withColumn("island", F.col("pos") - row)
            .groupBy("doc", "head", "diagonal", "island")
            .agg(F.min("pos").alias("start"), (F.max("pos") + n).alias("end"), F.min("there").alias("head_start"),
                 (F.max("there") + n).alias("head_end"))
            .select("doc", "start", "end", "head", "head_start", "head_end",
                    (F.col("end") - F.col("start")).alias("words")))


def _covered(found: DataFrame, n: int) -> DataFrame:
    return materialize(_runs(found, n).select(F.col("doc").alias("of"), "passage_start", "passage_end").distinct())


def _find(ready: DataFrame, min_words: int) -> DataFrame:
    """The stretches of all passages of (doc_id, text), see :func:`_runs`;
    doc_id is a number of its own for each text."""
    short = seeds(ready)
    heads = _first_places(short.where("first"), "key")
    short = materialize(short.drop("first").join(heads, "key"))
    long = seeds(ready, min_words)
    long = materialize(long.join(_first_places(long.where("first"), "key"), "key").drop("first"))
    links = (short.where("doc <> head").select("doc", "head", "pos", "there", F.lit(K).alias("size"))
             .unionByName(long.where("doc <> head").select("doc", "head", "pos", "there",
                                                           F.lit(half(min_words)).alias("size"))))
    found = materialize(aligned(materialize(chains(links)), ready))
    again = materialize(chains(_pair_links(short.select("doc", "pos", "key"), _covered(found, min_words))))
    found = found.unionByName(materialize(aligned(again, ready)))
    # Stretches of a document that meet make one passage.
    return _runs(found.unionByName(_exact(ready, long, _covered(found, min_words), min_words)), min_words)


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame | None]:
    """(doc_id, text) of the rows that take part, with a number of its own for
    each text; where ids repeat, also what the numbers stand for (number,
    doc_id, text_key), in the order of ids."""
    ready = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .where("doc_id is not null and text is not null")
    if not ready.groupBy("doc_id").count().where("count > 1").head(1):
        return ready, None
    keyed = ready.withColumn("text_key", text_key("text"))
    names = keyed.select("doc_id", "text_key").distinct()
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("text_key"))
    names = materialize(names.join(dense_rank_of(names.select("doc_id"), [], "doc_id").select("doc_id", "rank"), "doc_id")
                        .withColumn("nth", nth))
    most = names.agg(F.max("nth")).first()[0]
    names = names.select("doc_id", "text_key", (F.col("rank") * (most + 1) + F.col("nth")).alias("number"))
    rows = keyed.join(names, ["doc_id", "text_key"]).select(F.col("number").alias("doc_id"), "text")
    return rows.dropDuplicates(["doc_id"]), names


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             min_words: int = MIN_WORDS) -> DataFrame:
    """Stretches of documents that recur in a document of smaller id: doc_id,
    start_word, end_word, passage_start, passage_end, partner_id,
    partner_start, partner_end, matched_words, similarity.

    Positions count words (runs of characters other than space and
    0x09-0x0D), ends excluded; A-Z and a-z are alike.  A passage is the run of
    a document's stretches that meet, with ``min_words`` words at least; each
    stretch aligns with its partner at MIN_SIMILARITY or more.  Rows with a
    null id or text and texts without words take no part.  Different texts of
    one id are different documents, in the order of a hash; rows of the same
    id and text are one.  An empty table gives an empty result; other columns
    are not read.
    """
    ship_code(docs.sparkSession)
    ready, names = _numbered(docs, id_col, text_col)
    runs = _find(ready, min_words)
    if names is not None:
        for side in ("doc", "head"):
            runs = (runs.join(names.select(F.col("number").alias(side), F.col("doc_id").alias(f"{side}_id")), side)
                    .drop(side).withColumnRenamed(f"{side}_id", side))
    length = F.greatest(F.col("end") - F.col("start"), F.col("head_end") - F.col("head_start"))
    return runs.select(
        F.col("doc").alias("doc_id"), F.col("start").alias("start_word"), F.col("end").alias("end_word"),
        "passage_start", "passage_end", F.col("head").alias("partner_id"), F.col("head_start").alias("partner_start"),
        F.col("head_end").alias("partner_end"), F.col("words").alias("matched_words"),
        F.round(F.col("words") / length, 6).alias("similarity"))


def drop_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the words of recurring passages; the document of
    smallest id keeps its own.  A row of which no word is left is dropped; a
    column ``n_chars`` then counts the new text's characters.

    Other rows and columns stay as they are, whatever their names.  Null ids,
    null and empty texts, repeated ids and rows and empty tables: see
    :func:`passages`; rows of one id and text are cut alike.
    """
    ship_code(docs.sparkSession)
    ready, names = _numbered(docs, id_col, text_col)
    spans = (_find(ready, min_words).select("doc", F.struct("passage_start", "passage_end").alias("span")).distinct()
             .groupBy("doc").agg(F.sort_array(F.collect_list("span")).alias("spans")))
    rows = docs.select(whole_row(docs, but=text_col).alias("row"), F.col(text_col).alias("text"),
                       F.col(id_col).cast("bigint").alias("id"), *([text_key(text_col).alias("key")] if names is not None else []))
    if names is None:
        joined = rows.join(spans, F.col("id") == F.col("doc"), "left")
    else:
        spans = spans.join(names.select(F.col("number").alias("doc"), "doc_id", "text_key"), "doc").drop("doc")
        joined = rows.join(spans, (F.col("id") == F.col("doc_id")) & (F.col("key") == F.col("text_key")), "left")

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, 1):
                marks = part.column(2).to_pylist()
                text = part.column(1).cast(pa.large_binary())
                new = [_without(text[i].as_py(), marks[i]) if marks[i] else text[i].as_py() for i in range(len(text))]
                kept = pa.array([not m or bool(n and n.strip()) for m, n in zip(marks, new, strict=True)])
                columns = [part.column(0), pa.array(new, pa.binary()).cast(part.column(1).type), pa.array([bool(m) for m in marks])]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "text", "cut"]).filter(kept)

    joined = joined.select("row", "text", "spans")
    cut = joined.mapInArrow(tidy(run), joined.drop("spans").schema.add("cut", "boolean"))

    def column(name: str) -> Column:
        if name == text_col:
            return F.col("text").alias(name)
        own = F.col("row").getField(name)
        if name == "n_chars":
            own = F.when(F.col("cut"), F.length("text").cast(docs.schema[name].dataType)).otherwise(own)
        return own.alias(name)

    return cut.select(*[column(c) for c in docs.columns])


def _without(text: bytes, spans: list[dict]) -> bytes:
    data = np.frombuffer(text, dtype=np.uint8)
    start, _, _ = word_spans(data, np.array([0, len(data)]))
    edge = np.append(start, len(data))
    out, at = [], 0
    for span in spans:
        low, high = (int(edge[min(span[x], len(start))]) for x in ("passage_start", "passage_end"))
        out.append(text[at:max(at, low)])
        at = max(at, high)
    return b"".join([*out, text[at:]])
