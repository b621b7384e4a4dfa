"""Phrase collocations, counted in counting quotient filters.

Every word of a language has an id of 64 bits, a hash that is checked to be
different for all words of the corpus (and drawn anew if it is not).  The
n-grams of a task are packed word ids; :mod:`quotient_filter` permutes them,
counts them and files them, one filter per shard of permuted keys.  The
filters of a shard are merged in one task, which gives exact counts.

Phrases are counted level by level.  One that is frequent enough has only
frequent parts, so an occurrence is counted only if both parts that are one word
shorter pass a Bloom filter of the frequent ones.  That filter has no false
negatives and a bounded size: with more phrases than it is made for, it saves
less, and the counts stay exact.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import binary_buffers, materialize, mix64, ship_code, text_slices, tidy, word_hashes, word_spans
from tidewatch.llm.quotient_filter import CountingQuotientFilter, fold, merge, permute, restore

MIN_COUNT, MAX_WORDS, TOP, COVERED = 10, 3, 2000, 50
#: n-grams that a task gathers before it files them, and those that a shard
#: is to hold.
GATHER, SHARD = 1_000_000, 1_000_000
#: Bits of a Bloom filter for each of its entries, the most it has altogether,
#: and how many are set for an entry.
BLOOM_BITS, BLOOM_MAX, BLOOM_SET = 10, 1 << 28, 4
#: Words from so many bytes on have an id from a cryptographic hash.
LONG_WORD = 128

_PIECE_END = np.zeros(256, dtype=bool)
_PIECE_END[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
_BLANK = _PIECE_END.copy()
_BLANK[[0x20, 0x09]] = True
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xAEF17502108EF2D9, 0xF1357AEA2E62A9C5)


def word_ids(data: np.ndarray, offsets: np.ndarray, langs: np.ndarray, attempt: int):
    """(start, end, id, joins) of each word; ``joins`` tells that the next
    word follows in the same piece.  ``langs`` has a hash for each text."""
    start, end, text = word_spans(data, offsets, _BLANK)
    ids = word_hashes(data, start, end, base=_BASES[attempt % len(_BASES)])
    for i in np.flatnonzero(end - start >= LONG_WORD):
        word = data[start[i]:end[i]].tobytes().translate(_LOWER)
        ids[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8, salt=bytes([attempt])).digest(), "little")
    ids = mix64(ids + langs[text] + np.uint64(attempt))
    piece = np.searchsorted(np.flatnonzero(_PIECE_END[data]), start)
    joins = np.zeros(len(start), dtype=bool)
    joins[:-1] = (text[1:] == text[:-1]) & (piece[1:] == piece[:-1])
    return start, end, ids, joins, text


def _langs(column: pa.Array) -> np.ndarray:
    """A hash of each text's language."""
    coded = column.dictionary_encode()
    seeds = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little")
                      for x in coded.dictionary.to_pylist()], dtype=np.uint64)
    return seeds[np.asarray(coded.indices)]


def count_words(docs: DataFrame, attempt: int = 0) -> DataFrame:
    """(id, lang, word, n) of every word of ``docs`` (lang, text).  Different
    words of one id are different rows."""
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, 1, 8 << 20):
                data, offsets = binary_buffers(part.column(1))
                langs = _langs(part.column(0))
                start, end, ids, _, text = word_ids(data, offsets, langs, attempt)
                # A second hash tells apart the words of one id.
                other = word_hashes(data, start, end, base=_BASES[(attempt + 1) % len(_BASES)]) + langs[text]
                order = np.lexsort((other, ids))
                new = np.ones(len(order), dtype=bool)
                new[1:] = (ids[order][1:] != ids[order][:-1]) | (other[order][1:] != other[order][:-1])
                at = np.flatnonzero(new)
                first = order[at]
                words = [data[s:e].tobytes().translate(_LOWER) for s, e in zip(start[first], end[first], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[first].view(np.int64)), part.column(0).take(pa.array(text[first])),
                     pa.array(words, pa.binary()).cast(pa.string()), pa.array(np.diff(np.append(at, len(order))))],
                    names=["id", "lang", "word", "n"])

    rows = docs.select("lang", "text").mapInArrow(tidy(run), "id bigint, lang string, word string, n bigint")
    return rows.repartition("id").groupBy("id", "lang", "word").agg(F.sum("n").alias("n"))


def _bloom_places(words: list[np.ndarray], bits: int) -> np.ndarray:
    h = np.zeros(len(words[0]), dtype=np.uint64)
    for w in words:
        h = mix64(h + w)
    step = mix64(h ^ np.uint64(0xA24BAED4963EE407)) | np.uint64(1)
    return (h[None, :] + np.arange(BLOOM_SET, dtype=np.uint64)[:, None] * step[None, :]) & np.uint64(bits - 1)


def bloom_filter(frequent: DataFrame, n: int) -> np.ndarray:
    """The bytes of a Bloom filter of the ``n`` rows of ``frequent`` (ids).  It
    has BLOOM_MAX bits at most, which is what reaches the driver and the tasks."""
    bits = 1 << min(int(math.log2(BLOOM_MAX)), max(13, (BLOOM_BITS * n).bit_length()))
    chunk = min(bits // 8, 1 << 16)

    def run(batches):
        own = np.zeros(bits // 8, dtype=np.uint8)
        for batch in batches:
            ids = batch.column(0)
            if len(ids):
                values = np.asarray(ids.flatten()).view(np.uint64).reshape(len(ids), -1)
                for place in _bloom_places(list(values.T), bits):
                    np.bitwise_or.at(own, (place >> np.uint64(3)).astype(np.int64),
                                     np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
        for i in range(0, len(own), chunk):
            if own[i:i + chunk].any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([own[i:i + chunk].tobytes()])],
                                                 names=["at", "bits"])

    def either(t: pa.Table) -> pa.Table:
        parts = [np.frombuffer(b, dtype=np.uint8) for b in t.column("bits").to_pylist()]
        return pa.table({"at": t.column("at")[:1], "bits": pa.array([np.bitwise_or.reduce(parts).tobytes()])})

    rows = (frequent.select("ids").coalesce(64).mapInArrow(tidy(run), "at bigint, bits binary")
            .groupBy("at").applyInArrow(either, "at bigint, bits binary").collect())
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in rows:
        out[r["at"]:r["at"] + chunk] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def passes(bloom: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    out = np.ones(len(words[0]), dtype=bool)
    for place in _bloom_places(words, 8 * len(bloom)):
        out &= (bloom[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & np.uint8(1)) > 0
    return out


def file_phrases(docs: DataFrame, n: int, shorter: np.ndarray, shard_bits: int, attempt: int = 0) -> DataFrame:
    """(shard, filter): counting quotient filters of the phrases of ``n``
    words of ``docs`` (lang, text) whose two parts of n - 1 words pass the
    Bloom filter ``shorter``."""
    shared = docs.sparkSession.sparkContext.broadcast(shorter)

    def grams(part, bloom):
        _, _, ids, joins, _ = word_ids(*binary_buffers(part.column(1)), _langs(part.column(0)), attempt)
        if len(ids) < n:
            return [ids[:0]] * n
        parts = len(ids) - n + 2
        ok = passes(bloom, [ids[j:j + parts] for j in range(n - 1)])
        for j in range(n - 2):
            ok &= joins[j:j + parts]
        at = np.flatnonzero(ok[:-1] & ok[1:] & joins[n - 2:n - 2 + parts - 1] & joins[:parts - 1])
        return [ids[at + j] for j in range(n)]

    def filed(held):
        keys = permute([np.concatenate(x) for x in zip(*held, strict=True)])
        keys, counts = fold(keys, np.ones(len(keys[0]), np.int64))
        shard = (keys[0] >> np.uint64(64 - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(counts), np.int64)
        cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else shard
        for low, high in zip(cuts, np.append(cuts[1:], len(counts)), strict=True):
            f = CountingQuotientFilter([k[low:high] for k in keys], counts[low:high], shard_bits)
            yield pa.RecordBatch.from_arrays([pa.array([shard[low]], pa.int64()), pa.array([f.to_bytes()])],
                                             names=["shard", "filter"])

    def run(batches):
        bloom, held, size = shared.value, [], 0
        for batch in batches:
            for part in text_slices(batch, 1, 4 << 20):
                held.append(grams(part, bloom))
                size += len(held[-1][0])
                if size >= GATHER:
                    yield from filed(held)
                    held, size = [], 0
        if size:
            yield from filed(held)

    return docs.select("lang", "text").mapInArrow(tidy(run), "shard bigint, filter binary")


def merged(filters: DataFrame, min_count: int) -> DataFrame:
    """(ids, n) of the phrases of all filters that occur ``min_count`` times."""
    def run(t: pa.Table) -> pa.Table:
        keys, counts = merge([CountingQuotientFilter.from_bytes(x.as_buffer()) for x in t.column("filter")])
        kept = counts >= min_count
        keys = restore([k[kept] for k in keys])
        ids = np.stack(keys, axis=1).reshape(-1).view(np.int64)
        offsets = np.arange(0, len(ids) + 1, len(keys), dtype=np.int32)
        return pa.table({"ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)), "n": pa.array(counts[kept])})

    return filters.groupBy("shard").applyInArrow(run, "ids array<bigint>, n bigint")


def _bits(rows: int) -> int:
    return max(0, -(-rows // SHARD) - 1).bit_length()


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", max_words: int = MAX_WORDS,
                 min_count: int = MIN_COUNT, top: int = TOP, covered: int = COVERED) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts (A-Z lower-cased) are cut at ``.,;:!?`` and line ends into pieces and
    at spaces and tabs into words; a phrase has 2 to ``max_words`` words
    of one piece and occurs a >= ``min_count`` times.  Cut in two, its parts
    occur l and r times; the cut of the lowest floor(1000000 a a / (l r)) gives
    its score (ties: the first).  n counts the language's words.  A phrase
    inside a longer one that has ``covered`` percent of its occurrences is left
    out.  Order: score and a descending, phrase.

    A null language is ``und``; null and empty texts have no words.  Repeated
    rows count each; ids are not read, nor any other column.  An empty table
    gives an empty result.
    """
    ship_code(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.col(text_col).cast("string").alias("text")).where("text is not null")
    for attempt in range(len(_BASES)):
        words = materialize(count_words(texts, attempt))
        if not words.groupBy("id").count().where("count > 1").head(1):
            break
    else:
        raise RuntimeError("two words share an id under every hash")
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    single = words.where(F.col("n") >= min_count)
    counts = single.select(F.array("id").alias("ids"), F.col("n").alias("f"), "lang", "word")
    levels, shorter = [], counts.select("ids", F.col("f").alias("n"))
    for n in range(2, max_words + 1):
        known = shorter.agg(F.count("*").alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("uses")).first()
        bloom = bloom_filter(shorter, known["rows"])
        shorter = materialize(merged(file_phrases(texts, n, bloom, _bits(known["uses"]), attempt), min_count))
        levels.append(shorter)
    none = F.lit(None).cast("string")
    for level in levels[:-1]:
        counts = counts.unionByName(level.select("ids", F.col("n").alias("f"), none.alias("lang"), none.alias("word")))
    phrases = levels[0]
    for level in levels[1:]:
        phrases = phrases.unionByName(level)
    phrases = phrases.withColumnsRenamed({"ids": "phrase_ids", "n": "a"})
    return _ranked(_scored(phrases, counts), phrases, sizes, top, covered)


def _scored(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """phrase_ids, a, lang, phrase, l, r, score of every phrase."""
    cuts = F.sequence(F.lit(1), F.size("phrase_ids") - 1)
    ask = lambda kind, k, ids: F.struct(F.lit(kind).alias("kind"), k.alias("k"), ids.alias("ids"))
    asked = F.concat(
        F.transform(F.col("phrase_ids"), lambda w, i: ask("word", i, F.array(w))),
        F.transform(cuts, lambda k: ask("left", k, F.slice("phrase_ids", F.lit(1), k))),
        F.transform(cuts, lambda k: ask("right", k, F.slice("phrase_ids", k + 1, F.size("phrase_ids") - k))))
    found = (phrases.select("phrase_ids", "a", F.explode(asked).alias("x")).select("phrase_ids", "a", "x.*")
             .join(counts, "ids"))
    # A handful of rows per phrase.
    held = found.groupBy("phrase_ids", "a").agg(
        F.max("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("kind", "k", "f", "word"))).alias("x"))
    of = lambda kind: F.filter("x", lambda y: y["kind"] == kind)
    whole = F.lit(1_000_000).cast("decimal(7,0)") * F.col("a").cast("decimal(15,0)") * F.col("a").cast("decimal(15,0)")
    cut = F.explode(F.arrays_zip(F.transform(of("left"), lambda y: y["f"]).alias("l"),
                                 F.transform(of("right"), lambda y: y["f"]).alias("r"), cuts.alias("k"))).alias("c")
    scored = (held.select("phrase_ids", "a", "lang", F.concat_ws(" ", F.transform(of("word"), lambda y: y["word"])).alias("phrase"), cut)
              .select("phrase_ids", "a", "lang", "phrase", "c.*").withColumn("whole", whole)
              .withColumn("score", F.expr("whole div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")))
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    return (scored.groupBy("phrase_ids", "a", "lang", "phrase").agg(best)
            .select("phrase_ids", "a", "lang", "phrase", "best.l", "best.r", "best.score"))


def _ranked(scored: DataFrame, phrases: DataFrame, sizes: DataFrame, top: int, covered: int) -> DataFrame:
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size("phrase_ids") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.size("phrase_ids") - n + 1), lambda i: F.slice("phrase_ids", i, n))))
    longer = (phrases.where(F.size("phrase_ids") > 2).select(F.explode(inner).alias("phrase_ids"), F.col("a").alias("longer"))
              .groupBy("phrase_ids").agg(F.max("longer").alias("longer")))
    kept = scored.join(longer, "phrase_ids", "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .join(sizes, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
