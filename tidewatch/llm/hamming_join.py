"""Near-duplicate detection: a multi-index Hamming join of MinHash signatures.

A document's shingle set has a signature of COMPONENTS b-bit MinHash values;
the distance of two signatures is the number of values that differ.
Signatures are cut into CHUNKS chunks.  By the pigeonhole principle, two
signatures within CHUNKS * (ERRORS + 1) - 1 differ in ERRORS values at most in
one chunk, so each chunk is filed once per choice of ERRORS values left out:
all pairs within that distance meet under a common key.

Keys shared by many documents are never expanded into all pairs.  Documents
with equal sets are one node; under each key, every node is compared to the
smallest one, and links are confirmed on the full sets.  What hangs together
by close pairs is a family; the components of a family are compared to each
other in blocks, set against set, and only links come out.  Nodes that share a
key but no family are compared signature against signature, and pairs within
reach are confirmed like the first ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import (binary_buffers, connected_components, materialize, mix64, text_key, text_slices, tidy,
                                  word_hashes, word_spans)

CHUNKS, CHUNK_VALUES, ERRORS = 10, 5, 1
COMPONENTS = CHUNKS * CHUNK_VALUES
#: Distance up to which every pair meets under a key.
CERTAIN = CHUNKS * (ERRORS + 1) - 1
#: Shingles of a block in which a family's sets are compared.
FAMILY_SHINGLES = 1_000_000
_rng = np.random.default_rng(20)
_MULTIPLIERS = _rng.integers(0, 1 << 63, COMPONENTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _rng.integers(0, 1 << 63, COMPONENTS, dtype=np.uint64)


def reach(similarity: float) -> int:
    """Signature distance that a pair of this similarity exceeds with a
    chance of less than one in a million (normal bound); pairs beyond it are
    not confirmed."""
    miss = 1.0 - similarity
    return int(np.ceil(COMPONENTS * miss + 5.0 * np.sqrt(COMPONENTS * miss * similarity)))


def shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Per document the sorted distinct hashes of its k-word shingles; with
    fewer words, the whole sequence is one; without words, none."""
    start, end, doc = word_spans(data, offsets)
    words = word_hashes(data, start, end)
    n_docs = len(offsets) - 1
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    chain = np.zeros(max(0, len(words) - k + 1), dtype=np.uint64)
    for j in range(k):
        chain = mix64(chain * np.uint64(0xA24BAED4963EE407) + words[j:j + len(chain)])
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= k:
            values = np.sort(chain[a:b - k + 1])
            out.append(values[np.append(True, values[1:] != values[:-1])])
        elif b > a:
            one = np.array([b - a], dtype=np.uint64)
            for w in words[a:b]:
                one = mix64(one * np.uint64(0x9FB21C651E98DF25) + w)
            out.append(one)
        else:
            out.append(words[:0])
    return out


def fingerprint(values: np.ndarray) -> bytes:
    """Size (4 bytes, big-endian) and 96 bits of a set; equal sets only."""
    total = int(np.add.reduce(mix64(values)))
    other = int(np.bitwise_xor.reduce(mix64(values * np.uint64(0xC2B2AE3D27D4EB4F))))
    return len(values).to_bytes(4, "big") + total.to_bytes(8, "big") + (other >> 32).to_bytes(4, "big")


def signature(values: np.ndarray) -> np.ndarray:
    """COMPONENTS 16-bit MinHash values."""
    low = np.full(COMPONENTS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(values), 4096):
        part = values[at:at + 4096, None] + _OFFSETS[None, :]
        part *= _MULTIPLIERS[None, :]
        np.minimum(low, part.min(axis=0), out=low)
    return (mix64(low) >> np.uint64(48)).astype(np.uint16)


def _fixed(data: np.ndarray, width: int) -> pa.Array:
    """A binary column of equally long values from their bytes."""
    n = data.nbytes // width
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(
        np.arange(0, (n + 1) * width, width, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _rows(column: pa.Array, width: int, dtype=np.uint8) -> np.ndarray:
    return binary_buffers(column)[0].reshape(-1, width).view(dtype)


def signatures(docs: DataFrame, k: int, id_col: str, text_col: str, texts: bool = False) -> DataFrame:
    """doc_id, n_shingles, fp, sig of each row (fp and sig null without words),
    with ``texts`` also its text_key."""
    extra, kind = (["text_key"], ", text_key bigint") if texts else ([], "")

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, 1):
                sets = shingles(*binary_buffers(part.column(1)), k)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([fingerprint(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                    *part.columns[2:]], names=["doc_id", "n_shingles", "fp", "sig", *extra])

    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                        *([text_key(text_col).alias("text_key")] if texts else []))
            .mapInArrow(tidy(run), "doc_id bigint, n_shingles bigint, fp binary, sig binary" + kind))


def chunk_keys(nodes: DataFrame) -> DataFrame:
    """(key, fp): a key per chunk and per choice of values left out."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                sig = _rows(part.column(1), 2 * COMPONENTS, np.uint16).astype(np.uint64)
                keys = np.empty((part.num_rows, COMPONENTS), dtype=np.uint64)
                for c in range(CHUNKS):
                    chunk = sig[:, c * CHUNK_VALUES:(c + 1) * CHUNK_VALUES]
                    for left_out in range(CHUNK_VALUES):
                        packed = np.zeros(part.num_rows, dtype=np.uint64)
                        for j in range(CHUNK_VALUES):
                            if j != left_out:
                                packed = (packed << np.uint64(16)) | chunk[:, j]
                        n = c * CHUNK_VALUES + left_out
                        keys[:, n] = mix64(mix64(packed) + mix64(np.array([n + 1], dtype=np.uint64)))
                fp = np.repeat(_rows(part.column(0), 16), COMPONENTS, axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.reshape(-1).view(np.int64)), _fixed(fp, 16)], names=["key", "fp"])

    return nodes.select("fp", "sig").mapInArrow(tidy(run), "key bigint, fp binary")


def set_size(fp: str) -> Column:
    return F.conv(F.hex(F.substring(fp, 1, 4)), 16, 10).cast("long")


def _sizes_allow(a: str, b: str, percent: int) -> Column:
    small, large = F.least(set_size(a), set_size(b)), F.greatest(set_size(a), set_size(b))
    return small * 100 >= large * percent


def _within(pairs: DataFrame, nodes: DataFrame, limit: int) -> DataFrame:
    """Pairs (a, b) whose signatures differ in ``limit`` values at most, with
    the documents that stand for either."""
    def run(batches):
        for batch in batches:
            apart = (_rows(batch.column(2), 2 * COMPONENTS, np.uint16)
                     != _rows(batch.column(3), 2 * COMPONENTS, np.uint16)).sum(axis=1)
            kept = batch.filter(pa.array(apart <= limit))
            yield pa.RecordBatch.from_arrays([kept.column(i) for i in (0, 1, 4, 5)], names=["a", "b", "doc_a", "doc_b"])

    side = lambda x: nodes.select(F.col("fp").alias(x), F.col("sig").alias(f"sig_{x}"), F.col("doc").alias(f"doc_{x}"))
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .select("a", "b", "sig_a", "sig_b", "doc_a", "doc_b")
            .mapInArrow(tidy(run), "a binary, b binary, doc_a bigint, doc_b bigint"))


def _texts(close: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(fp, text) of every node of some pairs."""
    need = (close.select(F.col("doc_a").alias("need"), F.col("a").alias("fp"))
            .unionByName(close.select(F.col("doc_b").alias("need"), F.col("b").alias("fp"))).distinct())
    return (docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).cast("string").alias("text"))
            .join(need, F.col("doc") == F.col("need")).select("fp", "text"))


def _linked(close: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs that are linked on their full sets."""
    def run(batches):
        last: tuple[bytes, bytes, np.ndarray] = (b"", b"", np.zeros(0, np.uint64))
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                a, b = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if a != last[0] or last[1] != a:
                    last = (a, *_set_of(batch.column(2), i, k))
                fp_b, other = _set_of(batch.column(3), i, k)
                both = len(np.intersect1d(last[2], other, assume_unique=True))
                # The fingerprints tell apart the texts of a repeated id.
                found.append((last[1], fp_b) == (a, b)
                             and 100 * both >= percent * (len(last[2]) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(found, pa.bool_()))

    text = lambda x: texts.select(F.col("fp").alias(x), F.col("text").alias(f"text_{x}"))
    return (close.select("a", "b").join(text("b"), "b").join(text("a"), "a")
            .select("a", "b", "text_a", "text_b").mapInArrow(tidy(run), "a binary, b binary").distinct())


def _family_links(members: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) between the components of a family, one at least for any
    two components that a link joins.  ``members``: family, blocks, fp, comp, text.

    A family is dealt to blocks of about FAMILY_SHINGLES shingles, and each
    pair of blocks is one task, which holds the sets of both and counts the
    intersections of one set with all others at a time.
    """
    dealt = (members.withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "fp", "comp", "text"))

    def run(t: pa.Table) -> pa.Table:
        fps, comps = t.column("fp").to_pylist(), t.column("comp").to_pylist()
        sets = shingles(*binary_buffers(t.column("text").combine_chunks()), k)
        own = [i for i, values in enumerate(sets) if len(values) and fingerprint(values) == fps[i]]
        number = {c: n for n, c in enumerate(sorted({comps[i] for i in own}))}
        comp = np.array([number[comps[i]] for i in own], dtype=np.int64)
        found = []
        if len(number) > 1:
            size = np.array([len(sets[i]) for i in own])
            ids = np.unique(np.concatenate([sets[i] for i in own]), return_inverse=True)[1]
            first = np.append(0, np.cumsum(size))
            largest = int(np.bincount(comp).argmax())
            hit = np.zeros(int(ids.max()) + 1, dtype=np.int32)
            for x in np.flatnonzero(comp != largest):
                mine = ids[first[x]:first[x + 1]]
                hit[mine] = 1
                both = np.add.reduceat(hit[ids], first[:-1])
                hit[mine] = 0
                ok = (comp != comp[x]) & (100 * both >= percent * (size + size[x] - both))
                at = np.flatnonzero(ok)
                found += [(fps[own[x]], fps[own[y]]) for y in at[np.unique(comp[at], return_index=True)[1]]]
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return dealt.groupBy("family", "i", "j").applyInArrow(run, "a binary, b binary")


def _set_of(column: pa.Array, i: int, k: int) -> tuple[bytes, np.ndarray]:
    values = shingles(*binary_buffers(column.slice(i, 1)), k)[0]
    return fingerprint(values), values


def _pairs_of_keys(rows: DataFrame, percent: int, limit: int) -> DataFrame:
    """(a, b) of nodes under one key in different families (comp), of fitting
    sizes and within reach.  ``rows``: key, fp, comp, sig."""
    def pairs(fp, comp, sig):
        size = fp[:, :4].astype(np.int64) @ np.array([1 << 24, 1 << 16, 1 << 8, 1])
        for low in range(0, len(fp), 256):
            own = slice(low, min(low + 256, len(fp)))
            apart = np.zeros((own.stop - low, len(fp) - low), dtype=np.uint8)
            for j in range(COMPONENTS):
                apart += sig[own, j][:, None] != sig[low:, j][None, :]
            ok = apart <= limit
            small = np.minimum(size[own][:, None], size[low:][None, :])
            ok &= 100 * small >= percent * np.maximum(size[own][:, None], size[low:][None, :])
            i, j = np.nonzero(ok)
            i, j = i[j > i] + low, j[j > i] + low
            differ = (comp[i] != comp[j]).any(axis=1)
            yield fp[i[differ]], fp[j[differ]]

    def run(batches):
        held: list[pa.Table] = []

        def out(t):
            key = np.asarray(t.column(0).combine_chunks())
            cuts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            fp, comp, sig = (_rows(t.column(n).combine_chunks(), w, d)
                             for n, w, d in ((1, 16, np.uint8), (2, 16, np.uint8), (3, 2 * COMPONENTS, np.uint16)))
            for a, b in zip(cuts, np.append(cuts[1:], len(key)), strict=True):
                for x, y in pairs(fp[a:b], comp[a:b], sig[a:b]):
                    if len(x):
                        yield pa.RecordBatch.from_arrays([_fixed(x, 16), _fixed(y, 16)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            # Hold rows back until their last key is complete.
            key = np.asarray(batch.column(0))
            cut = int(np.searchsorted(key, key[-1], side="left"))
            t = pa.Table.from_batches([batch])
            if cut == 0 and (not held or held[-1].column(0)[-1].as_py() == key[0]):
                held.append(t)
                continue
            yield from out(pa.concat_tables([*held, t.slice(0, cut)]))
            held = [t.slice(cut)]
        if held:
            yield from out(pa.concat_tables(held))

    pairs_ = (rows.repartition("key").sortWithinPartitions("key").select("key", "fp", "comp", "sig")
              .mapInArrow(tidy(run), "a binary, b binary"))
    return pairs_.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text", texts: bool = False) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Words are runs of characters other than space and 0x09-0x0D, A-Z
    lower-cased.  Documents are linked if their sets of k-word shingles have
    100 * intersection >= percent * union; component_id is the smallest id
    reachable.  Texts without words, null texts among them, are linked with
    nothing.  Rows with a null id take no part and are kept, with a null
    component; repeated ids are one node for each of their texts.  An empty
    table gives an empty result; other columns are not read.  With
    ``texts``, each row also has its text_key and its group: null without
    words or id, else equal for the texts that hang together.
    """
    limit = reach(percent / 100)
    signed = materialize(signatures(docs, k, id_col, text_col, texts))
    nodes = materialize(signed.where("doc_id is not null and fp is not null")
                        .groupBy("fp").agg(F.min("doc_id").alias("doc"), F.first("sig").alias("sig")))
    # Two different sets this similar have so many shingles in common.
    least = -(-percent // (100 - percent)) if percent < 100 else 1 << 40
    linkable = nodes.where(set_size("fp") >= least)
    shared = chunk_keys(linkable).groupBy("key").count().where("count > 1").select("key")
    filed = materialize(chunk_keys(linkable).join(shared, "key"))
    heads = filed.groupBy("key").agg(F.min("fp").alias("a"))
    star = materialize(filed.join(heads, "key").where(F.col("fp") != F.col("a"))
                       .select("a", F.col("fp").alias("b")).where(_sizes_allow("a", "b", percent)).distinct())
    close = materialize(_within(star, nodes, limit))
    sources = materialize(_texts(close, docs, id_col, text_col))
    links = materialize(_linked(close, sources, k, percent))
    # Families: what hangs together by close pairs, linked or not.
    families = materialize(connected_components(close).select(F.col("node").alias("fp"), F.col("component").alias("family")))
    comps = connected_components(links)
    members = materialize(families.join(comps, families.fp == comps.node, "left")
                          .select("fp", "family", F.coalesce("component", "fp").alias("comp")))
    split = (members.groupBy("family")
             .agg(F.min("comp").alias("x"), F.max("comp").alias("y"),
                  F.ceil(F.sum(set_size("fp")) / F.lit(FAMILY_SHINGLES)).cast("int").alias("blocks"))
             .where("x <> y").select("family", "blocks"))
    within = _family_links(members.join(split, "family").join(sources, "fp"), k, percent)
    # Nodes that share a key but no family.
    placed = (filed.join(families, "fp", "left").select("key", "fp", F.coalesce("family", "fp").alias("comp")))
    open_ = placed.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("key")
    rows = placed.join(open_, "key").join(nodes.select("fp", "sig"), "fp")
    far = _pairs_of_keys(rows, percent, limit).join(star, ["a", "b"], "left_anti")
    far = materialize(_within(far, nodes, limit))
    across = _linked(far, _texts(far, docs, id_col, text_col), k, percent)
    comps = connected_components(materialize(links.unionByName(within).unionByName(across)))
    named = nodes.select("fp", "doc").join(comps, nodes.fp == comps.node, "left").select(
        "fp", "doc", F.coalesce("component", "fp").alias("component"))
    lowest = named.groupBy("component").agg(F.min("doc").alias("component_id"))
    of_node = named.join(lowest, "component").select("fp", "component_id", "component")
    extra = ["text_key", F.expr("if(doc_id is null, null, component)").alias("group")] if texts else []
    return (signed.join(of_node, "fp", "left")
            .select("doc_id", "n_shingles", *extra,
                    F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component_id", "doc_id"))
                    .cast("bigint").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
