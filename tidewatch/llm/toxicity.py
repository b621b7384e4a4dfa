"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary
labelled text.  A dictionary holds what sets its class apart: word prefixes
that recur in the class's documents and hardly occur in the other's, most
telling ones last (zstandard codes near content cheapest).  Each text is cut
into windows of a few words; every window is compressed with either
dictionary, and the difference of the two lengths is looked up among
thresholds calibrated on the training windows.  A logistic model, calibrated
likewise, turns a text's window evidence into a score.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import give_back, text_slices, tidy

#: Bound of the training sample: labelled documents of each class, in hash
#: order of their ids.
MAX_TRAIN_DOCS = 3000
WINDOW_BYTES = 47
#: Bytes of the shortest match the compressors look for; a shorter entry of a
#: dictionary would never be found.
MIN_MATCH = 5
#: Bytes of a telling prefix, the space before its word included.  Short ones
#: match ordinary words by chance; the rest of a longer one adds only chance matches.
PREFIX = (MIN_MATCH, 7)
MIN_DOCS, MIN_SHARE, MIN_Z, MIN_RATIO = 3, 0.015, 4.0, 8.0
LOW, HIGH = -6, 18

#: Both dictionaries end in this run, and each window starts with it: the
#: fixed cost of a compressed block is then the same for all windows.
_MARK = bytes([1, 2, 3, 4, 5, 6, 7, 11, 12, 14, 15, 16, 17, 18, 19, 20])
#: zstandard looks for no match in the last bytes of its input; each window
#: ends in these, which neither dictionary has.
_TAIL = bytes([21, 22, 23, 24, 25, 26, 27, 28])
_FILL = bytes([29])
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_CUT = re.compile(rb".{1,%d}(?= |$)|.{%d}" % (WINDOW_BYTES, WINDOW_BYTES + 1), re.S)


def words(text: bytes) -> list[bytes]:
    """Letters A-Z lower-cased, other ASCII characters as separators.  Words
    are filled up so that each makes a match with the spaces around it."""
    return [w if len(w) >= MIN_MATCH - 2 else w.ljust(MIN_MATCH - 2, _FILL) for w in text.translate(_FOLD).split()]


def windows(text: bytes) -> list[bytes]:
    """The whole text in windows of up to WINDOW_BYTES bytes, cut at spaces
    (inside a word only if it alone is longer)."""
    folded = b" ".join(words(text))
    return [_MARK + w + b" " + _TAIL for w in _CUT.findall(b" " + folded)] if folded else []


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    evidence: np.ndarray = field(default_factory=lambda: np.zeros(HIGH - LOW + 1))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(4))

    def compressors(self):
        """(ordinary, toxic): compressors with the dictionaries loaded once."""
        params = zstandard.ZstdCompressionParameters.from_level(
            5, strategy=zstandard.STRATEGY_GREEDY, min_match=MIN_MATCH, window_log=12, hash_log=10, chain_log=10,
            write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
        out = []
        for content in (self.ordinary, self.toxic):
            known = zstandard.ZstdCompressionDict(content + _MARK, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(compression_params=params)
            out.append(zstandard.ZstdCompressor(dict_data=known, compression_params=params))
        return out

    def gains(self, text: bytes, pair) -> np.ndarray:
        """Per window: bytes that the toxic dictionary saves over the other."""
        ordinary, toxic = pair[0].compress, pair[1].compress
        diff = [len(ordinary(w)) - len(toxic(w)) for w in windows(text)]
        return np.clip(np.array(diff, dtype=np.int64), LOW, HIGH) - LOW

    def features(self, gains: np.ndarray) -> np.ndarray:
        """Bias, evidence for, strongest evidence, share of telling windows."""
        e = self.evidence[gains]
        up = np.maximum(e - 1.0, 0.0)
        return np.array([1.0, min(float(up.sum()), 12.0), float(up.max(initial=0.0)),
                         10.0 * float(up.sum()) / (len(e) + 10.0)])

    def score(self, text: bytes | None, pair) -> float:
        z = float(self.weights @ self.features(self.gains(text or b"", pair)))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def _telling(own: Counter, other: Counter, n_own: int, n_other: int) -> list[bytes]:
    """Word prefixes that set a class apart, weakest first: the shortest such
    prefix of a family, carried on while one continuation has nearly all."""
    def apart(prefix: bytes, docs: int) -> bool:
        there = other.get(prefix, 0)
        p, q = docs / n_own, there / max(1, n_other)
        if docs < MIN_DOCS or p < MIN_SHARE or p < MIN_RATIO * (there + 0.5) / max(1, n_other):
            return False
        mean = (docs + there + 1) / (n_own + n_other + 2)
        return p - q >= MIN_Z * math.sqrt(mean * (1 - mean) * (1 / n_own + 1 / max(1, n_other)))

    pure = {p for p, docs in own.items() if apart(p, docs)}
    longer = defaultdict(list)
    for p in pure:
        longer[p[:-1]].append(p)
    out = []
    for p in (p for p in pure if p[:-1] not in pure):
        while (follow := max(longer.get(p, ()), key=lambda x: (own[x], x), default=None)) and own[follow] >= 0.9 * own[p]:
            p = follow
        out.append(p)
    return sorted(out, key=lambda p: (own[p], p))


def fit(samples: list[tuple[bytes, int]]) -> Model:
    """Train from (text, label) pairs; without both classes, every score is
    the share of label 1 (one half without any sample)."""
    docs, counts, seen = [0, 0], [Counter(), Counter()], set()
    for text, label in samples:
        distinct = set(words(text))  # of one text at a time: all of them take many times the texts' own bytes
        if not distinct:
            continue
        # Near copies count once: they share the smallest hashes of their words.
        sketch = tuple(min(zlib.crc32(w, seed) for w in distinct) for seed in (1, 2, 3))
        if sketch in seen:
            continue
        seen.add(sketch)
        prefixes = {w[:n] for w in (b" " + x + b" " for x in distinct) for n in range(PREFIX[0], min(len(w), PREFIX[1]) + 1)}
        docs[label] += 1
        counts[label].update(prefixes)
    y = np.array([label for _, label in samples], dtype=float)
    if not docs[0] or not docs[1]:
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(b"", b"", weights=np.array([math.log(share / (1 - share)), 0.0, 0.0, 0.0]))
    model = Model(b"".join(_telling(counts[1], counts[0], docs[1], docs[0])),
                  b"".join(_telling(counts[0], counts[1], docs[0], docs[1])))
    pair = model.compressors()
    gains = [model.gains(text, pair) for text, _ in samples]
    held = np.full((2, HIGH - LOW + 1), 0.5)
    for g, (_, label) in zip(gains, samples, strict=True):
        held[label] += np.bincount(g, minlength=HIGH - LOW + 1)
    # Thresholds: log odds of a window by its difference, made monotone.
    odds = np.log(held[1] / held[1].sum()) - np.log(held[0] / held[0].sum())
    model.evidence = _monotone(odds, held.sum(axis=0))
    x = np.array([model.features(g) for g in gains])
    model.weights = _logistic(x, y)
    return model


def _monotone(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Isotonic regression: pool neighbours that fall."""
    blocks: list[list[float]] = []
    for v, w in zip(values, weights, strict=True):
        blocks.append([float(v), float(w), 1])
        while len(blocks) > 1 and blocks[-2][0] > blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(n, v) for v, _, n in blocks])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)),
                               x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def held_out(id_col: str) -> Column:
    """True for ids whose crc32 (of the id as text) is a multiple of 5; a
    null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_docs: int = MAX_TRAIN_DOCS) -> Model:
    """Fit on labelled rows outside the held-out fold: at most ``max_docs``
    of each class, the ids picked by hash order from ``labels`` alone."""
    open_ = labels.where(~held_out(id_col)).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
    order = F.xxhash64("_id")
    picked = None
    for label in (0, 1):
        part = open_.where(F.col("_label") == label).orderBy(order, "_id").limit(max_docs)
        picked = part if picked is None else picked.unionByName(part)
    rows = (docs.select(F.col(id_col).alias("_doc"), F.col(text_col).cast("string").alias("_text"))
            .join(F.broadcast(picked), F.col("_doc") == F.col("_id"))
            .select("_text", "_label").where("_text is not null").limit(4 * max_docs).collect())
    samples = sorted((r["_text"].encode(), r["_label"]) for r in rows)
    del rows
    try:
        return fit(samples)
    finally:
        del samples
        give_back()


def score_texts(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score",
                keep: list[str] | None = None) -> DataFrame:
    """``docs`` with a score from 0 to 1 for each whole text (null and empty
    texts have the score of a text without windows).  Only the text is read;
    a column of the score's name is replaced."""
    cols = [c for c in (docs.columns if keep is None else keep) if c != score_col]
    schema = docs.select(*cols).schema
    at = cols.index(text_col) if text_col in cols else None
    source = docs.select(*cols) if at is not None else docs.select(*cols, F.col(text_col).alias("_text"))
    at = len(cols) if at is None else at
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        known = shared.value
        pair = known.compressors()
        for batch in batches:
            for part in text_slices(batch, at, 8 << 20):
                text = part.column(at).cast(pa.large_binary())
                scores = [known.score(text[i].as_buffer().to_pybytes() if text[i].is_valid else b"", pair)
                          for i in range(len(text))]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(cols)], pa.array(scores, pa.float64())], names=[*cols, score_col])

    return source.mapInArrow(tidy(run), schema.add(score_col, "double"))
