"""SentencePiece encoding and decoding as weighted finite-state transduction.

Three machines are compiled from a model file: the normaliser (a rewriting
transducer: the model's character map, blanks to U+2581, the leading blank),
the pieces (a trie whose final states write an id with a weight) and the byte
fallback (a character that no piece spells writes its bytes).  Composing them
with an input gives a lattice over its characters; the ids are those of its
shortest path in the tropical semiring (min, +).

For a unigram model the weights are the negated scores.  For a BPE model a
second acceptor is composed: it tells which two pieces may follow each other,
namely those whose characters the merge rules would not join across their
border.  Its forbidden pairs have the weight infinity, and the one path that
is left is the segmentation that the merges produce.

No piece reaches from another character to a U+2581, so the lattice falls
apart before each run of blanks; shortest paths of the parts are joined, and
parts that recur are looked up.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from tidewatch.llm.common import text_slices, tidy

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MAX_MODEL_BYTES = 64 << 20
BLANK = "▁"
#: Parts (in each of two generations) and pairs that a worker remembers.
MEMORY_PARTS, MEMORY_PAIRS = 200_000, 200_000
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0
UNKNOWN_TEXT = " ⁇ "


def _fields(data: bytes):
    """(number, value) of each field of a protocol-buffer message."""
    def number(at):
        value = shift = 0
        while True:
            byte = data[at]
            at, value, shift = at + 1, value | (byte & 127) << shift, shift + 7
            if byte < 128:
                return value, at
    at = 0
    while at < len(data):
        key, at = number(at)
        kind = key & 7
        if kind == 0:
            value, at = number(at)
        else:
            size, at = number(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at:at + size], at + size
        yield key >> 3, value


class CharacterMap:
    """The model's compiled character map: the longest key at a place is
    replaced.  Arcs are read from its double array as they are needed."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], dtype="<u4").tolist()
        self.texts = blob[4 + size:]
        self.known: dict[str, tuple[int, str]] = {}

    def longest(self, key: bytes) -> tuple[int, int]:
        """(bytes matched, place of the replacement), or (0, 0)."""
        units, found = self.units, (0, 0)
        step = lambda unit: (unit >> 10) << ((unit & 0x200) >> 6)
        at = step(units[0])
        for n, byte in enumerate(key):
            at ^= byte
            if at >= len(units) or units[at] & 0x800000FF != byte:
                break
            unit = units[at]
            at ^= step(unit)
            if unit & 0x100:
                found = (n + 1, units[at] & 0x7FFFFFFF)
        return found

    def apply(self, text: str) -> str:
        if not self.units:
            return text
        data, out, at = text.encode(), [], 0
        while at < len(data):
            n, place = self.longest(data[at:at + 64])
            if n:
                out.append(self.texts[place:self.texts.index(0, place)])
            else:
                first = data[at]
                n = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                out.append(data[at:at + n])
            at += n
        return b"".join(out).decode()


@dataclass
class Machines:
    """The compiled transducers of one model."""

    kind: int
    pieces: list[str]
    scores: list[float]
    types: list[int]
    character_map: CharacterMap
    leading_blank: bool = True
    squeeze: bool = False
    trie: dict = field(default_factory=dict)
    final: dict = field(default_factory=dict)
    bytes_ids: list = field(default_factory=list)

    def __post_init__(self):
        self.unknown = next((i for i, t in enumerate(self.types) if t == UNKNOWN), 0)
        usable = [s for s, t in zip(self.scores, self.types, strict=True) if t == NORMAL]
        self.fallback_weight = -(min(usable, default=0.0) - UNKNOWN_PENALTY)
        by_name = dict(zip(self.pieces, range(len(self.pieces)), strict=True))
        self.bytes_ids = [by_name.get(f"<0x{b:02X}>") for b in range(256)]
        self.has_bytes = all(i is not None and self.types[i] == BYTE for i in self.bytes_ids)
        for i, (piece, kind) in enumerate(zip(self.pieces, self.types, strict=True)):
            if kind in (NORMAL, USER) and piece:
                self.final[piece] = i
        self.merged = {p: self.scores[i] for p, i in self.final.items()}
        self.pairs: dict[tuple[str, str], bool] = {}
        for piece in self.final:
            # Pieces that merges cannot put together are on no path.
            if self.kind == BPE and self.merge(piece) != [piece]:
                continue
            node = self.trie
            for ch in piece:
                node = node.setdefault(ch, {})
            node[""] = piece
        # Parts are cut where no piece can lie across: before blanks here, and
        # between any two characters that no piece has side by side in ids().
        self.joined = {p[i:i + 2] for p in self.final for i in range(len(p) - 1)}
        self.separable = not any(a != BLANK and b == BLANK for p in self.final for a, b in zip(p, p[1:], strict=False))
        self.cut = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+" if self.separable else "(?s).+")
        self.memory = _Memory(self)

    # --- normaliser -------------------------------------------------------
    def normalise(self, text: str) -> str:
        text = self.character_map.apply(text)
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return ((BLANK if self.leading_blank else "") + text).replace(" ", BLANK)

    # --- merge rules as an acceptor of pairs ---------------------------------
    def merge(self, text: str) -> list[str]:
        """Segmentation of a short text by merges: best score, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best = max(((self.merged.get(a + b, -np.inf), -i) for i, (a, b) in
                        enumerate(zip(parts, parts[1:], strict=False))))
            if best[0] == -np.inf:
                break
            i = -best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def allowed(self, left: str, right: str) -> bool:
        """True if the merges of ``left + right`` stop at these two pieces."""
        known = self.pairs.get((left, right))
        if known is None:
            known = self.pairs[left, right] = self.merge(left + right) == [left, right]
            if len(self.pairs) > MEMORY_PAIRS:
                self.pairs.clear()
        return known

    # --- composition and shortest path ---------------------------------------
    def arcs(self, text: str, at: int) -> list[str]:
        """Surfaces of the lattice's arcs that leave ``at``, shortest first:
        pieces, and the bare character where no piece spells it alone."""
        node, end, out = self.trie, at, []
        while end < len(text) and (node := node.get(text[end])) is not None:
            end += 1
            piece = node.get("")
            if piece is not None:
                out.append(piece)
        if not out or len(out[0]) > 1:
            out.insert(0, text[at])
        return out

    def shortest(self, text: str) -> list[str]:
        return self._cheapest(text) if self.kind == UNIGRAM else self._only(text)

    def _cheapest(self, text: str) -> list[str]:
        """Surfaces along the path of least weight."""
        cost: list = [0.0] + [np.inf] * len(text)
        came: list = [""] * (len(text) + 1)
        for at in range(len(text)):
            for piece in self.arcs(text, at):
                total = cost[at] - self.merged.get(piece, -self.fallback_weight)
                if total < cost[at + len(piece)]:
                    cost[at + len(piece)], came[at + len(piece)] = total, piece
        out, at = [], len(text)
        while at:
            out.append(came[at])
            at -= len(came[at])
        return out[::-1]

    def _only(self, text: str) -> list[str]:
        """Surfaces along the one path whose pairs are all allowed.  A prefix
        of the text has one such path as well, so a place that leads nowhere
        is given up for good; longer pieces are tried first."""
        n, at, path, dead = len(text), 0, [], set()
        choices = [self.arcs(text, 0)]
        pairs = self.pairs
        while at < n:
            here = choices[-1]
            if not here:
                choices.pop()
                dead.add(at)
                at -= len(path.pop())
                continue
            piece = here.pop()
            end = at + len(piece)
            if end in dead:
                continue
            if path:
                pair = (path[-1], piece)
                ok = pairs.get(pair)
                if not (self.allowed(*pair) if ok is None else ok):
                    continue
            path.append(piece)
            at = end
            if at < n:
                choices.append(self.arcs(text, at))
        return path

    def ids(self, text: str) -> list[int]:
        """Ids of a part that no piece reaches out of; what is no piece falls
        back to bytes (without byte pieces: to one unknown for each run)."""
        out: list[int] = []
        for piece in self.shortest(text):
            i = self.final.get(piece)
            if i is not None:
                out.append(i)
            elif self.has_bytes:
                out += [self.bytes_ids[b] for b in piece.encode()]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def cuts(self, text: str) -> list[str]:
        """The text, cut wherever two neighbours are in no piece together.
        Without byte pieces runs of unknowns must stay together."""
        joined = self.joined
        at = [i for i in range(1, len(text)) if text[i - 1:i + 1] not in joined]
        if not at or not self.has_bytes:
            return [text]
        return [text[a:b] for a, b in zip([0, *at], [*at, len(text)], strict=True)]

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers."""
        memory = self.memory
        return b"".join([memory[part] for part in self.cut.findall(self.normalise(text))])

    @cached_property
    def inverse(self) -> "Inverse":
        return Inverse(self.pieces, self.types, self.leading_blank)

    def decode(self, ids) -> str:
        return self.inverse.decode(ids)


class Inverse:
    """The inverse transducer: what each id spells.  It needs neither the trie
    nor the pairs nor the memory of the machines above, and has none of them."""

    def __init__(self, pieces: list[str], types: list[int], leading_blank: bool = True):
        self.spelled = [self._spelling(piece, kind) for piece, kind in zip(pieces, types, strict=True)]
        self.leading_blank = leading_blank

    @staticmethod
    def _spelling(piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[1:-1], 16)])
        if kind == CONTROL:
            return b""
        return (UNKNOWN_TEXT if kind == UNKNOWN else piece.replace(BLANK, " ")).encode()

    def decode(self, ids) -> str:
        spelled = self.spelled
        text = b"".join([spelled[i] for i in ids]).decode("utf-8", errors="replace")
        return text[1:] if self.leading_blank and text.startswith(" ") else text


class _Memory(dict):
    """Ids of parts, in two generations: when the younger is full it becomes
    the older one, from which parts in use come back."""

    def __init__(self, machines: Machines):
        super().__init__()
        self.machines, self.older = machines, {}

    def forget(self) -> None:
        self.clear()
        self.older = {}

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            cuts = self.machines.cuts(part)
            if len(cuts) > 1:
                ids = b"".join([self[cut] for cut in cuts])
            else:
                ids = np.array(self.machines.ids(part), dtype="<i4").tobytes()
        if len(part) <= 64:
            if len(self) >= MEMORY_PARTS:
                self.older = dict(self)
                self.clear()
            self[part] = ids
        return ids


def _read_model(data: bytes) -> tuple[int, list[str], list[float], list[int], dict]:
    """(kind, pieces, scores, types, options of the normaliser) of a serialised model."""
    pieces, scores, types, kind = [], [], [], UNIGRAM
    options = {"character_map": CharacterMap(b""), "leading_blank": True, "squeeze": True}
    for number, value in _fields(data):
        if number == 1:
            entry = dict(_fields(value))
            pieces.append(entry.get(1, b"").decode())
            scores.append(struct.unpack("<f", entry[2])[0] if 2 in entry else 0.0)
            types.append(entry.get(3, NORMAL))
        elif number == 2:
            kind = dict(_fields(value)).get(3, UNIGRAM)
        elif number == 3:
            spec = dict(_fields(value))
            options = {"character_map": CharacterMap(spec.get(2, b"")), "leading_blank": bool(spec.get(3, 1)),
                       "squeeze": bool(spec.get(4, 1))}
            if not spec.get(5, 1):
                raise ValueError("models that keep blanks as they are are not supported")
    if kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    return kind, pieces, scores, types, options


def compile_model(data: bytes) -> Machines:
    """Compile the machines that encode from a serialised model."""
    kind, pieces, scores, types, options = _read_model(data)
    return Machines(kind, pieces, scores, types, **options)


def compile_inverse(data: bytes) -> Inverse:
    """Compile the inverse transducer from a serialised model."""
    _, pieces, _, types, options = _read_model(data)
    return Inverse(pieces, types, options["leading_blank"])


_compiled: dict[Callable, tuple[int, object]] = {}


def _once(compile_: Callable, data: bytes):
    """Compiled once per worker process."""
    key = hash(data)
    if _compiled.get(compile_, (None,))[0] != key:
        _compiled[compile_] = (key, compile_(data))
    return _compiled[compile_][1]


def load_model(path: str = MODEL_PATH) -> bytes:
    with open(path, "rb") as f:
        data = f.read(MAX_MODEL_BYTES + 1)
    if len(data) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MAX_MODEL_BYTES} bytes")
    return data


def _lists(parts: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(p) // 4 for p in parts)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), dtype="<i4")))


def encode_texts(docs: DataFrame, model: bytes, text_col: str = "text", keep: list[str] | None = None,
                 ids_col: str = "ids") -> DataFrame:
    """``keep`` (default: all columns but ``ids_col``) and the ids of each
    whole text.  Null and empty texts have no ids.  Rows are encoded one by
    one, so repeats and ties change nothing; an empty table stays empty."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != ids_col]
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        machines = _once(compile_model, shared.value)
        for batch in batches:
            for part in text_slices(batch, 1):
                texts = pc.fill_null(part.column(1), "").to_pylist()
                yield pa.RecordBatch.from_arrays([part.column(0), _lists([machines.encode(t) for t in texts])],
                                                 names=["row", "ids"])
        machines.memory.forget()  # workers are used again by other stages

    encoded = source.mapInArrow(tidy(run), source.select("row").schema.add("ids", ArrayType(IntegerType())))
    return encoded.select(*[F.col("row").getField(c).alias(c) for c in keep], F.col("ids").alias(ids_col))


def decode_ids(tokens: DataFrame, model: bytes, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """All columns of ``tokens`` but ``text_col``, and the text that the ids
    spell (null ids: null; ids outside the vocabulary are an error)."""
    keep = [c for c in tokens.columns if c != text_col]
    at = keep.index(ids_col)
    shared = tokens.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        inverse = _once(compile_inverse, shared.value)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = [None if ids is None else inverse.decode(ids) for ids in
                         (x.values.to_numpy(zero_copy_only=False).tolist() if x.is_valid else None
                          for x in part.column(at))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*keep, text_col])

    return tokens.select(*keep).mapInArrow(tidy(run), tokens.select(*keep).schema.add(text_col, "string"))


def tokenise(spark: SparkSession, docs: DataFrame, path: str = MODEL_PATH, keep: list[str] | None = None,
             text_col: str = "text") -> DataFrame:
    """``keep`` (default: all columns), ids, n_tokens and decoded of each
    document; columns of these three names are replaced, all others kept.

    Null and empty texts have no ids, 0 tokens and an empty decoded text.  Rows
    are encoded one by one: repeated rows, ids and ties change nothing, and an
    empty table stays empty."""
    model = load_model(path)
    return decode_ids(encode_texts(docs, model, text_col, keep), model).withColumn("n_tokens", F.size("ids"))
