"""Collocations, fill-in-middle and fingerprints against brute force."""
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import collocations, paragraph_sketch, queries, quotient_filter, skip_fim

SCHEMA = "doc_id long, lang string, text string, rank int, phrase string, id string, n string, output string, key int"


def words(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n)]


def frame(spark, rows):
    """Rows (doc_id, lang, text), with columns whose names the operators use."""
    return spark.createDataFrame([(d, g, t, 1, "x", "y", "z", "o", 7) for d, g, t in rows], SCHEMA).repartition(3)


def saved(spark, rows, path):
    frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    return str(path)


# --- collocations -----------------------------------------------------------

def brute_collocations(rows, top=2000, least=10, longest=3):
    count, total = {}, {}
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        text = (text or "").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)}))
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] = total.get(lang, 0) + len(w)
            for n in range(1, longest + 1):
                for i in range(len(w) - n + 1):
                    key = (lang, tuple(w[i:i + n]))
                    count[key] = count.get(key, 0) + 1
    found = {k: f for k, f in count.items() if len(k[1]) > 1 and f >= least}
    out = {}
    for (lang, w), a in found.items():
        if any(100 * f >= 50 * a for (g, v), f in found.items() if g == lang and len(v) > len(w)
               and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1))):
            continue
        cuts = [(10 ** 6 * a * a // (count[lang, w[:k]] * count[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), count[lang, w[:k]], count[lang, w[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, x, y, total[lang], -s) for lang, rows in out.items()
                  for i, (s, a, p, x, y) in enumerate(sorted(rows)[:top]))


def phrase_rows():
    rng = random.Random(4)
    vocabulary = words(30, 1) + ["É", "über", "ÀB", "Q", "x" * 300, "X" * 300]
    rows = []
    for i in range(150):
        text = ""
        for _ in range(rng.randint(0, 60)):
            text += rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\v", "\x1c "])
        rows.append((i, rng.choice(["en", "en", "fr", None, "und"]), text))
    rows += [(200 + i, "en", "New York City is new york CITY; new york") for i in range(12)]
    rows += [(300, "en", None), (301, "fr", ""), (302, "fr", " .,\n"), (None, "fr", "same words again"), rows[3], rows[3]]
    return rows + [(400 + i, "de", "das das das das") for i in range(6)]


def test_collocations_equal_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(collocations, "GATHER", 300)  # many filters a task
    monkeypatch.setattr(collocations, "SHARD", 200)  # and many shards
    rows = phrase_rows()
    got = queries.op11_collocations(spark, saved(spark, rows, tmp_path)).collect()
    assert sorted(tuple(r) for r in got) == brute_collocations(rows)
    assert [c for c in got[0].asDict()] == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_longer_phrases_and_short_reports(spark):
    rows = phrase_rows()
    got = collocations.collocations(frame(spark, rows), max_words=4, min_count=6, top=5).collect()
    assert sorted(tuple(r) for r in got) == brute_collocations(rows, 5, 6, 4)


def test_collocations_of_empty_tables(spark):
    assert collocations.collocations(frame(spark, [])).count() == 0
    assert collocations.collocations(frame(spark, [(1, "en", None), (2, None, "one two")])).count() == 0


def test_words_that_share_an_id_are_told_apart(spark, monkeypatch):
    plain = collocations.word_ids

    def colliding(data, offsets, langs, attempt):
        start, end, ids, joins, text = plain(data, offsets, langs, attempt)
        return start, end, ids % np.uint64(50) if attempt < 2 else ids, joins, text
    monkeypatch.setattr(collocations, "word_ids", colliding)
    rows = phrase_rows()
    got = collocations.collocations(frame(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == brute_collocations(rows)


@pytest.mark.parametrize("width", [1, 2, 3])
@pytest.mark.parametrize("n", [0, 1, 2, 60, 3000])
def test_filters_are_lossless_and_merge(width, n):
    rng = np.random.default_rng(n + width)
    keys = [rng.integers(0, 40, n, dtype=np.uint64) for _ in range(width)]
    weights = rng.integers(1, 400, n)
    permuted = quotient_filter.permute(keys)
    assert all((a == b).all() for a, b in zip(keys, quotient_filter.restore(permuted), strict=True))
    want = {}
    for k, w in zip(zip(*(x.tolist() for x in keys), strict=True), weights.tolist(), strict=True):
        want[k] = want.get(k, 0) + w
    half = n // 2
    for shard_bits in (0, 2):
        got = {}
        for shard in range(1 << shard_bits):
            filters = []
            for part in (slice(0, half), slice(half, n)):
                k, c = quotient_filter.fold([p[part] for p in permuted], weights[part])
                own = k[0] >> np.uint64(64 - shard_bits) == shard if shard_bits else np.ones(len(c), bool)
                made = quotient_filter.CountingQuotientFilter([x[own] for x in k], c[own], shard_bits)
                read = quotient_filter.CountingQuotientFilter.from_bytes(made.to_bytes())
                again, counts = read.items()
                assert all((x[own] == y).all() for x, y in zip(k, again, strict=True)) and (c[own] == counts).all()
                for i in range(len(counts)):
                    assert read.count([int(x[i]) for x in again]) == counts[i]
                assert read.count([(shard << 62 if shard_bits else 0) + 5] * width) == 0
                filters.append(read)
            k, c = quotient_filter.merge(filters)
            got.update(zip(zip(*(x.tolist() for x in quotient_filter.restore(k)), strict=True), c.tolist(), strict=True))
        assert got == want


def test_equal_first_words_of_different_keys():
    first = np.array([7, 7, 7, 7, 9], dtype=np.uint64)
    second = np.array([2, 1, 2, 1, 1], dtype=np.uint64)
    keys, counts = quotient_filter.fold([first, second], np.ones(5, np.int64))
    assert list(zip(keys[0].tolist(), keys[1].tolist(), counts.tolist())) == [(7, 1, 2), (7, 2, 2), (9, 1, 1)]
    again, counts = quotient_filter.CountingQuotientFilter(keys, counts).items()
    assert again[1].tolist() == [1, 2, 1] and counts.tolist() == [2, 2, 1]


# --- fill in the middle -------------------------------------------------------

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute_middle(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    t = TOKEN.findall(text)
    low, high = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return (doc_id, len(t), "plain", None, None, digest(text), digest(text))
    p, m, s = "".join(t[:low]), "".join(t[low:high]), "".join(t[high:])
    form = "spm" if h4 % 100 < 80 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return (doc_id, len(t), form, len(p), len(m), digest(out), digest(text))


def middle_rows():
    rng = random.Random(2)
    rows = [(i, "en", "".join(rng.choice(["a", "é", "日本", "𝒳y", "<", "P>", " ", "  ", "\n", "\x1c", " ", "S", ">"])
                              for _ in range(rng.choice([0, 1, 2, 5, 30, 200])))) for i in range(300)]
    rows += [(400 + i, "en", x) for x in ("<P>", "a <M> b", "x<S>y", "   ", "\t", "w", " w", "w ") for i in range(8)]
    return rows + [(None, "en", "null id here"), (900, None, None), rows[7], rows[7],
                   (901, "en", " ".join(words(200_000, 5))), (902, "en", "é" * 500_000), (903, "en", " " * 300_000)]


def test_fill_in_middle_equals_brute_force(spark, tmp_path):
    rows = middle_rows()
    got = queries.op12_fill_in_middle(spark, saved(spark, rows, tmp_path)).collect()
    want = [brute_middle(d, t) for d, _, t in rows]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
    assert {r.form for r in got} == {"plain", "spm", "psm"}


def test_options_and_empty_tables(spark):
    assert skip_fim.fill_in_middle(frame(spark, [])).count() == 0
    rows = [(i, "en", "one two  three\nfour ") for i in range(40)]
    made = skip_fim.fill_in_middle(frame(spark, rows), seed=7, rate=100, suffix_first=0)
    got = made.select("form", skip_fim.restored(F.col("output"), F.col("form")).alias("text"), "output").collect()
    assert {r.form for r in got} == {"psm"} and {r.text for r in got} == {rows[0][2]}
    assert len({r.output for r in got}) > 10


def test_offsets_of_the_skip_list():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 17, 400, 30_000):
        widths = rng.integers(1, 30, n)
        units = skip_fim.SkipList(widths, n)
        before = np.append(0, np.cumsum(widths))
        for r in {0, n, n // 2, n // 3, max(0, n - 1)}:
            assert units.offset(r) == before[r]
        for lane in units.lanes:
            assert lane.units.sum() == n and lane.chars.sum() == before[-1]
        assert n < 100 or len(units.lanes) > 2
    with pytest.raises(IndexError):
        units.offset(n + 1)


# --- fingerprints ---------------------------------------------------------------

def version_rows():
    rows = [(3 * i, "en", "\n".join(" ".join(words(12, 100 * i + j)) for j in range(1 + i % 9))) for i in range(60)]
    rows[20] = (60, "en", rows[19][2].replace(rows[19][2].split()[3], "other", 1))  # a near copy
    rows[31] = (93, "en", rows[30][2])  # an exact one
    rows += [(1000, "en", "é日 " * 9 + "𝒳"), (1001, "en", ""), (1002, "en", None), (1003, "en", " \n"), (1004, "en", "w"),
             (1005, "en", " ".join(words(30_000, 8))), (1006, "en", " ".join(words(30_000, 9))),
             (1007, "en", "same line\n" * 3000), (1008, "en", "same line\n" * 2999 + "other line")]
    random.Random(6).shuffle(rows)
    return rows


def pieces(text):
    digest, _ = paragraph_sketch.paragraphs(np.frombuffer(text.encode(), dtype=np.uint8),
                                            np.array([0, len(text.encode())]))
    assert len(set(digest.tolist())) == len(digest)
    return set(digest.tolist())


def near(a, b):
    a, b = pieces(a), pieces(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def check_versions(got, rows):
    rows = sorted(((d, t or "") for d, _, t in rows))
    assert len(got) == len(rows)
    of = {r.doc_id: r for r in got}
    for i, (d, t) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        gone = len(t) // 4
        edited = t[:len(t) - gone] + following[:gone]
        r = of[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(near(t, edited)) and r.near_next == pytest.approx(near(t, following))
        if t == following:
            assert r.fingerprint == of[rows[(i + 1) % len(rows)][0]].fingerprint and r.near_next == 1.0
        assert (r.fingerprint == r.edited_fingerprint) or t != edited


def test_versions_equal_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(paragraph_sketch, "BUCKET_BYTES", 20_000)
    rows = version_rows()
    got = queries.op13_fingerprints(spark, saved(spark, rows, tmp_path)).collect()
    check_versions(got, rows)
    long = [r for r in got if r.n_chars > 300]
    assert np.mean([r.near_edited for r in long]) > 0.5 and np.median([r.near_next for r in long]) < 0.1
    near_copy = next(r for r in got if r.doc_id == 57)
    assert near_copy.near_next > 0.7


def test_order_of_null_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(paragraph_sketch, "BUCKET_BYTES", 100)
    rows = [(None, "en", f"null {i} " + "x" * i) for i in range(50)] + [(5, "en", "five"), (5, "en", "five b"), (5, "en", "five"),
            (1, "en", "one"), (9, "en", None), (-4, "en", "minus")]
    got = paragraph_sketch.successors(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in got if r.doc_id) == sorted((d, t or "") for d, _, t in rows if d)
    assert sorted(r.text for r in got) == sorted(r.next_text for r in got)  # one cycle over all rows
    follows = {r.text: r.next_text for r in got if r.doc_id not in (5,)}
    assert follows["minus"] == "one" and follows["one"] in ("five", "five b") and follows[""].startswith("null")
    assert sum(r.next_text == "minus" and r.text.startswith("null") for r in got) == 1


def test_single_rows_and_empty_tables(spark):
    assert paragraph_sketch.fingerprints(frame(spark, [])).count() == 0
    (one,) = paragraph_sketch.fingerprints(frame(spark, [(1, "en", "abcd efgh")])).collect()
    assert one.edited == "abcd efab" and one.near_next == 1.0
    (one,) = paragraph_sketch.fingerprints(frame(spark, [(None, None, None)])).collect()
    assert one.near_edited == one.near_next == 1.0


def test_peeling_recovers_what_differs():
    a = " ".join(words(400, 1))
    b = a.replace(words(400, 1)[50], "changed", 1)
    sketch = lambda text: paragraph_sketch.encode(paragraph_sketch.sketches(
        np.array(sorted(pieces(text)), dtype=np.uint64), np.zeros(len(pieces(text)), np.int64), 1))[0]
    assert paragraph_sketch.recover(sketch(a), sketch(b)) == (sorted(pieces(a) - pieces(b)), sorted(pieces(b) - pieces(a)))
    assert paragraph_sketch.recover(sketch(a), sketch(" ".join(words(400, 2)))) is None
    assert paragraph_sketch.recover(sketch(a), sketch(a)) == ([], [])
