"""Suffix-sorted removal, near duplicates and recurring passages against brute force."""
import hashlib
import random
import re
import uuid

import numpy as np
import pyarrow as pa
import pytest

from tidewatch.llm import chain_dedup, hamming_join, induced_sorting, suffix_dedup

SCHEMA = "doc_id long, text string, row int, key string, fp string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n)]


def frame(spark, rows):
    """Rows (doc_id, text), with columns whose names the operators use inside."""
    return spark.createDataFrame([(d, t, 1, "x", "y") for d, t in rows], SCHEMA).repartition(3)


# --- suffix sorting -------------------------------------------------------

@pytest.mark.parametrize("memory,in_range", [(1 << 20, 1 << 20), (7, 1 << 20), (1 << 20, 3), (5, 4)])
def test_suffix_array_is_sorted(monkeypatch, memory, in_range):
    monkeypatch.setattr(induced_sorting, "RANGE_TUPLES", in_range)
    rng = np.random.default_rng(3)
    for n in [0, 1, 2, 3, *rng.integers(4, 90, 120)]:
        text = np.append(rng.integers(1, int(rng.integers(2, 30)), n), 0).astype(np.int32)
        plain = text.tolist()
        assert induced_sorting.suffix_array(text, memory=memory).tolist() == sorted(
            range(len(plain)), key=lambda i: plain[i:])


def test_suffix_array_of_long_runs():
    for plain in ([1] * 500 + [0], [2, 1] * 300 + [0], [3] * 200 + [1] * 200 + [2] * 200 + [0]):
        assert induced_sorting.suffix_array(np.array(plain)).tolist() == sorted(
            range(len(plain)), key=lambda i: plain[i:])


def brute_removal(rows, match=200):
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = {}
    for _, b in data:
        for i in range(len(b) - match + 1):
            seen[b[i:i + match]] = seen.get(b[i:i + match], 0) + 1
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - match + 1):
            if seen[b[i:i + match]] > 1:
                gone[i:i + match] = b"\1" * match
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_removal_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 2000)  # several shards, and cut minimizers
    base = " ".join(words(120, 1))
    other = " ".join(words(100, 2)) + " é日本"
    rows = [(1, base), (2, base[:300] + "X" + base[301:]), (3, other + base[100:350]), (4, other), (4, other),
            (5, None), (6, ""), (7, "a" * 199), (8, "a" * 201), (9, "ab" * 400), (None, base[50:260]),
            (10, " ".join(words(60, 9))), (11, other[:210]), (12, "z" * 200)]
    rows += [(100 + i, base[:250] + " ".join(words(20, 50 + i)) + base[250:470]) for i in range(12)]
    got = suffix_dedup.remove_repeats(frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_removal(rows)


def test_no_shard_grows_with_a_hot_minimizer(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 4000)
    plain, log = suffix_dedup._sort_shard, str(tmp_path)

    def logged(t: pa.Table) -> pa.Table:
        # A closure, so that workers get it by value.
        with open(f"{log}/{uuid.uuid4().hex}", "w") as out:
            out.write(str(sum(len(x) for x in t.column("text").to_pylist())))
        return plain(t)
    monkeypatch.setattr(suffix_dedup, "_sort_shard", logged)
    line = " ".join(words(60, 3))
    rows = [(i, " ".join(words(30, 100 + i)) + line[:150] + " ".join(words(60, 500 + i))) for i in range(200)]
    rows += [(300 + i, " ".join(words(30, 900 + i)) + line[:220] + " ".join(words(60, 950 + i))) for i in range(40)]
    rows += [rows[0], rows[210]]
    got = suffix_dedup.remove_repeats(frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_removal(rows)
    sizes = [int(f.read_text()) for f in tmp_path.iterdir()]
    assert sizes and max(sizes) < 10 * 4000


def test_removal_keeps_text_and_handles_empty_tables(spark):
    line = "x" + " ".join(words(80, 4))
    rows = [(1, line + "tail"), (2, line)]
    got = {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(frame(spark, rows), keep_text=True).collect()}
    assert got == {1: b"tail", 2: b""}
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0


# --- near duplicates --------------------------------------------------------

def brute_components(rows, k, percent):
    sets = []
    for d, t in rows:
        w = [x for x in WORD.findall((t or "").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})))]
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()})
    parent = {d: d for d, _ in rows if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, (d, _) in enumerate(rows):
        for j in range(i):
            e = rows[j][0]
            if d is None or e is None or not sets[i] or not sets[j]:
                continue
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
    out = []
    for (d, _), s in zip(rows, sets):
        c = None if d is None else find(d)
        out.append((d, len(s), c, c == d))
    return sorted(out, key=str)


def edited(base, seed, share):
    rng = random.Random(seed)
    return " ".join(w if rng.random() > share else f"q{rng.randrange(10 ** 6)}" for w in base)


@pytest.fixture(scope="module")
def families():
    rows, n = [], 0
    for f, (size, share) in enumerate([(25, 0.03), (40, 0.07), (6, 0.0), (30, 0.09)]):
        base = words(150, 100 + f)
        rows += [(n + i, edited(base, 1000 * f + i, share)) for i in range(size)]
        n += size
    rows += [(n + i, " ".join(words(40, 5000 + i))) for i in range(20)]
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "ONE"), (905, "a b c d"), (906, "a b c d"),
             (907, "a b c d e"), (None, rows[0][1]), (None, None), (908, rows[0][1]), (908, "something else here")]
    random.Random(1).shuffle(rows)
    return rows


@pytest.mark.parametrize("k,percent", [(2, 80), (5, 80)])
def test_components_equal_brute_force(spark, families, k, percent):
    rows = [r for r in families if r != (908, "something else here")]
    got = hamming_join.near_duplicates(frame(spark, rows), k, percent).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(rows, k, percent)


def test_components_in_many_blocks(spark, families, monkeypatch):
    monkeypatch.setattr(hamming_join, "FAMILY_SHINGLES", 700)
    rows = [r for r in families if r[0] is not None and r[0] != 908]
    got = hamming_join.near_duplicates(frame(spark, rows), 2, 80).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(rows, 2, 80)


def test_near_duplicates_of_empty_table_and_repeated_ids(spark, families):
    assert hamming_join.near_duplicates(frame(spark, [])).count() == 0
    got = hamming_join.near_duplicates(frame(spark, families), 2).where("doc_id = 908").collect()
    assert len(got) == 2


def test_pairs_within_the_certain_distance_share_a_key(spark):
    rng = np.random.default_rng(5)
    sig = rng.integers(0, 1 << 16, (1, hamming_join.COMPONENTS), dtype=np.uint16).repeat(200, axis=0)
    for i in range(1, 200):
        at = rng.choice(hamming_join.COMPONENTS, hamming_join.CERTAIN, replace=False)
        sig[i, at] ^= rng.integers(1, 1 << 16, len(at), dtype=np.uint16)
    rows = [(bytearray(i.to_bytes(16, "big")), bytearray(s.tobytes())) for i, s in enumerate(sig)]
    keys = hamming_join.chunk_keys(spark.createDataFrame(rows, "fp binary, sig binary")).collect()
    of = {}
    for r in keys:
        of.setdefault(int.from_bytes(r.fp, "big"), set()).add(r.key)
    assert all(of[0] & of[i] for i in range(1, 200))


def test_pairs_of_keys_streams_groups(spark):
    rng = np.random.default_rng(6)
    sig = rng.integers(0, 1 << 16, (6, hamming_join.COMPONENTS), dtype=np.uint16)
    sig[1], sig[2], sig[4] = sig[0], sig[0], sig[3]
    fp = [(10).to_bytes(4, "big") + i.to_bytes(12, "big") for i in range(6)]
    rows = [(7, bytearray(fp[i]), bytearray(fp[0 if i == 1 else i]), bytearray(sig[i].tobytes())) for i in range(6)]
    rows += [(8, *rows[i][1:]) for i in (0, 3, 4)]
    got = hamming_join._pairs_of_keys(spark.createDataFrame(rows, "key long, fp binary, comp binary, sig binary"), 80, 25)
    assert {(bytes(r.a), bytes(r.b)) for r in got.collect()} == {(fp[0], fp[2]), (fp[1], fp[2]), (fp[3], fp[4])}


# --- recurring passages -------------------------------------------------------

def covered(got):
    out = {}
    for r in got:
        out.setdefault(r.doc_id, set()).update(range(r.passage_start, r.passage_end))
    return out


def test_planted_passages_are_found_and_clean_documents_left_alone(spark):
    passage, fuzzy = words(60, 1), words(90, 2)
    rows = [(i, " ".join(words(80, 10 + i) + passage + words(50, 60 + i))) for i in range(6)]
    edited_fuzzy = [w if i % 15 else "edit" for i, w in enumerate(fuzzy)]
    rows += [(20, " ".join(words(70, 200) + fuzzy + words(30, 201))),
             (21, " ".join(words(20, 202) + edited_fuzzy + words(90, 203)).upper())]
    rows += [(30 + i, " ".join(words(150, 300 + i))) for i in range(5)]
    rows += [(40, None), (41, ""), (42, "short text"), (None, rows[0][1]), (43, " ".join(["same"] * 300)),
             (44, " ".join(passage[:40] + words(40, 400)))]
    got = chain_dedup.passages(frame(spark, rows)).collect()
    spans = covered(got)
    for i in range(1, 6):
        assert set(range(80, 140)) <= spans[i] and len(spans[i]) <= 64
    assert len(set(range(20, 110)) & spans[21]) >= 85
    assert set(spans) == {1, 2, 3, 4, 5, 21}  # not the first, nor 40 words, nor clean ones
    assert all(r.partner_id < r.doc_id and r.similarity >= 0.8 for r in got)


def test_exact_passages_are_found_when_earlier_documents_own_their_seeds(spark):
    rows = []
    for n in range(6):
        passage = words(50, 700 + n)
        # Shingles, scattered and at other places, and a long part of it come first.
        rows += [(1000 * n + i, " ".join(words(30, 10_000 + 1000 * n + i) + passage[i:i + 5] + words(30, 20_000 + 1000 * n + i)))
                 for i in range(46)]
        rows.append((1000 * n + 60, " ".join(words(40, 800 + n) + passage[6:44] + words(40, 810 + n))))
        rows.append((1000 * n + 70, " ".join(words(90, 820 + n) + passage[3:20] + words(20, 830 + n) + passage + words(20, 840 + n))))
        rows.append((1000 * n + 80, " ".join(words(35, 850 + n) + passage + words(60, 860 + n))))
    spans = covered(chain_dedup.passages(frame(spark, rows)).collect())
    assert all(set(range(35, 85)) <= spans.get(1000 * n + 80, set()) for n in range(6))
    assert set(spans) == {1000 * n + 80 for n in range(6)}


def fuzzy_recall(spark, share, owned, n=30):
    """Share of 60-word passages with random edits that are found, of those
    that are alike enough, if a share of their shingles occurs before."""
    rng, rows, wanted = random.Random(int(100 * share)), [], []
    for f in range(n):
        passage, base = words(60, 1000 + f), 1000 * f
        rows += [(base + i, " ".join(words(12, 50_000 + base + i) + passage[i:i + 5] + words(12, 90_000 + base + i)))
                 for i in range(56) if rng.random() < owned]
        copy = [w if rng.random() > share else f"q{rng.randrange(10 ** 6)}" for w in passage]
        if sum(a == b for a, b in zip(passage, copy)) >= 0.8 * 60:
            wanted.append(base + 600)
        rows.append((base + 500, " ".join(words(40, 200_000 + f) + passage + words(40, 210_000 + f))))
        rows.append((base + 600, " ".join(words(33, 220_000 + f) + copy + words(45, 230_000 + f))))
    spans = covered(chain_dedup.passages(frame(spark, rows)).collect())
    assert all(d % 1000 == 600 for d in spans)  # clean documents are left alone
    return sum(len(spans.get(d, set()) & set(range(33, 93))) >= 45 for d in wanted) / len(wanted)


@pytest.mark.parametrize("share,owned,least", [(0.05, 0.6, 0.95), (0.1, 0.6, 0.9), (0.15, 0.0, 0.9), (0.2, 0.6, 0.5)])
def test_fuzzy_passages_whose_seeds_occur_before(spark, share, owned, least):
    assert fuzzy_recall(spark, share, owned) >= least


def test_chain_takes_a_near_predecessor_if_the_best_is_too_far():
    near = [(405, 450, 358, 398, 3), (470, 500, 462, 492, 3)]
    assert [0, 1] in chain_dedup.chain(near)
    assert [1, 2] in chain_dedup.chain([(0, 400, 0, 400, 20), *near])


def brute_chain(parts):
    """Best score of a chain that ends with each part."""
    score = {}
    for i in sorted(range(len(parts)), key=lambda i: parts[i][0]):
        s, e, t, _, _ = parts[i]
        gains = [score[j] - chain_dedup.GAP_COST * (s - parts[j][1] + t - parts[j][3]) for j in score
                 if 0 <= s - parts[j][1] <= chain_dedup.LIMIT and 0 <= t - parts[j][3] <= chain_dedup.LIMIT]
        score[i] = e - s + max([0.0, *gains])
    return score


def test_chain_scores_equal_brute_force():
    rng = random.Random(8)
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(1, 40)):
            s, t, n = rng.randrange(400), rng.randrange(400), rng.randint(5, 40)
            parts.append((s, s + n, t, t + n, 1))
        best = chain_dedup.chain(parts)
        total = lambda path: sum(parts[i][1] - parts[i][0] for i in path) - chain_dedup.GAP_COST * sum(
            parts[j][0] - parts[i][1] + parts[j][2] - parts[i][3] for i, j in zip(path, path[1:]))
        assert max(map(total, best)) == pytest.approx(max(brute_chain(parts).values()))
        assert sorted(i for path in best for i in path) == list(range(len(parts)))


def test_dropping_passages_keeps_the_first(spark):
    passage = words(60, 1)
    rows = [(1, "a b " + " ".join(passage) + " c"), (2, "d  " + " ".join(passage) + "\n e"), (3, " ".join(passage)),
            (4, None), (5, ""), (6, "x y")]
    docs = spark.createDataFrame([(d, t, len(t or "")) for d, t in rows], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in chain_dedup.drop_passages(docs).collect()}
    assert got == {1: (rows[0][1], len(rows[0][1])), 2: ("d  e", 4), 4: (None, 0), 5: ("", 0), 6: ("x y", 3)}
    assert chain_dedup.passages(docs.where("false")).count() == 0


def test_chain_takes_the_best_order():
    # (start, end, start there, end there, seeds): the third crosses the second.
    parts = [(0, 20, 0, 20, 4), (22, 40, 21, 39, 4), (25, 35, 2, 12, 2), (44, 60, 43, 59, 4)]
    best = max(chain_dedup.chain(parts), key=len)
    assert best == [0, 1, 3]
    assert sorted(i for c in chain_dedup.chain(parts) for i in c) == [0, 1, 2, 3]


def test_common_words_of_gaps():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (rng.integers(0, 4, rng.integers(0, 12)).astype(np.uint32) for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert chain_dedup._common(a, b) == table[-1, -1]
