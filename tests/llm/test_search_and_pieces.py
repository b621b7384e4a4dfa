"""Vector searches against brute force; SentencePiece against the library."""
import os

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tidewatch.llm import hamming_search, maxscore, sentence_pieces, vector_blocks

VECTORS = "vec_id long, embedding array<float>, score double"


def vectors(n, seed=1, width=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, width))
    x = centres[rng.integers(0, 12, n)] + 0.4 * rng.standard_normal((n, width))
    return (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)


def frame(spark, ids, x):
    return spark.createDataFrame([(i, None if v is None else [None if a is None else float(a) for a in v], 0.0)
                                  for i, v in zip(ids, x)], VECTORS).repartition(3)


def brute(ids, x, queries, k):
    """Ranking of rows (id, vector); a row is no candidate of its own id."""
    out = []
    for n in queries:
        score = x @ x[n]
        other = np.flatnonzero(ids != ids[n])
        best = other[np.lexsort((ids[other], -score[other]))][:k]
        out += [(int(ids[n]), r + 1, int(ids[b]), score[b].item()) for r, b in enumerate(best)]
    return sorted(out)


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(vector_blocks, "SHARD_ROWS", 150)
    monkeypatch.setattr(vector_blocks, "QUERY_ROWS", 4)
    monkeypatch.setattr(maxscore, "PART_ROWS", 40)


ODD = [(5000, None), (5001, [1.0, None]), (5002, [float("nan")] * 16), (5003, [float("inf")] + [0.0] * 15), (None, [1.0] * 16)]


def test_top_k_equals_brute_force(spark, small_blocks):
    x = vectors(500)
    x[100:140] = x[100]  # ties
    x[200] = 0
    ids = np.arange(500)
    rows = frame(spark, [*range(500), *(i for i, _ in ODD)], [*x, *(v for _, v in ODD)])
    got = maxscore.top_k(rows, F.col("vec_id") % 100 == 0, k=10).collect()
    q = np.floor(1024.0 * x.astype(np.float64)).astype(np.int64)
    assert sorted(tuple(r) for r in got) == brute(ids, q, range(0, 500, 100), 10)


def test_top_k_of_few_rows_and_negative_scores(spark):
    x = np.array([[1, 0], [-1, 0], [-1, -1], [0.0001, -2]], dtype=np.float32)
    got = maxscore.top_k(frame(spark, [0, 1, 2, 3], x), F.col("vec_id") == 0, k=10).collect()
    q = np.floor(1024.0 * x.astype(np.float64)).astype(np.int64)
    assert sorted(tuple(r) for r in got) == brute(np.arange(4), q, [0], 10)
    assert maxscore.top_k(frame(spark, [], []), F.col("vec_id") == 0).count() == 0
    assert maxscore.top_k(frame(spark, [0], x[:1]), F.col("vec_id") == 0).count() == 0


def test_maxscore_drops_no_competitive_row():
    rng = np.random.default_rng(2)
    for _ in range(60):
        rows = rng.integers(-50, 50, (80, 9))
        q = rng.integers(-30, 30, 9)
        exact = rows @ q
        level = int(rng.integers(-500, 4000))
        at, score = maxscore.Postings(rows, 0).competitive(q, level)
        assert (exact[at] == score).all() and set(np.flatnonzero(exact >= level)) <= set(at.tolist())


def test_repeated_ids_are_rows_of_their_own(spark):
    x = vectors(30)
    got = maxscore.top_k(frame(spark, [0, 1, 1, *range(3, 30)], x), F.col("vec_id") == 1, k=3).collect()
    assert all(r.vec_id != 1 for r in got) and sorted(r["rank"] for r in got) == [1, 2, 3]


def test_neighbours_reach_the_recall(spark, small_blocks):
    x = vectors(1200, seed=3, width=32)
    x[50:90] = x[50]
    zero = [(6000, [0.0] * 32)]
    rows = frame(spark, [*range(1200), *(i for i, _ in ODD + zero)], [*x, *(v for _, v in ODD + zero)])
    got = hamming_search.nearest(rows, F.col("vec_id") % 20 == 0, k=20).collect()
    want = brute(np.arange(1200), x.astype(np.float64), range(0, 1200, 20), 20)
    assert len(got) == len(want)
    found = {(r.query_id, r.vec_id): r.score for r in got}
    hits = [(q, v) in found for q, _, v, _ in want]
    assert sum(hits) >= 0.95 * len(hits)
    for q in range(0, 1200, 20):
        mine = sorted((r["rank"], -r.score, r.vec_id) for r in got if r.query_id == q)
        assert mine == sorted(mine, key=lambda r: r[1:]) and [m[0] for m in mine] == list(range(1, 21))
    assert all(abs(s - float(x[v].astype(float) @ x[q].astype(float))) < 1e-12 for (q, v), s in found.items())


def test_neighbours_of_few_rows(spark):
    x = vectors(6)
    got = hamming_search.nearest(frame(spark, range(6), x), F.col("vec_id") == 0, k=20).collect()
    want = brute(np.arange(6), x.astype(np.float64), [0], 20)
    assert sorted(tuple(r)[:3] for r in got) == [w[:3] for w in want]
    assert sorted(r.score for r in got) == pytest.approx(sorted(w[3] for w in want), abs=1e-15)
    assert hamming_search.nearest(frame(spark, [], []), F.col("vec_id") == 0).count() == 0
    assert hamming_search.nearest(frame(spark, [0], x[:1]), F.col("vec_id") == 0).count() == 0


def test_probing_finds_every_code_in_the_radius():
    x = vectors(700, seed=9).astype(np.float64)
    coder = hamming_search.fit(x, 1.0, 10)
    for radius in (3, 9, 14, 23):
        coder.radius = radius
        codes, asked = coder.codes(x), coder.codes(x[:5], query=True)
        ids = np.arange(700)
        q, c, _ = hamming_search._searcher(coder)(ids, x, ids[:5], x[:5], 700)
        for n in range(5):
            near = np.flatnonzero(np.bitwise_count(codes ^ asked[n]).sum(axis=1) <= radius)
            assert set(near.tolist()) - {n} <= set(c[q == n].tolist())


# --- SentencePiece ---------------------------------------------------------------

needs_model = pytest.mark.skipif(not os.path.exists(sentence_pieces.MODEL_PATH), reason="no vocabulary files")
TEXTS = ["", " ", "Hello  world", "  lead", "trail  ", "a\nb\tc", "日本語 text ☃ 🎉🎉", "▁under ▁ score", "ﬁ é é", "\x00 b",
         "1234567890 3.14", " " * 45 + "x", "x" * 400, "the " * 60, "aaaaaaabbbbbbbb" * 9, "don't,stop%%%&&&", "Ünï çødé ßtraße"]


@pytest.fixture(scope="module")
def model():
    return sentence_pieces.load_model()


@needs_model
def test_ids_equal_the_library(spark, model):
    library = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.MODEL_PATH)
    texts = TEXTS + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, ids int").repartition(3)
    got = sentence_pieces.tokenise(spark, docs, keep=["doc_id"]).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.ids == library.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids)
        assert r.decoded == library.decode(r.ids)


@needs_model
def test_odd_rows(spark, model):
    docs = spark.createDataFrame([(1, None), (None, "a b"), (2, "a b"), (2, "a b")], "doc_id long, text string")
    got = sorted((tuple(r) for r in sentence_pieces.tokenise(spark, docs, keep=["doc_id"]).collect()), key=str)
    assert got[0] == (1, [], "", 0) and len({str(g[1:]) for g in got[1:]}) == 1
    assert sentence_pieces.tokenise(spark, docs.where("false")).count() == 0
    long = "word, " * 200_000
    tokens = sentence_pieces.encode_texts(spark.createDataFrame([(1, long)], "doc_id long, text string"), model)
    assert sentence_pieces.decode_ids(tokens, model).first().decoded == long


@needs_model
def test_unigram_paths_are_shortest(model):
    """The same pieces as a unigram model: no path weighs less than the
    library's, and ours weighs no more."""
    at = model.rindex(b"\x18\x02")
    unigram = model[:at] + b"\x18\x01" + model[at + 2:]
    library = sentencepiece.SentencePieceProcessor(model_proto=unigram)
    ours = sentence_pieces.compile_model(unigram)
    assert ours.kind == sentence_pieces.UNIGRAM
    for text in ["ouen the of", "worthless onrein", "Thnt eringing", "undecided people sing", "日本 the"]:
        ids = np.frombuffer(ours.encode(text), "<i4").tolist()
        weight = lambda x: sum(library.get_score(i) for i in x)
        assert weight(ids) >= weight(library.encode(text)) and ours.decode(ids) == text


def test_shortest_path_equals_brute_force():
    pieces = ["<unk>", "▁", "a", "b", "ab", "ba", "aba", "▁a", "bab"]
    scores = [0.0, -2.0, -1.5, -1.7, -2.1, -2.9, -3.3, -2.2, -3.0]
    kinds = [2] + [1] * 8
    machines = sentence_pieces.Machines(sentence_pieces.UNIGRAM, pieces, scores, kinds, sentence_pieces.CharacterMap(b""))

    def cost(text):
        if not text:
            return 0.0
        return min(-scores[pieces.index(text[:n])] + cost(text[n:]) for n in range(1, 4) if text[:n] in pieces[1:])
    rng = np.random.default_rng(4)
    for _ in range(60):
        text = "▁" + "".join(rng.choice(["a", "b"], rng.integers(0, 9)))
        path = machines.shortest(text)
        assert "".join(path) == text
        assert sum(-scores[pieces.index(p)] for p in path) == pytest.approx(cost(text))
    assert np.frombuffer(machines.encode("a日b"), "<i4").tolist()[1:] == [0, 3]


def test_character_map_equals_the_library():
    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc", add_dummy_prefix=False,
                                                    remove_extra_whitespaces=False)
    proto = dict(sentence_pieces._fields(library.serialized_model_proto()))
    spec = dict(sentence_pieces._fields(proto[3]))
    ours = sentence_pieces.CharacterMap(spec[2])
    for text in ["ﬁ é ①②", "Ａｂｃ　x\tz\n", "é ½ é", "日本 ㌔ ", "plain", "​zero", "ｶﾞ"]:
        assert ours.apply(text).replace(" ", "▁") == library.normalize(text).replace(" ", "▁")


@needs_model
def test_decoding_compiles_only_what_ids_spell(model):
    inverse, machines = sentence_pieces.compile_inverse(model), sentence_pieces.compile_model(model)
    assert not {"trie", "final", "merged", "pairs", "memory"} & set(vars(inverse))
    for text in ("Hello world", "日本語 text", "don't,stop"):
        assert inverse.decode(np.frombuffer(machines.encode(text), "<i4").tolist()) == text
