"""Url rules, toxicity, archives and mixing."""
import gzip
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import mixing, toxicity, url_rules, warc
from tidewatch.llm.common import scratch_path

# --- url rules ----------------------------------------------------------------


def brute_verdict(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[:min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(r.text), r.verdict, r.text) for r in rules
            if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[1] if best else default


URLS = ["http://example.org/es/1", "https://A.Example.ORG/en/123", "http://example.org/en/2", "http://xexample.org/es/",
        "http://org/", "http://org", "http://a.com/fr/x?y#z", "http://a.com/de/", "http://a.com/DE/", "http://com/de/q",
        "http://com?x=/de/", "http://a.net/", "no scheme", "", None, "http://a.b.c.example.org/es/?://", "ftp://com#/fr/",
        "http://example.org.evil.com/de/", "http://user@org/", "http://org:80/", "http://é.org/ü", "://org/",
        "http://example.org/en/1", "x" * 50000 + "://com/fr/" + "y" * 50000, "http://com/fr\n/x", "http://a.com/fr/"]


def test_rules_equal_brute_force(spark):
    rules = [url_rules.Rule(*r) for r in url_rules.RULES]
    rows = [(i, u, "h") for i, u in enumerate(URLS)] + [(None, URLS[0], "h"), (0, URLS[0], "h")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string").repartition(3)
    got = url_rules.judge_urls(pages, keep=["page_id"]).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(
        ((i, *brute_verdict(u, rules)) for i, u, _ in rows), key=str)
    assert url_rules.judge_urls(pages.where("false")).count() == 0


def test_rules_are_filed_under_their_rarest_token(spark):
    rules = [url_rules.Rule("block", "example.com", "/ads/*/x"), url_rules.Rule("block", "com", "/p"),
             url_rules.Rule("block", "", "/")]
    assert rules[0].tokens == ["h:example", "h:com", "p:ads"]
    assert rules[1].tokens == ["h:com"] and rules[2].tokens == []
    urls = spark.createDataFrame([("a.com", "/ads/")] * 3 + [("example.com", "/q")] * 2, "host string, path string")
    index = {r.rule: r.token for r in url_rules.rule_index(urls, rules).collect()}
    assert index == {"example.com/ads/*/x": "h:example", "com/p": "h:com", "/": ""}
    pages = spark.createDataFrame([(1, "http://example.com/ads/9/xy"), (2, "http://example.com/ads/x"), (3, "http://z.io/")],
                                  "page_id long, url string")
    got = {r.page_id: r.rule for r in url_rules.judge_urls(pages, rules).collect()}
    assert got == {1: "example.com/ads/*/x", 2: "/", 3: "/"}


# --- toxicity -------------------------------------------------------------------

def corpus(n, seed=1):
    rng = random.Random(seed)
    plain = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(400)]
    bad = ["wretched", "vermin", "imbecile", "loathsome"]
    out = []
    for i in range(n):
        w = rng.choices(plain, k=rng.randint(5, 120))
        toxic = i % 3 == 0
        for _ in range(rng.randint(2, 4) if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(bad) + rng.choice(["", ".", "!"]))
        out.append((i, " ".join(w), int(toxic)))
    return out


def test_held_out_documents_are_told_apart(spark):
    rows = corpus(600)
    docs = spark.createDataFrame([(i, t, "z") for i, t, _ in rows], "doc_id long, text string, score string").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.score_texts(docs, model).withColumn("h", toxicity.held_out("doc_id")).collect()}
    held = [(got[i].score >= 0.5, bool(y)) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in rows)
    assert len(held) > 80 and sum(a == b for a, b in held) >= 0.97 * len(held)


def test_whole_texts_count_and_odd_rows_have_scores(spark):
    rows = corpus(400)
    model = toxicity.fit([(t.encode(), y) for _, t, y in rows])
    tail = " ".join(t for _, t, y in rows if not y)[:200_000] + " wretched vermin, you imbecile: loathsome vermin"
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "wretched vermin imbecile"), (4, tail), (5, " \n"), (5, " \n")],
                                 "doc_id long, text string")
    got = toxicity.score_texts(docs, model).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    by_text = {r.text: r.score for r in got}
    assert by_text[None] == by_text[""] == by_text[" \n"] < 0.5 < by_text["wretched vermin imbecile"]
    pair = model.compressors()
    assert model.features(model.gains(tail.encode(), pair))[1] > model.features(model.gains(tail[:-50].encode(), pair))[1]
    assert toxicity.score_texts(docs.where("false"), model).count() == 0


def test_short_stems_and_two_letter_words_give_evidence():
    rng = random.Random(3)
    plain = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(400)]
    for bad in ([f"zqx{end}kv" for end in ("a", "ed", "ing", "er", "ish", "ous")], ["zq"]):
        samples = []
        for i in range(600):
            w = rng.choices(plain, k=rng.randint(20, 80))
            for _ in range(0 if i % 3 else 3):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
            samples.append((" ".join(w).encode(), int(i % 3 == 0)))
        model = toxicity.fit(samples[:400])
        pair = model.compressors()
        assert model.toxic
        assert sum((model.score(t, pair) >= 0.5) == bool(y) for t, y in samples[400:]) >= 195


def test_training_without_one_class(spark):
    assert toxicity.fit([]).score(b"x", toxicity.fit([]).compressors()) == 0.5
    one = toxicity.fit([(b"a b", 0), (b"c", 0)])
    assert one.score(b"anything", one.compressors()) < 0.01
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert toxicity.train(empty, spark.createDataFrame([], "doc_id long, toxic int")).toxic == b""


# --- archives ---------------------------------------------------------------------

def test_archives_round_trip(spark):
    big, huge = "payload " * 200, "é<p>\r\n\r\nWARC/1.0\r\n" * 100_000
    rows = [(1, "http://a", big), (2, "http://b", big), (3, None, "small"), (4, "http://d\r\nX: y", "small"), (5, "e", None),
            (6, "f", ""), (7, "g", huge), (8, "h", huge), (9, "i", "x" * 1000), (10, "j", "x" * 999), (11, "k", "x" * 999),
            (12, "l", "é" * 500), (13, "m", "é" * 500), (None, "n", big), (14, "o", "tie " * 300), (14, "o", "tie " * 300)]
    pages = spark.createDataFrame([(*r, 5) for r in rows], "page_id long, url string, html string, payload_bytes int").repartition(3)
    got = sorted(warc.archive_pages(pages, payloads=True).collect(), key=str)
    groups = {}
    for i, _, h in rows:
        groups.setdefault(h or "", []).append(i)
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        ids = [x for x in groups[h or ""] if x is not None]
        to = max(ids) if len(data) >= 1000 and len(groups[h or ""]) > 1 and max(ids) != i else None
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if to else "response", to))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    assert {bytes(r.payload) for r in got if r.record_type == "response"} == {(h or "").encode() for _, _, h in rows}
    assert warc.archive_pages(pages.where("false")).count() == 0


def test_normalised_archives_have_a_member_per_record(spark, tmp_path):
    rows = [(i, f"http://x/{i}", f"text {i} " * (i + 1)) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    base = scratch_path(spark, "warc-test")
    warc.write_archives(warc.plan_records(pages), f"{base}/m")
    index = warc.normalise_archives(spark, f"{base}/m", f"{base}/n").collect()
    again = warc.normalise_archives(spark, f"{base}/m", f"{base}/n").collect()  # a task that runs twice
    assert sorted(index) == sorted(again) and len(index) == 40
    folder = base.removeprefix("file:")
    for file in {r.file for r in index}:
        with open(f"{folder}/n/{file}", "rb") as f:
            data = f.read()
        mine = sorted((r.offset, r.length) for r in index if r.file == file)
        assert [a for a, _ in mine] == [0, *[a + n for a, n in mine][:-1]] and sum(mine[-1]) == len(data)
        for a, n in mine:
            one = zlib.decompressobj(31)
            text = one.decompress(data[a:a + n])
            assert one.eof and not one.unused_data and text.startswith(b"WARC/1.0\r\n")
        assert gzip.decompress(data).count(b"WARC/1.0\r\n") == len(mine)


def test_stream_reader_crosses_pieces_and_members():
    records = [(b"WARC/1.0\r\nContent-Length: %d" % n, bytes([65 + n % 26]) * n) for n in (0, 1, 5, 70_000, 3)]
    raw = [h + b"\r\n\r\n" + b + b"\r\n\r\n" for h, b in records]
    for data in (gzip.compress(b"".join(raw)), b"".join(gzip.compress(r) for r in raw)):
        stream = warc._Stream(memoryview(data), piece=7)
        out = []
        while (h := stream.until(b"\r\n\r\n")) is not None:
            out.append((h, stream.take(int(h.split(b": ")[1]))))
            stream.take(4)
        assert out == records
    with pytest.raises(ValueError):
        list(warc._records(memoryview(gzip.compress(raw[2][:-8]))))


# --- mixing -------------------------------------------------------------------------

def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    target, left, free = {}, share * sum(sizes.values()), set(order)
    while free:
        level = left / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] > cap * sizes[s]]
        if not over:
            target.update({s: level * w[s] for s in free})
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            free.discard(s)
    return target


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(4)
    rows = [(i, " ".join("w" * rng.randint(1, 5) for _ in range(rng.choice([0, 1, 5, 30, 400]))),
             rng.choice(["a", "b", "b", "b", "b", "c", "é", "z", None, ""])) for i in range(300)]
    return rows + [(900, None, "a"), (901, "x \t\n y\x0b\x0c\rz", "a"), (None, "n n n", "b"), (7, "again again", "c"),
                   (902, "", "only empty"), (903, "dup dup dup", "c"), (903, "dup dup dup", "c")]


def test_mix_meets_targets(spark, mixed):
    docs = spark.createDataFrame([(*r, 1.0) for r in mixed], "doc_id long, text string, source string, target double")
    got = mixing.mix_plan(docs.repartition(5)).collect()
    assert len(got) == len(mixed)
    sizes, taken = {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 2 * r.size
    assert {r.doc_id: r.size for r in got}[901] == 3
    target = brute_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source], rel=1e-12, abs=1e-9)
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
    again = mixing.mix_plan(docs.repartition(2)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mix_plan(docs.where("false")).count() == 0


def test_mixed_documents_have_the_planned_words(spark, mixed):
    docs = spark.createDataFrame([(*r, 1.0) for r in mixed], "doc_id long, text string, source string, _size double").drop("_size")
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    plan, got, texts = {}, {}, {}
    for r in mixing.mix_plan(docs).collect():
        plan[r.doc_id, r.source] = plan.get((r.doc_id, r.source), 0) + r.taken
    for i, t, s in mixed:
        texts.setdefault((i, s), []).append(t)
    for r in out.collect():
        got[r.doc_id, r.source] = got.get((r.doc_id, r.source), 0) + len((r.text or "").split())
        assert any((t or "").startswith(r.text or "") for t in texts[r.doc_id, r.source])
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in plan.items() if v}


def test_targets_of_skewed_sources(spark):
    for sizes in ({"a": 1, "b": 1000, "c": 5}, {"a": 10, "b": 10, "c": 10, "d": 0}, {None: 4}, {"a": 0}):
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
        want = brute_targets(sizes)
        assert got == pytest.approx(want)
        if sum(sizes.values()):
            assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_word_count_equals_contract(spark):
    text = "a b c\x1fd\x85e  f\tg"  # only six characters separate words
    got = spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")
    assert mixing.mix_plan(got).first().size == 4
    assert got.select(F.regexp_count("text", F.lit(mixing.WORD))).first()[0] == 4


def test_training_holds_the_words_of_one_text_at_a_time():
    import tracemalloc
    letters = "abcdefghijklmnopqrstuvwxyz"
    text = " ".join(a + b + c for a in letters for b in letters for c in letters[:3]).encode()
    samples = [(text + b" " + letters[i % 26].encode() * (4 + i // 26), i % 2) for i in range(150)]
    tracemalloc.start()
    try:
        toxicity.fit(samples)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 8 << 20  # the words of all texts at once: over 30 MB
