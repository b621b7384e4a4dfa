"""The pipeline's stages on a small corpus, each judged on its own input."""
import random

import corpus_pipeline
from tidewatch.llm import oracle_sql, queries


def small_corpus(spark, tmp_path):
    rng = random.Random(11)
    plain = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(900)]
    bad = ["wretched", "vermin", "imbecile", "loathsome"]
    rows, labels = [], []
    for i in range(400):
        w = rng.choices(plain, k=rng.randint(30, 120))
        toxic = i % 4 == 0
        for _ in range(3 if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows.append((i, " ".join(w)))
        labels.append((i, 0, int(toxic)))
    passage = " ".join(rng.choices(plain, k=60))
    rows += [(400 + i, " ".join(rng.choices(plain, k=50)) + " " + passage) for i in range(5)]
    copied = rows[1][1]
    rows += [(500, copied), (501, copied.replace(copied.split()[7], "other", 1)), (502, ""), (503, None)]
    docs = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in rows]
    base = str(tmp_path)
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{base}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return base, passage


def test_stages(spark, tmp_path):
    base, passage = small_corpus(spark, tmp_path)
    docs = spark.read.parquet(f"{base}/documents.parquet")
    columns, kept = docs.columns, {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, base).write.parquet(f"{base}/out/{name}")
        docs = spark.read.parquet(f"{base}/out/{name}")
        kept[name] = docs.collect()
        assert n == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    ids = {name: {r.doc_id for r in rows} for name, rows in kept.items()}
    toxic = set(range(0, 400, 4))
    assert len(toxic & ids["toxicity"]) <= 3 and len(set(range(400)) - toxic - ids["toxicity"]) <= 3
    assert {500, 502, 503} <= ids["toxicity"]
    assert ids["toxicity"] - ids["near_duplicates"] == {500, 501}
    having = [r.doc_id for r in kept["passages"] if r.text and passage in r.text]
    assert having == [400] and ids["passages"] == ids["near_duplicates"]
    assert all(r.n_chars == len(r.text or "") for r in kept["passages"])
    words = {}
    for r in kept["mixing"]:
        words[r.source] = words.get(r.source, 0) + len((r.text or "").split())
    own = {}
    for r in kept["passages"]:
        own[r.source] = own.get(r.source, 0) + len((r.text or "").split())
    total = sum(words.values())
    assert abs(total - 1.5 * sum(own.values())) <= 3 and all(words[s] <= 2 * own[s] for s in own)
    assert len(kept["tokens"]) == len(kept["mixing"])
    assert sorted(r.decoded for r in kept["tokens"]) == sorted(r.text or "" for r in kept["mixing"])
    run = corpus_pipeline.run(spark, base)
    assert sorted(map(str, run.collect())) == sorted(map(str, kept["tokens"]))


def test_near_duplicates_of_repeated_ids(spark):
    rng = random.Random(5)
    text = [" ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(60)) for _ in range(4)]
    rows = [(1, text[0]), (2, text[0]), (2, text[1]), (3, text[2]), (3, text[2]), (3, text[2] + " more"),
            (4, text[2]), (5, text[3]), (6, ""), (6, ""), (6, None), (None, text[0]), (None, text[0])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert sorted(x[0] for x in kept if x[0]) == [1, 2, 3, 5, 6, 6, 6]
    assert (2, text[1]) in kept and (2, text[0]) not in kept and len([x for x in kept if x[0] is None]) == 2


ODD = "doc_id long, text string, lang string, source string, n_chars long"


def odd_rows():
    rng = random.Random(7)
    plain = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(400)]
    passage = " ".join(rng.choices(plain, k=60))
    text = [" ".join(rng.choices(plain, k=120)) for _ in range(4)]
    return passage, text, [
        (1, text[0] + " " + passage), (2, text[1] + " " + passage), (2, text[2]), (3, text[3]), (3, text[3]), (4, None),
        (5, ""), (None, text[0] + " " + passage), (6, " \n"), (7, " ".join(rng.choices(plain, k=60_000)))]


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    base, _ = small_corpus(spark, tmp_path)
    extra = ["row", "text_key", "key", "_key", "_rest", "_copy", "_whole", "_nth", "_size", "_taken", "_rows", "_row_key",
             "_spans", "_doc", "_id", "_toxicity", "_text", "score", "group", "kept", "id", "cut", "doc", "size", "copy", "span"]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or ""), *[f"mine{i}"] * len(extra))
                                  for i, (d, t) in enumerate(odd_rows()[2][:7])],
                                 ODD + "".join(f", {c} string" for c in extra))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, base)
        assert got.columns == docs.columns
        assert all({r[c] for c in extra} <= {f"mine{i}" for i in range(7)} and len({r[c] for c in extra}) == 1 for r in got.collect())


def test_stages_with_odd_rows_and_empty_tables(spark, tmp_path):
    base, _ = small_corpus(spark, tmp_path)
    _, _, rows = odd_rows()
    docs = spark.createDataFrame([(d, t, "en", None, len(t or "")) for d, t in rows], ODD)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), base).count() == 0
        got = stage(spark, docs, base)
        if name == "toxicity":
            assert got.count() == len(rows)
        if name == "tokens":
            assert sorted(r.decoded for r in got.collect()) == sorted(t or "" for _, t in rows)


def test_passages_of_repeated_ids_are_cut_by_row(spark):
    passage, text, rows = odd_rows()
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], ODD)
    got = [(r.doc_id, r.text, r.n_chars) for r in corpus_pipeline.drop_passages(spark, docs, "").collect()]
    assert (2, text[2], len(text[2])) in got  # the clean text under an id whose other text has a passage
    assert (1, text[0] + " " + passage, len(text[0]) + 1 + len(passage)) in got and (None, rows[7][1], len(rows[7][1])) in got
    (cut,) = [t for d, t, _ in got if d == 2 and t != text[2]]
    assert cut.strip() == text[1] and got.count((3, text[3], len(text[3]))) == 2
    assert len(got) == len(rows)


def test_every_operator_has_a_query():
    assert [int(n[2:].split("_")[0]) for n in queries.queries()] == list(range(1, 14))
    assert set(oracle_sql.oracle_sql()) <= set(queries.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "passages", "mixing", "tokens"]
