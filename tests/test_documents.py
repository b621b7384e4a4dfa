"""Nested run documents (A14) and their flattening (H6) on inline frames."""
from tidewatch.plans.models import (RESULT_SCHEMA, TRIAL_SCHEMA, flatten_candidates,
                                    result_documents)


def test_documents_nest_and_flatten_back(spark, tmp_path):
    res = spark.createDataFrame(
        [("v1", "classification", "rf", 3, 6, 2, 2, .9, .8, "accuracy", 1.0, "ok", False),
         ("v2", "classification", "FAILED", 3, None, None, None, None, None, None, None,
          "FAILED", False)], RESULT_SCHEMA)
    trials = spark.createDataFrame(
        [("v1", "classification", 1, "lr", .7, .1, "ok"),
         ("v1", "classification", 0, "rf", .9, .2, "ok")], TRIAL_SCHEMA)
    docs = result_documents(res, trials)
    docs.write.json(str(tmp_path / "d"))
    back = spark.read.schema(docs.schema).json(str(tmp_path / "d"))
    got = {r.version: [c.model for c in (r.candidates or [])] for r in back.collect()}
    assert got == {"v1": ["rf", "lr"], "v2": []}       # candidate order kept
    flat = sorted(tuple(r) for r in flatten_candidates(back).collect())
    assert flat == [("v1", "classification", 0, "rf", .9, "ok", True),
                    ("v1", "classification", 1, "lr", .7, "ok", False),
                    ("v2", "classification", None, None, None, None, False)]
