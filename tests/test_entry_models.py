"""Driver contract and the model layer on the smallest tables."""
import __spark_entry__ as E
from conftest import SF001
from tidewatch.operators.features import build_feature_set
from tidewatch.plans import models as M
from tidewatch.sources.tables import daily_panel


def test_entry_flagship(spark):
    rows = {r.Market_Sentiment: r.n for r in E.entry(spark).collect()}
    assert set(rows) <= {"fear", "stable", "greed"} and sum(rows.values()) > 0


def test_queries_have_oracles_or_are_rows_only():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 50
    assert len(o) >= 40


def test_quick_models_and_leaderboard(spark):
    fs = build_feature_set(daily_panel(spark, SF001), "v1")
    res = M.sweep(spark, [fs], quick=True, missing="median")
    rows = res.collect()
    assert {r.task for r in rows} == {"classification", "regression"}
    for r in rows:
        assert r.status == "ok"
        if r.task == "classification":
            assert 0.0 <= r.test_metric <= 1.0
    lb = M.leaderboard(res).where("rank = 1").count()
    assert lb == 2
    st = M.experiment_stats(res).first()
    assert st.successful == 2 and st.tasks == 2


def test_shuffle_column_is_a_permutation(spark):
    """J17 permutation importance: the distributed shuffle keeps every row
    and every value of the column, moves values, and leaves the other
    columns in place; same seed, same result at any partitioning."""
    from pyspark.sql import functions as F
    from tidewatch.plans.models import shuffle_column
    df = spark.range(500).select(F.col("id").alias("ts"), (F.col("id") * 3).alias("x"),
                                 (F.col("id") % 7).alias("y"))
    a = shuffle_column(df, "x", seed=1, n_buckets=4)
    b = shuffle_column(df.repartition(7), "x", seed=1, n_buckets=4)
    ra = sorted((r.ts, r.x, r.y) for r in a.collect())
    rb = sorted((r.ts, r.x, r.y) for r in b.collect())
    assert ra == rb and len(ra) == 500
    assert sorted(x for _, x, _ in ra) == [3 * i for i in range(500)]
    assert all(y == t % 7 for t, _, y in ra)
    assert sum(x != 3 * t for t, x, _ in ra) > 400


def test_permutation_importance_runs_on_a_model(spark):
    from pyspark.ml.classification import LogisticRegression
    from tidewatch.operators.features import build_feature_set
    from tidewatch.plans.models import _pipeline, permutation_importance, prepare
    from tidewatch.sources.tables import daily_panel
    p = prepare(build_feature_set(daily_panel(spark, "/root/testdata/sf0.001"), "v1"),
                "classification", missing="median")
    model = _pipeline(p, LogisticRegression(maxIter=20)).fit(p.train)
    v = permutation_importance(model, p, p.features[0], repeats=2)
    assert v == v and -1.0 <= v <= 1.0


def test_importance_falls_back_to_permutation(spark):
    """A model without native importances or coefficients (MLP) gets
    permutation importances, one per feature, sorted descending."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from tidewatch.operators.features import build_feature_set
    from tidewatch.plans.models import _pipeline, feature_importance, prepare
    from tidewatch.sources.tables import daily_panel
    p = prepare(build_feature_set(daily_panel(spark, "/root/testdata/sf0.001"), "v1"),
                "classification", missing="median")
    mlp = MultilayerPerceptronClassifier(layers=[len(p.features), 4, 3], maxIter=10, seed=42)
    model = _pipeline(p, mlp).fit(p.train)
    assert feature_importance(model, p.features) == []
    rows = feature_importance(model, p.features, top=3, prepared=p, repeats=1)
    assert len(rows) == 3 and rows[0][1] >= rows[1][1] >= rows[2][1]


def test_runs_of_a_sweep_go_side_by_side(spark, monkeypatch):
    import threading
    from types import SimpleNamespace
    both = threading.Barrier(2, timeout=20)

    def run(fs, task, *_):
        both.wait()  # passes only while another run waits as well
        return (fs.version, task, "m", 0, 1, 1, 1, 0.0, 0.0, "r2", 0.0, "ok", False), [("m", 0.0, 0.0, "ok")], f"{fs.version}/{task}"
    monkeypatch.setattr(M, "run_experiment", run)
    models = {}
    sets = [SimpleNamespace(version=v, features=[]) for v in ("v1", "v2")]
    rows = M.sweep(spark, sets, tasks=("regression",), models=models).collect()
    assert [(r.version, r.status) for r in rows] == [("v1", "ok"), ("v2", "ok")]
    assert models == {("v1", "regression"): "v1/regression", ("v2", "regression"): "v2/regression"}
