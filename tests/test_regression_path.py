"""Gram matrices, scaling, ridge, time-ordered folds, halving and p-value
expressions against brute force; the hourly skew stream against its batch."""
import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tidewatch.functions import pvalues
from tidewatch.operators import drift, gram, split, stats
from tidewatch.operators.features import FeatureSet
from tidewatch.plans import models, regression, runs


def table(rows=400, cols=7, seed=1, holes=0.2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(rows, cols)) * 10.0 ** rng.integers(-2, 5, cols) + 1e6 * rng.random(cols)
    x[:, 1] = x[:, 0] * 2 + rng.normal(size=rows)
    x[rng.random(x.shape) < holes] = np.nan
    return pd.DataFrame(x, columns=[f"c {i}" for i in range(cols)])


def spark_table(spark, frame):
    return spark.createDataFrame([tuple(None if v != v else float(v) for v in row) for row in frame.itertuples(index=False)],
                                 ", ".join(f"`{c}` double" for c in frame.columns)).repartition(3)


@pytest.mark.parametrize("block", [3, 128])
def test_pair_sums_and_correlations(spark, block, monkeypatch):
    monkeypatch.setattr(gram, "PAIRS", 2)  # several passes
    frame = table()
    frame["flat"] = 5.0
    frame["empty"] = np.nan
    df, cols = spark_table(spark, frame), list(frame.columns)
    sums, shift = gram.pair_sums(df, cols, block)
    got = {(r.col_a, r.col_b): r for r in sums.collect()}
    assert len(got) == len(cols) * (len(cols) + 1) // 2
    for (a, b), r in got.items():
        both = frame[[a, b]].to_numpy()[frame[[a, b]].notna().all(axis=1).to_numpy()]
        x, y = both[:, 0] - shift[a], both[:, -1] - shift[b]
        assert r.n == len(both) and math.isclose(r.sum_ab, (x * y).sum(), rel_tol=1e-9, abs_tol=1e-6)
        assert math.isclose(r.sum_aa, (x * x).sum(), rel_tol=1e-9, abs_tol=1e-6)
    want = frame.corr()
    for r in stats.correlation_pairs(df, cols).collect():
        expected = want.loc[r.col_a, r.col_b]
        assert (r["corr"] is None) == bool(expected != expected)
        assert r["corr"] is None or math.isclose(r["corr"], expected, rel_tol=1e-7, abs_tol=1e-9)


def test_correlations_of_many_columns(spark):
    frame = table(rows=60, cols=300, seed=3, holes=0.05)
    got = stats.correlation_pairs(spark_table(spark, frame), list(frame.columns))
    want, n = frame.corr(), 0
    for r in got.collect():
        n += 1
        assert math.isclose(r["corr"], want.loc[r.col_a, r.col_b], rel_tol=1e-6, abs_tol=1e-8)
    assert n == 300 * 301 // 2


def test_scaler_and_ridge_equal_the_closed_form_and_are_saved(spark, tmp_path):
    frame = table(holes=0.0)
    frame["flat"] = 3.0
    features, target = list(frame.columns[1:]), frame.columns[0]
    df = spark_table(spark, frame).withColumnRenamed(target, "Target_Value")
    scaled = regression.scaled_names(features)
    model = Pipeline(stages=[regression.PopulationScaler(inputCols=features, outputCols=scaled),
                             regression.GramRidge(inputCols=scaled, labelCol="Target_Value", alpha=2.0)]).fit(df)
    x = frame[features].to_numpy() / np.where(frame[features].std(ddof=0) > 1e-12, frame[features].std(ddof=0), 1.0)
    y = frame[target].to_numpy()
    centred = x - x.mean(axis=0)
    w = np.linalg.solve(centred.T @ centred + 2.0 * np.eye(len(features)), centred.T @ (y - y.mean()))
    assert np.allclose(model.stages[1].getOrDefault("coefficients"), w, rtol=1e-6, atol=1e-9)
    expected = np.sort(y.mean() + centred @ w)
    model.write().overwrite().save(str(tmp_path / "m"))
    for one in (model, PipelineModel.load(str(tmp_path / "m"))):
        got = np.sort([r.prediction for r in one.transform(df).select("prediction").collect()])
        assert np.allclose(got, expected, rtol=1e-8)
    again = np.sort([r[0] for r in model.transform(df).select(f"`{scaled[-1]}`").collect()])
    assert np.allclose(again, 3.0)  # a constant column stays as it is


def dated(spark, n=120):
    rng = random.Random(3)
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), float(i), None if i % 11 == 5 else rng.random(), float(i) + rng.random(),
             rng.choice(["fear", "greed", "stable"])) for i in range(n)]
    return FeatureSet("v1", spark.createDataFrame(rows, "ts date, a double, b double, Target_Value double, Market_Sentiment string"),
                      ["a", "b"])


def test_chronological_train_val(spark):
    fs = dated(spark)
    rows = {r.part: r for r in regression.train_val(fs).groupBy("part").agg(
        F.count("*").alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last")).collect()}
    kept = [i for i in range(96) if i % 11 != 5]
    assert rows["train"].n == math.floor(len(kept) * 0.7) and rows["train"].n + rows["val"].n == len(kept)
    assert rows["train"].last < rows["val"].first and rows["val"].last == dt.date(2024, 1, 1) + dt.timedelta(days=kept[-1])


def test_splits_agree_whichever_way_the_boundary_is_found(spark, monkeypatch):
    df = dated(spark).df
    sides = lambda: sorted(map(tuple, split.chronological_split(df, "ts", 0.37).groupBy("split").agg(
        F.count("*"), F.max("ts")).collect()))
    want = sides()
    assert dict((s, n) for s, n, _ in want) == {"train": 44, "test": 76}
    monkeypatch.setattr(split, "MAX_SORTED_STAMPS", 10)
    assert sides() == want


def test_folds_expand_in_time(spark):
    rows = models.expanding_folds(dated(spark).df, 5).groupBy("fold").agg(
        F.count("*").alias("n"), F.min("ts").alias("a"), F.max("ts").alias("b")).orderBy("fold").collect()
    assert [r.n for r in rows] == [20] * 6 and all(x.b < y.a for x, y in zip(rows, rows[1:], strict=False))
    p = models.prepare(dated(spark), "classification")
    got = models.cross_validate(p, 3, models.forest("classification", quick=True)).orderBy("fold").collect()
    assert [r.fold for r in got] == [1, 2, 3] and all(x.n_train + x.n_test == y.n_train for x, y in zip(got, got[1:], strict=False))


def test_halving_keeps_the_best_and_ends_on_all_rows(spark):
    p = models.prepare(dated(spark), "regression")
    plan = models.trial_plan("regression", 9)
    assert plan == models.trial_plan("regression", 9) and {t["learner"] for t in plan} == {"rf", "gbt"}
    sizes = [models.nested_sample(p.train, models.sample_share(r, 3, 3)).count() for r in range(3)]
    assert sizes[0] < sizes[1] < sizes[2] == p.train.count()
    small = {r.ts for r in models.nested_sample(p.train, 1 / 9).collect()}
    assert small <= {r.ts for r in models.nested_sample(p.train, 1 / 3).collect()}


def test_dropped_rows_classes_and_medians(spark):
    p = models.prepare(dated(spark), "classification")
    counts = [d.count() for d in (p.train, p.val, p.test)]
    assert sum(counts) == sum(i % 11 != 5 for i in range(120))
    assert models.prepare(dated(spark), "classification", missing="median").train.where("b is null").count() == 0
    only = p.train.where("Market_Sentiment <> 'greed'")
    model = models._pipeline(p, models.forest("classification", quick=True)).fit(only)
    assert model.stages[2].labelsArray[0] == ("fear", "greed", "stable") or list(model.stages[2].labelsArray[0]) == ["fear", "greed", "stable"]
    assert model.stages[-1].numClasses == 3


def test_tails_equal_the_reference_functions(spark):
    rows = [(x, d) for x in (0.0, 0.01, 0.5, 3.84, 10.0, 200.0) for d in range(12)]
    df = spark.createDataFrame(rows, "x double, d long")
    for r in df.select("*", pvalues.chi2_pvalue(F.col("x"), F.col("d")).alias("p")).collect():
        assert abs(r.p - pvalues.chi2_sf(r.x, r.d)) < 1e-13
    df = spark.createDataFrame([(i / 17,) for i in range(180)] + [(None,)], "z double")
    for r in df.select("*", pvalues.normal_pvalue(F.col("z")).alias("p")).collect():
        assert r.p is None if r.z is None else abs(r.p - pvalues.normal_two_sided(r.z)) < 1e-14
    df = spark.createDataFrame([(i / 300, 50 + i, 70 + 3 * i) for i in range(200)], "d double, a long, b long")
    for r in df.select("*", pvalues.kolmogorov_pvalue(F.col("d"), F.col("a"), F.col("b")).alias("p")).collect():
        assert abs(r.p - pvalues._kolmogorov_sf(r.d * math.sqrt(r.a * r.b / (r.a + r.b)))) < 1e-14


def test_one_pass_drift_statistics_equal_plain_moments(spark):
    rng = random.Random(9)
    rows = [(f, s, None if rng.random() < 0.05 else 1e7 + round(rng.gauss(0, 2), 1)) for f in "ab" for s in ("ref", "cur") for _ in range(200)]
    long = spark.createDataFrame(rows, "feature string, side string, value double")
    for r in drift.numeric_drift_stats(long).collect():
        x, y = (np.array([v - 1e7 for f, s, v in rows if f == r.feature and s == side and v is not None]) for side in ("ref", "cur"))
        pooled = math.sqrt(((len(x) - 1) * x.var(ddof=1) + (len(y) - 1) * y.var(ddof=1)) / (len(x) + len(y) - 2))
        assert math.isclose(r.ref_mean - 1e7, x.mean(), abs_tol=1e-8) and math.isclose(r.curr_mean - 1e7, y.mean(), abs_tol=1e-8)
        assert math.isclose(r.ref_std, x.std(ddof=1), rel_tol=1e-9) and math.isclose(r.curr_std, y.std(ddof=1), rel_tol=1e-9)
        assert math.isclose(r.cohens_d, (y.mean() - x.mean()) / pooled, abs_tol=1e-8)
    auto = {r.feature: r.ks_pvalue for r in drift.numeric_drift(long, ks_method="exact").collect()}
    assert all(abs(r.ks_pvalue - auto[r.feature]) < 0.1 for r in drift.numeric_drift(long).collect())


def test_reports_of_runs(spark):
    market = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(days=i), 100.0 + (i % 13) * 2.5 + i * 0.1) for i in range(300)],
                                   "ts date, Target_Price double")
    found = runs.market_candidates(market)
    table_ = {(r.version, r.task): r for r in runs.runs(found, list(runs.HORIZONS)).collect()}
    assert table_["v4", "regression"].best_model == "FAILED" and table_["v1", "regression"].status == "ok"
    best = {r.version: r for r in runs.best_of_version(found).collect()}
    for v in ("v1", "v2", "v3"):
        rmse = {r.model: r.rmse for r in found.where(f"version = '{v}' and task = 'regression'").collect()}
        assert best[v].rmse == min(rmse.values())
    total = [r for r in runs.summary(runs.runs(found, list(runs.HORIZONS))).collect() if r.level == 3]
    assert [(r.runs, r.successful) for r in total] == [(8, 6)]


def test_skew_windows_with_late_events_and_a_baseline(spark, tmp_path):
    from tidewatch.streaming.skew import run_hourly_skew
    schema = "event_id long, ts timestamp_ntz, event_type string, value double"
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(minutes=5 * i), "a" if i % 2 else "b", float("nan") if i == 7 else float(i % 10)) for i in range(72)]
    rows += [(90, t0 + dt.timedelta(minutes=3), "c", 5.0), (91, t0 + dt.timedelta(hours=9), "a", 1.0)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    base = spark.createDataFrame([(i, t0, s, float(i % 10)) for i in range(100) for s in "ab"], schema)
    got = {(r.window_start, r.symbol): r for r in spark.read.parquet(run_hourly_skew(
        spark, str(tmp_path / "in"), baseline=base)).collect()}
    assert len(got) == 6 * 2 + 1
    first = got[t0, "a"]  # values 1, 3, 5, NaN, 9, 1 against a uniform training share of 0.1
    assert (first.n, first.n_unlabelled) == (6, 1) and math.isclose(first.skew, 0.3) and first.alert
    assert got[t0, "c"].skew is None and not got[t0, "c"].alert and got[t0, "c"].n_unlabelled == 1
    assert all(r.n == r.n_fear + r.n_greed + r.n_stable + r.n_unlabelled for r in got.values())
