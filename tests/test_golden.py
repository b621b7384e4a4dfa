"""Golden numbers recorded by the reference."""
import math

import pytest
from pyspark.sql import functions as F

from tidewatch.functions.pvalues import chi2_sf
from tidewatch.operators import drift as D
from tidewatch.operators import stats as S
from tidewatch.operators.split import three_way_split


def _labels(spark, ref, cur):
    rows = [("ref", k) for k, n in ref.items() for _ in range(n)]
    rows += [("cur", k) for k, n in cur.items() for _ in range(n)]
    return spark.createDataFrame(rows, "side string, lab string")


def test_chi_square_target_drift(spark):
    lab = _labels(spark, {"stable": 190, "fear": 22, "greed": 8},
                  {"stable": 188, "fear": 25, "greed": 8})
    st = D.chi_square_stats(D.category_alignment(lab, "lab")).first()
    assert st.dof == 2
    assert math.isclose(st.chi2_statistic, 0.19980482596252308, rel_tol=1e-12)
    assert math.isclose(chi2_sf(st.chi2_statistic, 2), 0.9049257227306545, rel_tol=1e-12)
    td = D.target_drift(lab, "lab").first()
    assert td.drift_detected is False


def _conf(spark, cells):
    rows = [(t, p) for (t, p), n in cells.items() for _ in range(n)]
    return S.confusion(spark.createDataFrame(rows, "t string, p string"), "t", "p")


def test_classification_report_v1(spark):
    conf = _conf(spark, {("fear", "fear"): 5, ("fear", "stable"): 17, ("greed", "greed"): 8,
                         ("stable", "greed"): 61, ("stable", "stable"): 129})
    s = S.classification_summary(conf).first()
    assert math.isclose(s.accuracy, 0.6454545454545455, rel_tol=1e-12)
    assert math.isclose(s.macro_f1, 0.44867324033990696, rel_tol=1e-12)
    assert math.isclose(s.macro_precision, 0.6665, abs_tol=1e-4)
    assert math.isclose(s.macro_recall, 0.63541, abs_tol=1e-5)
    assert math.isclose(s.weighted_f1, 0.70774, abs_tol=1e-5)


def test_zero_division_and_majority_baseline(spark):
    conf = _conf(spark, {("fear", "stable"): 22, ("greed", "stable"): 8,
                         ("stable", "stable"): 190})
    s = S.classification_summary(conf).first()
    assert math.isclose(s.accuracy, 0.8636363636363636, rel_tol=1e-12)
    assert math.isclose(s.macro_f1, 0.3089430894308943, rel_tol=1e-12)


def test_cohens_d_and_mean_shift_formulas():
    # T2/T3: (n, mean, std) of SPY_Price in the recorded drift file
    n1, n2 = 220, 221
    m1, m2 = 589.6276, 590.5293
    s1, s2 = 27.1296, 27.7620
    pooled = math.sqrt(((n1 - 1) * s1 ** 2 + (n2 - 1) * s2 ** 2) / (n1 + n2 - 2))
    assert math.isclose((m2 - m1) / pooled, 0.032851, abs_tol=1e-4)
    assert math.isclose((m2 - m1) / m1 * 100, 0.152932, abs_tol=1e-4)


def test_split_sizes_657_220_220(spark):
    df = spark.range(1097).select(F.col("id").alias("ts"))
    counts = {r.split: r["count"] for r in
              three_way_split(df, "ts", None, 0.2, 0.25, 42).groupBy("split").count().collect()}
    assert counts == {"train": 657, "val": 220, "test": 220}


def test_drift_summary_no_drift(spark):
    rows = [("f", "ref" if i % 2 else "cur", float(i % 17)) for i in range(400)]
    long = spark.createDataFrame(rows, "feature string, side string, value double")
    feats = D.numeric_drift(long)
    s = D.drift_summary(feats).first()
    assert s.features_tested == 1 and s.features_with_drift == 0
    assert s.drift_percentage == 0.0 and s.overall_drift_detected is False
    assert s.data_quality_score == 100.0


# The feature lists recorded by the reference for v1 / v2 / v3
# (20 / 30 / 50 names; v2 adds the moving averages, v3 the ratios).
RECORDED_V1 = ["BAMLH0A0HYM2", "CPIAUCSL", "DGS10", "GLD_Price_ret_pct", "GLD_Volatility",
               "GLD_Volume", "HOUST", "HYG_Price_ret_pct", "HYG_Volatility", "HYG_Volume",
               "QQQ_Price_ret_pct", "QQQ_Volatility", "QQQ_Volume", "SPY_Price_ret_pct",
               "SPY_Volatility", "SPY_Volume", "TLT_Price_ret_pct", "TLT_Volatility",
               "TLT_Volume", "UMCSENT"]
RECORDED_V2_EXTRA = ["GLD_Price_ma30", "GLD_Price_ma7", "HYG_Price_ma30", "HYG_Price_ma7",
                     "QQQ_Price_ma30", "QQQ_Price_ma7", "SPY_Price_ma30", "SPY_Price_ma7",
                     "TLT_Price_ma30", "TLT_Price_ma7"]
RECORDED_V3_EXTRA = [
    "ratio_GLD_Price_over_HYG_Price", "ratio_GLD_Price_over_TLT_Price",
    "ratio_GLD_Volume_over_HYG_Volume", "ratio_GLD_Volume_over_TLT_Volume",
    "ratio_HYG_Price_over_TLT_Price", "ratio_HYG_Volume_over_TLT_Volume",
    "ratio_QQQ_Price_over_GLD_Price", "ratio_QQQ_Price_over_HYG_Price",
    "ratio_QQQ_Price_over_TLT_Price", "ratio_QQQ_Volume_over_GLD_Volume",
    "ratio_QQQ_Volume_over_HYG_Volume", "ratio_QQQ_Volume_over_TLT_Volume",
    "ratio_SPY_Price_over_GLD_Price", "ratio_SPY_Price_over_HYG_Price",
    "ratio_SPY_Price_over_QQQ_Price", "ratio_SPY_Price_over_TLT_Price",
    "ratio_SPY_Volume_over_GLD_Volume", "ratio_SPY_Volume_over_HYG_Volume",
    "ratio_SPY_Volume_over_QQQ_Volume", "ratio_SPY_Volume_over_TLT_Volume"]


def test_feature_names_from_the_reference_wide_table(spark):
    """T7: a wide table with the reference's columns gives exactly the
    recorded 20 / 30 / 50 features; returns forward-fill a gap."""
    import datetime as dt
    from tidewatch.operators.features import build_feature_set_from_wide
    tickers = ["SPY", "QQQ", "GLD", "HYG", "TLT"]
    macro = ["CPIAUCSL", "HOUST", "BAMLH0A0HYM2", "DGS10", "UMCSENT"]
    cols = ["ts"] + [f"{t}_{m}" for t in tickers for m in ("Price", "Volume", "Volatility")] \
        + ["VIX_Price"] + macro
    rows = []
    for i in range(70):
        r = [dt.date(2024, 1, 1) + dt.timedelta(days=i)]
        for k, _ in enumerate(tickers):
            r += [100.0 + k + (i % 9) if (k, i) != (0, 5) else None, 1000 + 10 * k + i, 0.1 + 0.01 * (i % 5)]
        r += [15.0 + (i % 13)] + [float(j + i % 3) for j in range(len(macro))]
        rows.append(tuple(r))
    schema = ", ".join(["ts date"] + [f"{c} {'bigint' if c.endswith('_Volume') else 'double'}"
                                      for c in cols[1:]])
    wide = spark.createDataFrame(rows, schema)
    fs = {v: build_feature_set_from_wide(wide, v) for v in ("v1", "v2", "v3")}
    assert sorted(fs["v1"].features) == sorted(RECORDED_V1)
    assert sorted(fs["v2"].features) == sorted(RECORDED_V1 + RECORDED_V2_EXTRA)
    assert sorted(fs["v3"].features) == sorted(RECORDED_V1 + RECORDED_V2_EXTRA + RECORDED_V3_EXTRA)
    got = {r.ts: r.SPY_Price_ret_pct for r in fs["v1"].df.collect()}
    price = [r[1] for r in rows]
    ff = []
    for p in price:
        ff.append(p if p is not None else ff[-1])
    for i, r in enumerate(rows):
        exp = None if i == 0 else (ff[i] / ff[i - 1] - 1) * 100
        assert (exp is None and got[r[0]] is None) or abs(got[r[0]] - exp) < 1e-9


def test_best_selection_on_recorded_summary(spark):
    """T8: the recorded six-run summary; the best run per task is v3 for
    both (accuracy .9136, R2 .3907), each winner source's share of wins, and
    the experiment statistics."""
    from tidewatch.plans.models import RESULT_SCHEMA, experiment_stats, leaderboard
    # Version, task, winner source, features, test metric (recorded summary).
    recorded = [("v1", "classification", "sklearn", 20, 0.6454545454545455),
                ("v1", "regression", "sklearn", 20, 0.20588204500368423),
                ("v2", "classification", "flaml", 30, 0.8636363636363636),
                ("v2", "regression", "sklearn", 30, 0.29468369107942005),
                ("v3", "classification", "sklearn", 50, 0.9136363636363637),
                ("v3", "regression", "sklearn", 50, 0.3906945031288449)]
    rows = [(v, t, m, n, 657, None, 220, None, metric,
             "accuracy" if t == "classification" else "r2", None, "ok", True)
            for v, t, m, n, metric in recorded]
    res = spark.createDataFrame(rows, RESULT_SCHEMA)
    best = {r.task: (r.version, r.test_metric) for r in
            leaderboard(res).where("rank = 1").collect()}
    assert best == {"classification": ("v3", 0.9136363636363637),
                    "regression": ("v3", 0.3906945031288449)}
    shares = {r.best_model: r.win_share for r in leaderboard(res).collect()}
    assert abs(shares["sklearn"] - 5 / 6) < 1e-12 and abs(shares["flaml"] - 1 / 6) < 1e-12
    st = experiment_stats(res).first()
    assert (st.successful, st.versions, st.tasks, st.automl_available) == (6, 3, 2, True)
    assert abs(st.max_test_metric - 0.9136363636363637) < 1e-15
