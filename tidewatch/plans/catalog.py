"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the survey inventory.  Each reads the tables (or frames Spark
derives from them) in full; floating results are rounded so that an
independent SQL engine can be compared value by value."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import SENTIMENT_LABELS, neg_log10, safe_ratio
from ..operators import drift as D
from ..operators import stats as S
from ..operators.features import LABEL_COL, TARGET_VALUE, build_feature_set, series_features
from ..operators.panel import list_symbols, numeric_columns
from ..operators.ranks import exact_quantiles
from ..operators.target import add_sentiment, threshold_stats
from ..session import materialize
from ..sources.tables import read_table
from . import inputs as I
from .source_queries import source_catalog

Query = Callable[[SparkSession, str], DataFrame]


def _r(c, n: int):
    """Comparison rounding, tie-safe (see ``oracle._off``): a fixed offset of
    1.2345678912e-(n+3) is added before rounding to n decimals."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col + F.lit(1.2345678912 * 10 ** -(n + 3)), n)


# ---- minimum slice: panel -> thresholds -> labels -> counts ---------------

def i1_sentiment_counts(spark, sf):
    lab = add_sentiment(I.panel(spark, sf), "price", LABEL_COL)
    return lab.groupBy(LABEL_COL).agg(F.count(F.lit(1)).alias("n"))


def i1_target_labels(spark, sf):
    lab = add_sentiment(I.panel(spark, sf), "price", LABEL_COL)
    return lab.select("symbol", "ts", _r("price", 5).alias("price"), LABEL_COL)


def a1_panel_daily(spark, sf):
    p = I.panel(spark, sf)
    return p.select("symbol", "ts", _r("price", 5).alias("price"), "volume",
                    _r("volatility", 5).alias("volatility"))


def h5_wide_panel(spark, sf):
    w = I.wide_panel(spark, sf)
    return w.select("ts", *[_r(c, 5).alias(c) if not c.endswith("_Volume") else F.col(c)
                            for c in w.columns if c != "ts"])


def c1_returns(spark, sf):
    f = series_features(I.dense_panel(spark, sf))
    return f.select("symbol", "ts", _r("ret_pct", 8).alias("ret_pct"))


def f3_f4_moving_averages(spark, sf):
    f = series_features(I.dense_panel(spark, sf))
    return f.select("symbol", "ts", _r("ma7", 5).alias("ma7"), _r("ma30", 5).alias("ma30"))


def _feature_query(version):
    def q(spark, sf):
        fs = I.feature_set(spark, sf, version)
        cols = []
        for c in fs.df.columns:
            if c in ("ts", LABEL_COL) or (c.endswith("_Volume") and not c.startswith("ratio_")):
                cols.append(F.col(c))
            elif c.startswith("ratio_") or c.endswith("_ret_pct"):
                cols.append(_r(c, 8).alias(c))
            else:
                cols.append(_r(c, 5).alias(c))
        return fs.df.select(*cols)
    q.__name__ = f"features_{version}"
    return q


# ---- aggregations ---------------------------------------------------------

def e1_missing_counts(spark, sf):
    mc = S.missing_counts(I.wide_panel(spark, sf))
    return mc.select("column", "missing_count", _r("missing_share", 8).alias("missing_share"))


def e2_describe(spark, sf):
    w = I.wide_panel(spark, sf)
    d = S.describe(w, [c for c in w.columns if c != "ts"])
    return d.select("column", "count", *[_r(c, 5).alias(c) for c in
                                         ("mean", "std", "min", "p25", "p50", "p75", "max")])


def e3_mean_std(spark, sf):
    m = S.mean_std(I.panel(spark, sf), "price", ["symbol"])
    return m.select("symbol", _r("mean", 5).alias("mean"), _r("std", 5).alias("std"), "n")


def e4_correlation(spark, sf):
    w = I.wide_panel(spark, sf)
    c = S.correlation_pairs(w, [x for x in w.columns if x != "ts"])
    return c.select("col_a", "col_b", _r("corr", 8).alias("corr"))


def e5_value_counts(spark, sf):
    lab = add_sentiment(I.panel(spark, sf), "price", LABEL_COL)
    vc = S.value_counts(lab, LABEL_COL, by=["symbol"])
    return vc.select("symbol", LABEL_COL, "n", _r("share", 8).alias("share"))


def e7_histogram(spark, sf):
    h = S.histogram(I.panel(spark, sf), "price", 20, by=["symbol"])
    return h.select("symbol", "bin", _r("lo", 5).alias("lo"), _r("hi", 5).alias("hi"), "n",
                    _r(F.col("density") * 1e6, 5).alias("density_e6"))


def e8_density_2d(spark, sf):
    f = series_features(I.dense_panel(spark, sf))
    return S.histogram_2d(f, "price", "ma7", grid=35, min_count=1)


def e9_quantiles(spark, sf):
    q = exact_quantiles(I.panel(spark, sf), ["symbol"], "price", [0.05, 0.95])
    return q.select("symbol", "p", _r("q", 5).alias("q"))


def e10_calibration(spark, sf):
    pf = I.persistence_forecast(spark, sf)
    c = S.calibration_bins(pf, "actual", "predicted", q=10)
    return c.select("bin", _r("mean_actual", 5).alias("mean_actual"),
                    _r("mean_predicted", 5).alias("mean_predicted"),
                    _r("std_actual", 5).alias("std_actual"), "n")


def e11_errors_by_zone(spark, sf):
    pf = I.persistence_forecast(spark, sf)
    mu, sigma = threshold_stats(pf, "actual")
    z = S.errors_by_zone(pf, "actual", "predicted", mu, sigma)
    return z.select("zone", "zone_order", "n", _r("mae", 5).alias("mae"),
                    _r("rmse", 5).alias("rmse"))


def e12_regression_metrics(spark, sf):
    f = series_features(I.dense_panel(spark, sf))
    m = S.regression_metrics(f, "price", "ma7", by=["symbol"])
    return m.select("symbol", "n", _r("mae", 5).alias("mae"), _r("rmse", 5).alias("rmse"),
                    _r("r2", 8).alias("r2"), _r("mape", 5).alias("mape"))


def _labels_conf(spark, sf):
    lab = read_table(spark, sf, "labels", "quality", "toxic")
    return S.confusion(lab.select(F.col("quality").cast("string").alias("quality"),
                                  F.col("toxic").cast("string").alias("toxic")),
                       "quality", "toxic")


def e13_confusion(spark, sf):
    return _labels_conf(spark, sf)


def e14_classification_report(spark, sf):
    rep = S.classification_report(_labels_conf(spark, sf))
    return rep.select("row", _r("precision", 10).alias("precision"),
                      _r("recall", 10).alias("recall"), _r("f1", 10).alias("f1"), "support")


def _feature_sides(spark, sf, version="v3"):
    fs = I.feature_set(spark, sf, version)
    return fs, I.sides(fs.df)


def e15_class_balance(spark, sf):
    df = _label_sides(spark, sf)
    return df.where(F.col(LABEL_COL).isNotNull()).groupBy("side", LABEL_COL).agg(
        F.count(F.lit(1)).alias("n"))


def e16_shape(spark, sf):
    _, df = _feature_sides(spark, sf, "v1")
    return S.shape_and_range(df, "ts", by=["side"])


def e17_unique_counts(spark, sf):
    w = I.wide_panel(spark, sf)
    return S.unique_counts(w, [c for c in w.columns if c != "ts"])


def e19_mean_in_sigma(spark, sf, n_sigma: float = 2.0):
    m = D.moment_stats(I.drift_long(spark, sf))
    band = F.abs(F.col("curr_mean") - F.col("ref_mean")) <= F.lit(n_sigma) * F.col("ref_std")
    return m.select("feature", _r("ref_mean", 5).alias("ref_mean"),
                    _r("ref_std", 5).alias("ref_std"), _r("curr_mean", 5).alias("curr_mean"),
                    F.coalesce(band, F.lit(False)).alias("mean_in_sigma"))


def f5_chrono_split(spark, sf):
    s = I.sides(I.panel(spark, sf))
    return s.groupBy("side").agg(F.count_distinct("ts").alias("n_dates"),
                                 F.count(F.lit(1)).alias("n_rows"),
                                 F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"))


# ---- drift ----------------------------------------------------------------

def _label_sides(spark, sf):
    """Market target labelled by its own mean +- std, split into sides
    (one row per date; materialized once per application)."""
    from ..session import cached

    def build():
        lab = add_sentiment(I.market(spark, sf), "Target_Price", LABEL_COL)
        return I.sides(lab.select("ts", F.col("Target_Price").alias(TARGET_VALUE), LABEL_COL))
    return cached(spark, ("label_sides", sf), build)


def _numeric_drift(spark, sf):
    """Per-feature drift rows with p-values (one row per feature)."""
    from ..session import cached
    return cached(spark, ("numeric_drift", sf), lambda: D.numeric_drift(I.drift_long(spark, sf)))


def _target_drift(spark, sf):
    """Chi-square target drift row (with p-value), materialized once."""
    from ..session import cached
    return cached(spark, ("target_drift", sf),
                  lambda: D.target_drift(_label_sides(spark, sf), LABEL_COL))


def d1_category_alignment(spark, sf):
    return D.category_alignment(_label_sides(spark, sf), LABEL_COL)


def i5_ks_statistic(spark, sf):
    st = D.numeric_drift_stats(I.drift_long(spark, sf))
    return st.select("feature", "n_ref", "n_cur", _r("ks_statistic", 10).alias("ks_statistic"))


def i6_mann_whitney(spark, sf):
    st = D.numeric_drift_stats(I.drift_long(spark, sf))
    return st.select("feature", "mw_statistic", "tie_term", _r("mw_z", 8).alias("mw_z"))


def i7_cohens_d(spark, sf):
    st = D.numeric_drift_stats(I.drift_long(spark, sf))
    return st.select("feature", _r("cohens_d", 8).alias("cohens_d"),
                     _r("mean_shift_pct", 8).alias("mean_shift_pct"))


def i9_chi_square(spark, sf):
    st = D.chi_square_stats(D.category_alignment(_label_sides(spark, sf), LABEL_COL))
    return st.select(_r("chi2_statistic", 10).alias("chi2_statistic"),
                     F.col("dof").cast("long").alias("dof"), "n_ref", "n_cur")


def i19_ref_cur_comparison(spark, sf):
    c = D.ref_cur_comparison(I.drift_long(spark, sf))
    return c.select("feature", *[_r(x, 5).alias(x) for x in
                                 ("ref_mean", "curr_mean", "ref_std", "curr_std")],
                    _r("mean_shift_pct", 8).alias("mean_shift_pct"))


def i8_drift_report(spark, sf):
    return _numeric_drift(spark, sf).select(
        "feature", _r("ks_statistic", 10).alias("ks_statistic"), _r("ks_pvalue", 8).alias("ks_pvalue"),
        _r("mw_pvalue", 8).alias("mw_pvalue"), _r("cohens_d", 8).alias("cohens_d"), "drift_detected")


def i10_drift_summary(spark, sf):
    feats = _numeric_drift(spark, sf)
    tgt = _target_drift(spark, sf)
    s = D.drift_summary(feats, tgt)
    return s.withColumns({c: _r(c, 8) for c in ("drift_percentage", "data_quality_score")})


def i12_target_drift(spark, sf):
    t = _target_drift(spark, sf)
    return t.select(_r("chi2_statistic", 10).alias("chi2_statistic"),
                    F.col("dof").cast("long").alias("dof"), "n_ref", "n_cur",
                    _r("chi2_pvalue", 10).alias("chi2_pvalue"), "drift_detected")


def i14_error_analysis(spark, sf):
    pf = I.persistence_forecast(spark, sf)
    res = F.col("actual") - F.col("predicted")
    return pf.select("ts", _r("actual", 5).alias("actual"), _r("predicted", 5).alias("predicted"),
                     _r(res, 5).alias("residual"),
                     _r(F.abs(F.try_divide(res, F.col("actual"))) * 100, 8).alias("abs_pct_error"))


def i13_dummy_baseline(spark, sf):
    """Majority class (fitted on ref) scored on cur; mean (ref) as regression
    baseline scored on cur."""
    df = _label_sides(spark, sf)
    ref = df.where(F.col("side") == "ref")
    cur = df.where(F.col("side") == "cur")
    major = (ref.where(F.col(LABEL_COL).isNotNull()).groupBy(LABEL_COL)
             .agg(F.count(F.lit(1)).alias("n"))
             .select(F.max_by(LABEL_COL, F.struct("n", LABEL_COL)).alias("m")).scalar())
    mean_ref = ref.select(F.avg(TARGET_VALUE)).scalar()
    e = mean_ref - F.col(TARGET_VALUE)
    return cur.agg(
        F.first(major).alias("majority_class"),
        F.avg(F.when(F.col(LABEL_COL) == major, 1.0).otherwise(0.0)).alias("_acc"),
        F.sqrt(F.avg(e * e)).alias("_rmse"), F.avg(F.abs(e)).alias("_mae")).select(
        "majority_class", _r("_acc", 10).alias("accuracy"), _r("_rmse", 5).alias("rmse"),
        _r("_mae", 5).alias("mae"))


def i15_quality_report(spark, sf):
    """Per column of the v1 feature frame: missing count/share and exact
    5 % / 95 % quantiles; plus the label pattern share as its own row."""
    fs = I.feature_set(spark, sf, "v1")
    df = fs.df
    cols = [c for c in numeric_columns(df)]
    mc = S.missing_counts(df, cols)
    q = exact_quantiles(S.long_values(df, cols), ["column"], "value", [0.05, 0.95])
    qw = q.groupBy("column").agg(F.max(F.when(F.col("p") == 0.05, F.col("q"))).alias("q05"),
                                 F.max(F.when(F.col("p") == 0.95, F.col("q"))).alias("q95"))
    pattern = "^(" + "|".join(SENTIMENT_LABELS) + ")$"
    lab = df.agg(F.lit(LABEL_COL).alias("column"),
                 F.count_if(F.col(LABEL_COL).isNull()).alias("missing_count"),
                 F.avg(F.col(LABEL_COL).rlike(pattern).cast("double")).alias("pattern_share"))
    num = mc.join(qw, "column", "left").select(
        "column", "missing_count", _r("missing_share", 8).alias("missing_share"),
        _r("q05", 5).alias("q05"), _r("q95", 5).alias("q95"),
        F.lit(None).cast("double").alias("pattern_share"))
    lab = lab.select("column", "missing_count",
                     _r(F.col("missing_count") / F.lit(1.0) / df.select(F.count(F.lit(1))).scalar(),
                        8).alias("missing_share"),
                     F.lit(None).cast("double").alias("q05"), F.lit(None).cast("double").alias("q95"),
                     _r("pattern_share", 8).alias("pattern_share"))
    return num.unionByName(lab)


def b8_dropna_counts(spark, sf):
    """Rows left after B7 (target not null), B8 (no feature null) and B9
    (no column null) on each feature version."""
    out = None
    for v in ("v1", "v2", "v3"):
        fs = I.feature_set(spark, sf, v)
        df = fs.df
        row = df.agg(
            F.lit(v).alias("version"), F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(TARGET_VALUE).isNotNull()).alias("n_target"),
            F.count_if(F.col(TARGET_VALUE).isNotNull() & F.greatest(
                *[F.col(c).isNull() for c in fs.features]).eqNullSafe(F.lit(False))
            ).alias("n_complete"),
            F.count_if(~F.greatest(F.lit(False), *[F.col(c).isNull() for c in df.columns])).alias("n_no_null"),
            F.lit(len(fs.features)).cast("long").alias("n_features"))
        out = row if out is None else out.unionByName(row)
    return out


def c3_loose_ratio(spark, sf):
    """C3: the loose ratio keeps a zero denominator (here: days on which all
    orders of a symbol cost the same), the strict one makes it NULL."""
    p = I.panel(spark, sf).withColumn("spread", F.coalesce("volatility", F.lit(0.0)))
    small = lambda strict: F.log10(safe_ratio("price", "spread", strict))
    return p.select("symbol", "ts", _r(small(False), 5).alias("loose"), _r(small(True), 5).alias("strict"))


def c8_scalar_functions(spark, sf):
    """C8: absolute value, square root and negative decimal logarithm."""
    p = I.panel(spark, sf)
    return p.select("symbol", "ts", _r(F.abs(F.col("price") - 150000.0), 5).alias("distance"),
                    _r(F.sqrt("price"), 5).alias("root"), _r(neg_log10("price"), 5).alias("neg_log10"))


def catalog() -> dict[str, Query]:
    return {
        "c3_loose_ratio": c3_loose_ratio,
        "c8_scalar_functions": c8_scalar_functions,
        "i1_sentiment_counts": i1_sentiment_counts,
        "i1_target_labels": i1_target_labels,
        "a1_panel_daily": a1_panel_daily,
        "h5_wide_panel": h5_wide_panel,
        "c1_returns": c1_returns,
        "f3_f4_moving_averages": f3_f4_moving_averages,
        "i2_features_v1": _feature_query("v1"),
        "i3_features_v2": _feature_query("v2"),
        "i4_features_v3": _feature_query("v3"),
        "e1_missing_counts": e1_missing_counts,
        "e2_describe": e2_describe,
        "e3_mean_std": e3_mean_std,
        "e4_correlation": e4_correlation,
        "e5_value_counts": e5_value_counts,
        "e7_histogram": e7_histogram,
        "e8_density_2d": e8_density_2d,
        "e9_quantiles": e9_quantiles,
        "e10_calibration": e10_calibration,
        "e11_errors_by_zone": e11_errors_by_zone,
        "e12_regression_metrics": e12_regression_metrics,
        "e13_confusion": e13_confusion,
        "e14_classification_report": e14_classification_report,
        "e15_class_balance": e15_class_balance,
        "e16_shape": e16_shape,
        "e17_unique_counts": e17_unique_counts,
        "e19_mean_in_sigma": e19_mean_in_sigma,
        "f5_chrono_split": f5_chrono_split,
        "d1_category_alignment": d1_category_alignment,
        "i5_ks_statistic": i5_ks_statistic,
        "i6_mann_whitney": i6_mann_whitney,
        "i7_cohens_d": i7_cohens_d,
        "i9_chi_square": i9_chi_square,
        "i19_ref_cur_comparison": i19_ref_cur_comparison,
        "i14_error_analysis": i14_error_analysis,
        "i13_dummy_baseline": i13_dummy_baseline,
        "i15_quality_report": i15_quality_report,
        "b8_dropna_counts": b8_dropna_counts,
        "i8_drift_report": i8_drift_report,
        "i10_drift_summary": i10_drift_summary,
        "i12_target_drift": i12_target_drift,
        **more_catalog(),
        **extra_catalog(),
        **last_catalog(),
        **request_catalog(),
        **document_catalog(),
        **ranking_catalog(),
        **scoring_catalog(),
        **source_catalog(),
    }


# ---- sources / sinks / feature store --------------------------------------

def a5_csv_roundtrip(spark, sf):
    """Panel -> CSV sink -> CSV scan with an explicit schema."""
    from ..session import scratch_path
    from ..sources.files import read_csv_panel, write_csv
    path = scratch_path(spark, "panel_csv")
    p = I.panel(spark, sf)
    write_csv(p, path)
    back = read_csv_panel(spark, path, schema=p.schema)
    return back.select("symbol", "ts", _r("price", 5).alias("price"), "volume",
                       _r("volatility", 5).alias("volatility"))


def _store_with_versions(spark, sf):
    from ..session import scratch_path
    from .store import FeatureStore
    store = FeatureStore(spark, scratch_path(spark, "feature_store"))
    p = I.panel(spark, sf)
    for v in ("v1", "v2", "v3"):
        store.save(I.feature_set(spark, sf, v), name=f"sentiment_{v}", description=f"features {v}")
    return store


def a6_a7_feature_store_roundtrip(spark, sf):
    """Save v3 to the partitioned store, load it back by name (partition
    pruning) and return it rounded like ``i4_features_v3``."""
    from ..session import scratch_path
    from .store import FeatureStore
    store = FeatureStore(spark, scratch_path(spark, "feature_store"))
    store.save(I.feature_set(spark, sf, "v3"), name="sentiment_v3")
    fs = store.load("sentiment_v3")
    return _round_features(fs.df)


def a9_a11_registry(spark, sf):
    """Registry listing after saving v1-v3 (SQL over the registry view)."""
    store = _store_with_versions(spark, sf)
    return store.query().select("feature_set_name", "version", "num_features", "num_samples",
                                "date_range_start", "date_range_end")


def _round_features(df):
    cols = []
    for c in df.columns:
        if c in ("ts", LABEL_COL) or (c.endswith("_Volume") and not c.startswith("ratio_")):
            cols.append(F.col(c))
        elif c.startswith("ratio_") or c.endswith("_ret_pct"):
            cols.append(_r(c, 8).alias(c))
        else:
            cols.append(_r(c, 5).alias(c))
    return df.select(*cols)


# ---- streaming --------------------------------------------------------------

def m1_windowed_monitoring(spark, sf):
    """Hourly windows per event type behind a 1-hour watermark, compared with
    the reference statistics; rows of every window the watermark finalized."""
    from ..streaming.monitor import run_windowed_monitoring
    out = run_windowed_monitoring(spark, f"{sf.rstrip('/')}/events.parquet")
    w = spark.read.parquet(out)
    return w.select("window_start", "window_end", "symbol", "n", _r("mean", 8).alias("mean"),
                    _r("std", 8).alias("std"), _r("mean_shift", 8).alias("mean_shift"), "alert")


def m1_hourly_skew(spark, sf):
    """Hourly distance of each event type's bin shares from the training
    shares, with the window's label counts."""
    from ..streaming.skew import run_hourly_skew
    w = spark.read.parquet(run_hourly_skew(spark, f"{sf.rstrip('/')}/events.parquet"))
    return w.withColumn("skew", _r("skew", 8))


def m2_live_labels(spark, sf):
    """Events labelled on the stream by per-type mean +- std of the
    reference; counts per type and label."""
    from ..streaming.monitor import run_live_labels
    out = run_live_labels(spark, f"{sf.rstrip('/')}/events.parquet")
    return spark.read.parquet(out).groupBy("symbol", "label").agg(F.count(F.lit(1)).alias("n"))


# ---- monitoring suite, alerts ------------------------------------------------

def _monitoring_parts(spark, sf):
    from ..operators.panel import list_symbols, to_wide
    p = I.panel(spark, sf)
    syms = list_symbols(p)
    wide = to_wide(p, syms).join(I.market(spark, sf), "ts")
    lab = add_sentiment(wide, "Target_Price", LABEL_COL)
    # one row per date; every check of the suite reads it: materialize once
    from ..session import cached
    wide_s = cached(spark, ("monitoring_wide", sf), lambda: I.sides(lab))
    cols = [c for c in wide.columns if c != "ts"]
    feats = _numeric_drift(spark, sf)
    tgt = _target_drift(spark, sf)
    return wide_s, cols, feats, tgt, f"{syms[0]}_Price"


# The market level that the suite holds to be sound.
MARKET_RANGE = (100_000.0, 200_000.0)


def i16_test_suite(spark, sf):
    from .monitoring import test_suite
    wide_s, cols, feats, tgt, key = _monitoring_parts(spark, sf)
    suite = test_suite(wide_s, cols, feats, tgt, key, "Target_Price", value_range=MARKET_RANGE)
    return suite.withColumns({c: _r(c, 5) for c in ("observed", "threshold")})


def i17_alerts(spark, sf):
    from .monitoring import alerts, test_suite
    wide_s, cols, feats, tgt, key = _monitoring_parts(spark, sf)
    suite = test_suite(wide_s, cols, feats, tgt, key, "Target_Price", value_range=MARKET_RANGE)
    return alerts(D.drift_summary(feats, tgt), D.dataset_drift(feats), suite)


def i11_dataset_drift(spark, sf):
    d = D.dataset_drift(_numeric_drift(spark, sf))
    return d.withColumn("share_drifted", _r("share_drifted", 8))


# ---- models -------------------------------------------------------------------

def _sweep_parts(spark, sf):
    """The sweep at full size: the run rows, the candidate rows and a registry
    (version, task, path, created_at) of the saved winners, materialized once
    per application.  Each winner is registered twice, so that a lookup has
    an older entry to pass over."""
    from datetime import datetime, timedelta
    from ..session import cached, scratch_path
    from .models import save_model, sweep
    holder = {}

    def build():
        models, prepared = {}, {}
        res, trials = sweep(spark, [I.model_features(spark, sf, v) for v in _VERSIONS], with_trials=True, models=models,
                            prepared=prepared)
        now, entries = datetime.now(), []
        for (version, task), model in models.items():
            cached(spark, ("model_test", sf, version, task), lambda p=prepared[version, task]: p.test)
            path = scratch_path(spark, f"model_{version}_{task}")
            save_model(model, path)
            entries += [(version, task, f"{path}-older", now - timedelta(days=1)), (version, task, path, now)]
        holder["trials"], holder["registry"] = trials, spark.createDataFrame(
            entries, "version string, task string, path string, created_at timestamp")
        return res
    res = cached(spark, ("model_sweep", sf), build)
    return (res, cached(spark, ("model_trials", sf), lambda: holder["trials"]),
            cached(spark, ("model_registry", sf), lambda: holder["registry"]))


def _sweep(spark, sf):
    return _sweep_parts(spark, sf)[0]


def j18_model_sweep(spark, sf):
    """3 feature versions x 2 tasks; MLlib candidates selected on validation,
    scored on the last 20 % of dates."""
    return _sweep(spark, sf)


_VERSIONS = ("v1", "v2", "v3")


def j5_train_val_split(spark, sf):
    """Rows and dates of the chronological 70/30 split of each version, over
    complete rows of the first 80 % of dates."""
    from .regression import train_val
    out = None
    for v in _VERSIONS:
        part = train_val(I.model_features(spark, sf, v)).groupBy("part").agg(
            F.lit(v).alias("version"), F.count(F.lit(1)).alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"))
        out = part if out is None else out.unionByName(part)
    return out


def j2_scaled_features(spark, sf):
    """v1 features divided by the population deviation of the training part,
    without centring."""
    from .regression import PopulationScaler, scaled_names, train_val
    fs = I.model_features(spark, sf, "v1")
    rows = materialize(train_val(fs))
    scaler = PopulationScaler(inputCols=fs.features, outputCols=scaled_names(fs.features))
    scaled = scaler.fit(rows.where("part = 'train'")).transform(rows)
    return scaled.select("ts", "part", *[_r(f"{c}__scaled", 6).alias(c) for c in fs.features])


def j7_regression_candidates(spark, sf):
    """Ridge, a forest of 400 trees and 500 rounds of boosting on the 70/30
    split of v1, with RMSE, MAE, R2 and the metrics of the label that one pair
    of thresholds gives to both sides."""
    from .regression import fit_candidates
    fs = I.model_features(spark, sf, "v1")
    mu, sigma = threshold_stats(fs.df, TARGET_VALUE)
    return fit_candidates(fs, mu, sigma)[0].drop("seconds")


def _candidates(spark, sf):
    """Candidates of the deterministic forecasters (see ``runs``)."""
    from ..session import cached
    from .runs import market_candidates
    return cached(spark, ("run_candidates", sf), lambda: market_candidates(I.market(spark, sf)))


def _runs(spark, sf):
    from .runs import HORIZONS, runs
    return runs(_candidates(spark, sf), list(HORIZONS))


_METRIC_COLUMNS = ("val_metric", "test_metric", "rmse", "mae", "r2")


def j14_winner_selection(spark, sf):
    """The winner of every version and task on the validation dates, with its
    metrics on the test dates; FAILED where there is no candidate."""
    return _runs(spark, sf).withColumns({c: _r(c, 5) for c in _METRIC_COLUMNS})


def j15_candidate_metrics(spark, sf):
    """Every candidate's metrics on the validation and the test dates."""
    return _candidates(spark, sf).withColumns(
        {c: _r(c, 5) for c in ("val_metric", "rmse", "mae", "r2", "accuracy", "macro_f1")})


def j19_leaderboard(spark, sf):
    """Successful runs ranked per task, with each winner's share of wins."""
    from .models import leaderboard
    board = leaderboard(_runs(spark, sf))
    return board.select("best_model", "version", "task", F.col("rank").cast("long").alias("rank"), "wins",
                        _r("win_share", 8).alias("win_share"), _r("test_metric", 5).alias("test_metric"))


def j19_leaderboard_rollup(spark, sf):
    """Runs by version and task with subtotals (grouping sets)."""
    from .runs import summary
    return summary(_runs(spark, sf)).withColumns({c: _r(c, 5) for c in ("best_accuracy", "best_r2")})


def e20_experiment_stats(spark, sf):
    from .models import experiment_stats
    return experiment_stats(_runs(spark, sf)).withColumn("max_test_metric", _r("max_test_metric", 5))


def j17_feature_importance(spark, sf):
    """Top-20 native importances of a random forest on v3 (classification)."""
    from .models import _pipeline, feature_importance, forest, prepare
    p = prepare(I.model_features(spark, sf, "v3"), "classification")
    model = _pipeline(p, forest("classification")).fit(p.train)
    rows = [(i + 1, f, v) for i, (f, v) in enumerate(feature_importance(model, p.features))]
    return spark.createDataFrame(rows, "rank int, feature string, importance double")


def more_catalog() -> dict[str, Query]:
    return {
        "a5_csv_roundtrip": a5_csv_roundtrip,
        "a6_a7_feature_store_roundtrip": a6_a7_feature_store_roundtrip,
        "a9_a11_registry": a9_a11_registry,
        "m1_windowed_monitoring": m1_windowed_monitoring,
        "m1_hourly_skew": m1_hourly_skew,
        "m2_live_labels": m2_live_labels,
        "i11_dataset_drift": i11_dataset_drift,
        "i16_test_suite": i16_test_suite,
        "i17_alerts": i17_alerts,
        "j18_model_sweep": j18_model_sweep,
        "j2_scaled_features": j2_scaled_features,
        "j5_train_val_split": j5_train_val_split,
        "j7_regression_candidates": j7_regression_candidates,
        "j14_winner_selection": j14_winner_selection,
        "j15_candidate_metrics": j15_candidate_metrics,
        "j19_leaderboard_rollup": j19_leaderboard_rollup,
        "j19_leaderboard": j19_leaderboard,
        "e20_experiment_stats": e20_experiment_stats,
        "j17_feature_importance": j17_feature_importance,
    }


# ---- more inventory items -------------------------------------------------------

def i20_serving_skew(spark, sf, threshold: float = 0.01):
    """Per event type: L-infinity distance between value-bin shares of the
    first 80 % of event days (reference) and the rest; alert above 0.01."""
    from ..sources.tables import events_series
    ev = events_series(spark, sf)
    long = I.sides(ev.select(F.col("symbol").alias("feature"), F.to_date("ts").alias("day"),
                             "value"), ts="day")
    d = D.binned_distance(long, n_bins=10)
    return d.select("feature", _r("linf_distance", 10).alias("linf_distance"),
                    (F.col("linf_distance") > threshold).alias("alert"))


def e18_column_summary(spark, sf):
    """Per side and wide-panel column: count, missing, mean, min, max and
    distinct values, in one aggregate per side."""
    w = I.sides(I.wide_panel(spark, sf))
    cols = [c for c in w.columns if c not in ("ts", "side")]
    long = S.long_values(w, cols, key_cols=["side"])
    return long.groupBy("side", "column").agg(
        F.count("value").alias("count"), F.count_if(F.col("value").isNull()).alias("missing"),
        _r(F.avg("value"), 5).alias("mean"), _r(F.min("value"), 5).alias("min"),
        _r(F.max("value"), 5).alias("max"), F.count_distinct("value").alias("n_unique"))


def a2_holdout_pair(spark, sf):
    """Reference and current holdouts written as two CSV files and scanned
    back as one long frame with ``side``; rows and date range per side."""
    from ..session import scratch_path
    from ..sources.files import read_holdout_pair, write_csv
    w = I.sides(I.wide_panel(spark, sf)).withColumnRenamed("ts", "Date")
    ref_p, cur_p = scratch_path(spark, "holdout_ref"), scratch_path(spark, "holdout_cur")
    write_csv(w.where(F.col("side") == "ref").drop("side"), ref_p)
    write_csv(w.where(F.col("side") == "cur").drop("side"), cur_p)
    schema = w.drop("side").schema
    pair = read_holdout_pair(spark, ref_p, cur_p, "Date", schema)
    return pair.groupBy("side").agg(F.count(F.lit(1)).alias("n_rows"),
                                    F.to_date(F.min("Date")).alias("min_date"),
                                    F.to_date(F.max("Date")).alias("max_date"))


def i21_monitoring_run(spark, sf):
    """End-to-end monitoring run: drift, target drift, suite and alerts are
    appended to result tables (JSON lines, stamped with the run time); the
    run summary row is returned."""
    from ..session import scratch_path
    from ..sources.files import write_results
    from .monitoring import alerts, stamp, suite_summary, test_suite
    wide_s, cols, feats, tgt, key = _monitoring_parts(spark, sf)
    suite = materialize(test_suite(wide_s, cols, feats, tgt, key, "Target_Price", value_range=MARKET_RANGE))
    summary = materialize(D.drift_summary(feats, tgt))
    al = alerts(summary, D.dataset_drift(feats), suite)
    root = scratch_path(spark, "monitoring")
    for name, df in (("drift", feats), ("target_drift", tgt), ("suite", suite), ("alerts", al)):
        write_results(stamp(df), f"{root}/{name}")
    ss = suite_summary(suite)
    n_alerts = spark.read.json(f"{root}/alerts").count()
    return summary.select("features_tested", "features_with_drift", _r("drift_percentage", 8).alias("drift_percentage"),
                          "overall_drift_detected",
                          ss.select("passed").scalar().alias("tests_passed"),
                          ss.select("total").scalar().alias("tests_total"),
                          F.lit(n_alerts).alias("alerts"))


def j20_batch_scoring(spark, sf):
    """Every version's and task's newest registered model, loaded and applied
    to the test dates with the whole pipeline; predicted values are labelled by
    the pair of thresholds that labelled the rows, and both tasks are judged
    by accuracy and macro F1 (regression also by RMSE, MAE and R2)."""
    from concurrent.futures import ThreadPoolExecutor
    from pyspark.ml.feature import IndexToString
    from ..functions.scalar import threshold_label
    from ..session import cached
    from .models import load_latest_model, prepare
    _, _, registry = _sweep_parts(spark, sf)

    def score(item):
        version, task = item
        fs = I.model_features(spark, sf, version)
        test = cached(spark, ("model_test", sf, version, task), lambda: prepare(fs, task).test)
        pred = load_latest_model(registry, version, task).transform(test)
        if task == "classification":
            pred = IndexToString(inputCol="prediction", outputCol="guess", labels=sorted(SENTIMENT_LABELS)).transform(pred)
            errors = spark.range(1).select(*[F.lit(None).cast("double").alias(c) for c in ("rmse", "mae", "r2")])
        else:
            mu, sigma = threshold_stats(fs.df, TARGET_VALUE)
            pred = pred.withColumn("guess", threshold_label(F.col("prediction"), mu, sigma))
            errors = S.regression_metrics(pred, TARGET_VALUE, "prediction").select("rmse", "mae", "r2")
        judged = S.classification_summary(materialize(S.confusion(pred, LABEL_COL, "guess")))
        return materialize(errors.select(F.lit(version).alias("version"), F.lit(task).alias("task"), "rmse", "mae", "r2",
                                         *[judged.select(c).scalar().alias(c) for c in ("accuracy", "macro_f1", "n")]))

    items = sorted(tuple(r) for r in registry.select("version", "task").distinct().collect())
    with ThreadPoolExecutor(max_workers=max(1, len(items))) as pool:
        rows = list(pool.map(score, items))
    out = None
    for row in rows:
        out = row if out is None else out.unionByName(row)
    return out


def j16_regression_as_sentiment(spark, sf):
    """Regression predictions labelled fear/stable/greed by the pair of
    thresholds that labelled the rows (classification report)."""
    from ..functions.scalar import threshold_label
    from .models import _pipeline, forest, prepare
    fs = I.model_features(spark, sf, "v1")
    p = prepare(fs, "regression")
    pred = _pipeline(p, forest("regression")).fit(p.train).transform(p.test)
    mu, sigma = threshold_stats(fs.df, TARGET_VALUE)
    pred = pred.withColumn("pred_label", threshold_label(F.col("prediction"), mu, sigma))
    return S.classification_report(S.confusion(pred, LABEL_COL, "pred_label"))


def extra_catalog() -> dict[str, Query]:
    return {
        "i20_serving_skew": i20_serving_skew,
        "e18_column_summary": e18_column_summary,
        "a2_holdout_pair": a2_holdout_pair,
        "i21_monitoring_run": i21_monitoring_run,
        "j20_batch_scoring": j20_batch_scoring,
        "j16_regression_as_sentiment": j16_regression_as_sentiment,
    }


def h4_cross_ratios(spark, sf):
    """v3 with price / volatility cross ratios (off by default, as in the
    reference parameters); the 25 cross-ratio columns."""
    fs = build_feature_set(I.panel(spark, sf), "v3", cross_ratios=True)
    cols = [c for c in fs.features if "_over_" in c and c.endswith("_Volatility")]
    # values reach 1e4-1e5 and the sample std loses digits to cancellation:
    # compare at 3 decimals
    return fs.df.select("ts", *[_r(c, 3).alias(c) for c in cols])


def g3_best_of_version(spark, sf):
    """Best candidate of each version by RMSE, MAE and R2, ranked alike."""
    from .runs import best_of_version
    best = best_of_version(_candidates(spark, sf))
    return best.select("version", "model", F.col("rank").cast("long").alias("rank"),
                       *[_r(c, 5).alias(c) for c in ("rmse", "mae", "r2")])


def j13_budgeted_search(spark, sf):
    """Successive halving over forests and boosting on v2 (regression)."""
    from .models import halving_search, prepare
    return halving_search(prepare(I.model_features(spark, sf, "v2"), "regression"))


def j13_nested_samples(spark, sf):
    """Rows of the halving search's nested samples of complete v2 rows."""
    from .models import nested_sample, sample_share
    from .regression import complete_rows
    rows = complete_rows(I.model_features(spark, sf, "v2"))
    out = None
    for rung in range(3):
        part = nested_sample(rows, sample_share(rung, 3, 3)).agg(F.lit(rung).alias("rung"), F.count(F.lit(1)).alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


def j21_cross_validation(spark, sf):
    """Time-ordered 5-fold cross-validation of the full forest on v1."""
    from .models import cross_validate, prepare
    return cross_validate(prepare(I.model_features(spark, sf, "v1"), "classification"), 5)


def j21_fold_sizes(spark, sf):
    """Rows and dates of the expanding folds over complete v1 rows."""
    from .models import expanding_folds
    from .regression import complete_rows
    return expanding_folds(complete_rows(I.model_features(spark, sf, "v1"))).groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"))


def h3_long_features(spark, sf):
    """v3 in long form: rows (ts, name, value) instead of columns."""
    from ..operators.long_features import long_feature_set
    f = long_feature_set(I.panel(spark, sf), "v3")
    fine = F.col("name").startswith("ratio_") | F.col("name").endswith("_ret_pct")
    return f.select("ts", "name", F.when(fine, _r("value", 8)).otherwise(_r("value", 5)).alias("value"))


def i12_prediction_drift(spark, sf):
    """Drift of a forecast between the reference and the current dates."""
    pf = I.persistence_forecast(spark, sf)
    long = I.sides(pf.select(F.lit("Predicted").alias("feature"), "ts", F.col("predicted").alias("value")))
    return D.numeric_drift(long).select(
        "feature", "n_ref", "n_cur", _r("ks_statistic", 10).alias("ks_statistic"), _r("ks_pvalue", 8).alias("ks_pvalue"),
        _r("mw_pvalue", 8).alias("mw_pvalue"), _r("cohens_d", 8).alias("cohens_d"), "drift_detected")


def i15_quality_by_side(spark, sf):
    """Both sides of the quality report: missing values and exact 5 % / 95 %
    quantiles of each v1 column, reference and current."""
    df = I.sides(I.feature_set(spark, sf, "v1").df)
    cols = [c for c in numeric_columns(df) if c != "side"]
    long = materialize(S.long_values(df, cols, ["side"]))
    q = exact_quantiles(long, ["side", "column"], "value", [0.05, 0.95]).groupBy("side", "column").agg(
        F.max(F.when(F.col("p") == 0.05, F.col("q"))).alias("q05"), F.max(F.when(F.col("p") == 0.95, F.col("q"))).alias("q95"))
    counts = long.groupBy("side", "column").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("value").isNull()).alias("missing_count"))
    return counts.join(q, ["side", "column"], "left").select(
        "side", "column", "n_rows", "missing_count", _r("q05", 5).alias("q05"), _r("q95", 5).alias("q95"))


def last_catalog() -> dict[str, Query]:
    return {"h4_cross_ratios": h4_cross_ratios, "g3_best_of_version": g3_best_of_version,
            "j13_budgeted_search": j13_budgeted_search,
            "j13_nested_samples": j13_nested_samples, "j21_fold_sizes": j21_fold_sizes,
            "h3_long_features": h3_long_features, "i12_prediction_drift": i12_prediction_drift, "i15_quality_by_side": i15_quality_by_side,
            "j21_cross_validation": j21_cross_validation}


# ---- scoring requests (nested JSON documents) ------------------------------

def _request_docs(spark, sf, version="v2"):
    """Write the ``version`` feature rows as scoring requests
    ``{"instances": [...]}``, one document per month, and return the folder.

    A month holds at most 31 dates, so each collected group is bounded;
    ``partitionBy(month)`` puts one document in each file, the layout the
    multi-line JSON reader expects."""
    from ..session import scratch_path
    fs = I.feature_set(spark, sf, version)
    inst = F.struct(F.col("ts"), *[F.col(c) for c in fs.features])
    docs = (fs.df.groupBy(F.date_format("ts", "yyyy-MM").alias("month"))
            .agg(F.collect_list(inst).alias("instances")))
    path = scratch_path(spark, "requests")
    docs.write.partitionBy("month").option("ignoreNullFields", False).json(path)
    return path, fs.features


def a13_request_scan(spark, sf):
    """Requests read back with the multi-line JSON reader, one row per
    instance, rounded like ``i3_features_v2`` (without target and label)."""
    from ..sources.files import read_requests
    path, feats = _request_docs(spark, sf, "v2")
    req = read_requests(spark, path)
    return _round_features(req.select(F.to_date("ts").alias("ts"), *feats))


def b13_request_schema_check(spark, sf):
    """v2 requests checked against the v3 feature list: the ratio features
    are missing, ``ts`` is extra (rows ``column, problem``)."""
    from ..sources.files import read_requests, request_schema_check
    path, _ = _request_docs(spark, sf, "v2")
    return request_schema_check(read_requests(spark, path), I.feature_set(spark, sf, "v3").features)


def request_catalog() -> dict[str, Query]:
    return {"a13_request_scan": a13_request_scan,
            "b13_request_schema_check": b13_request_schema_check}


# ---- nested result documents -------------------------------------------------

def _documents_path(spark, sf):
    """Run documents (run fields + ``candidates`` array) written as JSON
    lines to the shared folder; returns the path and the schema."""
    from ..session import scratch_path
    from ..sources.files import write_results
    from .models import result_documents
    docs = result_documents(_runs(spark, sf), _candidates(spark, sf).select(
        "version", "task", "position", "model", "val_metric", "status"))
    path = scratch_path(spark, "run_documents")
    write_results(docs, path, mode="overwrite")
    return path, docs.schema


def a14_result_documents(spark, sf):
    """Result-document sink and scan: one nested document per run."""
    path, schema = _documents_path(spark, sf)
    back = spark.read.schema(schema).json(path)
    return back.select("version", "task", "best_model", "status",
                       F.size("candidates").alias("n_candidates"))


def h6_flatten_candidates(spark, sf):
    """Nested run documents flattened to one row per candidate."""
    from .models import flatten_candidates
    path, schema = _documents_path(spark, sf)
    flat = flatten_candidates(spark.read.schema(schema).json(path))
    return flat.withColumn("val_metric", _r("val_metric", 5))


def document_catalog() -> dict[str, Query]:
    return {"a14_result_documents": a14_result_documents,
            "h6_flatten_candidates": h6_flatten_candidates}


# ---- multi-key ranking -------------------------------------------------------

def g2_forecaster_ranking(spark, sf):
    """Moving-average forecasters of each series ranked inside the series
    by RMSE ascending, MAE ascending, R^2 descending (name breaks ties).
    The window partitions by symbol and holds one row per forecaster."""
    from pyspark.sql import Window
    f = series_features(I.dense_panel(spark, sf))
    fc = f.select("symbol", "price", F.explode(F.array(
        F.struct(F.lit("ma7").alias("forecaster"), F.col("ma7").alias("pred")),
        F.struct(F.lit("ma30").alias("forecaster"), F.col("ma30").alias("pred")))).alias("x"))
    m = S.regression_metrics(fc.select("symbol", "price", "x.*"), "price", "pred",
                             by=["symbol", "forecaster"])
    w = Window.partitionBy("symbol").orderBy(F.asc("rmse"), F.asc("mae"), F.desc("r2"),
                                             F.asc("forecaster"))
    return m.select("symbol", "forecaster", "n", _r("mae", 5).alias("mae"),
                    _r("rmse", 5).alias("rmse"), _r("r2", 8).alias("r2"),
                    F.row_number().over(w).cast("long").alias("rank"))


def ranking_catalog() -> dict[str, Query]:
    return {"g2_forecaster_ranking": g2_forecaster_ranking}


# ---- stream scoring ------------------------------------------------------------

def _scoring_parts(spark, sf):
    """A v2 forest and the test dates' feature rows written as request
    documents, one JSON line per month (bounded groups).  Requests may lack
    features, so its rows are filled with medians like theirs."""
    from ..session import scratch_path
    from .models import _pipeline, forest, prepare
    fs = I.model_features(spark, sf, "v2")
    p = prepare(fs, "classification", missing="median")
    model = _pipeline(p, forest("classification")).fit(p.train)
    test_ts = p.test.select("ts")
    inst = F.struct(F.col("ts"), *[F.col(c) for c in fs.features])
    docs = (fs.df.join(test_ts, "ts").groupBy(F.date_format("ts", "yyyy-MM").alias("month"))
            .agg(F.collect_list(inst).alias("instances")))
    path = scratch_path(spark, "scoring_requests")
    docs.write.option("ignoreNullFields", False).json(path)
    labels = list(model.stages[2].labelsArray[0])
    return p, model, path, docs.schema, labels


def m2_stream_scoring(spark, sf):
    """Request documents scored on a stream by the fitted pipeline;
    predicted-label counts of every test date."""
    from ..streaming.monitor import run_request_scoring
    p, model, path, schema, labels = _scoring_parts(spark, sf)
    out = run_request_scoring(spark, path, schema, model, p.features, p.medians,
                              LABEL_COL, labels)
    return spark.read.parquet(out).groupBy("pred_label").agg(F.count(F.lit(1)).alias("n"))


def scoring_catalog() -> dict[str, Query]:
    return {"m2_stream_scoring": m2_stream_scoring}
