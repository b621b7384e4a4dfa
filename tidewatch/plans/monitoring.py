"""Monitoring run: drift, data quality, a check suite and alerts.

Every statistic is one aggregate job over the long or wide frame with a
``side`` column (ref / cur); the suite is a list of ``(check, observed,
threshold, passed)`` rows, the alerts are the failed conditions as rows.
Thresholds that the reference leaves to a third-party library are explicit
parameters here (documented defaults).
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

from ..operators import drift as D
from ..operators import stats as S
from ..operators.features import LABEL_COL

# Documented defaults (the reference delegates these to a library).
N_SIGMA = 2.0
DATASET_DRIFT_SHARE = 0.5
HIGH_DRIFT_PCT = 20.0
EXPECTED_LABELS = 3
# Fixed values of the range check: the target's lowest and highest sound value.
VALUE_RANGE = (5.0, 80.0)


def _side_profile(wide: DataFrame, cols: list[str]) -> DataFrame:
    """Per side: rows, rows with a missing value, columns with a missing
    value, constant columns, share of missing cells."""
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | F.col(f"`{c}`").isNull()
    rows = wide.groupBy("side").agg(F.count(F.lit(1)).alias("rows"), F.count_if(any_null).alias("rows_with_missing"))
    # Unpivoted, so that distinct values are counted in two phases.
    per_column = S.long_values(wide, cols, ["side"]).groupBy("side", "column").agg(
        F.count_if(F.col("value").isNull()).alias("missing"), F.count_distinct("value").alias("n_unique"))
    totals = per_column.groupBy("side").agg(
        F.count_if(F.col("missing") > 0).alias("columns_with_missing"),
        F.count_if(F.col("n_unique") <= 1).alias("constant_columns"), F.sum("missing").alias("cells"))
    return rows.join(totals, "side").select(
        "side", "rows", "rows_with_missing", "columns_with_missing", "constant_columns",
        (F.col("cells") / (F.col("rows") * F.lit(len(cols)))).alias("missing_share"))


def test_suite(wide: DataFrame, cols: list[str], feature_drift: DataFrame,
               target_drift: DataFrame, key_feature: str, target_col: str,
               label_col: str = LABEL_COL, value_range: tuple[float, float] = VALUE_RANGE) -> DataFrame:
    """Rows ``(check, observed, threshold, passed)``.

    Dataset checks compare the current side with the reference side (not
    worse); drift checks use the per-feature flags; mean-in-sigma uses the
    reference statistics of the key feature; the current side's target must
    lie in ``value_range`` (left, right; both ends count)."""
    # two rows (ref, cur); eight scalar subqueries read it, so write it once
    prof = materialize(_side_profile(wide, cols))
    r = prof.where(F.col("side") == "ref").select(*[F.col(c).alias(f"r_{c}") for c in prof.columns])
    c = prof.where(F.col("side") == "cur").select(*[F.col(x).alias(f"c_{x}") for x in prof.columns])
    ref = wide.where(F.col("side") == "ref")
    cur = wide.where(F.col("side") == "cur")
    kstats = ref.agg(F.avg(key_feature).alias("mu"), F.stddev_samp(key_feature).alias("sd"))
    cstats = cur.agg(F.avg(key_feature).alias("cmu"), F.min(target_col).alias("clo"),
                     F.max(target_col).alias("chi"),
                     F.count_distinct(label_col).alias("n_labels"))
    dd = D.dataset_drift(feature_drift, DATASET_DRIFT_SHARE)
    flag = feature_drift.groupBy().agg(
        F.max(F.when(F.col("feature") == key_feature,
                     F.col("drift_detected"))).alias("key_drift"),
        F.max(F.when(F.col("feature") == target_col, F.col("drift_detected"))).alias("target_drift_f"))
    td = target_drift.select(F.col("drift_detected").alias("label_drift"))
    # All parts are single-row aggregates: combine them through scalar subqueries.
    def s(df, col):
        return df.select(col).scalar()
    row = kstats.select(
        s(r, "r_columns_with_missing").alias("r_cols"), s(c, "c_columns_with_missing").alias("c_cols"),
        s(r, "r_rows_with_missing").alias("r_rows"), s(c, "c_rows_with_missing").alias("c_rows"),
        s(r, "r_constant_columns").alias("r_const"), s(c, "c_constant_columns").alias("c_const"),
        s(r, "r_missing_share").alias("r_share"), s(c, "c_missing_share").alias("c_share"),
        s(dd, "n_drifted").alias("n_drifted"), s(dd, "n_columns").alias("n_columns"),
        s(flag, "key_drift").alias("key_drift"), s(flag, "target_drift_f").alias("tdrift"),
        s(td, "label_drift").alias("ldrift"),
        "mu", "sd",
        s(cstats, "cmu").alias("cmu"), s(cstats, "clo").alias("clo"), s(cstats, "chi").alias("chi"),
        s(cstats, "n_labels").alias("n_labels"))
    d = lambda x: F.col(x).cast("double")
    checks = [
        ("columns_with_missing_values", d("c_cols"), d("r_cols"), F.col("c_cols") <= F.col("r_cols")),
        ("rows_with_missing_values", d("c_rows"), d("r_rows"), F.col("c_rows") <= F.col("r_rows")),
        ("constant_columns", d("c_const"), d("r_const"), F.col("c_const") <= F.col("r_const")),
        ("drifted_columns", d("n_drifted"), d("n_columns") * DATASET_DRIFT_SHARE,
         F.col("n_drifted") < F.col("n_columns") * DATASET_DRIFT_SHARE),
        ("share_of_missing_values", d("c_share"), d("r_share"), F.col("c_share") <= F.col("r_share")),
        (f"column_drift:{key_feature}", F.lit(None).cast("double"), F.lit(None).cast("double"),
         ~F.coalesce(F.col("key_drift"), F.lit(False))),
        (f"column_drift:{target_col}", F.lit(None).cast("double"), F.lit(None).cast("double"),
         ~F.coalesce(F.col("tdrift"), F.lit(False))),
        (f"column_drift:{label_col}", F.lit(None).cast("double"), F.lit(None).cast("double"),
         ~F.coalesce(F.col("ldrift"), F.lit(False))),
        (f"mean_in_{N_SIGMA:g}_sigmas:{key_feature}", d("cmu"), F.col("sd") * N_SIGMA,
         F.abs(F.col("cmu") - F.col("mu")) <= F.col("sd") * N_SIGMA),
        (f"value_range:{target_col}", d("clo"), F.lit(float(value_range[0])),
         (F.col("clo") >= value_range[0]) & (F.col("chi") <= value_range[1])),
        (f"unique_values:{label_col}", d("n_labels"), F.lit(float(EXPECTED_LABELS)),
         F.col("n_labels") == EXPECTED_LABELS),
    ]
    parts = [F.struct(F.lit(n).alias("check"), o.alias("observed"), t.alias("threshold"),
                      F.coalesce(p, F.lit(False)).alias("passed")) for n, o, t, p in checks]
    return row.select(F.explode(F.array(*parts)).alias("x")).select("x.*")


def suite_summary(suite: DataFrame) -> DataFrame:
    return suite.agg(F.count(F.lit(1)).alias("total"), F.count_if("passed").alias("passed")) \
        .withColumn("success_rate", F.col("passed") / F.col("total"))


def alerts(drift_summary: DataFrame, dataset: DataFrame | None = None,
           suite: DataFrame | None = None) -> DataFrame:
    """One row per raised alert ``(alert, severity)``."""
    ds = drift_summary
    conds = [
        (F.col("overall_drift_detected"), "data drift detected", "critical"),
        (F.col("target_drift_detected"), "target distribution drift detected", "critical"),
        (F.col("drift_percentage") > HIGH_DRIFT_PCT,
         F.format_string("high drift percentage: %.1f%%", F.col("drift_percentage")), "warning"),
    ]
    if dataset is not None:
        conds.append((dataset.select(F.first("dataset_drift")).scalar(), "dataset drift detected",
                      "critical"))
    if suite is not None:
        failed = suite.select(F.count_if(~F.col("passed"))).scalar()
        conds.append((failed > 0, F.format_string("%d tests failed", failed), "warning"))
    parts = [F.when(c, F.struct((F.lit(m) if isinstance(m, str) else m).alias("alert"),
                                F.lit(sev).alias("severity"))) for c, m, sev in conds]
    return ds.select(F.explode(F.array(*parts)).alias("a")).where(F.col("a").isNotNull()) \
        .select("a.*")


def stamp(df: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Add the run time so result tables can be appended across runs."""
    ts = (run_ts or datetime.now(timezone.utc)).replace(tzinfo=None)
    return df.withColumn("run_ts", F.lit(ts).cast("timestamp_ntz"))
