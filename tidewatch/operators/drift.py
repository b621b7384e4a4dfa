"""Drift between a reference and a current sample, all features in one job.

Input is one long frame ``(feature, side, value)`` with side ``ref``/``cur``
(one shuffle by feature, not a loop over features).  The shared ECDF frame
(:func:`ecdf_frame`) gives the KS distance, the Mann-Whitney rank sums and the
moments in one grouped pass; p-values are Spark expressions on one row per
feature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.pvalues import chi2_pvalue, kolmogorov_pvalue, ks_pvalue_udf, normal_pvalue
from ..functions.scalar import pct_shift
from ..session import ship_package
from .ranks import cumulative_counts

# Fixed values of the reference's drift rules.
ALPHA = 0.05
MIN_SAMPLES = 10          # both samples need more than this many values
REF, CUR = "ref", "cur"


def ecdf_frame(long: DataFrame, group: str = "feature", value: str = "value",
               side: str = "side") -> DataFrame:
    """Per distinct ``(feature, value)``: counts and running counts of each
    side (``r``, ``c``, ``r_cum``, ``c_cum``, ``r_total``, ``c_total``)."""
    weights = {"r": F.when(F.col(side) == REF, 1).otherwise(0),
               "c": F.when(F.col(side) == CUR, 1).otherwise(0)}
    return cumulative_counts(long.select(group, side, value), [group], value, weights)


def _rank_aggregates() -> list:
    t = F.col("r") + F.col("c")
    midrank = F.col("r_cum") + F.col("c_cum") - t + (t + F.lit(1)) / F.lit(2.0)
    diff = F.abs(F.col("r_cum") / F.col("r_total") - F.col("c_cum") / F.col("c_total"))
    return [F.max("r_total").alias("n_ref"), F.max("c_total").alias("n_cur"), F.max(diff).alias("ks_statistic"),
            F.sum(F.col("r") * midrank).alias("_r1"), F.sum(t.cast("double") * t * t - t).alias("tie_term")]


def _with_rank_statistics(agg: DataFrame) -> DataFrame:
    n1 = F.col("n_ref").cast("double")
    n2 = F.col("n_cur").cast("double")
    n = n1 + n2
    u1 = F.col("_r1") - n1 * (n1 + 1) / 2
    sigma = F.sqrt(n1 * n2 / 12 * ((n + 1) - F.col("tie_term") / (n * (n - 1))))
    u = F.greatest(F.col("mw_statistic"), n1 * n2 - F.col("mw_statistic"))
    return (agg.withColumn("mw_statistic", u1)
            .withColumn("mw_z", F.try_divide(u - n1 * n2 / 2 - 0.5, sigma))
            .drop("_r1"))


def rank_tests(ecdf: DataFrame, group: str = "feature") -> DataFrame:
    """KS distance and Mann-Whitney U1, tie term and z per feature."""
    return _with_rank_statistics(ecdf.groupBy(group).agg(*_rank_aggregates()))


def moment_stats(long: DataFrame, group: str = "feature", value: str = "value",
                 side: str = "side") -> DataFrame:
    """Means, sample std, mean shift % and Cohen's d (pooled, n-1 weights)."""
    is_ref = F.col(side) == REF
    is_cur = F.col(side) == CUR
    v = F.col(value)
    agg = long.where(v.isNotNull()).groupBy(group).agg(
        F.avg(F.when(is_ref, v)).alias("ref_mean"), F.avg(F.when(is_cur, v)).alias("curr_mean"),
        F.stddev_samp(F.when(is_ref, v)).alias("ref_std"),
        F.stddev_samp(F.when(is_cur, v)).alias("curr_std"),
        F.count(F.when(is_ref, v)).alias("n_ref"), F.count(F.when(is_cur, v)).alias("n_cur"))
    return agg.select(group, *_effect_columns())


def _effect_columns() -> list:
    """Means, deviations, Cohen's d and mean shift from n_ref, n_cur, ref_mean ..."""
    n1, n2 = F.col("n_ref"), F.col("n_cur")
    pooled = F.sqrt(F.try_divide((n1 - 1) * F.col("ref_std") ** 2 + (n2 - 1) * F.col("curr_std") ** 2,
                                 n1 + n2 - 2))
    d = F.when(pooled > 0, (F.col("curr_mean") - F.col("ref_mean")) / pooled).otherwise(F.lit(0.0))
    return [F.col("ref_mean"), F.col("curr_mean"), F.col("ref_std"), F.col("curr_std"), d.alias("cohens_d"),
            pct_shift("curr_mean", "ref_mean").alias("mean_shift_pct")]


def numeric_drift_stats(long: DataFrame, group: str = "feature",
                        min_samples: int = MIN_SAMPLES, value: str = "value") -> DataFrame:
    """Statistics (no p-values) for features with both samples > min, all from
    one pass over the distinct values: moments are weighted by their counts,
    about the middle of the range so that no digits cancel."""
    ecdf = ecdf_frame(long, group, value)
    x = F.col(value).cast("double") - F.col("_mid")
    of = lambda side: [F.sum(F.col(side) * x).alias(f"_{side}_sum"), F.sum(F.col(side) * x * x).alias(f"_{side}_squares")]
    mid = (long.where(F.col(value).isNotNull()).groupBy(group)
           .agg(((F.min(value).cast("double") + F.max(value).cast("double")) / 2).alias("_mid")))
    agg = (ecdf.join(mid, group).groupBy(group)
           .agg(*_rank_aggregates(), F.first("_mid").alias("_mid"), *of("r"), *of("c")))
    st = _with_rank_statistics(agg).where((F.col("n_ref") > min_samples) & (F.col("n_cur") > min_samples))
    for side, n, name in (("r", "n_ref", "ref"), ("c", "n_cur", "curr")):
        mean = F.col(f"_{side}_sum") / F.col(n)
        left = F.greatest(F.col(f"_{side}_squares") - F.col(f"_{side}_sum") * mean, F.lit(0.0))
        st = st.withColumn(f"{name}_mean", mean + F.col("_mid")).withColumn(
            f"{name}_std", F.sqrt(left / (F.col(n) - 1)))
    return st.select(group, "n_ref", "n_cur", "ks_statistic", "tie_term", "mw_statistic", "mw_z", *_effect_columns())


def numeric_drift(long: DataFrame, group: str = "feature", alpha: float = ALPHA,
                  min_samples: int = MIN_SAMPLES, ks_method: str = "asymptotic") -> DataFrame:
    """Per-feature drift report with KS and Mann-Whitney p-values and flag.

    The KS p-value is that of Kolmogorov's limit at every size.  ``ks_method``
    "exact" (O(n1 * (n1 + n2)) per feature, an Arrow UDF) or "auto" (exact up
    to KS_EXACT_MAX_N rows a side) are there for small samples."""
    st = numeric_drift_stats(long, group, min_samples)
    if ks_method != "asymptotic":
        ship_package(long.sparkSession)
    ks = (kolmogorov_pvalue(F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur")) if ks_method == "asymptotic"
          else ks_pvalue_udf(ks_method)("ks_statistic", "n_ref", "n_cur"))
    return (st.withColumn("ks_pvalue", ks).withColumn("mw_pvalue", normal_pvalue(F.col("mw_z")))
            .withColumn("drift_detected", (F.col("ks_pvalue") < alpha) | (F.col("mw_pvalue") < alpha)))


def category_alignment(labels: DataFrame, label: str, side: str = "side") -> DataFrame:
    """Union of categories seen on either side with both counts (missing = 0):
    one grouped pass instead of a full outer join of two value counts."""
    return (labels.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("category"))
            .agg(F.count_if(F.col(side) == REF).alias("ref_count"),
                 F.count_if(F.col(side) == CUR).alias("cur_count")))


def chi_square_stats(aligned: DataFrame) -> DataFrame:
    """Chi-square statistic of the 2 x k table (Yates' correction only for
    k = 2) and its degrees of freedom: one pass over the categories, beside the
    totals as a scalar subquery."""
    tot = aligned.agg(F.sum("ref_count").alias("R"), F.sum("cur_count").alias("C"),
                      F.count(F.lit(1)).alias("k"))
    t = tot.select(F.struct("R", "C", "k").alias("t")).scalar()
    r, c, k = t.getField("R"), t.getField("C"), t.getField("k")
    dof = k - 1

    def cell(count: str, row_n):
        o = F.col(count).cast("double")
        e = F.try_divide(row_n * (F.col("ref_count") + F.col("cur_count")), r + c)
        diff = e - o
        yates = F.when(dof == 1, F.least(F.lit(0.5), F.abs(diff)) * F.signum(diff)).otherwise(0.0)
        return F.coalesce(F.try_divide(F.pow(o + yates - e, 2), e), F.lit(0.0))
    return aligned.agg(F.sum(cell("ref_count", r) + cell("cur_count", c)).alias("chi2_statistic"), F.first(dof).alias("dof"),
                       F.first(r).alias("n_ref"), F.first(c).alias("n_cur")) \
        .withColumn("chi2_statistic", F.when(F.col("dof") > 0, F.col("chi2_statistic"))
                    .otherwise(F.lit(0.0)))


def target_drift(labels: DataFrame, label: str, side: str = "side",
                 alpha: float = ALPHA) -> DataFrame:
    st = chi_square_stats(category_alignment(labels, label, side))
    st = st.withColumn("chi2_pvalue", chi2_pvalue(F.col("chi2_statistic"), F.col("dof")))
    return st.withColumn("drift_detected", F.col("chi2_pvalue") < alpha)


def drift_summary(features: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """features tested / drifted, drift %, data-quality score and overall flag."""
    s = features.agg(F.count(F.lit(1)).alias("features_tested"),
                     F.count_if("drift_detected").alias("features_with_drift"))
    pct = F.coalesce(F.try_divide(F.col("features_with_drift") * 100.0,
                                  F.col("features_tested")), F.lit(0.0))
    s = s.withColumn("drift_percentage", pct).withColumn(
        "data_quality_score",
        100.0 - F.col("features_with_drift") / F.greatest(F.col("features_tested"), F.lit(1)) * 100.0)
    tflag = F.lit(False)
    if target is not None:
        tflag = F.coalesce(target.select(F.bool_or("drift_detected")).scalar(), F.lit(False))
    return s.withColumn("target_drift_detected", tflag).withColumn(
        "overall_drift_detected", (F.col("features_with_drift") > 0) | F.col("target_drift_detected"))


def dataset_drift(features: DataFrame, share: float = 0.5) -> DataFrame:
    """Share of drifted columns and the dataset-level flag (share >= p)."""
    return features.agg(F.count(F.lit(1)).alias("n_columns"),
                        F.count_if("drift_detected").alias("n_drifted")).withColumn(
        "share_drifted", F.try_divide(F.col("n_drifted").cast("double"), F.col("n_columns"))
    ).withColumn("dataset_drift", F.col("share_drifted") >= F.lit(share))


def ref_cur_comparison(long: DataFrame, group: str = "feature") -> DataFrame:
    """Mean, std and mean change % per feature for the two sides."""
    m = moment_stats(long, group)
    return m.select(group, "ref_mean", "curr_mean", "ref_std", "curr_std", "mean_shift_pct")


def binned_distance(long: DataFrame, n_bins: int = 10, group: str = "feature",
                    value: str = "value", side: str = "side") -> DataFrame:
    """Serving-skew distance per feature: L-infinity distance between the
    reference and current shares of ``n_bins`` equal-width bins spanning the
    reference range (values outside it are clamped into the end bins)."""
    from ..functions.scalar import width_bin
    src = long.where(F.col(value).isNotNull())
    rng = src.where(F.col(side) == REF).groupBy(group).agg(
        F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    b = width_bin(F.col(value), F.col("_lo"), F.col("_hi"), n_bins)
    counts = (src.join(rng, group).groupBy(group, b.alias("bin"))
              .agg(F.count_if(F.col(side) == REF).alias("r"),
                   F.count_if(F.col(side) == CUR).alias("c")))
    tot = counts.groupBy(group).agg(F.sum("r").alias("_rt"), F.sum("c").alias("_ct"))
    shares = counts.join(tot, group).select(
        group, "bin", F.abs(F.try_divide(F.col("r"), F.col("_rt")) -
                            F.try_divide(F.col("c"), F.col("_ct"))).alias("gap"))
    return shares.groupBy(group).agg(F.max("gap").alias("linf_distance"))
