"""Descriptive statistics and evaluation metrics, one job per report.

Every report over many columns is a single multi-aggregate (partial
aggregation on the map side, one tiny final row) followed by an unpivot,
never a loop with one action per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import SENTIMENT_LABELS, clip, threshold_label, width_bin
from .ranks import exact_quantiles


def _unpivot_struct(df_one_row: DataFrame, names: list[str], fields: list[str]) -> DataFrame:
    """``[c__f for c in names for f in fields]`` columns of a one-row frame
    -> rows ``(column, f...)``."""
    parts = [F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}__{f}`").alias(f) for f in fields])
             for c in names]
    return df_one_row.select(F.explode(F.array(*parts)).alias("_r")).select("_r.*")


def long_values(df: DataFrame, cols: list[str], key_cols: list[str] | None = None,
                name: str = "column", value: str = "value") -> DataFrame:
    """Unpivot numeric columns to ``(keys..., column, value)`` (NULLs kept)."""
    key_cols = key_cols or []
    parts = [F.struct(F.lit(c).alias(name), F.col(f"`{c}`").cast("double").alias(value))
             for c in cols]
    return df.select(*key_cols, F.explode(F.array(*parts)).alias("_r")).select(
        *key_cols, f"_r.{name}", f"_r.{value}")


# ---- E1 missing values ---------------------------------------------------

def missing_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``(column, missing_count, missing_share)`` for all columns at once."""
    cols = cols or df.columns
    one = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"{c}__missing") for c in cols])
    parts = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}__missing`").alias("missing_count"))
             for c in cols]
    return one.select("__rows", F.explode(F.array(*parts)).alias("_r")).select(
        "_r.column", "_r.missing_count",
        F.try_divide(F.col("_r.missing_count"), F.col("__rows")).alias("missing_share"))


def missing_summary(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Dataset-level totals: rows, columns, missing cells, columns with a
    missing value, share of missing cells."""
    mc = missing_counts(df, cols)
    n_cols = len(cols or df.columns)
    rows = df.select(F.count(F.lit(1)).alias("n")).scalar()
    return mc.agg(F.sum("missing_count").alias("missing_cells"),
                  F.count_if(F.col("missing_count") > 0).alias("columns_with_missing")).select(
        rows.alias("n_rows"), F.lit(n_cols).cast("long").alias("n_columns"), "missing_cells",
        "columns_with_missing",
        F.try_divide(F.col("missing_cells"), rows * F.lit(n_cols)).alias("missing_share"))


# ---- E2 describe, E3 mean/std, E9 quantiles ------------------------------

def describe(df: DataFrame, cols: list[str], probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """count, mean, std (n-1), min, exact quantiles, max per column."""
    one = df.agg(*[a for c in cols for a in (
        F.count(F.col(f"`{c}`")).alias(f"{c}__count"),
        F.avg(F.col(f"`{c}`")).alias(f"{c}__mean"),
        F.stddev_samp(F.col(f"`{c}`")).alias(f"{c}__std"),
        F.min(F.col(f"`{c}`")).cast("double").alias(f"{c}__min"),
        F.max(F.col(f"`{c}`")).cast("double").alias(f"{c}__max"))])
    base = _unpivot_struct(one, cols, ["count", "mean", "std", "min", "max"])
    q = exact_quantiles(long_values(df, cols), ["column"], "value", list(probs))
    qw = q.groupBy("column").pivot("p", [float(p) for p in probs]).agg(F.first("q"))
    qw = qw.select("column", *[F.col(f"`{float(p)}`").alias(f"p{int(round(p * 100))}")
                               for p in probs])
    return base.join(qw, "column", "left")


def mean_std(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
                               F.count(value).alias("n"))


# ---- E4 correlation -------------------------------------------------------

def correlation_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation for every pair i<=j, clipped to
    [-1, 1], from blocked Gram matrices."""
    from .gram import correlations
    return correlations(df, cols)


# ---- E5/E6 value counts and shares ---------------------------------------

def value_counts(df: DataFrame, col: str, by: list[str] | None = None,
                 keep_null: bool = False) -> DataFrame:
    by = by or []
    src = df if keep_null else df.where(F.col(col).isNotNull())
    counts = src.groupBy(*by, col).agg(F.count(F.lit(1)).alias("n"))
    if by:
        # share within the group; the grouped frame is small (groups x labels)
        return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*by)))
    total = src.select(F.count(F.lit(1))).scalar()
    return counts.withColumn("share", F.col("n") / total)


# ---- E7/E8 histograms -----------------------------------------------------

def histogram(df: DataFrame, value: str, n_bins: int, by: list[str] | None = None) -> DataFrame:
    """Equal-width bins between min and max per group; last bin closed.
    Returns ``(group, bin, lo, hi, n, density)``; bins with no rows are absent."""
    by = by or []
    src = df.where(F.col(value).isNotNull())
    rng = src.groupBy(*by).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"),
                               F.count(F.lit(1)).alias("_n"))
    src = src.join(rng, by) if by else src.withColumn(
        "_r", rng.select(F.struct("_lo", "_hi", "_n")).scalar()).select("*", "_r.*").drop("_r")
    b = width_bin(F.col(value), F.col("_lo"), F.col("_hi"), n_bins)
    hist = src.groupBy(*by, b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"),
        F.first("_n").alias("_total"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(n_bins)
    return hist.select(*by, "bin", (F.col("_lo") + (F.col("bin") - 1) * width).alias("lo"),
                       (F.col("_lo") + F.col("bin") * width).alias("hi"), "n",
                       F.try_divide(F.col("n"), F.col("_total") * width).alias("density"))


def histogram_2d(df: DataFrame, x: str, y: str, grid: int = 35, min_count: int = 1) -> DataFrame:
    """Rectangular 2-D density bins (x bin, y bin, count) with min count."""
    src = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    rng = src.select(F.struct(F.min(x).alias("x0"), F.max(x).alias("x1"),
                              F.min(y).alias("y0"), F.max(y).alias("y1")).alias("r")).scalar()
    bx = width_bin(F.col(x), rng.getField("x0"), rng.getField("x1"), grid)
    by_ = width_bin(F.col(y), rng.getField("y0"), rng.getField("y1"), grid)
    return (src.groupBy(bx.alias("x_bin"), by_.alias("y_bin"))
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


# ---- E10 binned calibration, E11 errors by zone, E12 metrics -------------

def calibration_bins(df: DataFrame, actual: str, predicted: str, q: int = 10) -> DataFrame:
    """Quantile edges of ``actual`` (exact, linear interpolation); rows go to
    bin ``digitize(actual, inner edges)`` (left-closed), 0..q-1; per bin mean
    actual, mean predicted, population std of actual; empty bins are NULL."""
    src = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    probs = [i / q for i in range(1, q)]
    edges = exact_quantiles(src.select(actual), [], actual, probs)
    edge_arr = edges.agg(F.array_sort(F.collect_list(F.struct("p", "q"))).alias("e")).select(
        F.transform("e", lambda s: s.getField("q")).alias("edges")).scalar()
    # digitize against the q-1 inner edges (left-closed bins)
    with_edges = src.withColumn("_edges", edge_arr)
    bin_expr = sum(F.when(F.col(actual) >= F.element_at("_edges", i), 1).otherwise(0)
                   for i in range(1, q))
    binned = with_edges.withColumn("bin", bin_expr.cast("int"))
    stats = binned.groupBy("bin").agg(F.avg(actual).alias("mean_actual"),
                                      F.avg(predicted).alias("mean_predicted"),
                                      F.stddev_pop(actual).alias("std_actual"),
                                      F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    all_bins = spark.range(q).select(F.col("id").cast("int").alias("bin"))
    return all_bins.join(stats, "bin", "left")


def regression_metrics(df: DataFrame, actual: str, predicted: str,
                       by: list[str] | None = None) -> DataFrame:
    """MAE, RMSE, R^2 (1 - SSE / (n * var_pop)) and MAPE in one aggregate."""
    by = by or []
    e = F.col(predicted) - F.col(actual)
    src = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    return src.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.sum(e * e),
                                   F.var_pop(actual) * F.count(F.lit(1)))).alias("r2"),
        (F.avg(F.abs(F.try_divide(e, F.col(actual)))) * 100).alias("mape"))


def errors_by_zone(df: DataFrame, actual: str, predicted: str, mu: Column,
                   sigma: Column) -> DataFrame:
    """MAE and RMSE per true zone (greed, stable, fear); empty zones NULL."""
    zone = threshold_label(F.col(actual), mu, sigma)
    e = F.col(predicted) - F.col(actual)
    src = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    stats = src.groupBy(zone.alias("zone")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"))
    order = ["greed", "stable", "fear"]
    zones = df.sparkSession.createDataFrame([(z, i) for i, z in enumerate(order)],
                                            "zone string, zone_order int")
    return zones.join(stats, "zone", "left")


# ---- E13/E14 confusion matrix and classification report ------------------

def confusion(df: DataFrame, true: str, pred: str) -> DataFrame:
    return (df.where(F.col(true).isNotNull() & F.col(pred).isNotNull())
            .groupBy(F.col(true).alias("true_label"), F.col(pred).alias("pred_label"))
            .agg(F.count(F.lit(1)).alias("n")))


def classification_report(conf: DataFrame) -> DataFrame:
    """Per-class precision, recall, F1, support plus accuracy, macro and
    weighted averages (``zero_division=0``) from a confusion frame
    ``(true_label, pred_label, n)``.  Classes = labels seen as true or pred."""
    t = conf.groupBy(F.col("true_label").alias("label")).agg(
        F.sum("n").alias("support"),
        F.sum(F.when(F.col("true_label") == F.col("pred_label"), F.col("n"))
              .otherwise(0)).alias("tp"))
    p = conf.groupBy(F.col("pred_label").alias("label")).agg(F.sum("n").alias("predicted"))
    cls = t.join(p, "label", "full").select(
        "label", F.coalesce("support", F.lit(0)).alias("support"),
        F.coalesce("tp", F.lit(0)).alias("tp"), F.coalesce("predicted", F.lit(0)).alias("predicted"))
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("predicted")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    cls = cls.select("label", "support", prec.alias("precision"), rec.alias("recall"), "tp")
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                 F.col("precision") + F.col("recall")), F.lit(0.0))
    cls = cls.withColumn("f1", f1)
    summary = cls.agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"),
        F.sum("support").alias("n"))
    rows = cls.select(F.col("label").alias("row"), "precision", "recall", "f1",
                      F.col("support").cast("long").alias("support"))
    avg_rows = summary.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("row"), F.col("accuracy").alias("precision"),
                 F.col("accuracy").alias("recall"), F.col("accuracy").alias("f1"),
                 F.col("n").cast("long").alias("support")),
        F.struct(F.lit("macro avg").alias("row"), F.col("macro_precision").alias("precision"),
                 F.col("macro_recall").alias("recall"), F.col("macro_f1").alias("f1"),
                 F.col("n").cast("long").alias("support")),
        F.struct(F.lit("weighted avg").alias("row"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), F.col("weighted_f1").alias("f1"),
                 F.col("n").cast("long").alias("support")))).alias("_r")).select("_r.*")
    return rows.unionByName(avg_rows)


def classification_summary(conf: DataFrame) -> DataFrame:
    """One row: accuracy, macro precision/recall/F1, weighted F1, n."""
    rep = classification_report(conf)
    return rep.agg(
        F.max(F.when(F.col("row") == "accuracy", F.col("f1"))).alias("accuracy"),
        F.max(F.when(F.col("row") == "macro avg", F.col("precision"))).alias("macro_precision"),
        F.max(F.when(F.col("row") == "macro avg", F.col("recall"))).alias("macro_recall"),
        F.max(F.when(F.col("row") == "macro avg", F.col("f1"))).alias("macro_f1"),
        F.max(F.when(F.col("row") == "weighted avg", F.col("f1"))).alias("weighted_f1"),
        F.max(F.when(F.col("row") == "accuracy", F.col("support"))).alias("n"))


def sample_head(df: DataFrame, n: int = 5, order: str = "ts") -> DataFrame:
    """The first ``n`` rows in an order, as a display of a frame (top-n: no
    task sorts more than ``n`` rows of its partition)."""
    return df.orderBy(order).limit(n)


# ---- E16/E17 shape and uniqueness ----------------------------------------

def shape_and_range(df: DataFrame, ts: str, by: list[str] | None = None) -> DataFrame:
    by = by or []
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"),
                               F.lit(len(df.columns) - len(by)).alias("n_columns"),
                               F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


def unique_counts(df: DataFrame, cols: list[str], exact: bool = True) -> DataFrame:
    """Distinct non-null values per column and a constant-column flag."""
    # Unpivoted to one narrow row per value, distinct values are counted in
    # two phases (per column and value, then per column); several distinct
    # counts in one aggregate would copy every whole row once per column.
    fn = F.count_distinct if exact else F.approx_count_distinct
    out = long_values(df, cols).groupBy("column").agg(fn("value").alias("n_unique"))
    return out.withColumn("is_constant", F.col("n_unique") <= 1)
