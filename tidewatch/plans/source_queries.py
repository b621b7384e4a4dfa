"""Registered queries of the file sources, the store's metadata and the smaller
column rules: each calls the library's function on what Spark derives from the
tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stats as S
from ..operators.features import build_feature_set_from_wide
from ..session import scratch_path
from ..sources.files import (detect_date_column, feature_groups, read_csv_panel, read_feature_metadata, write_csv)
from . import inputs as I


def a3_date_column(spark, sf):
    """The date column of a CSV panel, told by its name and, where no name
    tells, by the share of its values that parse; its rows and range."""
    p = I.panel(spark, sf).select("symbol", "volume", "ts")
    out = None
    for name in ("Trade_Date", "observed"):
        path = scratch_path(spark, "date_column")
        write_csv(p.withColumnRenamed("ts", name), path)
        back = read_csv_panel(spark, path, f"symbol string, volume long, {name} string")
        found = detect_date_column(back)
        day = F.to_date(F.try_to_timestamp(F.col(found)))
        row = back.agg(F.lit(found).alias("found"), F.count(day).alias("n"), F.min(day).alias("first"), F.max(day).alias("last"))
        out = row if out is None else out.unionByName(row)
    return out


def a4_lenient_timestamps(spark, sf):
    """Order dates as CSV text, those of every odd order key spoiled, read by
    the library's scan: what cannot be read is NULL; counts per status."""
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_orderstatus", "o_orderdate")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    path = scratch_path(spark, "lenient_dates")
    write_csv(o.select("o_orderstatus", F.when(F.col("o_orderkey") % 2 == 1, F.concat(F.lit("on "), day)).otherwise(day)
                       .alias("day")), path)
    back = read_csv_panel(spark, path, "o_orderstatus string, day string", date_col="day")
    return back.groupBy("o_orderstatus").agg(
        F.count_if(F.col("day").isNull()).alias("unreadable"), F.count("day").alias("readable"),
        F.date_format(F.min("day"), "yyyy-MM-dd").alias("first_day"), F.date_format(F.max("day"), "yyyy-MM-dd").alias("last_day"))


def a8_metadata(spark, sf):
    """Metadata documents of three saved feature sets, read back."""
    from .store import FeatureStore
    store = FeatureStore(spark, scratch_path(spark, "metadata_store"))
    for v in ("v1", "v2", "v3"):
        store.save(I.feature_set(spark, sf, v), name=f"sentiment_{v}")
    return store.metadata().select(
        "feature_set_name", "version", "num_features", "num_samples", F.col("date_range.start").alias("first"),
        F.col("date_range.end").alias("last"), F.size("meta.features").cast("long").alias("listed"))


def a12_dual_location(spark, sf):
    """One set saved in both locations and one in the second only, each loaded
    from the first location that has it."""
    from .store import FeatureStore
    first, second = scratch_path(spark, "store_a"), scratch_path(spark, "store_b")
    both = FeatureStore(spark, roots=[first, second])
    both.save(I.feature_set(spark, sf, "v1"), name="in_both")
    FeatureStore(spark, roots=[second]).save(I.feature_set(spark, sf, "v2"), name="in_second")
    out = None
    for name in ("in_both", "in_second"):
        fs = both.load(name)
        row = fs.df.agg(F.lit(name).alias("name"), F.lit(len(fs.features)).cast("long").alias("features"),
                        F.count(F.lit(1)).alias("n"))
        out = row if out is None else out.unionByName(row)
    return out


def a16_feature_groups(spark, sf):
    """Feature metadata written as CSV, scanned, and grouped over the columns
    that exist: each group's features and their known values."""
    fs = I.feature_set(spark, sf, "v3")
    names = spark.createDataFrame([(f,) for f in fs.features], "Feature string")
    kind = F.when(F.col("Feature").endswith("_Volume"), "Traded Volume").when(
        F.col("Feature").endswith("_ret_pct"), "Daily Returns")
    path = scratch_path(spark, "feature_metadata")
    write_csv(names.where(~F.col("Feature").startswith("ratio_")).select(kind.alias("Category"), "Feature"), path)
    groups = feature_groups(read_feature_metadata(spark, path), fs.features)
    known = S.long_values(fs.df, fs.features).where("value is not null").groupBy("column").count()
    return (groups.select("group", F.explode("features").alias("column")).join(known, "column", "left")
            .groupBy("group").agg(F.count("column").alias("features"), F.coalesce(F.sum("count"), F.lit(0)).alias("known")))


def b2_leakage_modes(spark, sf):
    """Features that either leakage guard leaves of the wide panel, with a
    price column as target, and their known values."""
    wide = I.wide_panel(spark, sf)
    target = next(c for c in sorted(wide.columns) if c.endswith("_Price"))
    out = None
    for mode in ("strict", "loose"):
        fs = build_feature_set_from_wide(wide, "v1", target_col=target, leakage=mode)
        rows = S.missing_counts(fs.df, fs.features).select(F.lit(mode).alias("mode"), F.col("column").alias("feature"), "missing_count")
        out = rows if out is None else out.unionByName(rows)
    return out


def e1_missing_summary(spark, sf):
    s = S.missing_summary(I.wide_panel(spark, sf))
    return s.withColumn("missing_share", F.round(F.col("missing_share") + F.lit(1.2345678912e-11), 8))


def g7_sample_head(spark, sf):
    """The first five days of the wide panel."""
    head = S.sample_head(I.wide_panel(spark, sf), 5, "ts")
    return head.select("ts", *[c for c in head.columns if c.endswith("_Volume")])


def j11_linear_svm(spark, sf):
    """One-vs-rest linear support vector machines on v1, judged on the test dates."""
    from .models import _pipeline, classification_candidates, evaluate, prepare
    p = prepare(I.model_features(spark, sf, "v1"), "classification")
    svm = classification_candidates(len(p.features), 3, include_svm=True)["svm"]
    return evaluate(p, _pipeline(p, svm).fit(p.train)).select("accuracy", "macro_f1", "n")


def source_catalog():
    return {q.__name__: q for q in (a3_date_column, a4_lenient_timestamps, a8_metadata, a12_dual_location, a16_feature_groups,
                                    b2_leakage_modes, e1_missing_summary, g7_sample_head, j11_linear_svm)}
