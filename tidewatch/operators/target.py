"""Target creation: mean +- std thresholds and fear/stable/greed labels.

The two statistics are an uncorrelated scalar subquery: Spark runs the
one-row aggregate once (partial + final aggregation) and inlines the
result into the labelling projection, so no cross join, no window over the
whole frame and no driver round trip of data are needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import threshold_label


def threshold_stats(src: DataFrame, col: str) -> tuple[Column, Column]:
    """(mu, sigma) of ``col`` over ``src`` as scalar-subquery columns."""
    stats = src.select(F.struct(F.avg(col).alias("mu"),
                                F.stddev_samp(col).alias("sigma")).alias("s")).scalar()
    return stats.getField("mu"), stats.getField("sigma")


def add_sentiment(df: DataFrame, col: str, out: str = "Market_Sentiment",
                  fit_df: DataFrame | None = None) -> DataFrame:
    """Label every row of ``df`` from thresholds fitted on ``fit_df``
    (default: ``df`` itself, the reference's behaviour)."""
    mu, sigma = threshold_stats(fit_df if fit_df is not None else df, col)
    return df.withColumn(out, threshold_label(F.col(col), mu, sigma))


def label_counts(df: DataFrame, label: str = "Market_Sentiment", keep_null: bool = False,
                 by: list[str] | None = None) -> DataFrame:
    """Value counts per label (optionally per group), descending."""
    src = df if keep_null else df.where(F.col(label).isNotNull())
    keys = (by or []) + [label]
    return src.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
