"""Chronological and stratified splits without a global ``row_number``.

A global ``row_number()`` (window without a partition key) runs in one task.
Here the position of each time stamp comes from :func:`dense_rank_of`, a
blocked prefix sum over the distinct time stamps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranks import cumulative_counts, dense_rank_of


# Distinct time stamps that one sorted array may hold.
MAX_SORTED_STAMPS = 100_000


def boundary_of(df: DataFrame, ts: str, frac: float):
    """The last of the first ``floor(n * frac)`` of the n distinct time stamps,
    as a column.  A calendar's worth of them is one sorted array in a scalar
    subquery; more are ranked by distributed prefix sums."""
    stamps = df.select(ts).where(F.col(ts).isNotNull()).distinct()
    if stamps.limit(MAX_SORTED_STAMPS + 1).count() <= MAX_SORTED_STAMPS:
        every = stamps.agg(F.sort_array(F.collect_list(ts)).alias("all"))
        cut = F.floor(F.size("all") * F.lit(float(frac))).cast("int")
        return every.select(F.when(cut > 0, F.get("all", cut - 1)).alias("b")).scalar()
    ranks = dense_rank_of(stamps, [], ts)
    cut = F.floor(F.col("n_distinct") * F.lit(float(frac)))
    return F.lit(ranks.where(F.col("rank") <= cut).agg(F.max(ts)).first()[0])


def chronological_split(df: DataFrame, ts: str = "ts", train_frac: float = 0.8,
                        first: str = "train", second: str = "test",
                        out: str = "split") -> DataFrame:
    """Rows whose time stamp is among the first ``floor(n * train_frac)``
    distinct time stamps get ``first``, the rest ``second`` (the reference's
    ``iloc`` cut over a one-row-per-date frame).  Rows are labelled by
    comparing to :func:`boundary_of`, without a join.  A NULL time stamp has
    a NULL label."""
    early = F.coalesce(F.col(ts) <= boundary_of(df, ts, train_frac), F.lit(False))
    return df.withColumn(out, F.when(F.col(ts).isNotNull(), F.when(early, F.lit(first)).otherwise(F.lit(second))))


def three_way_split(df: DataFrame, ts: str = "ts", label: str | None = None,
                    test_frac: float = 0.2, val_frac: float = 0.25, seed: int = 42,
                    key: str = "ts", out: str = "split") -> DataFrame:
    """Last ``test_frac`` of time stamps -> ``test``; inside the first part
    a seeded hash split (stratified by ``label`` when given) gives ``val``
    (``val_frac`` of each class, rounded up) and ``train``."""
    chrono = chronological_split(df, ts, 1.0 - test_frac, "dev", "test", "_part")
    h = F.xxhash64(F.col(key).cast("string"), F.lit(seed))
    # One threshold hash per class: the ceil(n * val_frac)-th smallest.
    dev = chrono.where(F.col("_part") == "dev").select(
        *([F.col(label).alias("_cls")] if label else []), h.alias("_h"))
    groups = ["_cls"] if label else []
    cum = cumulative_counts(dev, groups, "_h")
    cut = F.ceil(F.col("n_total") * F.lit(float(val_frac)))
    limits = (cum.where(F.col("n_cum") - F.col("n") < cut).groupBy(*groups).agg(F.max("_h").alias("_limit")).collect())
    is_val = F.lit(False)
    for r in limits:  # one row per class
        own = F.lit(True) if not label else F.col(label).eqNullSafe(F.lit(r["_cls"]))
        is_val = is_val | (own & (h <= F.lit(r["_limit"]))) if r["_limit"] is not None else is_val
    return chrono.withColumn(out, F.when(F.col("_part") == "test", F.lit("test")).when(
        F.col("_part") == "dev", F.when(is_val, F.lit("val")).otherwise(F.lit("train")))) \
        .where(F.col("_part").isNotNull()).drop("_part")
