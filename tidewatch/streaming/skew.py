"""Hourly serving skew on a stream.

events -> watermark -> counts per window, series and value bin (edges fixed by
the training events) -> one row per window and series, by a second aggregation
chained to the first -> distance between the window's bin shares and the
training shares, alert, and label counts in the same row -> append sink.

The first aggregation's state is a few numbers per window, series and bin, so a
series with a third of all events costs no more than any other; the second
sums at most as many rows as there are bins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import LABEL_FEAR, LABEL_GREED, LABEL_STABLE, threshold_label, width_bin
from ..session import bounded_broadcast, materialize, scratch_path
from ..sources.tables import nan_to_null
from .monitor import DRIFT_THRESHOLD, WATERMARK, WINDOW, event_stream

N_BINS = 10
_LABELS = {"n_fear": LABEL_FEAR, "n_greed": LABEL_GREED, "n_stable": LABEL_STABLE}


def training_profile(events: DataFrame, n_bins: int = N_BINS) -> DataFrame:
    """Per series of training events (symbol, value): range (lo, hi), mean and
    deviation (mu, sigma), and the shares of its equal-width bins."""
    known = events.where("value is not null")
    edges = known.groupBy("symbol").agg(F.min("value").alias("lo"), F.max("value").alias("hi"),
                                        F.avg("value").alias("mu"), F.stddev_samp("value").alias("sigma"))
    placed = known.join(edges, "symbol").withColumn("bin", width_bin(F.col("value"), F.col("lo"), F.col("hi"), n_bins))
    shares = F.array(*[F.avg(F.when(F.col("bin") == k, 1.0).otherwise(0.0)) for k in range(1, n_bins + 1)])
    return edges.join(placed.groupBy("symbol").agg(shares.alias("shares")), "symbol")


def binned_windows(stream: DataFrame, profile: DataFrame, n_bins: int = N_BINS, window: str = WINDOW,
                   watermark: str = WATERMARK) -> DataFrame:
    """(w, symbol, n, counts, n_fear, n_greed, n_stable, n_unlabelled): events
    of each window and series by bin and by label.  Values outside the training
    range count into the end bins; events without a value, or of a series that
    training did not see, have no bin and no label."""
    known = bounded_broadcast(profile.select("symbol", "lo", "hi", "mu", "sigma"))
    placed = (stream.withWatermark("ts", watermark).join(known, "symbol", "left")
              .withColumn("bin", F.when(F.col("lo").isNotNull() & F.col("value").isNotNull(),
                                        width_bin(F.col("value"), F.col("lo"), F.col("hi"), n_bins)))
              .withColumn("label", F.when(F.col("mu").isNotNull(), threshold_label(F.col("value"), F.col("mu"), F.col("sigma")))))
    first = placed.groupBy(F.window("ts", window).alias("w"), "symbol", "bin").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("label") == label).alias(name) for name, label in _LABELS.items()],
        F.count_if(F.col("label").isNull()).alias("n_unlabelled"))
    counts = F.array(*[F.sum(F.when(F.col("bin") == k, F.col("n")).otherwise(0)) for k in range(1, n_bins + 1)])
    return (first.groupBy(F.window(F.window_time("w"), window).alias("w"), "symbol")
            .agg(F.sum("n").alias("n"), counts.alias("counts"), *[F.sum(c).alias(c) for c in (*_LABELS, "n_unlabelled")]))


def with_distance(windows: DataFrame, profile: DataFrame, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """Adds the largest difference of a bin's share from its training share
    (NULL without binned events or training) and the alert above ``threshold``."""
    j = windows.join(bounded_broadcast(profile.select("symbol", "shares")), "symbol", "left")
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    gaps = F.zip_with("counts", "shares", lambda c, s: F.abs(F.try_divide(c.cast("double"), total) - s))
    return j.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "symbol", "n",
                    F.array_max(gaps).alias("skew"), *_LABELS, "n_unlabelled").withColumn(
        "alert", F.coalesce(F.col("skew") > threshold, F.lit(False)))


def run_hourly_skew(spark: SparkSession, events_path: str, out: str | None = None, checkpoint: str | None = None,
                    baseline: DataFrame | None = None, n_bins: int = N_BINS,
                    max_files_per_trigger: int | None = None) -> str:
    """Process what the folder holds and return the output path.  Windows are
    compared with ``baseline`` (static training events with event_type, ts and
    value; default: the folder's own events)."""
    static = spark.read.parquet(events_path)
    training = (static if baseline is None else baseline).select(
        F.col("event_type").alias("symbol"), nan_to_null("value").alias("value"))
    profile = materialize(training_profile(training, n_bins))
    out = out or scratch_path(spark, "skew_windows")
    stream = event_stream(spark, events_path, static.schema, max_files_per_trigger)
    windows = with_distance(binned_windows(stream, profile, n_bins), profile)
    (windows.writeStream.outputMode("append").format("parquet").option("path", out)
     .option("checkpointLocation", checkpoint or scratch_path(spark, "skew_checkpoint"))
     .trigger(availableNow=True).start().awaitTermination())
    return out
