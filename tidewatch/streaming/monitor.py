"""Windowed drift monitoring and live labelling on streams.

M1: events stream -> watermark -> tumbling windows per symbol (count, mean,
std) -> each finalized window compared with static reference statistics
(broadcast: one row per symbol) -> alert flag -> append sink.
M2: events stream -> thresholds per symbol from the static reference ->
fear / stable / greed label per event -> append sink.

Both write Parquet (exactly-once via the checkpointed file sink) under a
folder of the shared checkpoint directory and can be started with any
trigger; ``run_available_now`` processes what is there and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalar import LABEL_FEAR, LABEL_GREED, LABEL_STABLE, threshold_label
from ..session import bounded_broadcast, materialize, scratch_path
from ..sources.tables import nan_to_null

# Fixed values of the monitoring set-up: hourly windows, drift threshold.
WINDOW = "1 hour"
WATERMARK = "1 hour"
DRIFT_THRESHOLD = 0.01


def event_stream(spark: SparkSession, path: str, schema: StructType,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of a parquet folder, or of one file (its folder + a name filter:
    the file source watches directories)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if path.rstrip("/").endswith(".parquet"):
        folder, name = path.rstrip("/").rsplit("/", 1)
        ev = reader.option("pathGlobFilter", name).parquet(folder)
    else:
        ev = reader.parquet(path)
    # Watermarks need TIMESTAMP; the tables store TIMESTAMP_NTZ (UTC session).
    return ev.select(F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("ts"),
                     nan_to_null("value").alias("value"))


def reference_stats(static_events: DataFrame) -> DataFrame:
    """Per-symbol mean / std / count over the static reference data.  The
    stream jobs materialize it once, so micro-batches never rescan the
    static table."""
    ev = static_events.select(F.col("event_type").alias("symbol"), nan_to_null("value").alias("value"))
    return ev.groupBy("symbol").agg(F.avg("value").alias("ref_mean"),
                                    F.stddev_samp("value").alias("ref_std"),
                                    F.count("value").alias("ref_n"))


def windowed_stats(stream: DataFrame, window: str = WINDOW, watermark: str = WATERMARK) -> DataFrame:
    w = F.window("ts", window)
    return (stream.withWatermark("ts", watermark)
            .groupBy(w.alias("w"), "symbol")
            .agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"),
                 F.stddev_samp("value").alias("std"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                    "symbol", "n", "mean", "std"))


def with_alerts(windows: DataFrame, ref: DataFrame, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """Relative mean shift of each window against the reference; alert
    when it exceeds ``threshold``.  The reference has one row per symbol:
    broadcast when its size is within the bound, else a shuffled join."""
    j = windows.join(bounded_broadcast(ref), "symbol", "left")
    shift = F.abs(F.try_divide(F.col("mean") - F.col("ref_mean"), F.col("ref_mean")))
    return j.select("window_start", "window_end", "symbol", "n", "mean", "std",
                    shift.alias("mean_shift"),
                    F.coalesce(shift > F.lit(threshold), F.lit(False)).alias("alert"))


def run_windowed_monitoring(spark: SparkSession, events_path: str, out: str | None = None,
                            checkpoint: str | None = None, available_now: bool = True,
                            baseline: DataFrame | None = None):
    """Start M1; with ``available_now`` wait for it to finish and return the
    output path.  Windows are emitted when the watermark passes their end.
    They are compared with ``baseline`` (static events, e.g. of the training
    period); without one, with all events of the folder itself."""
    schema = spark.read.parquet(events_path).schema
    ref = materialize(reference_stats(spark.read.parquet(events_path) if baseline is None else baseline))
    out = out or scratch_path(spark, "m1_windows")
    checkpoint = checkpoint or scratch_path(spark, "m1_checkpoint")
    wins = windowed_stats(event_stream(spark, events_path, schema))
    q = (with_alerts(wins, ref).writeStream.outputMode("append").format("parquet")
         .option("path", out).option("checkpointLocation", checkpoint))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    handle = q.start()
    if available_now:
        handle.awaitTermination()
    return out if available_now else handle


def live_labels(stream: DataFrame, ref: DataFrame) -> DataFrame:
    """Label each event by its symbol's reference mean +- std (stateless
    stream-static join against the per-symbol frame, broadcast when its
    size is within the bound)."""
    j = stream.join(bounded_broadcast(ref), "symbol", "left")
    return j.select("symbol", F.col("ts").cast("timestamp_ntz").alias("ts"), "value",
                    threshold_label(F.col("value"), F.col("ref_mean"), F.col("ref_std"))
                    .alias("label"))


def windowed_label_counts(labelled: DataFrame, window: str = WINDOW, watermark: str = WATERMARK) -> DataFrame:
    """Events of each label per window and symbol (append mode), from the
    frame of :func:`live_labels`."""
    timed = labelled.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    of = lambda label: F.count_if(F.col("label") == label)
    return (timed.groupBy(F.window("ts", window).alias("w"), "symbol")
            .agg(of(LABEL_FEAR).alias("n_fear"), of(LABEL_GREED).alias("n_greed"),
                 of(LABEL_STABLE).alias("n_stable"), F.count_if(F.col("label").isNull()).alias("n_unlabelled"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "symbol",
                    "n_fear", "n_greed", "n_stable", "n_unlabelled"))


def run_live_labels(spark: SparkSession, events_path: str, out: str | None = None,
                    checkpoint: str | None = None, baseline: DataFrame | None = None) -> str:
    """M2 labelling against ``baseline`` (default: the folder's own events)."""
    schema = spark.read.parquet(events_path).schema
    ref = materialize(reference_stats(spark.read.parquet(events_path) if baseline is None else baseline))
    out = out or scratch_path(spark, "m2_labels")
    checkpoint = checkpoint or scratch_path(spark, "m2_checkpoint")
    q = (live_labels(event_stream(spark, events_path, schema), ref).writeStream
         .outputMode("append").format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def score_requests(requests: DataFrame, model, features: list[str], medians: dict,
                   label_col: str, labels: list[str] | None = None) -> DataFrame:
    """Scoring requests (one row per instance) through a fitted pipeline:
    missing features become NULL, NULLs are filled with the training
    medians (then 0), the label column the pipeline indexes is added as
    NULL, and predictions are decoded to label names when ``labels`` are
    given.  Works on batch and streaming frames alike (row-wise only)."""
    from pyspark.ml.feature import IndexToString
    have = set(requests.columns)
    cols = [F.col(f"`{c}`").cast("double").alias(c) if c in have
            else F.lit(None).cast("double").alias(c) for c in features]
    keep = [c for c in requests.columns if c not in features]
    inst = requests.select(*keep, *cols)
    inst = inst.na.fill({c: float(v) for c, v in medians.items() if c in features})
    inst = inst.na.fill(0.0, subset=features)
    if label_col not in inst.columns:
        inst = inst.withColumn(label_col, F.lit(None).cast("string"))
    model = model.copy()
    for stage in model.stages:  # requests have no label
        if hasattr(stage, "labelsArray"):
            stage.setHandleInvalid("keep")
    pred = model.transform(inst)
    if labels:
        pred = IndexToString(inputCol="prediction", outputCol="pred_label",
                             labels=labels).transform(pred)
    return pred


def run_request_scoring(spark: SparkSession, requests_path: str, schema: StructType, model,
                        features: list[str], medians: dict, label_col: str, labels: list[str],
                        out: str | None = None, checkpoint: str | None = None) -> str:
    """M2 scoring: a stream of request documents (JSON lines
    ``{"instances": [...]}``) -> one row per instance -> fitted pipeline ->
    ``(ts, pred_label)`` appended to Parquet (checkpointed, exactly-once)."""
    raw = spark.readStream.schema(schema).json(requests_path)
    inst = raw.select(F.explode("instances").alias("i")).select("i.*")
    pred = score_requests(inst, model, features, medians, label_col, labels)
    out = out or scratch_path(spark, "m2_scores")
    checkpoint = checkpoint or scratch_path(spark, "m2_scores_checkpoint")
    q = (pred.select("ts", "pred_label").writeStream.outputMode("append").format("parquet")
         .option("path", out).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out
