"""Stream results equal the batch computation over the same file."""
import math

from pyspark.sql import functions as F

from conftest import SF001
from tidewatch.streaming.monitor import reference_stats, run_live_labels, run_windowed_monitoring


def test_windowed_monitoring_equals_batch(spark, tmp_path):
    path = f"{SF001}/events.parquet"
    out = run_windowed_monitoring(spark, path, out=str(tmp_path / "o"),
                                  checkpoint=str(tmp_path / "c"))
    got = {(r.window_start, r.symbol): (r.n, r.mean) for r in spark.read.parquet(out).collect()}
    ev = spark.read.parquet(path)
    wm = ev.agg(F.max("ts")).first()[0]
    import datetime
    batch = (ev.groupBy(F.date_trunc("hour", "ts").alias("ws"), "event_type")
             .agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("m")).collect())
    exp = {(r.ws, r.event_type): (r.n, r.m) for r in batch
           if r.ws + datetime.timedelta(hours=2) <= wm}
    assert got.keys() >= exp.keys() and len(got) > 0
    for k, (n, m) in exp.items():
        assert got[k][0] == n and math.isclose(got[k][1], m, rel_tol=1e-12)


def test_live_labels_cover_every_event(spark, tmp_path):
    path = f"{SF001}/events.parquet"
    out = run_live_labels(spark, path, out=str(tmp_path / "o"), checkpoint=str(tmp_path / "c"))
    lab = spark.read.parquet(out)
    assert lab.count() == spark.read.parquet(path).count()
    assert {r.label for r in lab.select("label").distinct().collect()} <= {"fear", "stable", "greed"}
    ref = reference_stats(spark.read.parquet(path)).collect()
    assert len(ref) == 5


def test_late_rows_beyond_watermark_are_dropped(spark, tmp_path):
    """Three files, one micro-batch each.  Spark filters late rows with the
    watermark of the previous batch, so the late row comes one batch after
    the watermark has moved: 5 h of data, then an on-time row, then a row
    older than the watermark.  Only the on-time rows are counted."""
    import datetime as dt
    import os
    import shutil
    from tidewatch.streaming.monitor import event_stream, windowed_stats
    schema = "event_id long, ts timestamp_ntz, event_type string, value double"
    t0 = dt.datetime(2024, 1, 1, 0, 0)
    batches = [[(i, t0 + dt.timedelta(minutes=10 * i), "a", 1.0) for i in range(30)],  # 5 hours
               [(101, t0 + dt.timedelta(hours=5, minutes=30), "a", 2.0)],               # on time
               [(100, t0 + dt.timedelta(minutes=5), "a", 50.0)]]                        # late
    flat = tmp_path / "flat"
    flat.mkdir()
    for i, rows in enumerate(batches):
        d = tmp_path / f"b{i}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(d))
        f = next(d.glob("*.parquet"))
        shutil.copy(f, flat / f"part-{i}.parquet")
        # The file source orders files by modification time: make it explicit.
        os.utime(flat / f"part-{i}.parquet", (1_700_000_000 + 100 * i,) * 2)
    stream = event_stream(spark, str(flat), spark.read.parquet(str(flat / "part-0.parquet")).schema,
                          max_files_per_trigger=1)
    q = (windowed_stats(stream).writeStream.outputMode("append").format("parquet")
         .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    dropped = sum(s.get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress for s in p["stateOperators"])
    rows = {r.window_start: r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert rows[t0] == 6          # the late row for 00:00-01:00 was dropped
    assert dropped == 1


def test_stream_scoring_equals_batch_scoring(spark, tmp_path):
    """Requests scored on a stream give the same label per date as the
    same instances scored in batch."""
    from pyspark.sql import functions as F
    from tidewatch.plans.catalog import _scoring_parts
    from tidewatch.streaming.monitor import run_request_scoring, score_requests
    from tidewatch.operators.features import LABEL_COL
    p, model, path, schema, labels = _scoring_parts(spark, SF001)
    out = run_request_scoring(spark, path, schema, model, p.features, p.medians, LABEL_COL,
                              labels, out=str(tmp_path / "o"), checkpoint=str(tmp_path / "c"))
    streamed = {r.ts: r.pred_label for r in spark.read.parquet(out).collect()}
    inst = spark.read.schema(schema).json(path).select(F.explode("instances").alias("i")) \
        .select("i.*")
    batch = {r.ts: r.pred_label for r in
             score_requests(inst, model, p.features, p.medians, LABEL_COL, labels).collect()}
    assert streamed == batch and len(batch) == p.test.count()


def test_nan_is_missing_and_baseline_is_separate(spark, tmp_path):
    """A NaN event neither spoils its symbol's statistics nor raises an alert;
    windows are compared with the baseline, not with themselves; label counts
    are those of the batch frame."""
    import datetime as dt
    from tidewatch.streaming.monitor import live_labels, windowed_label_counts
    schema = "event_id long, ts timestamp_ntz, event_type string, value double"
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(minutes=5 * i), "a", float("nan") if i == 3 else 10.0 + i % 2) for i in range(60)]
    rows.append((99, t0 + dt.timedelta(hours=9), "a", 10.0))
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    base = spark.createDataFrame([(i, t0, "a", 20.0 + i % 3) for i in range(9)], schema)
    run = lambda name, **o: spark.read.parquet(run_windowed_monitoring(
        spark, str(tmp_path / "in"), out=str(tmp_path / name), checkpoint=str(tmp_path / f"{name}c"), **o)).collect()
    own, other = run("own"), run("other", baseline=base)
    assert own and all(r.mean == r.mean and r.mean_shift < 0.05 for r in own)
    assert all(0.45 < r.mean_shift < 0.55 and r.alert for r in other)
    events = spark.read.parquet(str(tmp_path / "in")).select(F.col("event_type").alias("symbol"), "ts", F.nanvl(
        "value", F.lit(None).cast("double")).alias("value"))
    counts = windowed_label_counts(live_labels(events, reference_stats(base))).collect()
    assert sum(r.n_greed for r in counts) == 60 and sum(r.n_unlabelled for r in counts) == 1
    assert sum(r.n_fear + r.n_stable for r in counts) == 0
