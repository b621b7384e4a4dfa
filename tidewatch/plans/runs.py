"""Run tables of deterministic forecasters, and what is reported about runs.

A version forecasts the daily market level a number of dates ahead; its
candidates are the last known value and the last known moving averages.  Every
candidate is judged on the validation dates (the last 30 % of the first 80 %)
and on the test dates (the last 20 %), as a regression and, through the
thresholds, as a classification.  The same reports (best of a version,
leaderboard, win shares, nested documents, statistics) serve the sweeps of
``models``; here they rest on numbers that any engine can compute.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import threshold_label
from ..operators.features import series_features
from ..operators.ranks import dense_rank_of
from ..operators.split import boundary_of
from ..operators.target import threshold_stats
from ..session import materialize

#: Dates ahead of each version.  The last one is longer than any table of
#: daily data, so its runs fail.
HORIZONS = {"v1": 1, "v2": 7, "v3": 30, "v4": 1_000_000}
MODELS = ("persistence", "ma7", "ma30")
TASKS = ("classification", "regression")
TEST_FRAC, VAL_FRAC = 0.2, 0.3


def forecasts(market: DataFrame, horizons: dict[str, int] | None = None, ts: str = "ts",
              value: str = "Target_Price") -> DataFrame:
    """(version, model, ts, split, actual, predicted): every forecast with a
    known value ``horizon`` dates before; split is val or test (dates before
    the validation dates are left out)."""
    horizons = horizons or HORIZONS
    series = market.select(F.lit("market").alias("symbol"), F.col(ts).alias("ts"), F.col(value).alias("price"))
    known = series_features(series).select("ts", "price", "ma7", "ma30")
    known = materialize(known.join(dense_rank_of(known, [], "ts").select("ts", "rank"), "ts"))
    test_from = boundary_of(known, "ts", 1.0 - TEST_FRAC)
    val_from = boundary_of(known.where(F.col("ts") <= test_from), "ts", 1.0 - VAL_FRAC)
    split = F.when(F.col("ts") > test_from, "test").when(F.col("ts") > val_from, "val")
    ahead = F.explode(F.array(*[F.struct(F.lit(v).alias("version"), F.lit(h).alias("ahead")) for v, h in horizons.items()]))
    seen = F.array(*[F.struct(F.lit(m).alias("model"), F.col("price" if m == "persistence" else m).alias("predicted"))
                     for m in MODELS])
    before = (known.select("rank", ahead.alias("h"), seen.alias("seen"))
              .select((F.col("rank") + F.col("h.ahead")).alias("rank"), "h.version", "seen"))
    now = known.select("rank", "ts", F.col("price").alias("actual"), split.alias("split")).where("split is not null")
    return (now.join(before, "rank").select("version", F.explode("seen").alias("s"), "ts", "split", "actual")
            .select("version", "s.model", "ts", "split", "actual", "s.predicted")
            .where("actual is not null and predicted is not null"))


def candidates(rows: DataFrame, mu, sigma) -> DataFrame:
    """One row per version, task and model: position (in MODELS), val_metric
    (RMSE or accuracy), rmse, mae, r2, accuracy and macro_f1 of the test
    dates, n_val, n_test."""
    rows = materialize(rows.withColumn("label", threshold_label(F.col("actual"), mu, sigma))
                       .withColumn("guess", threshold_label(F.col("predicted"), mu, sigma)))
    e = F.col("predicted") - F.col("actual")
    on = lambda split, x: F.when(F.col("split") == split, x)
    right = F.when(F.col("label") == F.col("guess"), 1.0).otherwise(0.0)
    base = rows.groupBy("version", "model").agg(
        F.count(on("val", e)).alias("n_val"), F.count(on("test", e)).alias("n_test"),
        F.sqrt(F.avg(on("val", e * e))).alias("val_rmse"), F.avg(on("val", right)).alias("val_accuracy"),
        F.sqrt(F.avg(on("test", e * e))).alias("rmse"), F.avg(on("test", F.abs(e))).alias("mae"),
        (1.0 - F.try_divide(F.sum(on("test", e * e)), F.var_pop(on("test", F.col("actual"))) * F.count(on("test", e)))).alias("r2"),
        F.avg(on("test", right)).alias("accuracy"))
    # Macro F1 over the labels that occur on either side.
    test = rows.where("split = 'test'")
    sides = test.select("version", "model", F.explode(F.array(
        F.struct(F.col("label").alias("of"), F.lit(1).alias("true"), F.lit(0).alias("said")),
        F.struct(F.col("guess").alias("of"), F.lit(0).alias("true"), F.lit(1).alias("said")))).alias("x"),
        (F.col("label") == F.col("guess")).cast("int").alias("hit"))
    per_label = sides.groupBy("version", "model", "x.of").agg(
        F.sum("x.true").alias("true"), F.sum("x.said").alias("said"), F.sum(F.col("hit") * F.col("x.true")).alias("hits"))
    f1 = (per_label.withColumn("f1", 2.0 * F.col("hits") / (F.col("true") + F.col("said")))
          .groupBy("version", "model").agg(F.avg("f1").alias("macro_f1")))
    task = F.explode(F.array(*[F.lit(t) for t in TASKS])).alias("task")
    regression = F.col("task") == "regression"
    return (base.join(f1, ["version", "model"], "left").select("*", task)
            .select("version", "task", F.array_position(F.array(*[F.lit(m) for m in MODELS]), F.col("model")).alias("position"),
                    "model", F.when(regression, F.col("val_rmse")).otherwise(F.col("val_accuracy")).alias("val_metric"),
                    "rmse", "mae", "r2", "accuracy", "macro_f1", "n_val", "n_test", F.lit("ok").alias("status")))


def runs(found: DataFrame, versions: list[str]) -> DataFrame:
    """One row per version and task: the candidate of the lowest RMSE or the
    highest accuracy on the validation dates (ties: the first in order), with
    its test metrics; FAILED without any candidate."""
    wanted = found.sparkSession.createDataFrame([(v, t) for v in versions for t in TASKS], "version string, task string")
    sign = F.when(F.col("task") == "regression", F.col("val_metric")).otherwise(-F.col("val_metric"))
    best = found.groupBy("version", "task").agg(F.min_by(F.struct(*found.columns[2:]), F.struct(sign, F.col("position"))).alias("b"))
    metric = F.when(F.col("task") == "regression", F.col("b.r2")).otherwise(F.col("b.accuracy"))
    return wanted.join(best, ["version", "task"], "left").select(
        "version", "task", F.coalesce("b.model", F.lit("FAILED")).alias("best_model"),
        F.col("b.val_metric").alias("val_metric"), metric.alias("test_metric"),
        F.when(F.col("task") == "regression", "r2").otherwise("accuracy").alias("metric_name"),
        F.col("b.rmse").alias("rmse"), F.col("b.mae").alias("mae"), F.col("b.r2").alias("r2"),
        F.coalesce("b.status", F.lit("FAILED")).alias("status"), F.lit(False).alias("automl_available"))


def best_of_version(found: DataFrame) -> DataFrame:
    """The candidate of each version with the lowest RMSE, then the lowest MAE,
    then the highest R2 (then the name): the versions' bests, one after the
    other, ranked by the same keys."""
    keys = [F.asc_nulls_last("rmse"), F.asc_nulls_last("mae"), F.desc_nulls_last("r2"), F.asc("model")]
    own = found.where("task = 'regression'").withColumn(
        "nth", F.row_number().over(Window.partitionBy("version").orderBy(*keys))).where("nth = 1").drop("nth")
    # One row per version: the final ranking is a window over a handful of rows.
    return own.withColumn("rank", F.row_number().over(Window.partitionBy("task").orderBy(*keys)))


def summary(results: DataFrame) -> DataFrame:
    """Runs, successes and best test metric by version and task, with
    subtotals by version and the total (grouping sets; null: all)."""
    ok = F.col("best_model") != "FAILED"
    return results.rollup("version", "task").agg(
        F.grouping_id().cast("long").alias("level"), F.count(F.lit(1)).alias("runs"), F.count_if(ok).alias("successful"),
        F.max(F.when(F.col("metric_name") == "accuracy", F.col("test_metric"))).alias("best_accuracy"),
        F.max(F.when(F.col("metric_name") == "r2", F.col("test_metric"))).alias("best_r2"))


def market_candidates(market: DataFrame) -> DataFrame:
    """:func:`candidates` of the daily market level, labelled by its own
    mean and standard deviation."""
    mu, sigma = threshold_stats(market, "Target_Price")
    return candidates(forecasts(market), mu, sigma)
