"""Model training and evaluation with MLlib.

Feature frame -> complete rows -> chronological test cut (last 20 % of dates)
-> seeded, stratified hash split of the rest into train / validation
-> ``VectorAssembler`` -> ``StandardScaler`` -> candidate
estimators -> selection on the validation metric -> test metrics.  Every
fit and score is a distributed MLlib job; only the small result rows are
assembled on the driver.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (LogisticRegression, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import IndexToString, StandardScaler, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, LongType, StringType, StructField,
                               StructType)

from ..functions.scalar import SENTIMENT_LABELS
from ..operators import stats as S
from ..operators.features import LABEL_COL, TARGET_VALUE, FeatureSet
from ..operators.ranks import exact_quantiles
from ..operators.split import three_way_split
from ..session import materialize
from .regression import compact

# Fixed values of the reference's experiment set-up.
SEED = 42
TEST_FRAC = 0.2
VAL_FRAC = 0.25
FOREST_TREES = 100
#: Trees of unlimited depth: the deepest that MLlib grows.
FOREST_DEPTH = 30
#: Runs of a sweep that are fitted side by side.
MAX_RUNS = 6

RESULT_SCHEMA = StructType([
    StructField("version", StringType(), False), StructField("task", StringType(), False),
    StructField("best_model", StringType(), True), StructField("n_features", LongType(), True),
    StructField("train_samples", LongType(), True), StructField("val_samples", LongType(), True),
    StructField("test_samples", LongType(), True), StructField("val_metric", DoubleType(), True),
    StructField("test_metric", DoubleType(), True), StructField("metric_name", StringType(), True),
    StructField("duration_sec", DoubleType(), True), StructField("status", StringType(), True),
    StructField("automl_available", BooleanType(), True)])

TRIAL_SCHEMA = StructType([
    StructField("version", StringType(), False), StructField("task", StringType(), False),
    StructField("position", LongType(), False), StructField("model", StringType(), True),
    StructField("val_metric", DoubleType(), True), StructField("duration_sec", DoubleType(), True),
    StructField("status", StringType(), True)])


def forest(task: str, quick: bool = False, **options):
    """The random forest of a task, at the reference's size."""
    kind = RandomForestClassifier if task == "classification" else RandomForestRegressor
    size = {"numTrees": 20} if quick else {"numTrees": FOREST_TREES, "maxDepth": FOREST_DEPTH}
    return kind(seed=SEED, **{**size, **options})


def classification_candidates(n_features: int, n_classes: int, quick: bool = False,
                              include_svm: bool = False):
    extra = {}
    if include_svm:
        # The reference's RBF SVC has no MLlib counterpart: linear one-vs-rest.
        from pyspark.ml.classification import LinearSVC, OneVsRest
        extra["svm"] = OneVsRest(classifier=LinearSVC(maxIter=100 if quick else 1000))
    return {**extra,
        "random_forest": forest("classification", quick),
        "logistic_regression": LogisticRegression(maxIter=100 if quick else 1000,
                                                  family="multinomial"),
        "mlp": MultilayerPerceptronClassifier(layers=[n_features, 100, 50, n_classes],
                                              maxIter=50 if quick else 500, seed=SEED),
    }


def regression_candidates(n_train: int, y_std: float, quick: bool = False, alpha: float = 1.0):
    """Ridge with the penalty alpha * ||w||^2 of the closed form: MLlib's
    objective is 1/(2n) * SSE + regParam/2 * ||w||^2 scaled by std(y), so
    regParam = alpha / n * std(y) (l-bfgs uses the sample std)."""
    reg = alpha / max(n_train, 1) * (y_std or 1.0)
    return {
        "random_forest": forest("regression", quick),
        "ridge": LinearRegression(regParam=reg, elasticNetParam=0.0, standardization=False,
                                  solver="l-bfgs"),
    }


def exact_medians(df: DataFrame, cols: list[str]) -> dict[str, float]:
    """Exact per-column medians (one value per feature is returned)."""
    q = exact_quantiles(S.long_values(df, cols), ["column"], "value", [0.5])
    return {r["column"]: r["q"] for r in q.collect() if r["q"] is not None}


@dataclass
class Prepared:
    train: DataFrame
    val: DataFrame
    test: DataFrame
    features: list[str]
    label_col: str
    task: str
    medians: dict = field(default_factory=dict)


def prepare(fs: FeatureSet, task: str, missing: str = "drop") -> Prepared:
    """Split the rows.  Rows with a NULL in a feature or the label are dropped;
    with ``missing`` "median", features are filled with the training rows'
    medians instead (0 without any).  The medians also fill scoring requests."""
    if missing not in ("drop", "median"):
        raise ValueError(f"unknown treatment of missing values {missing!r}")
    label = LABEL_COL if task == "classification" else TARGET_VALUE
    # The feature frame (one row per date) is written once; the split's rank
    # and hash passes then read the table instead of re-running the features.
    needed = [label, *(fs.features if missing == "drop" else [])]
    base = materialize(fs.df.na.drop(how="any", subset=needed))
    split = materialize(three_way_split(base, "ts", LABEL_COL if task == "classification" else None,
                                        TEST_FRAC, VAL_FRAC, SEED))
    med = exact_medians(split.where(F.col("split") == "train"), fs.features)
    if missing == "median":
        split = split.na.fill({c: float(v) for c, v in med.items()}).na.fill(0.0, subset=fs.features)
    part = lambda name: split.where(F.col("split") == name)
    return Prepared(part("train"), part("val"), part("test"), fs.features, label, task, med)


def _pipeline(p: Prepared, estimator, with_mean: bool = True) -> Pipeline:
    stages = [VectorAssembler(inputCols=p.features, outputCol="raw_features", handleInvalid="keep"),
              StandardScaler(inputCol="raw_features", outputCol="features", withMean=with_mean,
                             withStd=True)]
    if p.task == "classification":
        # All three labels, in alphabetical order, whichever occur in the rows.
        stages.append(StringIndexerModel.from_labels(sorted(SENTIMENT_LABELS), inputCol=p.label_col,
                                                     outputCol="label", handleInvalid="error"))
    else:
        stages.append(_copy_label(p.label_col))
    stages.append(estimator.setFeaturesCol("features").setLabelCol("label"))
    return Pipeline(stages=stages)


def _copy_label(col: str):
    from pyspark.ml.feature import SQLTransformer
    return SQLTransformer(statement=f"SELECT *, CAST(`{col}` AS DOUBLE) AS label FROM __THIS__")


def _score(task: str, pred: DataFrame) -> float:
    if task == "classification":
        return MulticlassClassificationEvaluator(metricName="accuracy").evaluate(pred)
    return RegressionEvaluator(metricName="rmse").evaluate(pred)


def better(task: str, a: float, b: float | None) -> bool:
    """Same metric on both sides: accuracy higher, RMSE lower."""
    if b is None:
        return True
    return a > b if task == "classification" else a < b


def train_and_select(p: Prepared, quick: bool = False):
    """Fit every candidate, score on validation, keep failures as rows."""
    n_classes = 3
    if p.task == "classification":
        cands = classification_candidates(len(p.features), n_classes, quick)
    else:
        stats = p.train.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp(p.label_col).alias("s")).first()
        cands = regression_candidates(stats["n"], stats["s"], quick)
    train = compact(p.train).persist()

    def fit(item):
        name, est = item
        t0 = time.perf_counter()
        try:
            model = _pipeline(p, est).fit(train)
            val = _score(p.task, model.transform(p.val))
            return (name, val, time.perf_counter() - t0, "ok"), model
        except Exception as e:  # noqa: BLE001 - a failing candidate is recorded, not fatal
            return (name, None, time.perf_counter() - t0, f"FAILED: {e}"[:200]), None

    # Candidates are independent Spark jobs: fit them concurrently, like
    # CrossValidator(parallelism=...).
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=len(cands)) as pool:
        results = list(pool.map(fit, cands.items()))
    trials, best = [], (None, None, None)
    for trial, model in results:       # candidate order decides ties
        trials.append(trial)
        if model is not None and better(p.task, trial[1], best[1]):
            best = (trial[0], trial[1], model)
    train.unpersist()
    return best, trials


def evaluate(p: Prepared, model: PipelineModel) -> DataFrame:
    """Test metrics (E12 for regression, E14 for classification)."""
    pred = model.transform(p.test)
    if p.task == "classification":
        labels = model.stages[2].labelsArray[0]
        pred = IndexToString(inputCol="prediction", outputCol="pred_label",
                             labels=list(labels)).transform(pred)
        return S.classification_summary(materialize(S.confusion(pred, p.label_col, "pred_label")))
    return S.regression_metrics(pred, "label", "prediction")


def run_experiment(fs: FeatureSet, task: str, quick: bool = False, missing: str = "drop",
                   prepared: dict | None = None) -> tuple:
    t0 = time.perf_counter()
    p = prepare(fs, task, missing)
    if prepared is not None:
        prepared[fs.version, task] = p
    (name, val, model), trials = train_and_select(p, quick)
    n_tr, n_va, n_te = (p.train.count(), p.val.count(), p.test.count())
    if model is None:
        return (fs.version, task, "FAILED", len(fs.features), n_tr, n_va, n_te, None, None,
                None, time.perf_counter() - t0, "FAILED", False), trials, None
    m = evaluate(p, model).first()
    metric, mname = (m["accuracy"], "accuracy") if task == "classification" else (m["r2"], "r2")
    return (fs.version, task, name, len(fs.features), n_tr, n_va, n_te, float(val),
            float(metric) if metric is not None else None, mname,
            time.perf_counter() - t0, "ok", False), trials, model


def sweep(spark, feature_sets: list[FeatureSet], tasks=("classification", "regression"),
          quick: bool = False, with_trials: bool = False, missing: str = "drop", models: dict | None = None,
          prepared: dict | None = None):
    """Versions x tasks; each run recorded (failures as ``FAILED`` rows).
    With ``with_trials`` also every candidate of every run (``TRIAL_SCHEMA``);
    ``models`` takes the winners' pipelines by (version, task), ``prepared``
    the rows that they were fitted and tested on."""
    def run(item):
        fs, task = item
        try:
            return run_experiment(fs, task, quick, missing, prepared)
        except Exception:  # noqa: BLE001
            return (fs.version, task, "FAILED", len(fs.features), None, None, None,
                    None, None, None, None, "FAILED", False), [], None

    # Runs are independent, and an iterative fit on few rows keeps one core
    # busy: they go side by side, and are recorded in their order.
    from concurrent.futures import ThreadPoolExecutor
    rows, trial_rows, items = [], [], [(fs, task) for fs in feature_sets for task in tasks]
    with ThreadPoolExecutor(max_workers=max(1, min(MAX_RUNS, len(items)))) as pool:
        done = list(pool.map(run, items))
    for (fs, task), (row, trials, model) in zip(items, done, strict=True):
        if models is not None and model is not None:
            models[fs.version, task] = model
        rows.append(row)
        trial_rows += [(fs.version, task, i, *t) for i, t in enumerate(trials)]
    results = spark.createDataFrame(rows, RESULT_SCHEMA)
    if with_trials:
        return results, spark.createDataFrame(trial_rows, TRIAL_SCHEMA)
    return results


def result_documents(results: DataFrame, trials: DataFrame) -> DataFrame:
    """One nested document per run: the run's fields plus
    ``candidates: array<struct>`` in candidate order.  A run has a handful
    of candidates, so each collected group is bounded."""
    cand = F.struct("position", *[c for c in ("model", "val_metric", "duration_sec", "status") if c in trials.columns])
    docs = trials.groupBy("version", "task").agg(
        F.array_sort(F.collect_list(cand)).alias("candidates"))
    return results.join(docs, ["version", "task"], "left")


def flatten_candidates(docs: DataFrame) -> DataFrame:
    """Nested documents -> one row per candidate (``explode_outer`` keeps
    runs without candidates as one row with NULL candidate fields)."""
    return (docs.select("version", "task", "best_model",
                        F.explode_outer("candidates").alias("c"))
            .select("version", "task", F.col("c.position").alias("position"),
                    F.col("c.model").alias("model"), F.col("c.val_metric").alias("val_metric"),
                    F.col("c.status").alias("status"),
                    F.coalesce(F.col("c.model") == F.col("best_model"), F.lit(False))
                    .alias("is_best")))


def feature_importance(model: PipelineModel, features: list[str], top: int = 20,
                       prepared: "Prepared | None" = None, repeats: int = 5) -> list:
    """Native importances (trees), else |coefficient| (linear, mean over
    classes), else permutation importance on the validation rows (needs
    ``prepared``; ``repeats`` shuffles per feature); top-n rows."""
    est = model.stages[-1]
    if hasattr(est, "featureImportances"):
        vals = est.featureImportances.toArray()
    elif hasattr(est, "coefficients"):
        vals = [abs(v) for v in est.coefficients.toArray()]
    elif hasattr(est, "coefficientMatrix"):
        m = est.coefficientMatrix.toArray()
        vals = abs(m).mean(axis=0)
    elif prepared is not None:
        vals = [permutation_importance(model, prepared, f, repeats=repeats) for f in features]
    else:
        return []
    pairs = sorted(zip(features, [float(v) for v in vals]), key=lambda t: -t[1])
    return pairs[:top]


def shuffle_column(df: DataFrame, column: str, seed: int = SEED, key: str = "ts",
                   n_buckets: int | None = None) -> DataFrame:
    """``df`` with the values of ``column`` permuted among rows, distributed:
    rows are numbered inside hash buckets under two different orders and
    equi-joined on (bucket, position).  Buckets and orders derive from the
    unique ``key`` column, so the result does not depend on partitioning
    and survives recomputation."""
    from pyspark.sql import Window
    n_buckets = n_buckets or max(1, df.rdd.getNumPartitions())
    d = df.withColumn("_b", F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(n_buckets)))
    w1 = Window.partitionBy("_b").orderBy(key)
    w2 = Window.partitionBy("_b").orderBy(F.xxhash64(key, F.lit(seed + 1000)), key)
    left = d.withColumn("_pos", F.row_number().over(w1)).drop(column)
    right = d.withColumn("_pos", F.row_number().over(w2)).select("_b", "_pos", column)
    return left.join(right, ["_b", "_pos"]).drop("_b", "_pos")


def permutation_importance(model: PipelineModel, p: Prepared, column: str, seed: int = SEED,
                           repeats: int = 5, key: str = "ts") -> float:
    """Mean drop of the validation metric when one column is shuffled
    (:func:`shuffle_column`, a different seed per repeat)."""
    base = _score(p.task, model.transform(p.val))
    drops = []
    for r in range(repeats):
        s = _score(p.task, model.transform(shuffle_column(p.val, column, seed + r, key)))
        drops.append(base - s if p.task == "classification" else s - base)
    return float(sum(drops) / len(drops))


def trial_plan(task: str, n: int = 9, seed: int = SEED) -> list[dict]:
    """``n`` seeded configurations over forests and, for regression, boosting:
    the same list whenever and wherever it is drawn."""
    import random
    rng = random.Random(f"{task}/{seed}")
    plan = []
    for trial in range(n):
        if task == "regression" and trial % 2:
            plan.append({"trial": trial, "learner": "gbt", "maxIter": rng.choice([50, 100, 200]),
                         "maxDepth": rng.choice([3, 5]), "stepSize": rng.choice([0.05, 0.1])})
        else:
            plan.append({"trial": trial, "learner": "rf", "numTrees": rng.choice([50, 100, 200]),
                         "maxDepth": rng.choice([5, 10, 20])})
    return plan


def sample_share(rung: int, rungs: int, eta: int) -> float:
    return float(eta) ** (rung - rungs + 1)


def nested_sample(df: DataFrame, share: float, key: str = "ts") -> DataFrame:
    """Rows whose key's hash lies below ``share``: a smaller share's rows are
    among a larger one's, on any cluster."""
    if share >= 1.0:
        return df
    h = F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("double")
    return df.where(h < F.lit(share * 2.0 ** 32))


def halving_search(p: Prepared, n: int = 9, eta: int = 3, seed: int = SEED) -> DataFrame:
    """Successive halving: all trials of :func:`trial_plan` are fitted on a
    nested sample, the best 1/eta of them on eta times as many rows, and so on
    until the survivors are fitted on all rows.  One row per trial and rung.
    Nothing depends on the clock."""
    rungs = 1
    while eta ** rungs <= n:
        rungs += 1
    spark, alive, rows = p.train.sparkSession, trial_plan(p.task, n, seed), []
    for rung in range(rungs):
        share = sample_share(rung, rungs, eta)
        train = nested_sample(p.train, share).persist()

        def fit(trial, train=train):
            options = {k: v for k, v in trial.items() if k not in ("trial", "learner")}
            est = GBTRegressor(seed=seed, **options) if trial["learner"] == "gbt" else forest(p.task, **options)
            try:
                val = _score(p.task, _pipeline(p, est).fit(train).transform(p.val))
            except Exception:  # noqa: BLE001 - too few rows for a fit: the trial comes last
                return float("inf")
            return 1.0 - val if p.task == "classification" else val
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=3) as pool:
            losses = list(pool.map(fit, alive))
        train.unpersist()
        order = sorted(range(len(alive)), key=lambda i: (losses[i], alive[i]["trial"]))
        keep = max(1, len(alive) // eta)
        for place, i in enumerate(order):
            config = ",".join(f"{k}={v}" for k, v in alive[i].items() if k not in ("trial", "learner"))
            rows.append((alive[i]["trial"], alive[i]["learner"], config, rung, float(share), float(losses[i]),
                         place < keep or rung == rungs - 1))
        alive = [alive[i] for i in order[:keep]]
    return spark.createDataFrame(rows, "trial long, learner string, config string, rung int, share double, "
                                       "val_loss double, survived boolean")


def expanding_folds(df: DataFrame, folds: int = 5, ts: str = "ts") -> DataFrame:
    """``df`` with ``fold``: the dates are cut into folds + 1 runs of equal
    length by their distributed rank (0 is only ever trained on); fold k is
    judged by a model of all earlier runs."""
    from ..operators.ranks import dense_rank_of
    ranks = dense_rank_of(df.select(ts), [], ts)
    fold = F.floor((F.col("rank") - 1) * F.lit(folds + 1) / F.col("n_distinct")).cast("int")
    return df.join(ranks.select(F.col(ts).alias("_of"), fold.alias("fold")), F.col(ts) == F.col("_of")).drop("_of")


def cross_validate(p: Prepared, folds: int = 5, estimator=None) -> DataFrame:
    """Time-ordered cross-validation over training and validation rows: one
    row per fold with its sizes and metric (accuracy or RMSE).  The folds are
    one written frame; their fits run side by side."""
    from concurrent.futures import ThreadPoolExecutor
    spark = p.train.sparkSession
    rows = materialize(expanding_folds(p.train.unionByName(p.val), folds)).persist()

    def fit(fold):
        train, test = rows.where(F.col("fold") < fold), rows.where(F.col("fold") == fold)
        model = _pipeline(p, estimator.copy() if estimator is not None else forest(p.task)).fit(train)
        return (fold, train.count(), test.count(), float(_score(p.task, model.transform(test))))
    with ThreadPoolExecutor(max_workers=folds) as pool:
        done = list(pool.map(fit, range(1, folds + 1)))
    rows.unpersist()
    return spark.createDataFrame(done, "fold int, n_train long, n_test long, metric double")


def leaderboard(results: DataFrame) -> DataFrame:
    """Best run per task (ties: earlier version wins), wins share per model."""
    from pyspark.sql import Window
    ok = results.where(F.col("best_model") != "FAILED")
    w = Window.partitionBy("task").orderBy(F.desc("test_metric"), F.asc("version"))
    best = ok.withColumn("rank", F.row_number().over(w))
    wins = ok.groupBy("best_model").agg(F.count(F.lit(1)).alias("wins"))
    total = ok.select(F.count(F.lit(1))).scalar()
    wins = wins.withColumn("win_share", F.col("wins") / total)
    return best.join(wins, "best_model", "left")


def best_per_version(results: DataFrame, task: str) -> DataFrame:
    """Head 1 per version by the test metric, descending, ties by name; the
    per-version bests concatenated."""
    from pyspark.sql import Window
    ok = results.where((F.col("task") == task) & (F.col("best_model") != "FAILED"))
    w = Window.partitionBy("version").orderBy(F.desc("test_metric"), F.asc("best_model"))
    return ok.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def experiment_stats(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count_if(F.col("best_model") != "FAILED").alias("successful"),
        F.count_distinct("version").alias("versions"), F.count_distinct("task").alias("tasks"),
        F.bool_or("automl_available").alias("automl_available"),
        F.max("test_metric").alias("max_test_metric"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_latest_model(registry: DataFrame, version: str, task: str) -> PipelineModel:
    """Newest model path for (version, task) from a model-registry frame
    ``(version, task, path, created_at)``."""
    row = (registry.where((F.col("version") == version) & (F.col("task") == task))
           .agg(F.max_by("path", "created_at").alias("p")).first())
    if row is None or row["p"] is None:
        raise FileNotFoundError(f"no model for {version}/{task}")
    return PipelineModel.load(row["p"])
