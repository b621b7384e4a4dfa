"""The chronological regression path: 70/30 split, scaling without centring,
three candidates, all ranked by RMSE, MAE and R2.

Rows with a NULL in any feature or the target are dropped, not filled.  Two
estimators of our own fill gaps of MLlib: :class:`PopulationScaler` divides by
the population standard deviation and leaves constant columns alone (MLlib's
scaler takes the sample deviation and turns them to 0), and :class:`GramRidge`
solves ridge regression exactly from a blocked Gram matrix.  Both are saved and
loaded with pipelines.
"""

from __future__ import annotations

import time

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCols, HasPredictionCol
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import threshold_label
from ..operators import stats as S
from ..operators.features import LABEL_COL, TARGET_VALUE, FeatureSet
from ..operators.gram import ridge_solution
from ..operators.split import chronological_split
from ..session import materialize

# Fixed values of the reference's regression set-up.
SEED = 42
FIT_FRAC, VAL_FRAC = 0.8, 0.3
RIDGE_ALPHA = 1.0
FOREST_TREES, BOOST_ROUNDS, BOOST_STEP = 400, 500, 0.05
#: Unlimited depth is MLlib's largest; boosted trees of 31 leaves are trees of depth 5.
FOREST_DEPTH, BOOST_DEPTH = 30, 5
#: Rows that one partition of a training table holds.
PARTITION_ROWS = 100_000


class _Scaled(Params):
    scales = Param(Params._dummy(), "scales", "divisor of each column", TypeConverters.toListFloat)


class PopulationScaler(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Divides columns by their population standard deviation, without
    centring; a constant column, and one without values, stays as it is."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "PopulationScalerModel":
        cols = self.getInputCols()
        row = dataset.agg(*[F.stddev_pop(F.col(f"`{c}`").cast("double")) for c in cols]).first()
        scales = [float(s) if s and s == s else 1.0 for s in row]
        return PopulationScalerModel(inputCols=cols, outputCols=self.getOutputCols(), scales=scales)


class PopulationScalerModel(Model, HasInputCols, HasOutputCols, _Scaled, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, scales=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scales = self.getOrDefault(self.scales)
        return dataset.withColumns({out: F.col(f"`{c}`").cast("double") / F.lit(s) for c, out, s in zip(
            self.getInputCols(), self.getOutputCols(), scales, strict=True)})


class _Linear(Params):
    alpha = Param(Params._dummy(), "alpha", "weight of the penalty", TypeConverters.toFloat)
    coefficients = Param(Params._dummy(), "coefficients", "weight of each column", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "value at zero", TypeConverters.toFloat)


class GramRidge(Estimator, HasInputCols, HasLabelCol, HasPredictionCol, _Linear, DefaultParamsReadable, DefaultParamsWritable):
    """Exact ridge regression on columns (see ``gram.ridge_solution``)."""

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol="label", predictionCol="prediction", alpha=RIDGE_ALPHA):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        if not self.isSet(self.alpha):
            self._set(alpha=alpha, labelCol=labelCol, predictionCol=predictionCol)

    def _fit(self, dataset: DataFrame) -> "GramRidgeModel":
        w, b = ridge_solution(dataset, self.getInputCols(), self.getLabelCol(), self.getOrDefault(self.alpha))
        return GramRidgeModel(inputCols=self.getInputCols(), predictionCol=self.getPredictionCol(), coefficients=w, intercept=b)


class GramRidgeModel(Model, HasInputCols, HasPredictionCol, _Linear, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols=None, predictionCol="prediction", coefficients=None, intercept=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        value = F.lit(self.getOrDefault(self.intercept))
        for c, w in zip(self.getInputCols(), self.getOrDefault(self.coefficients), strict=True):
            value = value + F.col(f"`{c}`").cast("double") * F.lit(w)
        return dataset.withColumn(self.getPredictionCol() if self.isDefined(self.predictionCol) else "prediction", value)


def complete_rows(fs: FeatureSet, target: str = TARGET_VALUE) -> DataFrame:
    """Rows in which neither a feature nor the target is NULL."""
    return fs.df.na.drop(how="any", subset=[*fs.features, target])


def train_val(fs: FeatureSet, target: str = TARGET_VALUE, fit_frac: float = FIT_FRAC,
              val_frac: float = VAL_FRAC) -> DataFrame:
    """The first ``fit_frac`` of all dates, complete rows only, with ``part``
    train for the first floor(n * (1 - val_frac)) dates and val for the rest."""
    first = chronological_split(fs.df, fs.ts, fit_frac, "fit", "holdout", "_side").where("_side = 'fit'").drop("_side")
    rows = complete_rows(FeatureSet(fs.version, first, fs.features), target)
    return chronological_split(materialize(rows), fs.ts, 1.0 - val_frac, "train", "val", "part")


def scaled_names(features: list[str]) -> list[str]:
    return [f"{c}__scaled" for c in features]


def candidates(features: list[str]) -> dict[str, list]:
    """Stages of each candidate on scaled columns, in order of preference."""
    scaled = scaled_names(features)
    vector = VectorAssembler(inputCols=scaled, outputCol="features")
    return {
        "ridge": [GramRidge(inputCols=scaled, labelCol=TARGET_VALUE, alpha=RIDGE_ALPHA)],
        "rf": [vector, RandomForestRegressor(labelCol=TARGET_VALUE, numTrees=FOREST_TREES, maxDepth=FOREST_DEPTH, seed=SEED)],
        "gbt": [vector, GBTRegressor(labelCol=TARGET_VALUE, maxIter=BOOST_ROUNDS, stepSize=BOOST_STEP,
                                     maxDepth=BOOST_DEPTH, seed=SEED)],
    }


def compact(df: DataFrame) -> DataFrame:
    """``df`` in as few partitions as its rows need: an iterative fit starts a
    task per partition and round."""
    return df.coalesce(max(1, -(-df.count() // PARTITION_ROWS)))


def metrics(pred: DataFrame, mu: Column, sigma: Column, target: str = TARGET_VALUE) -> DataFrame:
    """RMSE, MAE and R2 of a prediction, and accuracy and macro F1 of the label
    that ``mu`` and ``sigma`` give to both sides."""
    labelled = materialize(pred.select(F.col(target).alias("y"), F.col("prediction").alias("p"),
                                       threshold_label(F.col(target), mu, sigma).alias("label"),
                                       threshold_label(F.col("prediction"), mu, sigma).alias("guess")))
    r = S.regression_metrics(labelled, "y", "p").select("rmse", "mae", "r2", "n")
    c = S.classification_summary(S.confusion(labelled, "label", "guess"))
    return r.withColumn("accuracy", c.select("accuracy").scalar()).withColumn("macro_f1", c.select("macro_f1").scalar())


def fit_candidates(fs: FeatureSet, mu: Column, sigma: Column, target: str = TARGET_VALUE,
                   only: list[str] | None = None) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit and judge every candidate: rows (version, model, rmse, mae, r2, n,
    accuracy, macro_f1, seconds, status) on the validation dates, and the
    fitted pipelines.  Candidates are fitted side by side, as independent
    Spark jobs over one written table; one that fails is a row."""
    from concurrent.futures import ThreadPoolExecutor
    spark = fs.df.sparkSession
    both = materialize(train_val(fs, target))
    scaler = PopulationScaler(inputCols=fs.features, outputCols=scaled_names(fs.features))
    train = compact(both.where("part = 'train'")).persist()
    val = both.where("part = 'val'")

    def fit(item):
        name, stages = item
        begun = time.perf_counter()
        try:
            model = Pipeline(stages=[scaler, *stages]).fit(train)
            got = metrics(model.transform(val), mu, sigma, target).first()
            values = (float(got["rmse"]), float(got["mae"]), None if got["r2"] is None else float(got["r2"]), int(got["n"]),
                      float(got["accuracy"]), float(got["macro_f1"]))
            return (fs.version, name, *values, time.perf_counter() - begun, "ok"), model
        except Exception as error:  # noqa: BLE001 - a failing candidate is recorded, not fatal
            return (fs.version, name, *[None] * 6, time.perf_counter() - begun, f"FAILED: {error}"[:200]), None

    chosen = {n: s for n, s in candidates(fs.features).items() if only is None or n in only}
    with ThreadPoolExecutor(max_workers=len(chosen)) as pool:
        done = list(pool.map(fit, chosen.items()))
    train.unpersist()
    rows = spark.createDataFrame([row for row, _ in done], "version string, model string, rmse double, mae double, r2 double, "
                                 "n bigint, accuracy double, macro_f1 double, seconds double, status string")
    return rows, {row[1]: model for row, model in done if model is not None}


def best_model(registry: DataFrame, version: str, task: str, train) -> PipelineModel:
    """The newest trained model of (version, task) in a registry (version,
    task, path, created_at); ``train()`` makes one where there is none."""
    from .models import load_latest_model
    try:
        return load_latest_model(registry, version, task)
    except FileNotFoundError:
        return train()


__all__ = ["GramRidge", "GramRidgeModel", "PopulationScaler", "PopulationScalerModel", "best_model", "candidates", "compact",
           "complete_rows", "fit_candidates", "metrics", "scaled_names", "train_val", "LABEL_COL"]
