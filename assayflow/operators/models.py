"""Regression on log10 targets: fixed models, random search, early stopping, reports. Boosted trees grow from histograms, the rest is MLlib's."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.ml.util import MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayflow import defaults
from assayflow.functions.numbers import hash_bucket, log10_positive, safe_ratio
from assayflow.operators import boosting
from assayflow.operators.evaluation import regression_metrics
from assayflow.operators.sampling import hash_folds, hash_split, tuning_subset
from assayflow.sources.tables import SMALL_READS, cut_lineage, read_text_document, scope, settings, shared_folder, write_table, write_text_document

# The published settings of the boosted trees and their searches.
GBT_FIXED = {"maxIter": 500, "stepSize": 0.05, "maxDepth": 6, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}
GBT_SEARCH = {
    "maxIter": [300, 500, 700],
    "stepSize": [0.01, 0.05, 0.1],
    "maxDepth": [4, 6, 8],
    "subsamplingRate": [0.7, 0.8, 0.9],
    "featureSubsetStrategy": ["0.6", "0.7", "0.8"],
    "minInstancesPerNode": [1],
}
GBT_BEST = {
    "maxIter": [1000],
    "stepSize": [0.04],
    "maxDepth": [20],
    "subsamplingRate": [0.6],
    "featureSubsetStrategy": ["0.8"],
    "minInstancesPerNode": [1],
}
FOREST_TREES = 100
RIDGE_ALPHA = 1.0
SEARCH_DRAWS, SEARCH_FOLDS = 15, 3


@dataclass(frozen=True)
class Log10:
    """A range that is drawn from evenly on the log scale."""

    low: float
    high: float
    whole: bool = False


@dataclass(frozen=True)
class Even:
    """A range that is drawn from evenly."""

    low: float
    high: float
    whole: bool = False


FOREST_SEARCH = {"numTrees": Even(100, 400, True), "maxDepth": Even(10, 30, True),
                 "featureSubsetStrategy": Even(0.2, 1.0), "minInstancesPerNode": Log10(1, 10, True)}
GBT_L1_SEARCH = {"stepSize": Log10(0.01, 0.2), "maxDepth": Even(4, 8, True), "subsamplingRate": Even(0.4, 1.0),
                 "featureSubsetStrategy": Even(0.4, 1.0), "minInstancesPerNode": Even(5, 100, True)}
GBT_STOP_SEARCH = {"stepSize": Log10(0.01, 0.2), "maxDepth": Even(3, 12, True), "subsamplingRate": Even(0.4, 1.0),
                   "featureSubsetStrategy": Even(0.4, 1.0), "minInstancesPerNode": Even(1, 10, True)}


# --- rows for one target -------------------------------------------------------------------------

def model_rows(df: DataFrame, target: str, features: str, row_id: Sequence[str] | str,
               test_percent: int = 20) -> DataFrame:
    """(row id, features, label, is_test): rows with a positive finite target, label = log10."""
    ids = [row_id] if isinstance(row_id, str) else list(row_id)
    rows = df.select(*ids, features, log10_positive(F.col(target)).alias("label")).filter(F.col("label").isNotNull())
    return hash_split(rows, ids, test_percent)


def assemble(df: DataFrame, columns: Sequence[str], features: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=features).transform(df)


def train_part(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.col("is_test"))


def test_part(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("is_test"))


def evaluate(model: Model, rows: DataFrame) -> DataFrame:
    """Scores on the held-out rows, on the log scale and on the original scale."""
    return regression_metrics(model.transform(test_part(rows)), "label", "prediction")


def predict(model: Model, df: DataFrame, name: str = "predicted") -> DataFrame:
    """Add the prediction on the original scale."""
    out = model.transform(df)
    return out.withColumn(name, F.pow(F.lit(10.0), F.col("prediction"))).drop("prediction")


# --- fixed models --------------------------------------------------------------------------------

def row_columns(train: DataFrame, features: str, label: str) -> list[str]:
    """The columns that tell rows apart: those beside features, label, marks and folds, or else features and label."""
    known = [features, label]
    return [c for c, kind in train.dtypes if c not in [*known, "fold"] and kind != "boolean"] or known


class BoostedTrees(GBTRegressor):
    """Second-order boosted trees under the parameters of MLlib's: ``subsamplingRate`` and ``featureSubsetStrategy`` are the shares of a tree.

    Rows are told apart by the columns beside features, label, marks and folds; without any, by features and label, so that equal rows are
    drawn together.
    """

    def settings(self) -> boosting.Settings:
        share = self.getFeatureSubsetStrategy()
        return boosting.Settings(rounds=self.getMaxIter(), rate=self.getStepSize(), depth=self.getMaxDepth(), min_weight=self.getMinInstancesPerNode(),
                                 rows=self.getSubsamplingRate(), columns=1.0 if share in ("all", "auto") else float(share), loss=self.getLossType(),
                                 measure=self.getLossType(), seed=self.getSeed())

    def _fit(self, dataset: DataFrame) -> "BoostedModel":
        trees = boosting.boost(dataset, row_columns(dataset, self.getFeaturesCol(), self.getLabelCol()), self.settings(), self.getFeaturesCol(), self.getLabelCol())
        return BoostedModel(trees, self.getMaxDepth(), self.getLabelCol())


class BoostedModel(Model):
    def __init__(self, trees: boosting.FittedTrees, depth: int, label: str):
        super().__init__()
        self.trees, self.depth, self.label = trees, depth, label

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.trees.transform(dataset)

    def write(self) -> "TreesWriter":
        return TreesWriter(self)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "BoostedModel":
        facts = read_text_document(spark, f"{path}/facts")
        trees = boosting.FittedTrees.from_table(spark.read.parquet(f"{path}/nodes"), facts.pop("cuts"), **facts["trees"])
        return BoostedModel(trees, facts["depth"], facts["label"])

    def getMaxDepth(self) -> int:
        return self.depth

    @property
    def getNumTrees(self) -> int:
        return len(self.trees.trees)

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(self.trees.importance())

    def evaluateEachIteration(self, dataset: DataFrame, loss: str) -> list[float]:
        return boosting.error_of_rounds(self.trees, dataset, loss, self.label)


class TreesWriter(MLWriter):
    """The nodes as a table, the rest as a document."""

    def __init__(self, model: BoostedModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m, spark = self.model.trees, SparkSession.active()
        write_table(m.table(spark), f"{path}/nodes")
        write_text_document(spark, {"cuts": [c.tolist() for c in m.cuts], "depth": self.model.depth, "label": self.model.label,
                                    "trees": {"base": m.base, "rate": m.rate, "features": m.features, "mean": m.mean}}, f"{path}/facts")


def boosted_trees(features: str = "features", seed: int = defaults.SEED, **params) -> GBTRegressor:
    return BoostedTrees(featuresCol=features, seed=seed, **{**GBT_FIXED, **params})


#: Levels up to which a forest grows from histograms, all trees in the passes of one.
LOW = 8


class LowForest(RandomForestRegressor):
    """Forests of few levels on all features, grown from histograms: MLlib keeps a number per row and tree, here a hash of the row tells it.

    Deeper forests, and those on some of the features per node, are MLlib's.
    """

    def _fit(self, dataset: DataFrame) -> Model:
        if self.getMaxDepth() > LOW or self.getFeatureSubsetStrategy() != "all":
            return super()._fit(dataset)
        s = boosting.Settings(depth=self.getMaxDepth(), columns=1.0, bins=self.getMaxBins(), min_weight=self.getMinInstancesPerNode(), seed=self.getSeed())
        ids = row_columns(dataset, self.getFeaturesCol(), self.getLabelCol())
        trees = boosting.forest(dataset, ids, self.getNumTrees(), s, self.getFeaturesCol(), self.getLabelCol())
        return BoostedModel(trees, self.getMaxDepth(), self.getLabelCol())


def random_forest(features: str = "features", seed: int = defaults.SEED, **params) -> RandomForestRegressor:
    return LowForest(featuresCol=features, seed=seed, **{"numTrees": FOREST_TREES, **params})


def ridge(train: DataFrame, alpha: float = RIDGE_ALPHA, features: str = "features") -> Model:
    """Least squares with penalty alpha * |w|^2 on the sum of squared errors.

    MLlib works with the mean squared error of the label divided by its deviation, so the penalty
    is divided by the number of rows and multiplied by that deviation.
    """
    n, deviation = train.agg(F.count("label"), F.stddev_pop("label")).first()
    return LinearRegression(featuresCol=features, elasticNetParam=0.0, regParam=alpha * (deviation or 0.0) / max(n, 1),
                            standardization=False, solver="normal").fit(train)


def fit(estimator: Estimator, train: DataFrame, params: dict | None = None) -> Model:
    """Fit on small partitions: MLlib keeps the rows of a partition as objects, some of them many times as large as what is read."""
    with settings(train.sparkSession, SMALL_READS):
        return estimator.fit(train, params or {})


def held_out_fold_r2(estimator: Estimator, train: DataFrame, row_id: Sequence[str] | str, folds: int = 5) -> float:
    """R2 on a fold that was kept from the fit. Stands in for the out-of-bag score of a forest."""
    rows = hash_folds(train, row_id, folds)
    model = fit(estimator, rows.filter(F.col("fold") > 0))
    return RegressionEvaluator(metricName="r2").evaluate(model.transform(rows.filter(F.col("fold") == 0)))


# --- search --------------------------------------------------------------------------------------

def draw_params(space: dict, draws: int, seed: int) -> list[dict]:
    """Seeded parameter draws; a space of single lists without repeats when it is small enough."""
    rng = random.Random(seed)
    lists = [v for v in space.values() if isinstance(v, list)]
    distinct = math.prod(len(v) for v in lists) if len(lists) == len(space) else None
    wanted = min(draws, distinct) if distinct else draws
    found: list[dict] = []
    while len(found) < wanted:
        drawn = {k: _draw(v, rng) for k, v in space.items()}
        if distinct is None or drawn not in found:
            found.append(drawn)
    return found


def _draw(choice, rng: random.Random):
    if isinstance(choice, list):
        return rng.choice(choice)
    if isinstance(choice, Log10):
        x = math.exp(rng.uniform(math.log(choice.low), math.log(choice.high)))
    else:
        x = rng.uniform(choice.low, choice.high)
    return min(round(x), int(choice.high)) if choice.whole else x


def _param_maps(estimator: Estimator, space: dict, draws: int, seed: int) -> list[dict]:
    text = lambda name, v: f"{v:.4f}" if name == "featureSubsetStrategy" and not isinstance(v, str) else v
    return [{estimator.getParam(n): text(n, v) for n, v in p.items()} for p in draw_params(space, draws, seed)]


def random_search(train: DataFrame, row_id: Sequence[str] | str, estimator: Estimator | None = None,
                  space: dict = GBT_SEARCH, draws: int = SEARCH_DRAWS, folds: int = SEARCH_FOLDS,
                  seed: int = defaults.SEED, parallelism: int = 4):
    """Cross-validated random search for the best R2, refitted on all training rows."""
    estimator = estimator or boosted_trees()
    maps = _param_maps(estimator, space, draws, seed)
    if isinstance(estimator, GBTRegressor):
        return _boosted_search(train, row_id, estimator, maps, folds, parallelism)
    search = CrossValidator(estimator=estimator, estimatorParamMaps=maps, numFolds=folds, foldCol="fold",
                            evaluator=RegressionEvaluator(metricName="r2"), parallelism=parallelism)
    return search.fit(hash_folds(train, row_id, folds))


def _boosted_search(train: DataFrame, row_id: Sequence[str] | str, estimator: GBTRegressor, maps: list[dict], folds: int, parallelism: int) -> CrossValidatorModel:
    """The search over boosted trees. The first rounds of a longer training are those of a shorter one, so draws that differ
    in their length only are one training of the greatest length, and one pass scores all its rounds.
    """
    length = lambda m: m.get(estimator.maxIter, estimator.getMaxIter())
    same = lambda m: tuple(sorted((p.name, v) for p, v in m.items() if p.name != "maxIter"))
    longest: dict[tuple, dict] = {}
    for m in maps:
        if same(m) not in longest or length(m) > length(longest[same(m)]):
            longest[same(m)] = m
    scores = [0.0] * len(maps)
    with scope():
        rows = cut_lineage(hash_folds(train, row_id, folds), small_parts=True)
        with settings(train.sparkSession, SMALL_READS):
            # Trainings go side by side where each is one task; on more rows, every one of them takes all cores.
            cores, label = train.sparkSession.sparkContext.defaultParallelism, estimator.getLabelCol()
            ids = [row_id] if isinstance(row_id, str) else list(row_id)
            alone = boosting.rows_of_one_task(boosting.known_rows(rows, ids, boosting.Settings(), estimator.getFeaturesCol(), label))
            parts = {fold: (rows.filter(F.col("fold") != fold), rows.filter(F.col("fold") == fold)) for fold in range(folds)}
            spread = {fold: check.agg(F.var_pop(label)).first()[0] for fold, (_, check) in parts.items()}

            def errors(job: tuple[int, tuple]) -> list[float]:
                fit_rows, check = parts[job[0]]
                return estimator.fit(fit_rows, longest[job[1]]).evaluateEachIteration(check, "squared")

            jobs = [(fold, key) for key in sorted(longest, key=lambda k: -length(longest[k])) for fold in range(folds)]
            with ThreadPool(max(parallelism, cores) if alone else 1) as pool:
                found = dict(zip(jobs, pool.map(inheritable_thread_target(train.sparkSession)(errors), jobs, chunksize=1), strict=True))
            for fold in range(folds):
                for i, m in enumerate(maps):
                    scores[i] += (1 - found[fold, same(m)][length(m) - 1] / spread[fold] if spread[fold] else float("nan")) / folds
    best = max(range(len(maps)), key=lambda i: scores[i])
    model = CrossValidatorModel(fit(estimator, train, maps[best]), scores)
    return model._set(estimatorParamMaps=maps)


def search_report(fitted) -> DataFrame:
    """(draw, params, r2) of every candidate of a search."""
    scores = getattr(fitted, "avgMetrics", None) or fitted.validationMetrics
    rows = [(i, str({p.name: v for p, v in m.items()}), float(s))
            for i, (m, s) in enumerate(zip(fitted.getEstimatorParamMaps(), scores))]
    return SparkSession.active().createDataFrame(rows, "draw int, params string, score double")


def tuned_forest(train: DataFrame, row_id: Sequence[str] | str, draws: int = SEARCH_DRAWS, subset: int = 30_000,
                 space: dict = FOREST_SEARCH, seed: int = defaults.SEED) -> Model:
    """Forest parameters from a search on a capped subset; the winner is refitted on all rows."""
    estimator = random_forest(seed=seed)
    maps = _param_maps(estimator, space, draws, seed)
    evaluator = RegressionEvaluator(metricName="rmse")
    with scope():
        # The subset is written: taken once, and in few partitions however many the table has.
        subset_rows = cut_lineage(tuning_subset(train, row_id, subset))
        fit_rows, check_rows = (subset_rows.filter(~F.col("is_validation")).cache(),
                                subset_rows.filter(F.col("is_validation")).cache())
        scores = [(evaluator.evaluate(estimator.fit(fit_rows, p).transform(check_rows)), i) for i, p in enumerate(maps)]
        fit_rows.unpersist()
        check_rows.unpersist()
    return fit(estimator, train, maps[min(scores)[1]])


def best_round(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """(number of rounds up to the smallest error, whether ``patience`` rounds without improvement followed it)."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def early_stopped_trees(train: DataFrame, row_id: Sequence[str] | str, space: dict = GBT_STOP_SEARCH,
                        loss: str = "squared", draws: int = 20, max_iter: int = 2000, patience: int = 50,
                        seed: int = defaults.SEED, validation_percent: int = 25) -> BoostedModel:
    """Boosted trees at the round of the smallest validation error, refitted on all rows at that length.

    Every draw is trained once, until ``patience`` rounds have brought no improvement or ``max_iter`` is reached. ``loss='absolute'``
    gives the L1 objective. Draws go side by side where each is one task.
    """
    spark = train.sparkSession
    shared_folder(spark)
    ids = [row_id] if isinstance(row_id, str) else list(row_id)
    base = boosted_trees(seed=seed, lossType=loss, maxIter=max_iter)
    maps = _param_maps(base, space, draws, seed)
    check = hash_bucket(100, F.lit("tune"), *[F.col(c) for c in ids]) < validation_percent
    with settings(spark, SMALL_READS):
        alone = boosting.rows_of_one_task(boosting.known_rows(train, ids, boosting.Settings(), base.getFeaturesCol(), base.getLabelCol()))

        def errors(params: dict) -> list[float]:
            return boosting.training_errors(train, ids, check, base.copy(params).settings(), patience, base.getFeaturesCol(), base.getLabelCol())

        with ThreadPool(spark.sparkContext.defaultParallelism if alone else 1) as pool:
            found = pool.map(inheritable_thread_target(spark)(errors), maps, chunksize=1)
    best = None
    for params, measured in zip(maps, found, strict=True):
        measured = measured[1:]
        rounds = best_round(measured, patience)[0]
        if best is None or measured[rounds - 1] < best[0]:
            best = (measured[rounds - 1], params, rounds)
    return fit(base, train.select(*dict.fromkeys([*ids, base.getFeaturesCol(), base.getLabelCol()])), {**best[1], base.maxIter: best[2]})


def feature_importance(model: Model, names: Sequence[str]) -> DataFrame:
    """(feature, importance) with the most important first."""
    weights = model.featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(names, weights)]
    spark = SparkSession.active()
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def with_ratio(df: DataFrame, targets: Sequence[str], parts: Sequence[str] = ("kcat_value", "km_value"), name: str = "kcat_km") -> DataFrame:
    """Derive the ratio target when it is wanted, is no column and its parts are."""
    wanted = name in targets and name not in df.columns and set(parts) <= set(df.columns)
    return df.withColumn(name, safe_ratio(F.col(parts[0]), F.col(parts[1]))) if wanted else df


def compare_models(df: DataFrame, targets: Sequence[str], features: str, row_id: Sequence[str] | str,
                   fits: dict[str, Callable[[DataFrame], Model]], test_percent: int = 20) -> DataFrame:
    """(target, model, label, prediction) on the held-out rows for every target and model.

    The ratio target is derived when absent. Targets without usable rows are skipped; without any, the table is empty.
    """
    df = with_ratio(df, targets)
    stacked = df.sparkSession.createDataFrame([], "target string, model string, label double, prediction double")
    for target in targets:
        if target not in df.columns:
            continue
        rows = cut_lineage(model_rows(df, target, features, row_id, test_percent))
        if not rows.isEmpty():
            for name, fit in fits.items():
                stacked = stacked.unionByName(fit(train_part(rows)).transform(test_part(rows)).select(
                    F.lit(target).alias("target"), F.lit(name).alias("model"), "label", "prediction"))
    return stacked
