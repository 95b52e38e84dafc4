import hashlib

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from assayflow.operators import evaluation as E, models as M, sampling as K


def _labelled(spark, partitions):
    rows = [(i, "regular" if i % 10 else ("iso" if i % 20 else "domain")) for i in range(5000)]
    return spark.createDataFrame(rows, "id bigint, label string").repartition(partitions)


def _smallest(ids, n):
    return set(sorted(ids, key=lambda i: hashlib.md5(str(i).encode()).hexdigest())[:n])


@pytest.mark.parametrize("limit", [50, 1_000_000])
@pytest.mark.parametrize("partitions", [1, 8])
def test_capped_sample(spark, limit, partitions):
    df = _labelled(spark, partitions)
    found = {r["id"] for r in K.capped_sample(df, "id", 700, limit).collect()}
    assert found == _smallest(range(5000), 700)
    assert K.capped_sample(df, "id", 5000).count() == 5000


@pytest.mark.parametrize("limit", [50, 1_000_000])
def test_stratified_sample(spark, limit):
    out = K.stratified_sample(_labelled(spark, 4), "id", "label", 1000, {"regular": 400}, 120, limit)
    ids = {}
    for r in out.collect():
        ids.setdefault(r["label"], set()).add(r["id"])
    # regular: 4500 rows, a fifth of them; the others have 250 rows each, floor 120
    assert ids["regular"] == _smallest([i for i in range(5000) if i % 10], 900)
    assert ids["domain"] == _smallest(range(0, 5000, 20), 120)
    assert ids["iso"] == _smallest(range(10, 5000, 20), 120)


def test_split_and_folds_are_fair_and_independent(spark):
    df = K.hash_folds(K.hash_split(spark.range(20000), "id", 20), "id", 3)
    counts = {(r["is_test"], r["fold"]): r["count"] for r in df.groupBy("is_test", "fold").count().collect()}
    for fold in range(3):
        assert abs(counts[True, fold] / 20000 - 0.2 / 3) < 0.01
        assert abs(counts[False, fold] / 20000 - 0.8 / 3) < 0.01


def _linear(spark, n=600):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(n, 3))
    y = x @ [0.5, -0.25, 0.0] + 1.0 + 0.1 * rng.normal(size=n)
    rows = [(i, *map(float, r), float(10 ** t)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, kcat_value double")
    return x, y, VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)


@pytest.mark.parametrize("alpha", [1.0, 200.0])
def test_ridge_against_normal_equations(spark, alpha):
    x, y, df = _linear(spark)
    model = M.ridge(df.select("features", F.log10("kcat_value").alias("label")), alpha)
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
    np.testing.assert_allclose(model.coefficients.toArray(), w, atol=1e-6)
    assert model.intercept == pytest.approx(y.mean() - x.mean(0) @ w, abs=1e-6)


def test_metrics(spark):
    y, p = np.array([1.0, 2.0, 3.0, 4.0]), np.array([1.1, 1.9, 3.3, 3.7])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)] + [(None, 1.0)], "label double, prediction double")
    r = E.regression_metrics(df, "label", "prediction").first()
    r2 = lambda a, b: 1 - ((a - b) ** 2).sum() / ((a - a.mean()) ** 2).sum()
    assert r["n"] == 4 and r["mae"] == pytest.approx(np.abs(y - p).mean())
    assert r["rmse"] == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    assert r["r2"] == pytest.approx(r2(y, p)) and r["r2_orig"] == pytest.approx(r2(10 ** y, 10 ** p))
    flat = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "label double, prediction double")
    assert E.regression_metrics(flat, "label", "prediction").first()["r2"] is None


def test_target_rows_skip_absent_targets(spark):
    df = spark.createDataFrame([(1, 100.0, 10.0), (2, 0.0, 1.0), (3, None, 1.0), (4, 5.0, 0.0)],
                               "id int, kcat_value double, km_value double")
    rows = E.target_rows(df, ["id"], ["kcat_value", "kcat_km", "nothing"], {"kcat_km": ("kcat_value", "km_value")})
    assert {(r["id"], r["target"], round(r["label"], 6)) for r in rows.collect()} == {
        (1, "kcat_value", 2.0), (4, "kcat_value", 0.69897), (1, "kcat_km", 1.0)}


def test_drawn_parameters(spark):
    assert M.draw_params(M.GBT_SEARCH, 15, 42) == M.draw_params(M.GBT_SEARCH, 15, 42)
    assert len(M.draw_params(M.GBT_BEST, 15, 42)) == 1
    for p in M.draw_params(M.FOREST_SEARCH, 30, 1):
        assert 100 <= p["numTrees"] <= 400 and 1 <= p["minInstancesPerNode"] <= 10 and isinstance(p["maxDepth"], int)


def test_search_and_importance(spark):
    _, _, df = _linear(spark)
    rows = M.model_rows(df, "kcat_value", "features", "id").cache()
    space = {"maxDepth": [1, 4], "maxIter": [3]}
    fitted = M.random_search(M.train_part(rows), "id", M.boosted_trees(maxIter=3, stepSize=0.5), space, draws=2, folds=2)
    scores = {eval(r["params"])["maxDepth"]: r["score"] for r in M.search_report(fitted).collect()}
    assert scores[4] > scores[1] and fitted.bestModel.getMaxDepth() == 4
    top = M.feature_importance(fitted.bestModel, ["a", "b", "c"]).collect()
    assert [r["feature"] for r in top] == ["a", "b", "c"]
    assert M.evaluate(fitted.bestModel, rows).first()["r2"] > 0.5


def test_early_stopping_refits_with_fewer_trees(spark):
    _, _, df = _linear(spark)
    rows = M.model_rows(df, "kcat_value", "features", "id").cache()
    space = {"maxDepth": [2], "stepSize": [0.9]}
    model = M.early_stopped_trees(M.train_part(rows), "id", space, draws=1, max_iter=15, patience=3)
    assert 1 <= model.getNumTrees < 15


def test_prediction_returns_to_the_original_scale(spark):
    _, _, df = _linear(spark)
    rows = M.model_rows(df, "kcat_value", "features", "id")
    out = M.predict(M.ridge(M.train_part(rows)), rows).select(F.corr(F.log10("predicted"), "label")).first()[0]
    assert out > 0.9


def test_best_model_and_comparison(spark):
    _, _, df = _linear(spark)
    fits = {"Ridge": M.ridge, "Stump": lambda t: M.random_forest(numTrees=1, maxDepth=1).fit(t)}
    table = E.results_table(M.compare_models(df, ["kcat_value", "km_value"], "features", "id", fits))
    assert table.count() == 8
    assert [(r["target"], r["model"]) for r in E.best_model(table).collect()] == [("kcat_value", "Ridge")]


def test_the_best_round_waits(spark):
    assert M.best_round([5, 4, 3, 4, 5, 6], 3) == (3, True)
    assert M.best_round([5, 4, 3, 4, 5], 3) == (3, False)
    assert M.best_round([5, 4, 4.5, 4.2, 3.9, 5], 3) == (5, False)
    assert M.best_round([3, 3, 3, 3], 2) == (1, True)


@pytest.mark.parametrize("step", [0.05, 0.3])
def test_early_stopping_takes_the_round_of_the_least_error(spark, step):
    _, _, df = _linear(spark)
    rows = M.train_part(M.model_rows(df, "kcat_value", "features", "id"))
    model = M.early_stopped_trees(rows, "id", {"maxDepth": [2], "stepSize": [step]}, draws=1, max_iter=24, patience=4)
    marked = rows.withColumn("check", M.hash_bucket(100, F.lit("tune"), F.col("id")) < 25)
    longest = M.boosted_trees(maxIter=24, maxDepth=2, stepSize=step, lossType="squared").fit(marked.filter("not check"))
    errors = longest.evaluateEachIteration(marked.filter("check"), "squared")
    assert model.getNumTrees == M.best_round(errors, 4)[0]


def test_rows_without_label_are_sampled_too(spark):
    df = spark.range(1000).withColumn("g", F.when(F.col("id") % 4 > 0, F.concat(F.lit("g"), F.col("id") % 4)))
    sample = K.stratified_sample(df, "id", "g", 400, {}, 10)
    assert {r["g"]: r["count"] for r in sample.groupBy("g").count().collect()} == {None: 100, "g1": 100, "g2": 100, "g3": 100}
    whole = K.stratified_sample(df.filter("id < 20 or g is not null"), "id", "g", 400, {}, 50)
    assert whole.filter("g is null").count() == 5


def test_ratio_target_and_no_target(spark):
    _, _, df = _linear(spark)
    df = df.withColumn("km_value", F.lit(2.0))
    fits = {"Ridge": M.ridge}
    found = M.compare_models(df, ["kcat_value", "kcat_km"], "features", "id", fits)
    assert {r["target"] for r in found.select("target").distinct().collect()} == {"kcat_value", "kcat_km"}
    assert M.compare_models(df, ["absent"], "features", "id", fits).count() == 0


def test_draws_that_differ_in_length_are_one_training(spark, monkeypatch):
    """The scores are those of the cross-validator of MLlib; 2 trainings a fold and the last one, where there were 4 a fold."""
    _, _, df = _linear(spark)
    train = M.train_part(M.model_rows(df, "kcat_value", "features", "id")).coalesce(1).cache()
    base = M.boosted_trees(stepSize=0.5, subsamplingRate=1.0, featureSubsetStrategy="all")
    space, fits = {"maxIter": [2, 5], "maxDepth": [1, 3]}, []
    whole = M.CrossValidator(estimator=base, estimatorParamMaps=M._param_maps(base, space, 4, 1), numFolds=2, foldCol="fold",
                             evaluator=M.RegressionEvaluator(metricName="r2")).fit(K.hash_folds(train, "id", 2))
    fit = M.GBTRegressor.fit
    monkeypatch.setattr(M.GBTRegressor, "fit", lambda self, *a: fits.append(1) or fit(self, *a))
    found = M.random_search(train, "id", base, space, draws=4, folds=2, seed=1)
    assert len(fits) == 5 and found.avgMetrics == pytest.approx(whole.avgMetrics, abs=1e-9)
    assert found.bestModel.getNumTrees == whole.bestModel.getNumTrees and M.search_report(found).count() == 4


def test_models_are_fitted_on_small_partitions(spark, monkeypatch):
    """A table of one file is read by several tasks."""
    from assayflow.sources import tables
    monkeypatch.setattr(tables, "PART_BYTES", 1 << 16)
    df = spark.range(60_000, numPartitions=1).select("id", F.xxhash64("id").alias("x"), F.rand(1).alias("label"))
    rows = tables.cut_lineage(df, small_parts=True)
    with tables.settings(spark, {"spark.sql.files.maxPartitionBytes": str(1 << 16), "spark.sql.files.openCostInBytes": "4096"}):
        assert len([n for n in rows.rdd.glom().map(len).collect() if n]) > 4
