"""Registered models do the whole published job, and tables of one task get the trees of passes."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

import catalog
from assayflow.operators import boosting as B, models as M
from catalog import modelling
from tests.test_boosting import _table

catalog.load_all()


class _Seen(Exception):
    pass


@pytest.mark.parametrize("more", [{}, {"loss": "absolute", "l1": 0.01}, {"rows": 1.0, "columns": 1.0, "depth": 4, "min_weight": 7}])
def test_one_task_grows_the_trees_of_passes(spark, monkeypatch, more):
    df = _table(spark, 500, seed=11)[0]
    s = B.Settings(**({"rounds": 3, "depth": 2, "rate": 0.4, "bins": 32} | more))
    check = F.col("id") % 5 == 0
    alone, errors = B.boost(df, "id", s), B.training_errors(df, "id", check, s, 2)
    monkeypatch.setattr(B, "ALONE", 0)
    passes = B.boost(df, "id", s)
    assert alone.trees == passes.trees and alone.base == passes.base
    assert all((a == b).all() for a, b in zip(alone.cuts, passes.cuts, strict=True))
    assert errors == B.training_errors(df, "id", check, s, 2)


def test_errors_of_rounds_are_those_of_shorter_trainings(spark):
    df = _table(spark, 300, seed=12)[0].select("id", F.transform("features", lambda v: F.coalesce(v, F.lit(0.0))).alias("features"), "label")
    model = B.boost(df, "id", B.Settings(rounds=3, depth=2, bins=16))
    for loss, measure in (("squared", lambda r: r * r), ("absolute", F.abs)):
        want = []
        for n in (1, 2, 3):
            short = replace(model, trees=model.trees[:n]).transform(df)
            want.append(short.agg(F.avg(measure(F.col("prediction") - F.col("label")))).first()[0])
        assert B.error_of_rounds(model, df, loss) == pytest.approx(want, abs=1e-12)


def _settings_of(spark, sf_dir, monkeypatch, name):
    """What the query asks of the first training that it starts."""
    seen = []

    def stop(train, row_id, settings=B.Settings(), *_):
        seen.append(settings)
        raise _Seen
    monkeypatch.setattr(B, "boost", stop)
    with pytest.raises(_Seen):
        catalog.QUERIES[name](spark, sf_dir)
    return seen[0]


@pytest.mark.parametrize("name", ["gbt_second_order"])
def test_boosted_queries_grow_the_published_trees(spark, sf_dir, monkeypatch, name):
    s = _settings_of(spark, sf_dir, monkeypatch, name)
    assert (s.rounds, s.depth, s.rate, s.rows, s.columns, s.l2) == (500, 6, 0.05, 0.8, 0.8, 1.0)


def test_boosted_regression_is_the_published_one(spark, sf_dir, monkeypatch):
    s = _settings_of(spark, sf_dir, monkeypatch, "gbt_regression")
    assert (s.rounds, s.depth, s.rate, s.rows, s.columns) == (500, 6, 0.05, 0.8, 0.8)


def _search_of(spark, sf_dir, monkeypatch, name):
    """The settings of all draws of an early stopped search, and its wait."""
    seen = []
    monkeypatch.setattr(B, "training_errors", lambda train, row_id, check, settings, patience, *_: seen.append((settings, patience)) or [1.0, 0.5, 0.6])
    monkeypatch.setattr(B, "boost", lambda *a: (_ for _ in ()).throw(_Seen()))
    with pytest.raises(_Seen):
        catalog.QUERIES[name](spark, sf_dir)
    return seen


def test_early_stop_makes_the_published_draws(spark, sf_dir, monkeypatch):
    seen = _search_of(spark, sf_dir, monkeypatch, "gbt_early_stop")
    assert len(seen) == 20 and all(s.rounds == 2000 and wait == 50 and s.loss == "squared" and 3 <= s.depth <= 12 for s, wait in seen)
    assert max(s.depth for s, _ in seen) > 6


def test_absolute_loss_search_makes_the_published_draws(spark, sf_dir, monkeypatch):
    seen = _search_of(spark, sf_dir, monkeypatch, "gbt_l1")
    assert len(seen) == 20 and all(s.rounds == 2000 and wait == 50 and s.loss == "absolute" and 4 <= s.depth <= 8 for s, wait in seen)


def test_random_search_draws_from_the_published_space(spark, sf_dir, monkeypatch):
    seen = []

    def stop(estimator, train, params=None):
        seen.append(estimator.copy(params or {}).settings())
        raise _Seen
    monkeypatch.setattr(M.GBTRegressor, "fit", stop)
    monkeypatch.setattr(M, "_param_maps", lambda e, space, draws, seed: seen.append((space, draws)) or [{e.maxIter: 700, e.maxDepth: 8}])
    with pytest.raises(_Seen):
        catalog.QUERIES["random_search"](spark, sf_dir)
    assert seen[0] == (M.GBT_SEARCH, 15) and seen[1].rounds == 700 and seen[1].depth == 8


@pytest.mark.parametrize("finished, dealt", [(10 ** 6, 10 ** 6), (40, 700)])
def test_trees_of_a_forest_grow_to_their_ends(spark, monkeypatch, finished, dealt):
    """Rows that a tree drew get their own label wherever no other row has the same bins; the score is that of a loop over trees."""
    monkeypatch.setattr(B, "FINISHED", finished)
    monkeypatch.setattr(B, "DEALT", dealt)
    df, x, y = _table(spark, 300, seed=13)
    forest, score = B.bagged_forest(df, "id", 5)
    u = np.array([r["u"] for r in df.select(F.xxhash64(F.lit(B.Settings().seed), "id").alias("u"), "id").orderBy("id").collect()])
    bins = np.stack([np.where(np.isnan(x[:, i]), B.MISSING, np.searchsorted(c, x[:, i], side="right")) for i, c in enumerate(forest.cuts)]).astype(np.uint8)
    assert len(np.unique(bins.T, axis=0)) > 290
    ends = {(r["tree"], r["node"]): B.unpacked_tree(r["packed"]) for _, table in forest.ends for r in table.collect()}
    total, n, every = np.zeros(300), np.zeros(300), np.zeros(300)
    for t, top in enumerate(forest.tops):
        weight, found = B.bootstrap_weights(u, t), np.zeros(300)
        for node, rows in top.parts(bins, np.arange(300)):
            end = ends[t, node]
            leaf = end.leaf_of(bins.T[rows])
            found[rows] = end.value[leaf]
            assert end.weight[0] == weight[rows].sum()
        drawn = weight > 0
        like = [drawn & (bins == bins[:, [i]]).all(axis=0) for i in range(300)]
        assert found[drawn] == pytest.approx([np.average(y[r], weights=weight[r]) for r, d in zip(like, drawn, strict=True) if d], abs=1e-5)
        total, n, every = total + found * ~drawn, n + ~drawn, every + found
    known = n > 0
    rest = y[known] - total[known] / n[known]
    assert score["n"] == known.sum() and score["r2"] == pytest.approx(1 - (rest ** 2).mean() / y[known].var(), abs=1e-9)
    got = {r["id"]: r["prediction"] for r in forest.transform(df).collect()}
    assert [got[i] for i in range(300)] == pytest.approx(every / 5, abs=1e-12)


def test_registered_forest_has_no_depth(spark, sf_dir, monkeypatch):
    seen = []
    monkeypatch.setattr(B, "_whole_forest", lambda train, row_id, trees, s, *_: seen.append((trees, s.depth, s.columns, s.rows)) or (_ for _ in ()).throw(_Seen()))
    with pytest.raises(_Seen):
        catalog.QUERIES["forest_out_of_bag"](spark, sf_dir)
    assert seen[0][:3] == (100, None, 1.0)


def test_low_forests_are_means_of_drawn_rows(spark, monkeypatch):
    """A stump forest by hand; MLlib, which holds a weight per row and tree, is not asked."""
    monkeypatch.setattr(M.RandomForestRegressor, "_fit", lambda *_: pytest.fail("fitted by MLlib"))
    df, x, y = _table(spark, 400, seed=14)
    model = M.random_forest(numTrees=6, maxDepth=1, featureSubsetStrategy="all").fit(df)
    u = np.array([r["u"] for r in df.select(F.xxhash64(F.lit(M.random_forest().getSeed()), "id").alias("u"), "id").orderBy("id").collect()])
    got = {r["id"]: r["prediction"] for r in model.transform(df).collect()}
    want = np.zeros(400)
    for t, tree in enumerate(model.trees.trees):
        weight, f = B.bootstrap_weights(u, t), tree.feature[0]
        left = np.where(np.isnan(x[:, f]), tree.missing_left[0], x[:, f] < model.trees.cuts[f][tree.cut[0]])
        want += np.where(left, np.average(y[left], weights=weight[left]), np.average(y[~left], weights=weight[~left])) / 6
    assert [got[i] for i in range(400)] == pytest.approx(want, abs=1e-5) and model.getNumTrees == 6


def test_draws_by_head_are_those_of_all_bits():
    u = np.random.default_rng(15).integers(-2 ** 62, 2 ** 62, 300_000)
    x = B._mixed(u, 4)
    assert (B.bootstrap_weights(u, 4) == sum((x >= least).astype(np.int64) for least in B.POISSON_BITS)).all()


def test_saved_models_predict_the_same(spark, tmp_path):
    df = _table(spark, 300, seed=16)[0]
    model = M.boosted_trees(maxIter=3, maxDepth=3, stepSize=0.5).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    model.write().overwrite().save(str(tmp_path / "m"))
    again = M.BoostedModel.load(spark, str(tmp_path / "m"))
    both = again.transform(model.transform(df).withColumnRenamed("prediction", "p"))
    assert both.where("p is distinct from prediction").count() == 0 and again.getMaxDepth() == 3 and again.getNumTrees == 3
