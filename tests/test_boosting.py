"""Boosted trees and forests against trees grown by hand, row by row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayflow.operators import boosting as B


def _table(spark, n, seed=0, gaps=True, parts=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 2)
    y = np.where(x[:, 0] > 0.3, 2.0, 0.0) + x[:, 1] * (x[:, 2] > 0) + 0.1 * rng.normal(size=n)
    if gaps:
        x[rng.random(n) < 0.2, 0] = np.nan  # rows with a gap are high or low, so the side of missing values matters
    rows = [(i, [None if np.isnan(v) else float(v) for v in x[i]], float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, features array<double>, label double").repartition(parts), x, y


def _hand_cuts(x, bins):
    known = x[~np.isnan(x)]
    return np.unique(np.percentile(known, [100 * k / bins for k in range(1, bins)])) if len(known) else np.zeros(0)


def _hand_split(x, g, rows, cuts, s):
    """The best of all cuts and both sides for missing values, each gain from the sums of its rows."""
    score = lambda r: g[r].sum() ** 2 / (len(r) + s.l2)
    best = (1e-12, None)
    for f in range(x.shape[1]):
        v = x[rows, f]
        for missing_left in (False, True) if np.isnan(v).any() else (False,):
            for k, cut in enumerate(cuts[f]):
                left = (v < cut) | (np.isnan(v) & missing_left)
                a, b = rows[left], rows[~left]
                if len(a) >= s.min_weight and len(b) >= s.min_weight:
                    gain = 0.5 * (score(a) + score(b) - score(rows))
                    if gain > best[0] + 1e-9:
                        best = gain, (f, k, missing_left, a, b)
    return best


def _hand_levels(x, y, base, cuts, s):
    """Predictions of one tree grown level by level."""
    g = np.rint((base - y) * B.UNIT) / B.UNIT
    leaves, done = [np.arange(len(y))], []
    for _ in range(s.depth):
        following = []
        for rows in leaves:
            _, found = _hand_split(x, g, rows, cuts, s)
            (done if found is None else following).extend([rows] if found is None else [found[3], found[4]])
        leaves = following
    value = np.empty(len(y))
    for rows in done + leaves:
        value[rows] = -g[rows].sum() / (len(rows) + s.l2)
    return value


def test_first_tree_is_the_one_grown_by_hand(spark):
    df, x, y = _table(spark, 600)
    s = B.Settings(rounds=1, depth=3, rows=1.0, columns=1.0, bins=16, rate=0.5, l2=1.0)
    model = B.boost(df, "id", s)
    cuts = [_hand_cuts(x[:, i], 16) for i in range(4)]
    for got, want in zip(model.cuts, cuts, strict=True):
        assert np.allclose(got, want)
    want = model.base + 0.5 * _hand_levels(x, y, model.base, cuts, s)
    got = {r["id"]: r["prediction"] for r in model.transform(df).collect()}
    assert np.allclose([got[i] for i in range(len(y))], want)
    assert any(any(t.missing_left) for t in model.trees)  # some gap goes left


def test_later_trees_follow_the_gradients(spark, monkeypatch):
    """Also across the writes of the rows between trees."""
    monkeypatch.setattr(B, "REWRITE", 2)
    df, x, y = _table(spark, 300, seed=1)
    s = B.Settings(rounds=5, depth=2, rows=1.0, columns=1.0, bins=8, rate=0.3, l2=0.5, min_weight=5)
    model, margin = B.boost(df, "id", s), None
    margin = np.full(len(y), model.base)
    cuts = [_hand_cuts(x[:, i], 8) for i in range(4)]
    for _ in range(5):
        margin = margin + 0.3 * _hand_levels(x, y - margin, 0.0, cuts, s)
    got = {r["id"]: r["prediction"] for r in model.transform(df).collect()}
    assert np.allclose([got[i] for i in range(len(y))], margin, atol=1e-5)


def test_leaves_are_split_in_order_of_gain_and_hold_medians(spark):
    """5,000 rows, absolute loss: the same leaf order and the same values as numpy."""
    df, x, y = _table(spark, 5000, seed=2, gaps=False)
    s = B.Settings(rounds=1, leaves=6, rows=1.0, columns=1.0, bins=16, rate=1.0, l2=0.1, loss="absolute", min_weight=20)
    model = B.boost(df, "id", s)
    base = round(float(np.median(y)), 6)
    assert model.base == base
    g, cuts = np.sign(base - y), [_hand_cuts(x[:, i], 16) for i in range(4)]
    leaves, order = {0: np.arange(len(y))}, []
    found = {0: _hand_split(x, g, leaves[0], cuts, s)}
    while len(leaves) < 6:
        node = max(found, key=lambda k: found[k][0])
        order.append(node)
        _, (_, _, _, a, b) = found.pop(node)
        del leaves[node]
        for k, rows in ((2 * len(order) - 1, a), (2 * len(order), b)):
            leaves[k], found[k] = rows, _hand_split(x, g, rows, cuts, s)
    tree = model.trees[0]
    split = [n for n, f in enumerate(tree.feature) if f >= 0]
    assert sorted(split, key=lambda n: tree.left[n]) == order
    for node, rows in leaves.items():
        assert tree.feature[node] == -1 and tree.value[node] == pytest.approx(np.median(y[rows] - base), abs=1e-9)


def test_partitions_do_not_matter(spark):
    s = B.Settings(rounds=3, depth=3, rows=0.7, columns=0.6, bins=32)
    first = B.boost(_table(spark, 400, parts=1)[0], "id", s)
    second = B.boost(_table(spark, 400, parts=7)[0].orderBy(F.desc("id")), "id", s)
    assert first.trees == second.trees and first.base == second.base


def test_few_sums_at_a_time_give_the_same_trees(spark, monkeypatch):
    df = _table(spark, 400)[0]
    s = B.Settings(rounds=2, depth=3, bins=16)
    whole = B.boost(df, "id", s).trees
    monkeypatch.setattr(B, "CELLS", 150)
    assert B.boost(df, "id", s).trees == whole


def test_early_stop_grows_each_tree_once(spark):
    df, x, y = _table(spark, 500, seed=3)
    s = B.Settings(rounds=200, depth=3, rate=0.6, bins=16, l2=0.0)
    check = F.col("id") % 4 == 0
    model, errors = B.boost_until(df, "id", check, s, patience=4)
    assert len(model.trees) == int(np.argmin(errors)) and len(errors) - 1 - len(model.trees) in (0, 4) and len(errors) < 200
    got = {r["id"]: r["prediction"] for r in model.transform(df).collect()}
    held = np.arange(len(y)) % 4 == 0
    rest = np.array([got[i] for i in range(len(y))])[held] - y[held]
    assert (rest ** 2).mean() == pytest.approx(min(errors), abs=1e-5)


def test_training_goes_on_where_it_stopped(spark):
    df = _table(spark, 300)[0]
    s = B.Settings(rounds=4, depth=2, bins=16)
    with B.Training(df, "id", s) as run:
        run.grow(1).grow(3)
        assert run.model().trees == B.boost(df, "id", s).trees


def test_out_of_bag_score_is_that_of_a_loop_over_trees(spark):
    df, x, y = _table(spark, 400, seed=4)
    forest, score = B.bagged_forest(df, "id", 7, B.Settings(depth=4, columns=1.0, bins=32))
    u = np.array([r["u"] for r in df.select(F.xxhash64(F.lit(B.Settings().seed), "id").alias("u"), "id").orderBy("id").collect()])
    bins = np.stack([np.where(np.isnan(x[:, i]), B.MISSING, np.searchsorted(c, x[:, i], side="right")) for i, c in enumerate(forest.cuts)], axis=1)
    total, n = np.zeros(len(y)), np.zeros(len(y))
    for t, tree in enumerate(forest.trees):
        weight = B.bootstrap_weights(u, t)
        leaf = tree.leaf_of(bins)
        for k in np.unique(leaf):  # a leaf is the mean of the rows as often as they were drawn
            rows = leaf == k
            assert weight[rows].sum() == 0 or tree.value[k] == pytest.approx(np.average(y[rows], weights=weight[rows]), abs=1e-5)
        for i in range(len(y)):
            if weight[i] == 0:
                total[i] += tree.value[leaf[i]]
                n[i] += 1
    known = n > 0
    rest = y[known] - total[known] / n[known]
    assert score["n"] == known.sum() and score["r2"] == pytest.approx(1 - (rest ** 2).mean() / y[known].var(), abs=1e-9)
    mean = {r["id"]: r["prediction"] for r in forest.transform(df).collect()}
    assert mean[0] == pytest.approx(np.mean([t.value[t.leaf_of(bins[:1])[0]] for t in forest.trees]))


def test_bootstrap_draws_rows_as_often_as_chance_does():
    u = np.random.default_rng(0).integers(-2 ** 62, 2 ** 62, 50_000)
    drawn = B.bootstrap_weights(u, 3)
    assert abs(drawn.mean() - 1) < 0.02 and abs((drawn == 0).mean() - np.exp(-1)) < 0.01 and abs(drawn.var() - 1) < 0.05
    assert abs(np.corrcoef(drawn, B.bootstrap_weights(u, 4))[0, 1]) < 0.02


def test_odd_tables(spark):
    rows = [(1, [None, 1.0], 1.0), (1, [None, 1.0], 1.0), (None, [None, float("nan")], 2.0), (3, [None, 2.0], None), (4, [None, float("inf")], float("nan"))]
    df = spark.createDataFrame(rows, "id long, features array<double>, label double")
    model = B.boost(df, "id", B.Settings(rounds=2, depth=2, rows=1.0, bins=4))
    assert all(r["prediction"] is not None for r in model.transform(df).collect()) and model.importance().sum() in (0.0, pytest.approx(1.0))
    empty = B.boost(df.limit(0), "id", B.Settings(rounds=2, depth=2))
    assert empty.base == 0.0 and empty.table(spark).count() == 2
    with pytest.raises(ValueError):
        B.boost(df, "id", B.Settings(bins=300))


def test_rows_lie_in_blocks_and_only_open_nodes_get_rows(spark):
    """A record per Arrow batch, not per row, so that passes do not cost by the record."""
    df, x, y = _table(spark, 3000, seed=5, parts=2)
    with B.Training(df, "id", B.Settings(rounds=1, depth=3, bins=16)) as run:
        assert run.rows.count() <= 4
        tree = run.grow(1).trees[0]
        bins = np.stack([np.where(np.isnan(x[:, i]), B.MISSING, np.searchsorted(c, x[:, i], side="right")) for i, c in enumerate(run.cuts)]).astype(np.uint8)
    whole = tree.leaf_of(bins.T)
    wanted = [n for n, f in enumerate(tree.feature) if f < 0][:2]
    some = dict(tree.parts(bins, np.arange(len(y)), tree.leading(wanted)))
    assert sorted(some) == wanted and all((np.sort(some[n]) == np.flatnonzero(whole == n)).all() for n in wanted)


def test_medians_are_exact_also_by_digits(spark, monkeypatch):
    """Many equal numbers, both zeros, huge and tiny ones; few numbers may be gathered, so that all digits are looked at."""
    monkeypatch.setattr(B, "GATHERED", 3)
    rng = np.random.default_rng(6)
    y = np.concatenate([np.full(300, 0.25), np.zeros(200), [-0.0] * 20, rng.normal(size=401), 10.0 ** rng.integers(-300, 300, 50), -(10.0 ** rng.integers(-300, 300, 50))])
    side = rng.integers(0, 2, len(y))
    df = spark.createDataFrame([(i, [float(s)], float(v)) for i, (s, v) in enumerate(zip(side, y, strict=True))], "id long, features array<double>, label double")
    with B.Training(df, "id", B.Settings(rounds=1, leaves=2, rows=1.0, columns=1.0, bins=4, loss="absolute", min_weight=1, l2=1.0)) as run:
        tree = B.Tree()
        tree.split(0, B.Split(1.0, 0, 0, False, 0.0, 1.0, 0.0, 2.0), (0.0, 0.0))
        run._take_medians(tree)
        for node, rest in ((1, y[side < run.cuts[0][0]] - run.base), (2, y[side >= run.cuts[0][0]] - run.base)):
            assert tree.value[node] == (np.median(rest) if len(rest) else 0.0)
    assert (B.ordered_numbers(B.ordered_bits(y)) == y).all() and (np.argsort(B.ordered_bits(np.unique(y))) == np.arange(len(np.unique(y)))).all()


def test_cuts_do_not_depend_on_the_way_they_are_found(spark, monkeypatch):
    df = _table(spark, 700, seed=7)[0].select(F.transform("features", lambda v: F.coalesce(v, F.lit(float("nan")))).alias("features"))
    known = df.select(F.transform("features", lambda v: F.when(~F.isnan(v), v)).alias("v"))
    counted = B.quantile_cuts(known, "v", 4, 32)
    monkeypatch.setattr(B, "DISTINCT", 5)
    assert B._counted_quantiles(known, "v", 4, [0.5]) == {}
    assert all(np.allclose(a, b, rtol=1e-14) for a, b in zip(counted, B.quantile_cuts(known, "v", 4, 32), strict=True))


def test_several_leaves_are_looked_at_in_a_pass(spark, monkeypatch):
    """Seven leaves once took six passes."""
    passes, search = [], B._search
    monkeypatch.setattr(B, "_search", lambda rows, job, sizes: passes.append(1) or search(rows, job, sizes))
    df = _table(spark, 2000, seed=8, gaps=False)[0]
    model = B.boost(df, "id", B.Settings(rounds=1, leaves=7, rows=1.0, columns=1.0, bins=16))
    assert sum(f < 0 for f in model.trees[0].feature) == 7 and len(passes) <= 4
