import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from assayflow.operators import features as G, stats
from assayflow.operators.clean import basic_clean, drop_missing_rows, missing_fraction, winsorize


def _wide(spark, n=400):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(n, 3))
    x = np.column_stack([base[:, 0], base[:, 0] + 0.2 * base[:, 1], base[:, 0] + 0.55 * base[:, 2], base[:, 1], np.full(n, 7.0),
                         1e9 + base[:, 2]])
    gaps = rng.random(x.shape) < 0.1
    return x, gaps, spark.createDataFrame([tuple(None if g else float(v) for v, g in zip(r, m)) for r, m in zip(x, gaps)],
                                          ", ".join(f"c{i} double" for i in range(6)))


@pytest.mark.parametrize("route", [stats._corr_aggregate, stats._corr_gram])
def test_pairwise_complete_correlation(spark, route):
    x, gaps, df = _wide(spark)
    found = {(r["x"], r["y"]): r for r in route(df, df.columns).collect()}
    for (a, b), r in found.items():
        i, j = int(a[1]), int(b[1])
        both = ~gaps[:, i] & ~gaps[:, j]
        assert r["n"] == both.sum()
        if 4 in (i, j):
            assert r["r"] is None
        else:
            assert r["r"] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-6)


def test_dropped_columns_still_drop_later_ones(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(size=2000)
    steps = [a, a + 0.4 * rng.normal(size=2000)]
    steps.append(steps[1] + 0.4 * rng.normal(size=2000))  # close to the second, not to the first
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*steps)], "p double, q double, r double")
    r = {(c["x"], c["y"]): c["r"] for c in stats.corr_pairs(df, df.columns).collect()}
    assert r["p", "q"] > 0.9 and r["q", "r"] > 0.9 and r["p", "r"] < 0.9
    assert G.correlation_prune(df, df.columns) == ["p"]
    assert G.correlation_prune(df, ["p"]) == ["p"] and G.correlation_prune(df, []) == []


def test_impute_and_scale(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (4.0, None), (None, 5.0)], "x double, flat double")
    filled = G.median_impute(df, ["x", "flat"])
    assert sorted(r["x"] for r in filled.collect()) == [1.0, 2.0, 2.5, 3.0, 4.0]
    scaled = G.standardize(filled, ["x", "flat"]).collect()
    assert np.std([r["x"] for r in scaled]) == pytest.approx(1.0)
    assert {r["flat"] for r in scaled} == {0.0}


def test_variance_filter_uses_population_variance(spark):
    df = spark.createDataFrame([([0, 1],)] + [([1],)] * 99 + [([],)] * 100, "bits array<int>")
    found = {r["bit"]: (r["variance"], r["kept"]) for r in G.variance_filter(df, "bits", 3).collect()}
    assert found[0] == (pytest.approx(0.005 * 0.995), False)
    assert found[1] == (pytest.approx(0.25), True)
    assert found[2] == (0.0, False)


def test_feature_model_end_to_end_and_reload(spark, tmp_path):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 2))
    bits = (rng.random((300, 8)) < [0.5, 0.4, 0.3, 0.5, 0.0, 1.0, 0.2, 0.6]).astype(int)
    rows = [(i, float(a), float(b), [int(k) for k in np.flatnonzero(w)], 1.0 + i) for i, ((a, b), w) in enumerate(zip(x, bits))]
    df = spark.createDataFrame(rows, "id int, a double, b double, fp array<int>, kcat_value double")
    model = G.fit_features(df, ["a", "b"], "fp", bits=8, components=3)
    assert model.kept_bits == [0, 1, 2, 3, 6, 7] and model.names == ["a", "b", "fp_pca_0", "fp_pca_1", "fp_pca_2"]
    out = model.transform(df).orderBy("id").select(vector_to_array("features").alias("f")).collect()
    f = np.array([r["f"] for r in out])
    np.testing.assert_allclose(f[:, :2], (x - x.mean(0)) / x.std(0), atol=1e-9)
    centred = bits[:, model.kept_bits] - bits[:, model.kept_bits].mean(0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    np.testing.assert_allclose(np.abs(f[:, 2:]), np.abs(centred @ vt[:3].T), atol=1e-8)
    ratios = [r["ratio"] for r in G.explained_variance(model.pca, df).collect()]
    np.testing.assert_allclose(ratios, (s ** 2 / (s ** 2).sum())[:3], atol=1e-9)
    model.save(spark, str(tmp_path / "m"))
    again = G.FeatureModel.load(spark, str(tmp_path / "m"))
    back = again.transform(df).orderBy("id").select(vector_to_array("features").alias("f")).collect()
    np.testing.assert_allclose(np.array([r["f"] for r in back]), f, atol=1e-12)


def test_new_rows_use_the_training_statistics(spark):
    train = spark.createDataFrame([(float(i),) for i in range(11)], "a double")
    model = G.fit_features(train, ["a"])
    new = spark.createDataFrame([(None,), (float("inf"),), (5.0,)], "a double")
    assert [list(r["f"]) for r in model.transform(new).select(vector_to_array("features").alias("f")).collect()] == [[0.0]] * 3


def test_missing_counts_nan(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (None, None), (1.0, "y"), (2.0, "z")], "a double, s string")
    assert {tuple(r) for r in missing_fraction(df).collect()} == {("a", 0.5), ("s", 0.25)}
    assert drop_missing_rows(df, ["a"]).count() == 2


def test_winsorize_keeps_missing(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1001)] + [(None,)], "x double")
    out = [r["x"] for r in winsorize(df, ["x"], 1, 99).collect()]
    assert min(v for v in out if v is not None) == 10.0 and max(v for v in out if v is not None) == 990.0
    assert out.count(None) == 1


def test_missing_share_is_measured_after_row_filter(spark):
    rows = [(1.0, 1.0, "a", None if i < 7 else "v", "[5, 6]", None) for i in range(10)]
    rows += [(None, 1.0, "a", "v", "[5]", 90.0)] * 90
    df = spark.createDataFrame(rows, "kcat_value double, km_value double, kcat string, rare string, cid string, "
                                     "max_enzyme_similarity double")
    out = basic_clean(df)
    assert out.columns == ["kcat_value", "km_value", "cid"] and out.count() == 10
    assert {r["cid"] for r in out.collect()} == {5}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(10 ** (i / 10)),) for i in range(101)], "x double")
    rows = stats.log_histogram(df, "x").orderBy("bin").collect()
    assert len(rows) == 20 and sum(r["n"] for r in rows) == 101
    assert rows[0]["lo"] == pytest.approx(0.0) and rows[-1]["hi"] == pytest.approx(10.0)
    counts, _ = np.histogram([i / 10 for i in range(101)], bins=20)
    assert abs(np.cumsum(counts) - np.cumsum([r["n"] for r in rows])).max() <= 1
    one = stats.histogram(df.limit(1), F.lit(3.0), 4).collect()
    assert sum(r["n"] for r in one) == 1


@pytest.mark.parametrize("route", ["aggregate", "gram"])
@pytest.mark.parametrize("far", [1e9, 1e14])
def test_a_far_value_costs_no_digits(spark, route, far):
    """y is missing in the far row, so the correlation is that of the other rows."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=400)
    y = 0.6 * x + 0.8 * rng.normal(size=400)
    rows = [(float(a), float(b)) for a, b in zip(x, y)] + [(far, None)]
    r = stats.corr_pairs(spark.createDataFrame(rows, "x double, y double"), ["x", "y"], route).first()
    assert r["n"] == 400 and r["r"] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-9)


@pytest.mark.parametrize("route", ["aggregate", "gram"])
def test_constant_columns_have_no_correlation(spark, route):
    df = spark.createDataFrame([(1.0, 0.1), (2.0, 0.1), (3.0, 0.1)], "x double, y double")
    assert stats.corr_pairs(df, ["x", "y"], route).first()["r"] is None


def test_nan_and_infinity_inside_the_operators(spark):
    from assayflow.operators.clean import winsorize
    from assayflow.operators.outliers import default_rules
    rows = [(float(i),) for i in range(1, 20)] + [(float("nan"),), (float("inf"),), (None,)]
    df = spark.createDataFrame(rows, "x double").coalesce(1)
    known = lambda out: [r["x"] for r in out.collect()]
    assert known(winsorize(df, ["x"]))[19] is None
    assert known(G.median_impute(df, ["x"]))[19] == known(G.median_impute(df, ["x"]))[21]
    scaled = known(G.standardize(df, ["x"]))
    assert scaled[19] is None and scaled[9] == pytest.approx(0.0)
    flagged = df.select(F.col("x").alias("pH_value")).withColumns({c: F.lit(None).cast("double") for c in ("temperature_C", "kcat_value", "km_value", "unknown_frac")})
    rules = default_rules()
    assert [r["f"] for r in flagged.select(F.coalesce(rules["pH_value"], F.lit(False)).alias("f")).collect()][19] is False
