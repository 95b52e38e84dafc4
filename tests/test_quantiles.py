import numpy as np
import pytest
from pyspark.sql import functions as F

from assayflow.operators.quantiles import exact_quantiles, medians, quantile_values

PROBS = [0.001, 0.25, 0.5, 0.75, 0.999]


def _rows(seed=0):
    rng = np.random.default_rng(seed)
    groups = {"hot": 4000, "mid": 300, "small": 7, None: 500}
    rows = []
    for g, n in groups.items():
        x = np.where(rng.random(n) < 0.3, 5.0, rng.lognormal(0, 3, n))  # many ties, long tail
        y = rng.normal(0, 1e-9, n)
        rows += [(g, float(a), float(b) if i % 3 else None) for i, (a, b) in enumerate(zip(x, y))]
    return rows


@pytest.mark.parametrize("limit", [10, 400, 1_000_000])
def test_same_as_numpy_at_any_task_limit(spark, limit):
    rows = _rows()
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(7)
    found = {r["g"]: r for r in exact_quantiles(df, ["x", "y"], PROBS, ["g"], limit).collect()}
    assert set(found) == {"hot", "mid", "small", None}
    for g, r in found.items():
        for i, v in ((1, "x"), (2, "y")):
            values = [row[i] for row in rows if row[0] == g and row[i] is not None]
            assert r[f"n_{v}"] == len(values)
            np.testing.assert_allclose(r[f"q_{v}"], np.percentile(values, np.array(PROBS) * 100), rtol=1e-12)
        assert r["n_rows"] == sum(row[0] == g for row in rows)


@pytest.mark.parametrize("limit", [5, 1_000_000])
def test_whole_table(spark, limit):
    values = [float(v) for v in np.random.default_rng(1).standard_t(1, 2001)]
    df = spark.createDataFrame([(v, None) for v in values], "x double, empty double")
    found = quantile_values(df, ["x", "empty"], PROBS, limit)
    np.testing.assert_allclose(found["x"], np.percentile(values, np.array(PROBS) * 100), rtol=1e-12)
    assert found["empty"] is None


@pytest.mark.parametrize("limit", [2, 1_000_000])
def test_one_value_repeated(spark, limit):
    df = spark.range(1000).select(F.lit(3.5).alias("x"))
    assert medians(df, ["x"], limit) == {"x": 3.5}


def test_empty_table(spark):
    assert medians(spark.range(0).select(F.lit(1.0).alias("x")), ["x"]) == {"x": None}


@pytest.mark.parametrize("limit", [5, 1_000_000])
def test_extreme_values(spark, limit):
    rng = np.random.default_rng(6)
    scales = [1.7e308, 1.0, 5e-324, 1e-300, 1e12]
    values = [float(s * u) for s in scales for u in rng.uniform(-1, 1, 400)] + [0.0]
    values[:100], values[100:150] = [float("inf")] * 100, [float("-inf")] * 50
    df = spark.createDataFrame([(v,) for v in values + [float("nan")] * 40], "x double").repartition(4)
    found = quantile_values(df, ["x"], [0.05, 0.25, 0.5, 0.75, 0.9], limit)["x"]
    assert found == [sorted(values)[i] for i in (100, 500, 1000, 1500, 1800)]
