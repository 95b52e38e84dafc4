"""Scores of regression predictions on the log10 scale and tables made of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayflow.functions.numbers import log10_positive, safe_ratio
from assayflow.operators.quantiles import quantile_values

# Fixed value: keeps log10 defined for a zero.
TINY = 1e-30
METRICS = ("mae", "rmse", "r2", "r2_orig")


def _r2(y: Column, p: Column) -> Column:
    return F.lit(1.0) - F.try_divide(F.avg((y - p) * (y - p)), F.var_pop(y))


def regression_metrics(df: DataFrame, y: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and R2 of log10 values, and R2 of the values themselves, in one aggregate."""
    a, p = F.col(y), F.col(prediction)
    ten = F.lit(10.0)
    known = df.filter(a.isNotNull() & p.isNotNull())
    return known.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(a - p)).alias("mae"), F.sqrt(F.avg((a - p) * (a - p))).alias("rmse"),
        _r2(a, p).alias("r2"), _r2(F.pow(ten, a), F.pow(ten, p)).alias("r2_orig"))


def results_table(predictions: DataFrame, y: str = "label", prediction: str = "prediction") -> DataFrame:
    """(target, model, metric, value) from stacked predictions."""
    scores = regression_metrics(predictions, y, prediction, ["target", "model"])
    return scores.select("target", "model", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS])))


def best_model(results: DataFrame, metric: str = "r2") -> DataFrame:
    """(target, model, value): the highest score per target; the later name wins a tie."""
    best = F.max(F.struct("value", "model"))
    return (results.filter(F.col("metric") == metric).groupBy("target").agg(best.alias("best"))
            .select("target", "best.model", "best.value"))


def parity_data(df: DataFrame, y: str, prediction: str, low: float = 1, high: float = 99, stretch: float = 1.1,
                limit: int | None = None) -> DataFrame:
    """Actual and predicted log10 values with the axis limits: percentiles of both, stretched."""
    logs = df.withColumns({"actual_log": F.log10(F.col(y) + TINY), "predicted_log": F.log10(F.col(prediction) + TINY)})
    both = logs.select(F.explode(F.array("actual_log", "predicted_log")).alias("x"))
    lo, hi = quantile_values(both, ["x"], [low / 100, high / 100], limit)["x"] or (None, None)
    bound = lambda q, fallback: F.lit(fallback if q is None else q * stretch)
    return logs.withColumns({"limit_lo": bound(lo, -10.0), "limit_hi": bound(hi, 10.0)})


def target_rows(df: DataFrame, row_id: Sequence[str], targets: Sequence[str],
                ratios: dict[str, tuple[str, str]] = {}) -> DataFrame:
    """(row id, target, label): log10 of every usable target value in one pass.

    A target that is absent is taken from its ratio when both parts are there, else skipped.
    """
    pairs = []
    for t in targets:
        if t in df.columns:
            value = F.col(t)
        elif t in ratios and set(ratios[t]) <= set(df.columns):
            value = safe_ratio(F.col(ratios[t][0]), F.col(ratios[t][1]))
        else:
            continue
        pairs.append(F.struct(F.lit(t).alias("target"), log10_positive(value).alias("label")))
    return df.select(*row_id, F.inline(F.array(*pairs))).filter(F.col("label").isNotNull())
