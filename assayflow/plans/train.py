"""From the cleaned table to one tuned model per target."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayflow import defaults as D
from assayflow.functions.numbers import nan_to_null
from assayflow.operators import models as M
from assayflow.operators.clean import drop_sparse_columns, numeric_columns
from assayflow.operators.evaluation import regression_metrics
from assayflow.operators.features import FeatureModel, mean_and_scale
from assayflow.operators.quantiles import medians
from assayflow.sources.tables import cut_lineage


def numeric_features(train: DataFrame, columns: Sequence[str]) -> FeatureModel:
    """Median imputation learned on the training rows; trees need no scaling but do not mind it."""
    center = {c: 0.0 if m is None else m for c, m in medians(train, columns).items()}
    scale = mean_and_scale(train, {c: F.coalesce(nan_to_null(F.col(c).cast("double")), F.lit(center[c])) for c in columns})
    return FeatureModel(list(columns), list(columns), center, scale)


def train(clean: DataFrame, row_id: Sequence[str], targets: Iterable[str] = ("kcat_value", "km_value"), *,
          estimator: Estimator | None = None, space: dict | None = None, draws: int = M.SEARCH_DRAWS,
          excluded: Iterable[str] = D.NOT_FEATURES, test_percent: int = 20, path: str | None = None) -> DataFrame:
    """(target, n, mae, rmse, r2, r2_orig) of one model per target, searched when a space is given.

    Models go to ``path`` when there is one. Targets that are absent or have no usable row are skipped.
    """
    targets = list(targets)
    df = M.with_ratio(drop_sparse_columns(clean), targets)
    targets = [t for t in targets if t in df.columns]
    columns = numeric_columns(df, {*excluded, *D.TARGETS, *targets, *row_id})
    scores = None
    for target in targets:
        rows = M.hash_split(df.filter(F.col(target) > 0), row_id, test_percent)
        if rows.isEmpty():
            continue
        features = numeric_features(rows.filter(~F.col("is_test")), columns)
        ready = features.transform(rows).select(*row_id, "features", "is_test", F.log10(target).alias("label"))
        ready = cut_lineage(ready)
        base = estimator or M.boosted_trees()
        if space:
            fitted = M.random_search(M.train_part(ready), row_id, base, space, draws).bestModel
        else:
            fitted = base.fit(M.train_part(ready))
        if path:
            fitted.write().overwrite().save(f"{path}/{target}")
            features.save(df.sparkSession, f"{path}/{target}_features")
        held_out = fitted.transform(M.test_part(ready)).select(F.lit(target).alias("target"), "label", "prediction")
        row = regression_metrics(held_out, "label", "prediction", ["target"])
        scores = row if scores is None else scores.unionByName(row)
    return scores
