"""Feature reduction: correlation pruning, imputation, scaling, variance filter and projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import PCA, PCAModel, StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayflow import defaults as D
from assayflow.functions.notation import bits_to_array
from assayflow.functions.numbers import finite, nan_to_null
from assayflow.operators.clean import split_feature_blocks
from assayflow.operators.quantiles import medians
from assayflow.operators.stats import bit_variance, corr_pairs
from assayflow.sources.tables import read_text_document, write_text_document


def pruned_columns(df: DataFrame, columns: Sequence[str], threshold: float = D.CORRELATION_THRESHOLD) -> DataFrame:
    """(column, kept): a column goes when any earlier one correlates above the threshold with it.

    The earlier column counts even when it is dropped itself; an undefined correlation drops nothing.
    """
    high = (corr_pairs(df, columns).filter(F.abs("r") > threshold).groupBy(F.col("y").alias("column"))
            .agg(F.lit(False).alias("kept")))
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return every.join(high, "column", "left").select("column", F.coalesce("kept", F.lit(True)).alias("kept"))


def correlation_prune(df: DataFrame, columns: Sequence[str], threshold: float = D.CORRELATION_THRESHOLD) -> list[str]:
    """The kept columns, in their given order (one row per column is fetched)."""
    if len(columns) < 2:
        return list(columns)
    kept = {r["column"] for r in pruned_columns(df, columns, threshold).collect() if r["kept"]}
    return [c for c in columns if c in kept]


def median_impute(df: DataFrame, columns: Sequence[str], limit: int | None = None) -> DataFrame:
    middle = medians(df, columns, limit)
    return df.withColumns({c: F.coalesce(nan_to_null(F.col(c).cast("double")), F.lit(middle[c])) for c in columns})


def mean_and_scale(df: DataFrame, columns: dict[str, Column]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of the finite values per column from one aggregate; a deviation of 0 becomes 1."""
    if not columns:
        return {}
    columns = {c: finite(x) for c, x in columns.items()}
    row = df.agg(*[f(x).alias(f"{n}{i}") for i, x in enumerate(columns.values())
                   for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    stats = mean_and_scale(df, {c: F.col(c) for c in columns})
    return df.withColumns({c: (finite(F.col(c)) - F.lit(stats[c][0])) / F.lit(stats[c][1]) for c in columns})


def variance_filter(df: DataFrame, bits_column: str, bits: int = D.FINGERPRINT_BITS,
                    threshold: float = D.BIT_VARIANCE_THRESHOLD) -> DataFrame:
    """(bit, variance, kept) for every fingerprint bit."""
    return bit_variance(df, bits_column, bits).select("bit", "variance", (F.col("variance") > threshold).alias("kept"))


def explained_variance(model: PCAModel, df: DataFrame, line: float = 0.95) -> DataFrame:
    """(component, ratio, cumulative, reaches_line) of a fitted projection."""
    rows, total = [], 0.0
    for i, ratio in enumerate(model.explainedVariance.toArray(), start=1):
        total += float(ratio)
        rows.append((i, float(ratio), total, total >= line))
    return df.sparkSession.createDataFrame(rows, "component int, ratio double, cumulative double, reaches_line boolean")


@dataclass
class FeatureModel:
    """Everything learned from the training rows. ``transform`` is a projection: no shuffle, no job."""

    columns: list[str]
    kept: list[str]
    center: dict[str, float]
    scale: dict[str, tuple[float, float]]
    fingerprint: str | None = None
    kept_bits: list[int] = field(default_factory=list)
    scaler: StandardScalerModel | None = None
    pca: PCAModel | None = None

    @property
    def names(self) -> list[str]:
        parts = [f"fp_pca_{i}" for i in range(self.pca.getK())] if self.pca else [f"fp_{b}" for b in self.kept_bits]
        return [*self.kept, *parts]

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        filled = [_imputed(c, self.center[c]) for c in self.kept]
        scaled = [(x - F.lit(self.scale[c][0])) / F.lit(self.scale[c][1]) for c, x in zip(self.kept, filled)]
        out = df.withColumn("_continuous", array_to_vector(F.array(*scaled).cast("array<double>")))
        blocks = ["_continuous"]
        if self.kept_bits:
            out = out.withColumn("_bits", array_to_vector(bits_to_array(F.col(self.fingerprint), self.kept_bits)))
            blocks.append("_bits")
        if self.pca:
            out = self.pca.transform(self.scaler.transform(out))
            blocks[-1] = "_projected"
        out = VectorAssembler(inputCols=blocks, outputCol=features).transform(out)
        return out.select(*df.columns, features)

    def save(self, spark, path: str) -> None:
        state = {k: getattr(self, k) for k in ("columns", "kept", "center", "scale", "fingerprint", "kept_bits")}
        write_text_document(spark, state | {"projected": self.pca is not None}, f"{path}/state")
        if self.pca:
            self.scaler.write().overwrite().save(f"{path}/scaler")
            self.pca.write().overwrite().save(f"{path}/pca")

    @classmethod
    def load(cls, spark, path: str) -> "FeatureModel":
        state = read_text_document(spark, f"{path}/state")
        projected = state.pop("projected")
        state["scale"] = {c: tuple(s) for c, s in state["scale"].items()}
        if projected:
            state |= {"scaler": StandardScalerModel.load(f"{path}/scaler"), "pca": PCAModel.load(f"{path}/pca")}
        return cls(**state)


def _imputed(column: str, center: float) -> Column:
    return F.coalesce(finite(F.col(column)), F.lit(center))


def fit_features(df: DataFrame, columns: Sequence[str] | None = None, fingerprint: str | None = None,
                 bits: int = D.FINGERPRINT_BITS, threshold: float = D.CORRELATION_THRESHOLD,
                 bit_threshold: float = D.BIT_VARIANCE_THRESHOLD, components: int | None = D.PCA_COMPONENTS,
                 limit: int | None = None) -> FeatureModel:
    """Prune, then learn medians, means, deviations, kept bits and the projection of the bits."""
    if columns is None:
        columns, _ = split_feature_blocks(df)
    kept = correlation_prune(df, columns, threshold)
    known = df.select(*[finite(F.col(c)).alias(c) for c in kept])
    center = {c: 0.0 if m is None else m for c, m in medians(known, kept, limit).items()}
    scale = mean_and_scale(df, {c: _imputed(c, center[c]) for c in kept})
    model = FeatureModel(list(columns), kept, center, scale, fingerprint)
    if fingerprint is None:
        return model
    found = variance_filter(df, fingerprint, bits, bit_threshold).filter("kept").select("bit").collect()
    model.kept_bits = sorted(r["bit"] for r in found)
    if components and model.kept_bits:
        vectors = df.select(array_to_vector(bits_to_array(F.col(fingerprint), model.kept_bits)).alias("_bits"))
        model.scaler, model.pca = fit_projection(vectors, "_bits", min(components, len(model.kept_bits)))
    return model


def fit_projection(df: DataFrame, vector: str, components: int) -> tuple[StandardScalerModel, PCAModel]:
    """Principal components of centred vectors; the matrix that is decomposed is columns x columns."""
    scaler = StandardScaler(withMean=True, withStd=False, inputCol=vector, outputCol="_centred").fit(df)
    pca = PCA(k=components, inputCol="_centred", outputCol="_projected").fit(scaler.transform(df))
    return scaler, pca
