"""Row and column cleaning."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayflow import defaults
from assayflow.functions.numbers import finite, nan_to_null
from assayflow.operators.parsing import normalize_ids
from assayflow.operators.quantiles import medians, quantile_values


def drop_if_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*names)


def drop_missing_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows where all the columns hold a value; NaN counts as missing."""
    for c in columns:
        df = df.filter(F.col(c).isNotNull())  # a bare null test reaches the Parquet reader
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            df = df.filter(~F.isnan(c))
    return df


def _missing(df: DataFrame, column: str):
    missing = F.col(column).isNull()
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        missing = missing | F.isnan(column)
    return missing


def missing_fraction(df: DataFrame) -> DataFrame:
    """(column, fraction) in one pass over the table."""
    shares = df.agg(*[F.avg(_missing(df, c).cast("int")).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("fraction")) for c in df.columns])
    return shares.select(F.inline(pairs))


def sparse_columns(df: DataFrame, threshold: float = defaults.MISSING_THRESHOLD) -> list[str]:
    """Names of the columns whose missing share is above the threshold (one row per column comes back)."""
    found = missing_fraction(df).filter(F.col("fraction") > threshold)
    return [r["column"] for r in found.collect()]


def drop_sparse_columns(df: DataFrame, threshold: float = defaults.MISSING_THRESHOLD) -> DataFrame:
    return df.drop(*sparse_columns(df, threshold))


def null_tolerant_filter(df: DataFrame, columns: Iterable[str], minimum: float) -> DataFrame:
    """Keep rows whose value is missing or at least the minimum; absent columns are skipped."""
    for c in columns:
        if c in df.columns:
            df = df.filter(F.col(c).isNull() | (F.col(c) >= minimum))
    return df


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skipped = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skipped]


def split_feature_blocks(df: DataFrame, targets: Iterable[str] = defaults.TARGETS,
                         prefix: str = "fp_") -> tuple[list[str], list[str]]:
    """Numeric columns without targets, parted into continuous ones and fingerprint ones."""
    numeric = numeric_columns(df, targets)
    return ([c for c in numeric if not c.startswith(prefix)], [c for c in numeric if c.startswith(prefix)])


def ensure_column(df: DataFrame, name: str, data_type: str) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(data_type))


def median_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Infinite and missing values become the column median."""
    cleaned = df.withColumns({c: finite(F.col(c)) for c in columns})
    middle = medians(cleaned, columns)
    return cleaned.withColumns({c: F.coalesce(F.col(c), F.lit(middle[c])) for c in columns})


def winsorize(df: DataFrame, columns: Sequence[str], low: float = 0.1, high: float = 99.9) -> DataFrame:
    """Pull values outside the two percentiles back to them; missing stays missing, NaN becomes missing."""
    bounds = quantile_values(df, columns, [low / 100, high / 100])
    clipped = {}
    for c in columns:
        if bounds[c]:
            lo, hi = bounds[c]
            x = nan_to_null(F.col(c).cast("double"))
            clipped[c] = F.when(x < lo, lo).when(x > hi, hi).otherwise(x)
    return df.withColumns(clipped)


def basic_clean(df: DataFrame, measures: Sequence[str] = ("kcat_value", "km_value"),
                text_duplicates: Iterable[str] = defaults.TEXT_DUPLICATES,
                id_columns: Iterable[str] = defaults.ID_COLUMNS,
                similarity_columns: Iterable[str] = defaults.SIMILARITY_COLUMNS,
                minimum: float = defaults.MIN_SIMILARITY,
                threshold: float = defaults.MISSING_THRESHOLD) -> DataFrame:
    """Known measures only, then sparse columns dropped, ids normalised, weak rows filtered.

    The missing share is measured on the rows with known measures, so the order matters.
    """
    df = drop_missing_rows(drop_if_present(df, text_duplicates), measures)
    df = drop_sparse_columns(df, threshold)
    df = normalize_ids(df, [c for c in id_columns if c in df.columns])
    return null_tolerant_filter(df, similarity_columns, minimum)
