"""Lookups by key and by lists of codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayflow.functions.numbers import coerce_numeric, log10_positive
from assayflow.functions.text import code_list
from assayflow.operators.parsing import normalize_ids
from assayflow.sources.tables import cut_lineage

STATISTICS = ("min", "max", "mean")


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """The keys to look up: normalised, known, each once."""
    return normalize_ids(df.select(key), [key], strict=True).filter(F.col(key).isNotNull()).distinct()


def enrich_left_join(df: DataFrame, properties: DataFrame, key: str) -> DataFrame:
    """Add the properties of each row's key; rows without a match keep NULLs.

    ``properties`` has one row per key. The side is broadcast only when its measured size is small;
    a hot or missing key is otherwise split by adaptive skew handling.
    """
    return normalize_ids(df, [key], strict=True).join(properties, key, "left")


def log_min_max_mean(df: DataFrame, key: str, measure: str, value: str,
                     measures: Sequence[str], absent: str = "zero") -> DataFrame:
    """Per key: min, max and mean of log10 of the positive values of each measure; 0, or NULL, when none."""
    number = F.col(value)
    if dict(df.dtypes)[value] == "string":
        number = coerce_numeric(number)
    rows = df.select(key, measure, log10_positive(number).alias("x"))
    wanted = []
    for m in measures:
        x = F.when(F.col(measure) == m, F.col("x"))
        for name, f in zip(STATISTICS, (F.min, F.max, F.avg)):
            wanted.append((F.coalesce(f(x), F.lit(0.0)) if absent == "zero" else f(x)).alias(f"{m}_{name}"))
    return rows.groupBy(key).agg(*wanted)


def code_list_enrich(df: DataFrame, column: str, lookup: DataFrame, measures: Sequence[str] = ("km", "kcat"),
                     absent: str = "zero", code: str = "code", measure: str = "measure",
                     value: str = "value") -> DataFrame:
    """Combine lookup statistics over the codes of each row.

    ``lookup`` is flat: (code, measure, value). Per row, minima are combined by min, maxima by max
    and means by mean over the row's codes. A code that is not in the lookup counts as 0, or with
    ``absent='null'`` is left out. Every distinct list is worked out once and joined back.
    """
    per_code = log_min_max_mean(lookup, code, measure, value, measures, absent).withColumn("known", F.lit(1))
    filler = F.lit(0.0) if absent == "zero" else F.lit(None).cast("double")
    filled = lambda name: F.coalesce(F.col(name), filler)
    is_array = dict(df.dtypes)[column].startswith("array")
    codes = F.col(column) if is_array else code_list(F.col(column))
    lists = df.select(column).distinct()
    matched = (lists.select(column, F.explode(codes).alias(code)).join(per_code, code, "left"))
    combined = [F.coalesce(F.max("known"), F.lit(0)).alias("has_match")]
    for m in measures:
        for name, f in zip(STATISTICS, (F.min, F.max, F.avg)):
            combined.append(f(filled(f"{m}_{name}")).alias(f"{m}_{name}"))
    per_list = cut_lineage(matched.groupBy(column).agg(*combined))  # its size decides how it is joined
    joined = df.join(per_list, column, "left")
    names = [f"{m}_{s}" for m in measures for s in STATISTICS]
    return joined.withColumns({"has_match": F.coalesce("has_match", F.lit(0))}
                              | {n: F.coalesce(F.col(n), filler) for n in names})
