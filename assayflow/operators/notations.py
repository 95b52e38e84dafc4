"""Features of molecule notations: token counts and folded fingerprints."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayflow import defaults
from assayflow.functions import notation as N
from assayflow.functions.numbers import log10_positive


def add_notation_features(df: DataFrame, column: str = "smiles", bits: int = defaults.FINGERPRINT_BITS,
                          fingerprint: str = "fp_bits", prefix: str = "tok_") -> DataFrame:
    """Token counts as columns and the fingerprint as one array of set bits, never a column per bit."""
    text = F.col(column) if column in df.columns else F.lit(None).cast("string")
    return df.withColumns(N.token_counts(text, prefix) | {fingerprint: N.folded_bits(text, bits)})


def log_scale_features(df: DataFrame, log10: Mapping[str, str] = {}, log1p: Mapping[str, str] = {}) -> DataFrame:
    """Replace skewed columns by their logarithm: {old name: new name}."""
    scaled = {new: log10_positive(F.col(old)) for old, new in log10.items()}
    scaled |= {new: F.when(F.col(old) > -1, F.log1p(old)) for old, new in log1p.items()}
    return df.withColumns(scaled).drop(*log10, *log1p)
