"""The tables behind the diagnostic figures, before and after cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayflow import defaults as D
from assayflow.operators import stats
from assayflow.operators.clean import numeric_columns
from assayflow.operators.features import variance_filter
from assayflow.operators.outliers import (independent_masks, priority_label, reason_counts, sequential_labels)
from assayflow.operators.sampling import stratified_sample
from assayflow.sources.tables import cut_lineage

# Size and floors of the stratified sample behind the scatter figure.
SAMPLE_SIZE = 80_000
REGULAR_FLOOR, OTHER_FLOOR = 4000, 2000


def diagnostics(df: DataFrame, row_id: Sequence[str], a: str = "kcat_value", b: str = "km_value",
                fingerprint: str | None = "fp_bits", order: Sequence[str] = ("domain", "iso", "kinetics"),
                isolation: bool = True, iso_columns: Sequence[str] | None = None,
                sample_size: int = SAMPLE_SIZE, regular_floor: int = REGULAR_FLOOR, other_floor: int = OTHER_FLOOR) -> dict[str, DataFrame]:
    """Name to table: profile, missing shares, correlation, histograms, reasons, shares and a sample."""
    masked = independent_masks(df, a=a, b=b, row_id=row_id, isolation=isolation, iso_columns=iso_columns)
    flags = {k: F.col(k) for k in ("domain", "kinetics", "iso") if k in masked.columns}
    scores = ["iso_score"] if isolation else []
    masked = cut_lineage(masked.select(*dict.fromkeys([*row_id, a, b]), *flags, *scores))
    usable = masked.filter((F.col(a) > 0) & (F.col(b) > 0)).withColumn("label", priority_label(flags, order))
    tables = {
        "profile": stats.profile_columns(df),
        "correlation": stats.corr_pairs(df, numeric_columns(df, [*row_id, *D.TARGETS])),
        "histogram_a": stats.log_histogram(masked, a),
        "histogram_b": stats.log_histogram(masked, b),
        "fences_a": stats.fence_positions(masked, a),
        "fences_b": stats.fence_positions(masked, b),
        "reasons": reason_counts(masked, flags, ("domain", "kinetics", "iso")),
        "shares": stats.label_share(usable, "label"),
        "scatter": stratified_sample(usable, row_id, "label", sample_size, {"regular": regular_floor}, other_floor),
    }
    if isolation:
        tables["iso_scores"] = stats.histogram(masked, F.col("iso_score"), 60)
    if fingerprint in df.columns:
        tables["bit_variance"] = variance_filter(df, fingerprint)
    return tables


def drop_report(df: DataFrame, row_id: Sequence[str], **options) -> DataFrame:
    """(outcome, n) of the sequential strategy."""
    return stats.count_by(sequential_labels(df, row_id=row_id, **options), "outcome")
