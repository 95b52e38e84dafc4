"""From the raw measurement table to the cleaned table and the model input."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayflow import defaults as D
from assayflow.operators.clean import basic_clean, split_feature_blocks
from assayflow.operators.enrich import code_list_enrich, enrich_left_join
from assayflow.operators.features import FeatureModel, fit_features
from assayflow.operators.notations import add_notation_features
from assayflow.operators.outliers import apply_outlier_strategy
from assayflow.operators.parsing import expand_codes, standardize_ph, standardize_temperature
from assayflow.operators.sampling import hash_split
from assayflow.operators.sequences import add_sequence_features
from assayflow.sources.tables import NamedTables, read_table, write_bundle


@dataclass
class Prepared:
    features: DataFrame
    clean: DataFrame
    model: FeatureModel


def derive_features(raw: DataFrame, properties: DataFrame | None = None, reactions: DataFrame | None = None,
                    mode: str = "simple", missing_threshold: float = D.MISSING_THRESHOLD) -> DataFrame:
    """Clean rows and add every derived column. Lookups are optional inputs."""
    df = basic_clean(raw, threshold=missing_threshold)
    df = standardize_temperature(standardize_ph(df, mode=mode), mode=mode)
    df = add_notation_features(add_sequence_features(df))
    if properties is not None and "cid" in df.columns:
        df = enrich_left_join(df, properties, "cid")
    if "enzyme_ecs" in df.columns:
        if reactions is not None:
            df = code_list_enrich(df, "enzyme_ecs", reactions)
        df = expand_codes(df, "enzyme_ecs")
    return df


def preprocess(spark, raw_path: str, row_id: Sequence[str], tables: NamedTables,
               properties: DataFrame | None = None, reactions: DataFrame | None = None,
               mode: str = "simple", test_percent: int = 20, **options) -> Prepared:
    """The whole job. Texts are read once: the stages after ``derived`` pass over written columns.

    Features are fitted without the rows that ``train`` holds out, which are those of the same ids and ``test_percent``.
    """
    derived = tables.save(derive_features(read_table(spark, raw_path), properties, reactions, mode), "derived")
    clean = tables.save(apply_outlier_strategy(derived, row_id=row_id, **options), "clean")
    columns, _ = split_feature_blocks(clean, [*D.TARGETS, *row_id])
    # Medians, scales, bits and projection come from the rows that training uses; all rows are then transformed by them.
    fit_rows = hash_split(clean, list(row_id), test_percent).filter(~F.col("is_test")).drop("is_test")
    model = fit_features(fit_rows, columns, "fp_bits")
    model.save(spark, f"{tables.root}/feature_model")
    bundle = model.transform(clean)
    write_bundle(bundle, f"{tables.root}/bundle", list(row_id), "features", D.TARGETS,
                 {"columns": columns, "kept": model.kept, "names": model.names})
    return Prepared(derived, clean, model)
