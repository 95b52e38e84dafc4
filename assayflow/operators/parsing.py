"""Dirty text columns to typed values, with a status column that tells how each value was read."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayflow.functions import text as X
from assayflow.operators.joins import join_groups
from assayflow.sources.tables import cut_lineage

MAX_TEXT_BYTES = 8 * 1024 * 1024


def first_int(column: Column, data_type: T.DataType) -> Column:
    """First integer of a list, a number, or either of them written as text."""
    if isinstance(data_type, T.ArrayType):
        return X.first_int_of_array(column)
    if isinstance(data_type, T.StringType):
        return X.first_int_of_text(column)
    return column.try_cast("bigint")


def normalized_id(column: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        return X.normalized_id_of_text(column)
    return first_int(column, data_type)


def normalize_ids(df: DataFrame, columns: Iterable[str], strict: bool = False) -> DataFrame:
    """Id columns to nullable bigint; ``strict`` takes no digits out of other text."""
    read = normalized_id if strict else first_int
    found = {c: read(F.col(c), df.schema[c].dataType) for c in columns}
    return df.withColumns(found) if found else df


def _missing_input(df: DataFrame, column: str) -> Column:
    return F.col(column) if column in df.columns else F.lit(None).cast("string")


def standardize_ph(df: DataFrame, column: str = "pH", mode: str = "simple",
                   value: str = "pH_value", status: str = "pH_status", per_text: bool = True) -> DataFrame:
    """Add the pH as a number. ``mode`` is 'simple' (first number) or 'rich' (words and ranges)."""
    def read(rows: DataFrame) -> DataFrame:
        text = _missing_input(rows, column)
        if mode == "simple":
            number = X.ph_simple(text)
            return rows.withColumns({value: number, status: _plain_status(text, number)})
        parsed = X.ph_rich(text)
        return rows.withColumns({value: parsed.value, status: parsed.status})

    return _once_per_text(df, column, read) if per_text else read(df)


def standardize_temperature(df: DataFrame, column: str = "temperature", mode: str = "simple",
                            value: str = "temperature_C", status: str = "temperature_status",
                            strict_parity: bool = False, per_text: bool = True) -> DataFrame:
    """Add the temperature in °C. ``mode`` is 'simple' or 'rich' (units, ranges, ± forms)."""
    def read(rows: DataFrame) -> DataFrame:
        text = _missing_input(rows, column)
        if mode == "simple":
            number = X.temperature_simple(text)
            return rows.withColumns({value: number, status: _plain_status(text, number)})
        return _temperature_rich(rows, text, value, status, strict_parity)

    return _once_per_text(df, column, read) if per_text else read(df)


def _once_per_text(df: DataFrame, column: str, read: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Read every distinct text once and join the results back, when the texts are few and short.

    One cheap pass checks that. Many or long texts are read in place instead, without a join.
    """
    if column not in df.columns:
        return read(df)
    seen, longest = df.agg(F.approx_count_distinct(column), F.max(F.octet_length(column))).first()
    if seen * ((longest or 0) + 32) > MAX_TEXT_BYTES:
        return read(df)
    texts = cut_lineage(read(df.select(column).distinct()))
    return join_groups(df, texts, [column], "left")


def _temperature_rich(df: DataFrame, text: Column, value: str, status: str, strict_parity: bool) -> DataFrame:
    steps = temperature_steps(df, text, strict_parity)
    number, unit, had_unit = F.col("_number"), F.col("_unit"), F.col("_segment.had_unit")
    how = (F.when(F.col("_pre").isNull() | (F.col("_pre") == ""), "unavailable").when(number.isNull(), "failed")
           .when(unit.isNotNull(), "valid").when(~had_unit, "assumed").otherwise("unrecognized"))
    return steps.withColumns({value: X.celsius(number, unit, had_unit), status: how}).select(
        *[c for c in df.columns if c not in (value, status)], value, status)


def temperature_steps(df: DataFrame, text: Column, strict_parity: bool = False) -> DataFrame:
    """Working columns ``_pre``, ``_segment``, ``_number`` and ``_unit``.

    One projection per step, so that each pattern runs once per row.
    """
    return (df.withColumn("_lowered", X.without_ph(text))
            .withColumn("_pre", X.strip(X.temperature_prepass(F.col("_lowered"))))
            .withColumns({"_plain": X.segment_text(F.col("_pre")), "_unit": X.temperature_unit(F.col("_pre"), strict_parity)})
            .withColumn("_segment", X.numeric_segment(F.col("_plain"), strict_parity))
            .withColumn("_tokens", X.number_tokens(F.col("_segment.segment"), strict_parity))
            .withColumn("_number", X.number_of_tokens(F.col("_tokens"))))


def _plain_status(text: Column, number: Column) -> Column:
    return F.when(text.isNull(), "unavailable").when(number.isNull(), "failed").otherwise("valid")


def parse_status_counts(df: DataFrame, status: str) -> DataFrame:
    return df.groupBy(F.col(status).alias("status")).agg(F.count(F.lit(1)).alias("n"))


def expand_codes(df: DataFrame, column: str, levels: int = 4) -> DataFrame:
    """Dotted code to ``<column>_level1..``; of a list of codes the first one counts."""
    code = F.col(column)
    if isinstance(df.schema[column].dataType, T.ArrayType):
        code = F.get(code, 0)
    return df.withColumns({f"{column}_level{i}": X.code_level(code, i) for i in range(1, levels + 1)})
