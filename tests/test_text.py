"""Known answers for the readers of dirty text."""

import pytest
from pyspark.sql import functions as F

from assayflow.functions import numbers, text as X
from assayflow.operators import parsing


def _answers(spark, cases, read):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, t string")
    return [r[0] for r in read(df).orderBy("i").select("out").collect()]


def _check(spark, cases, column):
    found = _answers(spark, cases, lambda df: df.withColumn("out", column(F.col("t"))))
    assert found == [pytest.approx(c[1]) if isinstance(c[1], float) else c[1] for c in cases]


def test_first_int(spark):
    _check(spark, [("[123, 456]", 123), ("[789]", 789), ("[]", None), ("[ ]", None), ("42", 42), (" 42 ", 42), ("-5", -5),
                   ("12.7", 12), ("1e3", 1000), ("007", 7), ("CID:44 and 5", 44), ("12, 34", None), ("(12, 34)", None),
                   ("['12']", 12), ("[1.9, 2]", 1), ("[a, 7]", 7), ("'12'", None), ("none", None), ("", None), (None, None),
                   ("99999999999999999999", None)], X.first_int_of_text)


def test_first_int_of_arrays_and_numbers(spark):
    df = spark.createDataFrame([(0, [7, 8], 3.9), (1, [], None), (2, None, -2.5)], "i int, l array<int>, x double")
    rows = parsing.normalize_ids(df, ["l", "x"]).orderBy("i").collect()
    assert [(r["l"], r["x"]) for r in rows] == [(7, 3), (None, None), (None, -2)]


def test_normalized_id(spark):
    _check(spark, [("[123, 456]", 123), ("42", 42), ("007", 7), ("CID:44", None), ("12, 34", None), ("[]", None),
                   ("'12'", 12), ("3.0", 3), ("x", None), (None, None)], X.normalized_id_of_text)


def test_ph_simple(spark):
    _check(spark, [("7.5", 7.5), ("pH 7.5", 7.5), ("6.5-7.5", 6.5), ("-5", 5.0), ("nd", None), ("standard 7", None),
                   ("and 6", None), ("n.d.", None), ("Unknown", None), ("negligible", 0.0), ("neutral", None), ("", None),
                   (None, None)], X.ph_simple)


def test_ph_rich(spark):
    cases = [("7.5", 7.5, "valid"), ("pH 6.5 - 7.5", 7.0, "valid"), ("6.0 to 8.0", 7.0, "valid"), ("6.5–7.5", None, "unavailable"),
             ("neutral", 7.0, "word"), ("weakly acidic", 5.0, "word"), ("basic", 9.0, "word"), ("Alkaline", 9.0, "word"),
             ("7.5.3", None, "failed"), ("buffer", None, "unrecognized"), ("n/a", None, "unavailable"), ("  ", None, "unavailable"),
             (None, None, "unavailable"), ("at 7.5", None, "unrecognized")]
    for per_text in (True, False):
        def read(name):
            return lambda df: parsing.standardize_ph(df, "t", "rich", per_text=per_text).withColumn("out", F.col(name))
        assert _answers(spark, cases, read("pH_value")) == [c[1] for c in cases]
        assert _answers(spark, cases, read("pH_status")) == [c[2] for c in cases]


def test_temperature_simple(spark):
    _check(spark, [("37", 37.0), ("25C", 25.0), ("298K", 298 - 273.15), ("310 K", 310 - 273.15), ("room temp", 22.0),
                   ("37 °C, pH 7 kept", 37.0), ("30 c with k", 30 - 273.15), ("nd", None), ("unknown", None), ("-5", 5.0),
                   (None, None)], X.temperature_simple)


RICH = [  # text, value, status, value with strict_parity
    ("37 °C", 37.0, "valid", 37.0), ("310 K", 36.85, "valid", 36.85), ("98.6 F", 37.0, "valid", 37.0),
    ("30 ± 2°C", 30.0, "valid", 30.0), ("20 - 25 °C", 22.5, "valid", 22.5), ("20-25 °C", 22.5, "valid", -2.5),
    ("20 to 25 °C", 22.5, "valid", 20.0), ("2 x 10^1 °c", 20.0, "valid", 6.0), ("2 × 10^1 °C", 20.0, "valid", 6.0),
    ("room temperature", 22.0, "valid", 22.0), ("RT", 22.0, "valid", 22.0),
    ("Room temperature (25 °C)", 25.0, "valid", 25.0), ("pH 7.4, 37 °C", 37.0, "valid", 37.0),
    ("37", 37.0, "assumed", 37.0), ("37 bar", None, "unrecognized", None), ("not mentioned", None, "unavailable", None),
    ("", None, "unavailable", None), (None, None, "unavailable", None), ("warm", None, "failed", None),
    ("-5 °C", -5.0, "valid", -5.0), ("25 °C", 25.0, "valid", 25.0), ("25 deg C", 25.0, "valid", 25.0),
    ("(37 °C)", 37.0, "valid", 37.0), ("50 relative to basic", None, "unrecognized", 50.0),
]


@pytest.mark.parametrize("per_text", [True, False])
def test_temperature_rich(spark, per_text):
    def read(name, strict):
        return lambda df: parsing.standardize_temperature(
            df, "t", "rich", strict_parity=strict, per_text=per_text).withColumn("out", F.col(name))
    expect = lambda i: [None if c[i] is None else pytest.approx(c[i]) for c in RICH]
    assert _answers(spark, RICH, read("temperature_C", False)) == expect(1)
    assert _answers(spark, RICH, read("temperature_status", False)) == [c[2] for c in RICH]
    assert _answers(spark, RICH, read("temperature_C", True)) == expect(3)


def test_absent_text_column_gives_null(spark):
    df = parsing.standardize_temperature(parsing.standardize_ph(spark.range(2), "pH"), "temperature", "rich")
    assert df.select("pH_value", "temperature_C", "temperature_status").distinct().collect() == [(None, None, "unavailable")]


def test_codes(spark):
    df = spark.createDataFrame([("2.7.1.40",), ("1.1.-.-",), ("3.4",), ("2.7.n1.x",), (None,)], "ec string")
    levels = [tuple(r)[1:] for r in parsing.expand_codes(df, "ec").collect()]
    assert levels == [(2, 7, 1, 40), (1, 1, None, None), (3, 4, None, None), (2, 7, None, None), (None,) * 4]
    lists = spark.createDataFrame([(["5.3.1.9", "1.1.1.1"],), ([],)], "ec array<string>")
    assert [r["ec_level2"] for r in parsing.expand_codes(lists, "ec").collect()] == [3, None]


def test_code_list(spark):
    _check(spark, [("a; b", ["a", "b"]), ("a,b ,", ["a", "b"]), ("a;b,c", ["a", "b,c"]), ("a", ["a"]), ("nan", []), (" ", []),
                   (None, [])], X.code_list)


def test_numbers_from_text(spark):
    _check(spark, [("1.5", 1.5), (" 7. ", 7.0), ("1e3", 1000.0), ("1d", None), ("nan", None), ("2f", None), ("x", None),
                   ("", None), (None, None)], numbers.coerce_numeric)


def test_safe_numbers(spark):
    rows = [(0.0, 1.0), (1.0, 0.0), (-1.0, 2.0), (float("nan"), 1.0), (float("inf"), 1.0), (None, 1.0), (100.0, 4.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    out = df.select(numbers.log10_positive(F.col("a")), numbers.safe_ratio(F.col("a"), F.col("b")),
                    numbers.flag(F.col("a") > 50)).collect()
    assert [r[0] for r in out] == [None, 0.0, None, None, None, None, 2.0]
    assert [r[1] for r in out] == [0.0, None, -0.5, None, None, None, 25.0]
    assert all(r[2] is not None for r in out)
