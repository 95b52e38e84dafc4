"""Column expressions over letter sequences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The standard letters, the replacements of rare ones, and the letter groups.
LETTERS = "ACDEFGHIKLMNPQRSTVWY"
RARE_LETTERS, STAND_INS = "UOBZJ", "CKDEL"
NOT_STANDARD = "X"
HYDROPHOBIC = "AVILMFWY"
POLAR = "STNQ"
POSITIVE = "KRH"
NEGATIVE = "DE"
MIN_LENGTH = 10
RUN_LENGTH = 3
SMOOTHING = 1e-6
# Dissociation constants of side chains and ends, and of ends by their letter.
ACIDS = {"D": 4.05, "E": 4.45, "C": 9.0, "Y": 10.0}
BASES = {"K": 10.0, "R": 12.0, "H": 5.98}
FIRST_END, FIRST_ENDS = 7.5, {"A": 7.59, "M": 7.0, "S": 6.93, "P": 8.36, "T": 6.82, "V": 7.44, "E": 7.7}
LAST_END, LAST_ENDS = 3.55, {"D": 4.55, "E": 4.75}
HALVINGS, WIDEST_PH = 40, 14.0
ALIPHATIC_WEIGHTS = (("A", 1.0), ("V", 2.9), ("I", 3.9), ("L", 3.9))


def letters_only(sequence: Column) -> Column:
    """Upper-case letters without bracketed remarks, rare letters replaced."""
    letters = F.upper(F.regexp_replace(sequence, r"\([^)]*\)|[^A-Za-z(]+|\(", ""))
    for rare, stand_in in zip(RARE_LETTERS, STAND_INS):
        letters = F.replace(letters, F.lit(rare), F.lit(stand_in))
    return letters


def standard_letters(letters: Column) -> Column:
    for other in NOT_STANDARD:
        letters = F.replace(letters, F.lit(other), F.lit(""))
    return letters


def unknown_fraction(letters: Column, clean: Column) -> Column:
    return F.lit(1.0) - F.try_divide(F.octet_length(clean).cast("double"), F.octet_length(letters).cast("double"))


def letter_count(clean: Column, letter: str) -> Column:
    # Clean letters take one byte each, so that the lengths need no further pass over the text.
    return F.octet_length(clean) - F.octet_length(F.replace(clean, F.lit(letter), F.lit("")))


def total(columns) -> Column:
    return reduce(lambda a, b: a + b, columns)


def entropy_bits(shares) -> Column:
    """Shannon entropy of shares that sum to one."""
    return total([F.when(p > 0, -p * F.log2(p)).otherwise(F.lit(0.0)) for p in shares])


def run_fraction(clean: Column) -> Column:
    """Share of letters that stand in a run of three or more equal ones."""
    rest = F.regexp_replace(clean, rf"([A-Z])\1{{{RUN_LENGTH - 1},}}", "")
    return F.try_divide((F.octet_length(clean) - F.octet_length(rest)).cast("double"), F.octet_length(clean).cast("double"))


def charge_at(ph: Column, count: dict[str, Column], first_end: Column, last_end: Column) -> Column:
    """Net charge of a chain: what its basic groups hold less what its acid groups have given off."""
    base = lambda pk: F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(10.0), ph - pk))
    acid = lambda pk: F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(10.0), pk - ph))
    plus = total([base(first_end), *[count[a] * base(F.lit(pk)) for a, pk in BASES.items()]])
    return plus - total([acid(last_end), *[count[a] * acid(F.lit(pk)) for a, pk in ACIDS.items()]])


def isoelectric_point(clean: Column, count: dict[str, Column]) -> Column:
    """The pH of charge zero, by a fixed number of halvings between 0 and 14; null for an empty or missing sequence."""
    end = lambda letter, other, known: reduce(lambda e, a: F.when(letter == a, F.lit(known[a])).otherwise(e), known, F.lit(other))
    first_end, last_end = end(F.substring(clean, 1, 1), FIRST_END, FIRST_ENDS), end(F.substring(clean, -1, 1), LAST_END, LAST_ENDS)

    def halved(ends: Column) -> Column:
        def step(s: Column, _: Column) -> Column:
            middle = (s["low"] + s["high"]) / 2
            above = charge_at(middle, count, ends["first"], ends["last"]) > 0  # the point lies higher
            return F.struct(F.when(above, middle).otherwise(s["low"]).alias("low"), F.when(above, s["high"]).otherwise(middle).alias("high"))
        start = F.struct(F.lit(0.0).alias("low"), F.lit(WIDEST_PH).alias("high"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), start, step, lambda s: (s["low"] + s["high"]) / 2)

    found = F.element_at(F.transform(F.array(F.struct(first_end.alias("first"), last_end.alias("last"))), halved), 1)
    return F.when(F.octet_length(clean) > 0, found)
