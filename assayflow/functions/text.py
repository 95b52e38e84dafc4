"""Column expressions that read ids, pH values, temperatures and codes from free text."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words, assumed numbers and patterns that decide how a text is read.
PH_SIMPLE_MISSING = ("nd", "ud", "n.d.", "unknown")
PH_SIMPLE_ZERO = "negligible"
PH_RICH_MISSING = ("unknown", "n/a", "—", "–")
PH_WORDS = (("neutral", 7.0), ("acidic", 5.0), ("basic", 9.0), ("alkaline", 9.0))
PH_RANGE_PATTERN = r"^p?h?(?U:\s*)([\d.]+)(?U:\s*)[-–to]+(?U:\s*)([\d.]+)"
PH_NUMBER_PATTERN = r"^p?h?(?U:\s*)([\d.]+)"
TEMPERATURE_SIMPLE_MISSING = ("nd", "unknown")
ROOM_TEMPERATURE = 22.0
ROOM_TEMPERATURE_PATTERN = r"room temperature|ambient temperature|\brt\b"
TEMPERATURE_MISSING = "not mentioned"
PH_IN_TEMPERATURE_PATTERN = r"ph(?U:\s*)\d+(\.\d+)?(?U:\s*),?(?U:\s*)"
KELVIN_OFFSET = 273.15
UNSIGNED_NUMBER_PATTERN = r"(\d+(?:\.\d+)?)"
DASHES = "–—−"

WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    chr(c) for c in range(0x2000, 0x200b))

_INTEGER = r"[+-]?\d+"
_PLAIN_INTEGER = r"^(?:0|[+-]?[1-9]\d*)$"
_LEADING_ZEROS = r"^[+-]?0\d+$"
_QUOTED = r"^(?:'[^']*'|\"[^\"]*\")$"
_NUMBER = r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"
_SEGMENT_CHARS = r"[\d.+\-eEx^ ]"
_PLAIN_TOKEN = r"[+-]?\d*\.?\d+(?:[eE][+-]?\d+)?"
_POWER_TOKEN = r"[+-]?\d*\.?\d+\s*x\s*10\^?[+-]?\d+"


def strip(text: Column) -> Column:
    """Trim white space of any kind, the no-break space included."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def lower_stripped(text: Column) -> Column:
    return F.lower(strip(text.cast("string")))


def contains_any(text: Column, words) -> Column:
    return text.rlike("|".join(re.escape(word) for word in words))


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match; NULL rather than '' when nothing matches."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def to_double(text: Column) -> Column:
    """A text cut out by a pattern to double; NULL for leftovers such as ``7.5.3`` or ``.``."""
    return F.when(text.rlike(rf"^{_NUMBER}$"), text.try_cast("double"))


def _whole(number: Column) -> Column:
    """Text of a number to bigint, fractions cut off; integers never pass through double."""
    return F.when(number.rlike(rf"^{_INTEGER}$"), number.try_cast("bigint")).otherwise(
        number.try_cast("double").try_cast("bigint"))


# --- identifiers ---------------------------------------------------------------------------------

def first_int_of_text(text: Column) -> Column:
    """First integer of a number or of a list written as text.

    An empty list and a bare comma list give NULL. Text that is neither gives its first digit run.
    The common forms come first, so that most rows meet one or two patterns.
    """
    t = strip(text)
    comma_list = rf"^\(?\s*{_NUMBER}\s*,(?:\s*{_NUMBER}\s*,?)*\s*\)?$"
    digits = first_match(t, r"(\d+)").try_cast("bigint")
    return (F.when(t.rlike(_PLAIN_INTEGER), t.try_cast("bigint"))
            .when(t.startswith("["), F.when(t.rlike(r"^\[\s*\]$"), F.lit(None).cast("bigint"))
                  .otherwise(F.coalesce(_first_item(t), digits)))
            .when(t.rlike(comma_list) | t.rlike(_QUOTED), F.lit(None).cast("bigint"))
            .when(t.rlike(rf"^{_NUMBER}$") & ~t.rlike(_LEADING_ZEROS), _whole(t))
            .otherwise(digits))


def normalized_id_of_text(text: Column) -> Column:
    """Like :func:`first_int_of_text`, but text that is neither number nor list gives NULL."""
    t = strip(text)
    return (F.when(t.rlike(_PLAIN_INTEGER), t.try_cast("bigint"))
            .when(t.startswith("["), _first_item(t))
            .when(t.rlike(rf"^['\"]\s*{_INTEGER}\s*['\"]$"), first_match(t, rf"({_INTEGER})").try_cast("bigint"))
            .when(t.rlike(rf"^{_NUMBER}$"), _whole(t)))


def _first_item(t: Column) -> Column:
    """First item of a list text when it is a number, or a quoted integer."""
    number = first_match(t, rf"^\[\s*({_NUMBER})\s*(?:,[^\[\]]*)?\]$")
    quoted = first_match(t, rf"^\[\s*['\"]\s*({_INTEGER})\s*['\"]\s*(?:,[^\[\]]*)?\]$")
    return F.coalesce(F.when(~number.rlike(_LEADING_ZEROS), _whole(number)), quoted.try_cast("bigint"))


def first_int_of_array(items: Column) -> Column:
    return F.get(items, 0).cast("bigint")


# --- pH ------------------------------------------------------------------------------------------

def ph_simple(text: Column) -> Column:
    t = lower_stripped(text)
    return (F.when(contains_any(t, PH_SIMPLE_MISSING), F.lit(None).cast("double"))
            .when(t.contains(PH_SIMPLE_ZERO), F.lit(0.0))
            .otherwise(first_match(t, UNSIGNED_NUMBER_PATTERN).try_cast("double")))


@dataclass(frozen=True)
class Parsed:
    """A value column with the column that says how it came about."""

    value: Column
    status: Column


def ph_rich(text: Column) -> Parsed:
    """Words, ranges (midpoint) and leading numbers."""
    t = lower_stripped(text)
    unavailable = F.coalesce(t == "", F.lit(True)) | contains_any(t, PH_RICH_MISSING)
    word_value = F.coalesce(*[F.when(t.contains(word), F.lit(number)) for word, number in PH_WORDS])
    is_word = word_value.isNotNull()
    low = to_double(first_match(t, PH_RANGE_PATTERN, 1))
    high = to_double(first_match(t, PH_RANGE_PATTERN, 2))
    single = to_double(first_match(t, PH_NUMBER_PATTERN, 1))
    number = F.when(t.rlike(PH_RANGE_PATTERN), (low + high) / 2).otherwise(single)
    has_number = t.rlike(PH_NUMBER_PATTERN)
    value = F.when(~unavailable, F.when(is_word, word_value).when(has_number, number))
    status = (F.when(unavailable, "unavailable").when(is_word, "word")
              .when(has_number & number.isNotNull(), "valid").when(has_number, "failed")
              .otherwise("unrecognized"))
    return Parsed(value, status)


# --- temperature ---------------------------------------------------------------------------------

def temperature_simple(text: Column) -> Column:
    """First number; room temperature by word; any ``k`` means Kelvin unless ``°c`` is there."""
    t = lower_stripped(text)
    number = first_match(t, UNSIGNED_NUMBER_PATTERN).try_cast("double")
    kelvin = t.contains("k") & ~t.contains("°c")
    return (F.when(t.contains("room"), F.lit(ROOM_TEMPERATURE))
            .when(contains_any(t, TEMPERATURE_SIMPLE_MISSING), F.lit(None).cast("double"))
            .when(kelvin, number - KELVIN_OFFSET).otherwise(number))


def temperature_prepass(lowered: Column) -> Column:
    """Text without pH remarks; room temperature spelled out as a number with unit.

    Expects :func:`without_ph` text.
    """
    given = first_match(lowered, r"(\d+(\.\d+)?)(?U:\s*)°?(?U:\s*)c")
    return (F.when(lowered.rlike(ROOM_TEMPERATURE_PATTERN),
                   F.coalesce(F.concat(given, F.lit("°C")), F.lit("22°C")))
            .when(lowered.contains(TEMPERATURE_MISSING), F.lit(None).cast("string"))
            .otherwise(F.btrim(lowered, F.lit(" ,;()[]"))))


def without_ph(text: Column) -> Column:
    return F.regexp_replace(lower_stripped(text), PH_IN_TEMPERATURE_PATTERN, "")


def spaced(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\s+", " ")


def segment_text(text: Column) -> Column:
    """The text as :func:`numeric_segment` reads it: single blanks, one kind of times sign."""
    return spaced(F.translate(strip(text), "×X", "xx"))


def numeric_segment(text: Column, strict_parity: bool = False) -> Column:
    """Struct of the leading numeric part of a text and of whether anything (a unit) follows it.

    ``to`` joins two numbers. With ``strict_parity`` it counts letter by letter, as a class of
    single characters, so that ``20 to 25`` ends after 20.
    """
    joint = "[-–—to]" if strict_parity else "(?:[-–—]|to)"
    pattern = rf"(?i)^\s*({_SEGMENT_CHARS}+(?:\s*(?:±|{joint})\s*{_SEGMENT_CHARS}+)?)\s*(.*)$"
    segment = F.btrim(F.regexp_extract(text, pattern, 1))
    rest = F.btrim(F.regexp_extract(text, pattern, 2))
    found = F.struct(segment.alias("segment"), (rest != "").alias("had_unit"))
    whole = F.struct(F.coalesce(text, F.lit("")).alias("segment"), F.lit(False).alias("had_unit"))
    return F.when(text.rlike(rf"(?i)^\s*{_SEGMENT_CHARS}"), found).otherwise(whole)


def number_tokens(segment: Column, strict_parity: bool = False) -> Column:
    """The numbers of a segment as texts.

    A dash between two numbers parts a range and ``a x 10^b`` is one number. With
    ``strict_parity`` the dash is taken as a sign and the power form as three numbers.
    """
    t = F.lower(F.translate(spaced(segment), "×X" + DASHES, "xx" + "-" * len(DASHES)))
    t = F.regexp_replace(t, r"\bto\b", "-")
    t = F.regexp_replace(t, r"\s*±\s*[\d.e+\-]+", "")
    if strict_parity:
        return F.regexp_extract_all(t, F.lit(f"({_PLAIN_TOKEN})"), 1)
    t = F.regexp_replace(t, r"([\d.])\s*-\s*([\d.])", "$1 ~ $2")
    return F.regexp_extract_all(t, F.lit(f"({_POWER_TOKEN}|{_PLAIN_TOKEN})"), 1)


def number_of_tokens(tokens: Column) -> Column:
    """One number, or the midpoint of the first two."""
    first, second = _token_value(F.get(tokens, 0)), _token_value(F.get(tokens, 1))
    return F.when(F.size(tokens) == 1, first).when(F.size(tokens) > 1, (first + second) / 2)


def _token_value(token: Column) -> Column:
    power = r"^([+-]?\d*\.?\d+)\s*x\s*10\^?([+-]?\d+)$"
    mantissa, exponent = (first_match(token, power, 1).try_cast("double"), first_match(token, power, 2).try_cast("int"))
    return F.when(token.contains("x"), mantissa * F.pow(F.lit(10.0), exponent)).otherwise(to_double(token))


def temperature_unit(text: Column, strict_parity: bool = False) -> Column:
    """'C', 'K' or 'F', tried in that order.

    The unit has to follow a number. With ``strict_parity`` any word that ends in the letter counts.
    """
    lead = r"(?i)" if strict_parity else r"(?i)\d[^0-9a-z]*(?:deg(?:rees?)?)?[^0-9a-z]*"
    return (F.when(text.rlike(lead + r"c\b"), "C").when(text.rlike(lead + r"k\b"), "K")
            .when(text.rlike(lead + r"f\b"), "F"))


def celsius(number: Column, unit: Column, had_unit: Column) -> Column:
    """The number in °C; no unit text at all means °C, an unknown unit gives NULL."""
    return (F.when(unit == "C", number).when(unit == "K", number - KELVIN_OFFSET)
            .when(unit == "F", (number - 32) * 5 / 9).when(~had_unit, number))


# --- dotted codes --------------------------------------------------------------------------------

def code_level(code: Column, level: int) -> Column:
    """Level 1, 2, ... of a dotted code as int; NULL when absent or not a number."""
    part = strip(F.get(F.split(code, "[.]"), level - 1))
    return F.when(part.rlike(r"^[+-]?\d+$"), part.try_cast("int"))


def code_list(text: Column) -> Column:
    """Codes parted by ``;``, or by ``,`` when there is no ``;``; blanks and empty items go."""
    parts = F.when(text.contains(";"), F.split(text, ";")).otherwise(F.split(text, ","))
    cleaned = F.filter(F.transform(parts, lambda x: F.btrim(x)), lambda x: x != "")
    empty_words = F.btrim(text).isin("", "None", "nan", "NaN", "null")
    return F.when(text.isNull() | empty_words, F.array().cast("array<string>")).otherwise(cleaned)
