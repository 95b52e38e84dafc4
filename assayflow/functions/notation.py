"""Column expressions over line notations of molecules (SMILES-like text)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token classes of the notation.
BRACKET_ATOM = r"\[[^\]]*\]"
BRACKET_CARBON = r"\[[0-9]*[Cc][@H0-9+\-:\]]"
HALOGENS = "Cl|Br"
ORGANIC_ATOM = "[BCNOPSFI]|[bcnops]"
AROMATIC_ATOM = "[bcnops]"
CARBON = "[Cc]"
RING_MARK = "%[0-9]{2}|[0-9]"
BRANCH = r"\("
STEREO_MARK = r"@@?|[/\\]"
MULTIPLE_BOND = "[=#]"


def count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def token_counts(notation: Column, prefix: str = "tok_") -> dict[str, Column]:
    """Structural token counts. They describe the text and do not claim chemical values."""
    outside = F.regexp_replace(notation, BRACKET_ATOM, "")
    plain = F.regexp_replace(outside, HALOGENS, "")
    atoms = count(notation, BRACKET_ATOM) + count(outside, f"{HALOGENS}|{ORGANIC_ATOM}")
    carbons = count(plain, CARBON) + count(notation, BRACKET_CARBON)
    return {
        f"{prefix}atoms": atoms,
        f"{prefix}non_carbon": atoms - carbons,
        f"{prefix}ring_marks": count(outside, RING_MARK),
        f"{prefix}branches": count(notation, BRANCH),
        f"{prefix}aromatic": count(plain, AROMATIC_ATOM),
        f"{prefix}stereo": count(notation, STEREO_MARK),
        f"{prefix}multiple_bonds": count(notation, MULTIPLE_BOND),
        f"{prefix}length": F.length(notation),
    }


def folded_bits(notation: Column, bits: int, shingle: int = 3) -> Column:
    """The set bits of a fingerprint: every run of ``shingle`` characters hashed to a bit number.

    Sorted and without repeats; missing or too short text sets no bit.
    """
    runs = F.array_distinct(F.regexp_extract_all(notation, F.lit(f"(?s)(?=(.{{{shingle}}}))"), 1))
    number = lambda run: F.conv(F.substring(F.md5(run), 1, 8), 16, 10).cast("bigint")
    on = F.transform(runs, lambda run: F.pmod(number(run), F.lit(bits)).cast("int"))
    return F.coalesce(F.array_sort(F.array_distinct(on)), F.array().cast("array<int>"))


def bits_to_array(on: Column, bits) -> Column:
    """Chosen bit numbers as an array of 0.0 and 1.0, in the order given.

    The NULL test names the column a second time, which keeps the optimizer from moving the
    expression that makes the bits into the lambda, where it would run once per bit.
    """
    chosen = F.transform(F.array(*[F.lit(int(b)) for b in bits]), lambda b: F.array_contains(on, b).cast("double"))
    return F.when(on.isNotNull(), chosen).otherwise(F.array_repeat(F.lit(0.0), len(bits)))
