"""Features of letter sequences (proteins)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayflow.functions import sequence as S

# Published per-residue tables.
# Hydropathy: Kyte and Doolittle 1982.
HYDROPATHY = {
    "A": 1.8, "C": 2.5, "D": -3.5, "E": -3.5, "F": 2.8, "G": -0.4, "H": -3.2, "I": 4.5, "K": -3.9,
    "L": 3.8, "M": 1.9, "N": -3.5, "P": -1.6, "Q": -3.5, "R": -4.5, "S": -0.8, "T": -0.7, "V": 4.2,
    "W": -0.9, "Y": -1.3,
}
# Average masses of the free amino acids in dalton; one water is lost per bond.
MASS = {
    "A": 89.0932, "C": 121.1582, "D": 133.1027, "E": 147.1293, "F": 165.1891, "G": 75.0666,
    "H": 155.1546, "I": 131.1729, "K": 146.1876, "L": 131.1729, "M": 149.2113, "N": 132.1179,
    "P": 115.1305, "Q": 146.1445, "R": 174.2010, "S": 105.0926, "T": 119.1192, "V": 117.1463,
    "W": 204.2252, "Y": 181.1885,
}
WATER = 18.0153
AROMATIC = "YWF"
HELIX = "EMALK"
TURN = "NPGSD"
SHEET = "VIYFWLT"
EXTINCTION_W, EXTINCTION_Y, EXTINCTION_CYSTINE = 5500, 1490, 125

def normalize_sequence(df: DataFrame, column: str = "sequence") -> DataFrame:
    """Add ``clean_sequence``, ``orig_len`` (letters) and ``unknown_frac`` (share not standard)."""
    letters = S.letters_only(F.col(column)) if column in df.columns else F.lit(None).cast("string")
    clean = S.standard_letters(letters)
    return df.withColumns({"clean_sequence": clean, "orig_len": F.octet_length(letters),
                           "unknown_frac": S.unknown_fraction(letters, clean)})


def long_enough() -> Column:
    """The guard of all features: some standard letter, and at least ten letters."""
    return (F.octet_length("clean_sequence") > 0) & (F.col("orig_len") >= S.MIN_LENGTH)


def add_sequence_features(df: DataFrame, column: str = "sequence", prefix: str = "aa_") -> DataFrame:
    """Lengths, letter shares, group shares, charge, entropy and weighted scores.

    Short or missing sequences get NULL in every feature. Three projections, no shuffle: letter
    counts, then shares, then what follows from the shares.
    """
    kept = df.columns
    df = normalize_sequence(df, column)
    guard = long_enough()
    clean = F.when(guard, F.col("clean_sequence"))
    df = df.withColumns({f"n_{a}": S.letter_count(clean, a) for a in S.LETTERS}
                        | {"clean_length": F.octet_length(clean), "low_complexity_frac": S.run_fraction(clean)})
    df = df.withColumns({f"{prefix}{a}": F.col(f"n_{a}") / F.col("clean_length") for a in S.LETTERS})

    share = {a: F.col(f"{prefix}{a}") for a in S.LETTERS}
    count = {a: F.col(f"n_{a}") for a in S.LETTERS}
    length = F.col("clean_length")
    shares_of = lambda letters: S.total([share[a] for a in letters])
    counts_of = lambda letters: S.total([count[a] for a in letters])
    positive, negative = counts_of(S.POSITIVE), counts_of(S.NEGATIVE)
    rings = count["W"] * EXTINCTION_W + count["Y"] * EXTINCTION_Y
    features = {
        "sequence_length": F.when(guard, F.col("orig_len")),
        "unknown_frac": F.when(guard, F.col("unknown_frac")),
        "frac_hydrophobic": shares_of(S.HYDROPHOBIC),
        "frac_polar": shares_of(S.POLAR),
        "frac_charged_pos": shares_of(S.POSITIVE),
        "frac_charged_neg": shares_of(S.NEGATIVE),
        "net_charge_pH7_approx": positive - negative,
        "charge_ratio_pos_neg": (positive + S.SMOOTHING) / (negative + S.SMOOTHING),
        "aliphatic_index": S.total([share[a] * w for a, w in S.ALIPHATIC_WEIGHTS]),
        "aa_entropy": F.when(guard, S.entropy_bits(share.values())),
        "aromaticity": shares_of(AROMATIC),
        "gravy": weighted(share, HYDROPATHY),
        "mol_weight": weighted(count, MASS) - (length - 1) * WATER,
        "frac_helix": shares_of(HELIX),
        "frac_turn": shares_of(TURN),
        "frac_sheet": shares_of(SHEET),
        "ext_coeff_reduced": rings,
        "ext_coeff_oxidized": rings + F.floor(count["C"] / 2).cast("int") * EXTINCTION_CYSTINE,
    }
    df = df.withColumns(features)
    names = [*features, "clean_length", "low_complexity_frac", *[f"{prefix}{a}" for a in S.LETTERS]]
    return df.select(*[c for c in kept if c not in names], *names)


def add_isoelectric_point(df: DataFrame, column: str = "sequence", name: str = "isoelectric_point") -> DataFrame:
    """Add the pH at which the sequence has no charge; null for short and missing sequences.

    Letters are counted in one projection, and the point is found in the next by column expressions: no Python, no shuffle.
    """
    letters = [*S.ACIDS, *S.BASES]
    guarded = normalize_sequence(df, column).withColumn("_clean", F.when(long_enough(), F.col("clean_sequence")))
    counted = guarded.withColumns({f"_n_{a}": S.letter_count(F.col("_clean"), a) for a in letters})
    return counted.select(*df.columns, S.isoelectric_point(F.col("_clean"), {a: F.col(f"_n_{a}") for a in letters}).alias(name))


def weighted(parts: Mapping[str, Column], weights: Mapping[str, float]) -> Column:
    """Sum of letter parts times letter weights."""
    return S.total([parts[a] * F.lit(w) for a, w in weights.items()])


def bigram_score(df: DataFrame, row_id: str, weights: DataFrame, column: str = "sequence") -> DataFrame:
    """(row id, score): 10 / length times the sum of the weights of adjacent letter pairs.

    ``weights`` holds (pair, weight). Only pairs of the 20 letters count, one weight each (two are an error), so the
    broadcast has at most 400 rows. Pairs are summed
    inside the task that reads the row, so one partial sum per row is shuffled and no letters are.
    Pairs without a weight add nothing; short sequences score NULL.
    """
    weights = (weights.filter(F.col("pair").rlike(f"^[{''.join(S.LETTERS)}]{{2}}$")).groupBy("pair")
               .agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("weight")))
    if not weights.filter("n > 1").isEmpty():
        raise ValueError("a letter pair has two weights")
    weights = weights.drop("n")
    rows = normalize_sequence(df.select(row_id, column), column)
    clean = F.when(long_enough(), F.col("clean_sequence"))
    rows = rows.select(row_id, clean.alias("clean"), F.octet_length(clean).alias("length"))
    pairs = F.regexp_extract_all(F.col("clean"), F.lit("(?=(..))"), 1)
    exploded = rows.select(row_id, "length", F.explode_outer(pairs).alias("pair"))
    scored = exploded.join(F.broadcast(weights), "pair", "left")
    return (scored.groupBy(row_id)
            .agg(F.sum(F.coalesce("weight", F.lit(0.0))).alias("total"), F.max("length").alias("length"))
            .select(row_id, (F.lit(10.0) / F.col("length") * F.col("total")).alias("score")))
