import math

import pytest
from pyspark.sql import functions as F

from assayflow.functions import notation as N
from assayflow.operators.notations import add_notation_features, log_scale_features
from assayflow.functions import sequence as S
from assayflow.operators.sequences import add_isoelectric_point, add_sequence_features, bigram_score, normalize_sequence


def test_normalize(spark):
    rows = [("MK(tag)TA YI-x",), ("acdu(obz",), ("12 34",), (None,), ("ÄMK",)]
    out = normalize_sequence(spark.createDataFrame(rows, "sequence string")).collect()
    assert [(r["clean_sequence"], r["orig_len"]) for r in out] == [
        ("MKTAYI", 7), ("ACDCKDE", 7), ("", 0), (None, None), ("MK", 2)]
    assert [r["unknown_frac"] for r in out] == [pytest.approx(1 / 7), 0.0, None, None, 0.0]


def test_features_by_hand(spark):
    s = "AAAACCDKWYVILX"
    r = add_sequence_features(spark.createDataFrame([(s,)], "sequence string")).first()
    clean, n = "AAAACCDKWYVIL", 13
    share = lambda letters: sum(clean.count(a) for a in letters) / n
    assert (r["sequence_length"], r["clean_length"]) == (14, 13)
    assert r["aa_A"] == pytest.approx(4 / n) and r["aa_G"] == 0.0
    assert r["frac_hydrophobic"] == pytest.approx(share("AVILMFWY"))
    assert r["net_charge_pH7_approx"] == 0
    assert r["charge_ratio_pos_neg"] == pytest.approx(1.0)
    assert r["aliphatic_index"] == pytest.approx(share("A") + 2.9 * share("V") + 3.9 * share("IL"))
    assert r["aa_entropy"] == pytest.approx(-sum(p * math.log2(p) for p in map(share, set(clean))))
    assert r["low_complexity_frac"] == pytest.approx(4 / n)
    assert (r["ext_coeff_reduced"], r["ext_coeff_oxidized"]) == (5500 + 1490, 5500 + 1490 + 125)


def test_short_and_missing_sequences_have_no_features(spark):
    out = add_sequence_features(spark.createDataFrame([("MKT",), ("XXXXXXXXXXXX",), (None,)], "sequence string"))
    for r in out.drop("sequence", "clean_sequence").collect():
        assert all(v is None for v in r)


def test_bigram_score(spark):
    weights = spark.createDataFrame([("MK", 2.0), ("KK", 0.5)], "pair string, weight double")
    rows = spark.createDataFrame([(1, "MKKKKKKKKM"), (2, "MK"), (3, None)], "id int, sequence string")
    found = {r["id"]: r["score"] for r in bigram_score(rows, "id", weights).collect()}
    assert found == {1: pytest.approx(10 / 10 * (2.0 + 7 * 0.5)), 2: None, 3: None}


def test_token_counts(spark):
    df = add_notation_features(spark.createDataFrame([("C[C@@H](N)C(=O)Oc1ccccc1Cl",), (None,)], "smiles string"))
    r, missing = df.collect()
    assert (r["tok_atoms"], r["tok_non_carbon"], r["tok_ring_marks"], r["tok_branches"]) == (13, 4, 2, 2)
    assert (r["tok_aromatic"], r["tok_stereo"], r["tok_multiple_bonds"]) == (6, 1, 1)
    assert missing["fp_bits"] == [] and missing["tok_atoms"] is None


def test_fingerprint_expands_to_kept_bits(spark):
    df = add_notation_features(spark.createDataFrame([("CCO",), ("CC",)], "smiles string"), bits=16)
    on = df.first()["fp_bits"]
    assert len(on) == 1
    dense = df.select(N.bits_to_array(F.col("fp_bits"), [on[0], (on[0] + 1) % 16])).collect()
    assert [list(r[0]) for r in dense] == [[1.0, 0.0], [0.0, 0.0]]


def test_log_scale(spark):
    df = spark.createDataFrame([(100.0, 0.0), (0.0, -5.0)], "MW double, TPSA double")
    out = log_scale_features(df, {"MW": "log_MW"}, {"TPSA": "log_TPSA"})
    assert out.columns == ["log_MW", "log_TPSA"]
    assert [tuple(r) for r in out.collect()] == [(2.0, 0.0), (None, None)]


def test_charge_at_the_isoelectric_point_is_nil(spark):
    """Known chains lie where their groups say, and the charge at the point found is below 1e-3."""
    chains = ["MKWVTFISLLFLFSSAYSRGV", "DDDDDEEEEEDDDDDEEEEE", "KKKKKRRRRRKKKKKRRRRR", "GGGGGGGGGGGG", "ACDEFGHIKLMNPQRSTVWY" * 40]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(chains)] + [(10, "MK"), (11, None), (12, "")], "id long, sequence string")
    found = {r["id"]: r["isoelectric_point"] for r in add_isoelectric_point(df).collect()}
    assert found[10] is None and found[11] is None and found[12] is None
    for i, chain in enumerate(chains):
        first, last = S.FIRST_ENDS.get(chain[0], S.FIRST_END), S.LAST_ENDS.get(chain[-1], S.LAST_END)
        bases = [(1, first), *[(chain.count(a), pk) for a, pk in S.BASES.items()]]
        acids = [(1, last), *[(chain.count(a), pk) for a, pk in S.ACIDS.items()]]
        charge = sum(n / (1 + 10 ** (found[i] - pk)) for n, pk in bases) - sum(n / (1 + 10 ** (pk - found[i])) for n, pk in acids)
        assert abs(charge) < 1e-3
    assert found[1] < 4.2 and found[2] > 11.5 and 5 < found[3] < 6
