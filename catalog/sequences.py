"""Sequence and notation feature queries."""

from pyspark.sql import functions as F

from assayflow.functions import sequence as S
from assayflow.operators import neighbours, notations, sequences
from catalog import query
from catalog.views import over, view

L = S.LETTERS
MASS = ("A 89.0932 C 121.1582 D 133.1027 E 147.1293 F 165.1891 G 75.0666 H 155.1546 I 131.1729 K 146.1876 L 131.1729 "
        "M 149.2113 N 132.1179 P 115.1305 Q 146.1445 R 174.2010 S 105.0926 T 119.1192 V 117.1463 W 204.2252 Y 181.1885").split()
HYDROPATHY = ("A 1.8 C 2.5 D -3.5 E -3.5 F 2.8 G -0.4 H -3.2 I 4.5 K -3.9 L 3.8 M 1.9 N -3.5 P -1.6 Q -3.5 R -4.5 "
              "S -0.8 T -0.7 V 4.2 W -0.9 Y -1.3").split()


def _pairs(flat):
    return list(zip(flat[::2], flat[1::2]))


SEQ_SQL = f"""
, t as (select row_id, translate(upper(regexp_replace(regexp_replace(sequence, '\\([^)]*\\)', '', 'g'), '[^A-Za-z]', '', 'g')),
  'UOBZJ', 'CKDEL') as letters from v),
c as (select row_id, letters, regexp_replace(letters, '[^{L}]', '', 'g') as clean, length(letters) as orig_len from t),
k as (select row_id, orig_len, case when length(clean)>0 and orig_len>=10 then clean end as clean,
  1.0 - length(clean)::double/nullif(orig_len,0) as unknown from c),
n as (select *, length(clean)::double as len, {', '.join(f"(length(clean)-length(replace(clean,'{a}','')))::double as n_{a}" for a in L)} from k)
"""


def _share(letters):
    return "(" + "+".join(f"n_{a}/len" for a in letters) + ")"


def _count(letters):
    return "(" + "+".join(f"n_{a}" for a in letters) + ")"


def _features(spark, sf_dir, *columns, digits=6):
    df = sequences.add_sequence_features(view(spark, sf_dir, "v_seq", spread=True), "sequence")
    return df.select("row_id", *[(F.round(F.col(c).cast("double"), digits) + F.lit(0.0)).alias(c) for c in columns])


@query("normalize_sequence", over("v_seq", SEQ_SQL + """
select row_id, md5(clean) as clean_hash, orig_len::double as orig_len, round(unknown,6)+0.0 as unknown_frac
from (select row_id, clean, orig_len, 1.0-length(clean)::double/nullif(orig_len,0) as unknown from c)"""))
def normalize_sequence(spark, sf_dir):
    df = sequences.normalize_sequence(view(spark, sf_dir, "v_seq", spread=True), "sequence")
    return df.select("row_id", F.md5("clean_sequence").alias("clean_hash"), F.col("orig_len").cast("double").alias("orig_len"),
                     (F.round("unknown_frac", 6) + F.lit(0.0)).alias("unknown_frac"))


@query("letter_composition", over("v_seq", SEQ_SQL + "select row_id, "
                                  + ", ".join(f"round(n_{a}/len,6) as aa_{a}" for a in L) + " from n"))
def letter_composition(spark, sf_dir):
    return _features(spark, sf_dir, *[f"aa_{a}" for a in L])


@query("group_fractions", over("v_seq", SEQ_SQL + f"""select row_id, round({_share('AVILMFWY')},6) as frac_hydrophobic,
 round({_share('STNQ')},6) as frac_polar, round({_share('KRH')},6) as frac_charged_pos, round({_share('DE')},6) as frac_charged_neg from n"""))
def group_fractions(spark, sf_dir):
    return _features(spark, sf_dir, "frac_hydrophobic", "frac_polar", "frac_charged_pos", "frac_charged_neg")


@query("charge_features", over("v_seq", SEQ_SQL + f"""select row_id, {_count('KRH')}-{_count('DE')} as net_charge_pH7_approx,
 round(({_count('KRH')}+1e-6)/({_count('DE')}+1e-6),4) as charge_ratio_pos_neg from n"""))
def charge_features(spark, sf_dir):
    return _features(spark, sf_dir, "net_charge_pH7_approx").join(
        _features(spark, sf_dir, "charge_ratio_pos_neg", digits=4), "row_id")


@query("aliphatic_index", over("v_seq", SEQ_SQL + """
select row_id, round(n_A/len + 2.9*(n_V/len) + 3.9*(n_I/len+n_L/len),6) as aliphatic_index from n"""))
def aliphatic_index(spark, sf_dir):
    return _features(spark, sf_dir, "aliphatic_index")


@query("letter_entropy", over("v_seq", SEQ_SQL + "select row_id, case when len is not null then round("
                              + "+".join(f"case when n_{a}>0 then -(n_{a}/len)*log2(n_{a}/len) else 0 end" for a in L)
                              + ",6)+0.0 end as aa_entropy from n"))
def letter_entropy(spark, sf_dir):
    return _features(spark, sf_dir, "aa_entropy")


@query("low_complexity", over("v_seq", SEQ_SQL + "select row_id, round((len-length(regexp_replace(clean, '"
                              + "|".join(f"{a}{{3,}}" for a in L) + "', '', 'g')))/len,6) as low_complexity_frac from n"))
def low_complexity(spark, sf_dir):
    return _features(spark, sf_dir, "low_complexity_frac")


@query("weighted_composition", over("v_seq", SEQ_SQL + f"""select row_id, round({_share('YWF')},6) as aromaticity,
 round({'+'.join(f'(n_{a}/len)*({w})' for a, w in _pairs(HYDROPATHY))},6)+0.0 as gravy,
 round({'+'.join(f'n_{a}*{w}' for a, w in _pairs(MASS))} - (len-1)*18.0153,4) as mol_weight,
 round({_share('EMALK')},6) as frac_helix, round({_share('NPGSD')},6) as frac_turn, round({_share('VIYFWLT')},6) as frac_sheet,
 n_W*5500+n_Y*1490 as ext_coeff_reduced, n_W*5500+n_Y*1490+floor(n_C/2)*125 as ext_coeff_oxidized from n"""))
def weighted_composition(spark, sf_dir):
    return _features(spark, sf_dir, "aromaticity", "gravy", "frac_helix", "frac_turn", "frac_sheet", "ext_coeff_reduced",
                     "ext_coeff_oxidized").join(_features(spark, sf_dir, "mol_weight", digits=4), "row_id")


# The weights are those of a made-up table: 1 + position of the first letter - half the position of the second.
WEIGHTS_SQL = f"""select substr('{L}',i::int,1)||substr('{L}',j::int,1) as pair, 1.0+i-j*0.5 as weight
 from (select unnest(range(1,21)) as i) a, (select unnest(range(1,21)) as j) b"""


def _ends_sql(letter, other, known):
    return f"case {letter} " + " ".join(f"when '{a}' then {pk}" for a, pk in known.items()) + f" else {other} end"


def _charge_sql(ph):
    plus = [f"1/(1+power(10.0,({ph})-first_end))", *[f"n_{a}/(1+power(10.0,({ph})-{pk}))" for a, pk in S.BASES.items()]]
    minus = [f"1/(1+power(10.0,last_end-({ph})))", *[f"n_{a}/(1+power(10.0,{pk}-({ph})))" for a, pk in S.ACIDS.items()]]
    return f"({'+'.join(plus)}-({'+'.join(minus)}))"


@query("isoelectric_point", over("v_seq", SEQ_SQL + f""", p as (
  select *, {_ends_sql("clean[1]", S.FIRST_END, S.FIRST_ENDS)} as first_end, {_ends_sql("clean[-1]", S.LAST_END, S.LAST_ENDS)} as last_end from n where clean is not null),
r as (
  select row_id, 0 as step, 0.0::double as low, {S.WIDEST_PH}::double as high from p
  union all select row_id, step + 1, case when charge > 0 then middle else low end, case when charge > 0 then high else middle end
  from (select row_id, step, low, high, (low + high) / 2 as middle, {_charge_sql("(low + high) / 2")} as charge from r join p using (row_id)) where step < {S.HALVINGS})
select n.row_id, round((low + high) / 2, 6) as isoelectric_point from n left join (select * from r where step = {S.HALVINGS}) h on h.row_id = n.row_id""")
       .replace("with v as", "with recursive v as", 1))
def isoelectric_point(spark, sf_dir):
    df = sequences.add_isoelectric_point(view(spark, sf_dir, "v_seq", spread=True), "sequence")
    return df.select("row_id", F.round("isoelectric_point", 6).alias("isoelectric_point"))


@query("bigram_score", over("v_seq", SEQ_SQL + f""", w as ({WEIGHTS_SQL}),
 g as (select row_id, len, substr(clean, u::bigint, 2) as pair from (select row_id, len, clean, unnest(range(1, len::bigint)) as u from n)),
 s as (select row_id, 10.0/len*sum(weight) as score from g join w using (pair) group by row_id, len)
select n.row_id, round(score,4) as score from n left join s on n.row_id=s.row_id"""))
def bigram_score(spark, sf_dir):
    weights = [(a + b, 1.0 + i - j * 0.5) for i, a in enumerate(L, 1) for j, b in enumerate(L, 1)]
    table = spark.createDataFrame(weights, "pair string, weight double")
    scores = sequences.bigram_score(view(spark, sf_dir, "v_seq", spread=True), "row_id", table)
    return scores.select("row_id", F.round("score", 4).alias("score"))


@query("sequence_guard", over("v_seq", SEQ_SQL + """
select row_id, case when clean is not null then orig_len end::double as sequence_length, len as clean_length,
 case when clean is not null then round(unknown,6)+0.0 end as unknown_frac from n"""))
def sequence_guard(spark, sf_dir):
    return _features(spark, sf_dir, "sequence_length", "clean_length", "unknown_frac")


def _n(pattern, text="notation"):
    return f"len(regexp_extract_all({text}, '{pattern}'))"


@query("notation_token_counts", over("v_notation", f"""
, o as (select *, regexp_replace(notation, '\\[[^\\]]*\\]', '', 'g') as outside from v),
p as (select *, regexp_replace(outside, 'Cl|Br', '', 'g') as plain from o)
select row_id, {_n(r'\[[^\]]*\]')} + {_n('Cl|Br|[BCNOPSFI]|[bcnops]', 'outside')} as tok_atoms,
 {_n(r'\[[^\]]*\]')} + {_n('Cl|Br|[BCNOPSFI]|[bcnops]', 'outside')} - {_n('[Cc]', 'plain')} - {_n(r'\[[0-9]*[Cc][@H0-9+\-:\]]')} as tok_non_carbon,
 {_n('%[0-9]{2}|[0-9]', 'outside')} as tok_ring_marks, {_n(r'\(')} as tok_branches, {_n('[bcnops]', 'plain')} as tok_aromatic,
 {_n('@@?|[/' + chr(92) * 2 + ']')} as tok_stereo, {_n('[=#]')} as tok_multiple_bonds, length(notation) as tok_length from p"""))
def notation_token_counts(spark, sf_dir):
    df = notations.add_notation_features(view(spark, sf_dir, "v_notation", spread=True), "notation")
    return df.select("row_id", *[F.col(c).cast("bigint").alias(c) for c in df.columns if c.startswith("tok_")])


def _fingerprint_sql(bits):
    return over("v_notation", f"""
, r as (select row_id, unnest(list_distinct(list_transform(range(1, length(notation)-1), lambda i: substr(notation, i::bigint, 3)))) as s from v),
o as (select distinct row_id, ('0x'||substr(md5(s),1,8))::bigint % {bits} as bit from r)
select row_id, string_agg(bit::varchar, ',' order by bit) as bits, count(*) as n_on from o group by row_id""")


def _fingerprints(spark, sf_dir, bits):
    df = notations.add_notation_features(view(spark, sf_dir, "v_notation", spread=True), "notation", bits)
    return df.select("row_id", F.array_join(F.col("fp_bits").cast("array<string>"), ",").alias("bits"),
                     F.size("fp_bits").cast("bigint").alias("n_on"))


@query("folded_fingerprint", _fingerprint_sql(256))
def folded_fingerprint(spark, sf_dir):
    return _fingerprints(spark, sf_dir, 256)


@query("folded_fingerprint_wide", _fingerprint_sql(2048))
def folded_fingerprint_wide(spark, sf_dir):
    return _fingerprints(spark, sf_dir, 2048)


@query("jaccard_topk", over("v_notation", """
, r as (select row_id, unnest(list_distinct(list_transform(range(1, length(notation)-1), lambda i: substr(notation, i::bigint, 3)))) as s from v),
o as (select distinct row_id, ('0x'||substr(md5(s),1,8))::bigint % 256 as bit from r),
n as (select row_id, count(*) as n from o group by row_id),
p as (select a.row_id, b.row_id as neighbour, count(*) as hits from o a join o b using (bit) where a.row_id <> b.row_id group by a.row_id, b.row_id),
s as (select p.row_id, neighbour, hits / (a.n + b.n - hits) as similarity from p join n a on a.row_id = p.row_id join n b on b.row_id = neighbour)
select row_id, cast(row_number() over (partition by row_id order by similarity desc, neighbour) as integer) as rank, neighbour, round(similarity, 9) as similarity
from s where similarity >= 0.6 qualify row_number() over (partition by row_id order by similarity desc, neighbour) <= 15"""))
def jaccard_topk(spark, sf_dir):
    df = notations.add_notation_features(view(spark, sf_dir, "v_notation", spread=True), "notation", 256)
    found = neighbours.jaccard_topk(df, "row_id", "fp_bits", 256, k=15, least=0.6)
    return found.withColumn("similarity", F.round("similarity", 9))


@query("log_scale_features", """
select l_orderkey, l_linenumber, round(log10(l_extendedprice),6) as log_price, round(ln(1+l_quantity),6) as log_quantity from lineitem""")
def log_scale_features(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    df = notations.log_scale_features(df, {"l_extendedprice": "log_price"}, {"l_quantity": "log_quantity"})
    return df.withColumns({c: F.round(c, 6) for c in ("log_price", "log_quantity")})
