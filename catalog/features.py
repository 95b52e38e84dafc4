"""Feature reduction queries."""

import uuid

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from assayflow.functions.notation import folded_bits
from assayflow.operators import features
from assayflow.operators.notations import add_notation_features
from assayflow.sources.tables import cut_lineage, shared_folder
from catalog import query
from catalog.statistics import BITS, CORR5, PAIRS5, _pair
from catalog.views import over, table, view


@query("corr_prune", over("v_corr5", ", r as (" + " union all ".join(_pair(x, y) for x, y in PAIRS5) + """)
select c as "column", not exists (select 1 from r where r.y=c and abs(r.r)>0.9) as kept
from (select unnest(['x0','x1','x2','x3','x4']) as c)"""))
def corr_prune(spark, sf_dir):
    return features.pruned_columns(view(spark, sf_dir, "v_corr5", spread=True), CORR5)


@query("variance_filter", f"""with {BITS},
c as (select bit, count(*) as n_on from o group by bit), t as (select count(*)::double as n from pages),
p as (select b.bit, coalesce(n_on,0)/n*(1-coalesce(n_on,0)/n) as variance
 from (select unnest(range(256))::int as bit) b left join c using (bit), t)
select bit, round(variance,6) as variance, variance>0.01 as kept from p""")
def variance_filter(spark, sf_dir):
    bits = view(spark, sf_dir, "v_notation").select(folded_bits(F.col("notation"), 256).alias("bits"))
    return features.variance_filter(bits, "bits", 256).withColumn("variance", F.round("variance", 6))


@query("median_impute", over("v_corr5", """
, m as (select quantile_cont(x4,0.5) as m4, quantile_cont(x3,0.5) as m3 from v)
select x0, round(coalesce(x3,m3),6) as x3, round(coalesce(x4,m4),6) as x4 from v, m"""))
def median_impute(spark, sf_dir):
    df = features.median_impute(view(spark, sf_dir, "v_corr5").select("x0", "x3", "x4"), ["x3", "x4"])
    return df.withColumns({c: F.round(c, 6) for c in ("x3", "x4")})


@query("standardize", over("v_corr5", """
, s as (select avg(x0) as a0, stddev_pop(x0) as s0, avg(x4) as a4, stddev_pop(x4) as s4 from v)
select round((x0-a0)/s0,5)+0.0 as x0, x2, round((x4-a4)/s4,5)+0.0 as x4 from v, s"""))
def standardize(spark, sf_dir):
    df = features.standardize(view(spark, sf_dir, "v_corr5").select("x0", "x2", "x4"), ["x0", "x4"])
    return df.withColumns({c: F.round(c, 5) + F.lit(0.0) for c in ("x0", "x4")})


@query("fitted_state", over("v_corr5", """
, s as (select avg(x0) as a0, stddev_pop(x0) as s0, avg(x2) as a2, stddev_pop(x2) as s2, avg(x3) as a3, stddev_pop(x3) as s3 from v)
select round((x0-a0)/s0,5)+0.0 as z0, round((x2-a2)/s2,5)+0.0 as z2, round((x3-a3)/s3,5)+0.0 as z3 from v, s"""))
def fitted_state(spark, sf_dir):
    """What was fitted is saved, loaded and applied."""
    df = view(spark, sf_dir, "v_corr5").select("x0", "x2", "x3")
    path = f"{shared_folder(spark)}/state/{uuid.uuid4().hex}"
    features.fit_features(df, ["x0", "x2", "x3"]).save(spark, path)
    parts = vector_to_array("features")
    done = features.FeatureModel.load(spark, path).transform(df)
    return done.select(*[(F.round(parts[i], 5) + F.lit(0.0)).alias(c) for i, c in enumerate(("z0", "z2", "z3"))])


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))


@query("pca_project")
def pca_project(spark, sf_dir):
    df = _vectors(spark, sf_dir)
    scaler, pca = features.fit_projection(df, "v", 10)
    return pca.transform(scaler.transform(df)).select("vec_id", vector_to_array("_projected").alias("projected"))


@query("pca_explained")
def pca_explained(spark, sf_dir):
    df = _vectors(spark, sf_dir)
    _, pca = features.fit_projection(df, "v", 64)
    return features.explained_variance(pca, df)


@query("pca_explained_pair", over("v_corr5", """
, r as (select abs(corr(x0,x2)) as r from v)
select 1 as component, round((1+r)/2,6) as ratio, round((1+r)/2,6) as cumulative, (1+r)/2>=0.95 as reaches_line from r
union all select 2, round((1-r)/2,6), 1.0, true from r"""))
def pca_explained_pair(spark, sf_dir):
    df = features.standardize(view(spark, sf_dir, "v_corr5").select("x0", "x2"), ["x0", "x2"])
    df = df.select(array_to_vector(F.array("x0", "x2")).alias("v"))
    _, pca = features.fit_projection(df, "v", 2)
    return features.explained_variance(pca, df).withColumns({c: F.round(c, 6) for c in ("ratio", "cumulative")})


@query("pca_project_pair", over("v_corr5", """
, s as (select avg(x0) as a0, stddev_pop(x0) as s0, avg(x2) as a2, stddev_pop(x2) as s2, sign(corr(x0,x2)) as r from v)
select x0, x2, round(abs((x0-a0)/s0 + r*(x2-a2)/s2)/sqrt(2),5) as first, round(abs((x0-a0)/s0 - r*(x2-a2)/s2)/sqrt(2),5) as second
from v, s"""))
def pca_project_pair(spark, sf_dir):
    df = view(spark, sf_dir, "v_corr5").select("x0", "x2")
    scaled = features.standardize(df.withColumns({"z0": F.col("x0"), "z2": F.col("x2")}), ["z0", "z2"])
    scaled = scaled.select("x0", "x2", array_to_vector(F.array("z0", "z2")).alias("v"))
    scaler, pca = features.fit_projection(scaled, "v", 2)
    return pca.transform(scaler.transform(scaled)).select(
        "x0", "x2", *[F.round(F.abs(vector_to_array("_projected")[i]), 5).alias(n) for i, n in enumerate(("first", "second"))])


@query("prepare_features_bits", f"""with {BITS},
t as (select count(*)::double as n, avg(length(url)) as m, stddev_pop(length(url)) as s from pages),
k as (select bit from o, t group by bit, n having count(*)/n*(1-count(*)/n) > 0.01),
c as (select row_id, count(*) as n_on from o join k using (bit) group by row_id)
select page_id as row_id, round((length(url)-m)/s,5)+0.0 as scaled_length, coalesce(n_on,0)::double as n_on
from pages left join c on page_id=row_id, t""")
def prepare_features_bits(spark, sf_dir):
    df = _page_rows(spark, sf_dir)
    out = features.fit_features(df, ["tok_length"], "fp_bits", components=None).transform(df)
    parts = vector_to_array("features")
    total = F.aggregate(F.slice(parts, 2, 256), F.lit(0.0), lambda a, x: a + x)
    return out.select("row_id", (F.round(parts[0], 5) + F.lit(0.0)).alias("scaled_length"), total.alias("n_on"))


def _page_rows(spark, sf_dir):
    rows = cut_lineage(add_notation_features(view(spark, sf_dir, "v_notation", spread=True), "notation"))
    return rows.withColumn("kcat_value", F.col("tok_length").cast("double"))


@query("prepare_features")
def prepare_features(spark, sf_dir):
    df = _page_rows(spark, sf_dir)
    columns = [c for c in df.columns if c.startswith("tok_")]
    model = features.fit_features(df, columns, "fp_bits", components=20)
    return model.transform(df).select("row_id", "kcat_value", vector_to_array("features").alias("features"))


@query("prepare_features_continuous", over("v_corr5", """
, f as (select x0, x2, x3 from v), s as (select avg(x0) as a0, stddev_pop(x0) as s0, avg(x2) as a2, stddev_pop(x2) as s2,
 avg(x3) as a3, stddev_pop(x3) as s3 from f)
select round((x0-a0)/s0,5)+0.0 as f0, round((x2-a2)/s2,5)+0.0 as f1, round((x3-a3)/s3,5)+0.0 as f2 from f, s"""))
def prepare_features_continuous(spark, sf_dir):
    df = view(spark, sf_dir, "v_corr5")
    out = features.fit_features(df, CORR5).transform(df)
    parts = vector_to_array("features")
    return out.select(*[(F.round(parts[i], 5) + F.lit(0.0)).alias(f"f{i}") for i in range(3)])
