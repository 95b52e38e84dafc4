"""Scan, cleaning and projection queries. Integers that may be NULL leave as double, in SQL as well."""

from pyspark.ml.functions import vector_to_array
import uuid

from pyspark.sql import functions as F

from assayflow.functions.numbers import coerce_numeric, log10_positive, safe_ratio
from assayflow.operators import clean, stats
from assayflow.operators.models import assemble
from assayflow.sources.tables import (NamedTables, clean_nan, read_bundle, read_table, shared_folder, write_bundle,
                                      write_table)
from catalog import query
from catalog.views import over, table, view


def _round(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _as_double(df, *columns):
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


@query("scan_clean", over("v_gaps", """
select row_id, grp, case when isnan(a) then null else a end as a, b from v"""))
def scan_clean(spark, sf_dir):
    return clean_nan(view(spark, sf_dir, "v_gaps"))


@query("scan_projected", "select l_orderkey, l_quantity, l_extendedprice from lineitem where l_quantity >= 25")
def scan_projected(spark, sf_dir):
    columns = ["l_orderkey", "l_quantity", "l_extendedprice"]
    return read_table(spark, f"{sf_dir}/lineitem.parquet", columns).filter(F.col("l_quantity") >= 25)


@query("roundtrip_parquet", over("v_gaps", "select row_id, grp, case when isnan(a) then null else a end as a, b from v"))
def roundtrip_parquet(spark, sf_dir):
    path = f"{shared_folder(spark)}/roundtrip/{uuid.uuid4().hex}"
    write_table(clean_nan(view(spark, sf_dir, "v_gaps")), path)
    return read_table(spark, path)


@query("named_checkpoint", "select event_type, count(*) as n from events group by event_type")
def named_checkpoint(spark, sf_dir):
    tables = NamedTables(spark, f"{shared_folder(spark)}/named/{uuid.uuid4().hex}")
    tables.save(table(spark, sf_dir, "events").select("event_id", "event_type"), "events_slim")
    return stats.count_by(tables.load("events_slim"), "event_type")


@query("feature_bundle", """
select event_id, value as x, user_id as y, round(value+1,6) as kcat_value from (
 select event_id, round(value,6) as value, cast(user_id as double) as user_id from events)""")
def feature_bundle(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.round("value", 6).alias("x"), F.col("user_id").cast("double").alias("y"))
    rows = assemble(rows.withColumn("kcat_value", F.round(F.col("x") + 1, 6)), ["x", "y"])
    path = f"{shared_folder(spark)}/bundle/{uuid.uuid4().hex}"
    write_bundle(rows, path, "event_id", "features", ["kcat_value", "km_value"], {"features": ["x", "y"]})
    back, meta = read_bundle(spark, path)
    parts = vector_to_array("features")
    return back.select("event_id", *[parts[i].alias(n) for i, n in enumerate(meta["features"])], *meta["targets"])


@query("profile_columns", over("v_assay", """
select 'row_id' as "column", 'string' as data_type, count(*) as n_rows, count(row_id) as n_known from v
union all select 'grp', 'string', count(*), count(grp) from v
union all select 'small_grp', 'bigint', count(*), count(small_grp) from v
union all select 'a', 'double', count(*), count(a) from v
union all select 'b', 'double', count(*), count(b) from v
union all select 'ph_text', 'string', count(*), count(ph_text) from v
union all select 'temp_text', 'string', count(*), count(temp_text) from v
union all select 'similarity', 'bigint', count(*), count(similarity) from v
union all select 'sparse_col', 'double', count(*), count(sparse_col) from v
union all select 'code', 'string', count(*), count(code) from v
union all select 'id_text', 'string', count(*), count(id_text) from v"""))
def profile_columns(spark, sf_dir):
    return stats.profile_columns(view(spark, sf_dir, "v_assay"))


@query("drop_if_present", "select event_id, user_id, event_type from events")
def drop_if_present(spark, sf_dir):
    return clean.drop_if_present(table(spark, sf_dir, "events"), ["value", "props", "ts", "not_there"])


@query("drop_missing_rows", over("v_gaps", "select row_id, grp, a, b from v where a is not null and not isnan(a) and b is not null"))
def drop_missing_rows(spark, sf_dir):
    return clean.drop_missing_rows(view(spark, sf_dir, "v_gaps"), ["a", "b"])


@query("missing_fraction", over("v_assay", """
select 'row_id' as "column", 0.0::double as fraction
union all select 'grp', 0.0 union all select 'small_grp', 0.0 union all select 'a', 0.0 union all select 'b', 0.0
union all select 'ph_text', (select round(avg(case when ph_text is null then 1 else 0 end),6) from v)
union all select 'temp_text', (select round(avg(case when temp_text is null then 1 else 0 end),6) from v)
union all select 'similarity', (select round(avg(case when similarity is null then 1 else 0 end),6) from v)
union all select 'sparse_col', (select round(avg(case when sparse_col is null then 1 else 0 end),6) from v)
union all select 'code', 0.0
union all select 'id_text', (select round(avg(case when id_text is null then 1 else 0 end),6) from v)"""))
def missing_fraction(spark, sf_dir):
    return _round(clean.missing_fraction(view(spark, sf_dir, "v_assay")), "fraction")


@query("drop_sparse_columns", over("v_assay", """
select row_id, grp, small_grp, a, b, ph_text, temp_text, similarity::double as similarity, code, id_text from v"""))
def drop_sparse_columns(spark, sf_dir):
    return _as_double(clean.drop_sparse_columns(view(spark, sf_dir, "v_assay"), 0.6), "similarity")


@query("null_tolerant_filter", over("v_assay", "select row_id, similarity::double as similarity from v where similarity is null or similarity >= 60"))
def null_tolerant_filter(spark, sf_dir):
    kept = clean.null_tolerant_filter(view(spark, sf_dir, "v_assay"), ["similarity", "not_there"], 60)
    return _as_double(kept.select("row_id", "similarity"), "similarity")


@query("basic_clean", over("v_assay", r"""
select row_id, a, b, similarity::double as similarity, case when regexp_matches(id_text,'^[0-9]+$') then id_text::double
  else nullif(regexp_extract(id_text,'^\[([0-9]+)',1),'')::double end as id_text
from v where similarity is null or similarity >= 60"""))
def basic_clean(spark, sf_dir):
    df = view(spark, sf_dir, "v_assay").select("row_id", "a", "b", "similarity", "sparse_col", "id_text", "grp")
    return _as_double(clean.basic_clean(df, ["a", "b"], ["grp"], ["id_text"], ["similarity"]), "similarity", "id_text")


@query("numeric_projection", over("v_assay", "select small_grp, a, b, similarity::double as similarity from v"))
def numeric_projection(spark, sf_dir):
    df = view(spark, sf_dir, "v_assay")
    return _as_double(df.select(*clean.numeric_columns(df, ["sparse_col"])), "similarity")


@query("feature_blocks", """
select 'l_quantity' as "column", 'continuous' as block, sum(l_quantity) as total from lineitem
union all select 'fp_discount', 'fingerprint', round(sum(l_discount),2) from lineitem""")
def feature_blocks(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(
        "l_quantity", F.col("l_discount").alias("fp_discount"),
        F.col("l_tax").alias("kcat_value"))
    continuous, fingerprint = clean.split_feature_blocks(df)
    named = [(c, "continuous") for c in continuous] + [(c, "fingerprint") for c in fingerprint]
    sums = df.agg(*[F.sum(c).alias(c) for c, _ in named])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(b).alias("block"),
                                                   F.round(c, 2).alias("total")) for c, b in named])))


@query("coerce_numeric", over("v_dirty", r"""
select temp_text, ph_text, case when regexp_matches(trim(temp_text),'^[0-9]+$') then trim(temp_text)::double end as t,
 case when regexp_matches(ph_text,'^-?[0-9]+$') then ph_text::double end as p, count(*) as n
from v group by all"""))
def coerce(spark, sf_dir):
    df = view(spark, sf_dir, "v_dirty")
    return df.groupBy("temp_text", "ph_text", coerce_numeric(F.col("temp_text")).alias("t"),
                      coerce_numeric(F.col("ph_text")).alias("p")).agg(F.count(F.lit(1)).alias("n"))


@query("log10_positive", over("v_gaps", """
select row_id, case when a>0 and not isnan(a) and not isinf(a) then round(log10(a),6) end as x from v"""))
def log10(spark, sf_dir):
    return view(spark, sf_dir, "v_gaps").select("row_id", F.round(log10_positive(F.col("a")), 6).alias("x"))


@query("safe_ratio", over("v_gaps", """
select row_id, case when isnan(a/nullif(b,0)) or isinf(a/nullif(b,0)) then null
 else round(a/nullif(b,0),10)+0.0 end as ratio from v"""))
def ratio(spark, sf_dir):
    return view(spark, sf_dir, "v_gaps").select(
        "row_id", (F.round(safe_ratio(F.col("a"), F.col("b")), 10) + F.lit(0.0)).alias("ratio"))


@query("ensure_column", "select event_id, cast(null as varchar) as sequence from events")
def ensure_column(spark, sf_dir):
    return clean.ensure_column(table(spark, sf_dir, "events").select("event_id"), "sequence", "string")


@query("derived_columns", """
select l_orderkey, l_linenumber, round(log10(l_extendedprice),6) as log_price,
 round(l_extendedprice/l_quantity,8) as unit_price from lineitem""")
def derived_columns(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").withColumns({
        "log_price": F.round(log10_positive(F.col("l_extendedprice")), 6),
        "unit_price": F.round(safe_ratio(F.col("l_extendedprice"), F.col("l_quantity")), 8)})
    return df.select("l_orderkey", "l_linenumber", "log_price", "unit_price")


@query("stack_blocks", """
select l_orderkey, l_linenumber, round(l_quantity + 2*l_discount + 3*l_tax, 6) as weighted from lineitem""")
def stack_blocks(spark, sf_dir):
    df = assemble(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount", "l_tax"])
    x = vector_to_array("features")
    return df.select("l_orderkey", "l_linenumber", F.round(x[0] + 2 * x[1] + 3 * x[2], 6).alias("weighted"))


@query("extract_targets", over("v_assay", "select row_id, a as kcat_value, b as km_value from v"))
def extract_targets(spark, sf_dir):
    df = view(spark, sf_dir, "v_assay").withColumnsRenamed({"a": "kcat_value", "b": "km_value"})
    wanted = ["kcat_value", "km_value", "kcat_km"]
    return df.select("row_id", *[t for t in wanted if t in df.columns])


@query("median_fill", over("v_gaps", """
, f as (select row_id, case when isnan(a) or isinf(a) then null else a end as a, b from v),
m as (select quantile_cont(a, 0.5) as ma, quantile_cont(b, 0.5) as mb from f)
select row_id, round(coalesce(a, ma),6) as a, round(coalesce(b, mb),6) as b from f, m"""))
def median_fill(spark, sf_dir):
    filled = clean.median_fill(view(spark, sf_dir, "v_gaps"), ["a", "b"])
    return filled.select("row_id", F.round("a", 6).alias("a"), F.round("b", 6).alias("b"))


@query("winsorize", """
with q as (select quantile_cont(l_extendedprice,0.001) as lo, quantile_cont(l_extendedprice,0.999) as hi from lineitem)
select l_orderkey, l_linenumber, round(least(greatest(l_extendedprice, lo), hi), 4) as price from lineitem, q""")
def winsorize(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"))
    return _round(clean.winsorize(df, ["price"]), "price", digits=4)
