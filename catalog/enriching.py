"""Lookup queries."""

from pyspark.sql import functions as F

from assayflow.operators import enrich
from catalog import query
from catalog.views import over, table, text_of, view


@query("enrich_left_join", """
with v as (select l_orderkey, l_linenumber, case when l_partkey%9=0 then null else l_partkey*2 end as cid from lineitem)
select l_orderkey, l_linenumber, cid::double as cid, p_size::double as p_size, p_retailprice from v left join part on cid=p_partkey""")
def enrich_left_join(spark, sf_dir):
    rows = spark.sql("""select l_orderkey, l_linenumber, case when l_partkey%9=0 then null else l_partkey*2 end as cid
                        from {lineitem}""", lineitem=table(spark, sf_dir, "lineitem"))
    properties = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("cid"), "p_size", "p_retailprice")
    joined = enrich.enrich_left_join(rows, properties, "cid")
    return joined.select("l_orderkey", "l_linenumber", F.col("cid").cast("double").alias("cid"),
                         F.col("p_size").cast("double").alias("p_size"), "p_retailprice")


@query("distinct_keys", over("v_assay", r"""
select distinct coalesce(nullif(regexp_extract(id_text,'^\[([0-9]+)',1),''), case when regexp_matches(id_text,'^[0-9]+$') then id_text end)::bigint as id_text
from v where regexp_matches(id_text,'[0-9]')"""))
def distinct_keys(spark, sf_dir):
    return enrich.distinct_keys(view(spark, sf_dir, "v_assay"), "id_text")


PER_CODE = "g as (select code, " + ", ".join(
    f"coalesce({f}(case when measure='{m}' and value>0 then log10(value) end),0.0) as {m}_{n}"
    for m in ("km", "kcat") for n, f in (("min", "min"), ("max", "max"), ("mean", "avg"))) + " from u group by code)"
PER_CODE_NULL = PER_CODE.replace("coalesce(", "(").replace(",0.0)", ")")


@query("log_min_max_mean", over("v_lookup", ", " + PER_CODE + " select code, " + ", ".join(
    f"round({m}_{n},6)+0.0 as {m}_{n}" for m in ("km", "kcat") for n in ("min", "max", "mean")) + " from g", "u"))
def log_min_max_mean(spark, sf_dir):
    df = enrich.log_min_max_mean(view(spark, sf_dir, "v_lookup"), "code", "measure", "value", ("km", "kcat"))
    return df.select("code", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in df.columns[1:]])


def _code_list_sql(absent):
    filled = (lambda c: f"coalesce({c},0.0)") if absent == "zero" else (lambda c: c)
    outer = ", ".join(f"round({filled(f'{m}_{n}')},6)+0.0 as {m}_{n}" for m in ("km", "kcat") for n in ("min", "max", "mean"))
    combined = ", ".join(f"{f}({filled(f'{m}_{n}')}) as {m}_{n}" for m in ("km", "kcat")
                         for n, f in (("min", "min"), ("max", "max"), ("mean", "avg")))
    per_code = PER_CODE if absent == "zero" else PER_CODE_NULL
    return over("v_lookup", f""", {per_code}, v as ({text_of('v_dirty')}),
r as (select row_number() over () as rid, l_orderkey, l_linenumber, codes from v),
x as (select rid, unnest(case when codes is null or trim(codes) in ('','None','nan','NaN','null') then []
  else list_filter(list_transform(string_split(codes, case when contains(codes,';') then ';' else ',' end), lambda x: trim(x)), lambda x: x<>'') end) as code from r),
s as (select rid, max(case when g.code is not null then 1 else 0 end)::int as has_match, {combined} from x left join g using (code) group by rid)
select l_orderkey, l_linenumber, codes, coalesce(has_match,0) as has_match, {outer} from r left join s using (rid)""", "u")


def _code_list(spark, sf_dir, absent):
    rows = view(spark, sf_dir, "v_dirty").select("l_orderkey", "l_linenumber", "codes")
    df = enrich.code_list_enrich(rows, "codes", view(spark, sf_dir, "v_lookup"), absent=absent)
    names = [f"{m}_{n}" for m in ("km", "kcat") for n in ("min", "max", "mean")]
    return df.select("l_orderkey", "l_linenumber", "codes", "has_match", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in names])


@query("code_list_enrich", _code_list_sql("zero"))
def code_list_enrich(spark, sf_dir):
    return _code_list(spark, sf_dir, "zero")


@query("code_list_enrich_null", _code_list_sql("null"))
def code_list_enrich_null(spark, sf_dir):
    return _code_list(spark, sf_dir, "null")
