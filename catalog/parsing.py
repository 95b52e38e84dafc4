"""Text parsing queries: ids, pH, temperature, codes."""

from pyspark.sql import functions as F

from assayflow.functions import text as X
from assayflow.operators import parsing
from catalog import query
from catalog.views import over, view

NUM = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"

# --- statements in the check engine's dialect; written apart from the Spark expressions ---

SQL_FIRST_INT = rf"""case
 when regexp_matches(trim(id_text), '^\[ *\]$') then null
 when regexp_matches(trim(id_text), '^{NUM} *, *{NUM}$') then null
 when regexp_matches(trim(id_text), '^0[0-9]+$') then trim(id_text)::bigint
 when regexp_matches(trim(id_text), '^{NUM}$') then trunc(trim(id_text)::double)::bigint
 when trim(id_text) like '[%' then nullif(regexp_extract(id_text, '[0-9]+'), '')::bigint
 else nullif(regexp_extract(id_text, '[0-9]+'), '')::bigint end"""

SQL_NORMAL_ID = rf"""case
 when regexp_matches(trim(id_text), '^{NUM}$') then trunc(trim(id_text)::double)::bigint
 when trim(id_text) like '[%' then nullif(regexp_extract(id_text, '[0-9]+'), '')::bigint end"""

SQL_PH_SIMPLE = r"""case when ph_text is null then null
 when contains(lower(ph_text),'nd') or contains(lower(ph_text),'ud') or contains(lower(ph_text),'n.d.')
   or contains(lower(ph_text),'unknown') then null
 when contains(lower(ph_text),'negligible') then 0.0
 else nullif(regexp_extract(ph_text, '[0-9]+(\.[0-9]+)?'), '')::double end"""

SQL_TEMP_SIMPLE = r"""case when temp_text is null then null when contains(lower(temp_text),'room') then 22.0
 when contains(lower(temp_text),'nd') or contains(lower(temp_text),'unknown') then null
 when contains(lower(temp_text),'k') and not contains(lower(temp_text),'°c')
   then nullif(regexp_extract(temp_text, '[0-9]+(\.[0-9]+)?'), '')::double - 273.15
 else nullif(regexp_extract(temp_text, '[0-9]+(\.[0-9]+)?'), '')::double end"""

SQL_PH_RICH = r"""
, t as (select ph_text, lower(trim(ph_text)) as t from v),
p as (select ph_text, t,
  t is null or t='' or contains(t,'unknown') or contains(t,'n/a') or contains(t,'—') or contains(t,'–') as gone,
  case when contains(t,'neutral') then 7.0 when contains(t,'acidic') then 5.0
   when contains(t,'basic') or contains(t,'alkaline') then 9.0 end::double as word,
  regexp_matches(t,'^p?h?\s*([0-9.]+)\s*[-–to]+\s*([0-9.]+)') as is_range,
  try_cast(regexp_extract(t,'^p?h?\s*([0-9.]+)\s*[-–to]+\s*([0-9.]+)',1) as double) as lo,
  try_cast(regexp_extract(t,'^p?h?\s*([0-9.]+)\s*[-–to]+\s*([0-9.]+)',2) as double) as hi,
  regexp_matches(t,'^p?h?\s*[0-9.]+') as is_number,
  try_cast(regexp_extract(t,'^p?h?\s*([0-9.]+)',1) as double) as single from t),
r as (select ph_text, case when gone then null when word is not null then word when is_range then (lo+hi)/2
   when is_number then single end as pH_value,
  case when gone then 'unavailable' when word is not null then 'word'
   when is_number and (case when is_range then (lo+hi)/2 else single end) is not null then 'valid'
   when is_number then 'failed' else 'unrecognized' end as pH_status from p)
"""

SQL_PREPASS = r"""case when temp_text is null then null
 when contains(s,'room temperature') or contains(s,'ambient temperature') or regexp_matches(s,'\brt\b')
  then coalesce(nullif(regexp_extract(s,'([0-9]+(\.[0-9]+)?)\s*°?\s*c',1),'') || '°C', '22°C')
 when contains(s,'not mentioned') then null else trim(s, ' ,;()[]') end"""


def sql_temperature(strict: bool) -> str:
    joint = "[-–—to]" if strict else "(?:[-–—]|to)"
    power = r"[+-]?[0-9]*\.?[0-9]+\s*x\s*10\^?[+-]?[0-9]+"
    plain = r"[+-]?[0-9]*\.?[0-9]+(?:[e][+-]?[0-9]+)?"
    tokens = plain if strict else f"{power}|{plain}"
    dashed = "u" if strict else r"regexp_replace(u, '([0-9.])\s*-\s*([0-9.])', '\1 ~ \2', 'g')"
    lead = "" if strict else r"[0-9][^0-9a-z]*(?:deg(?:rees?)?)?[^0-9a-z]*"
    value = lambda tok: (rf"case when regexp_matches({tok},'x') then regexp_extract({tok},'^([+-]?[0-9]*\.?[0-9]+)',1)::double"
                         rf" * power(10, regexp_extract({tok},'10\^?([+-]?[0-9]+)$',1)::int) else try_cast({tok} as double) end")
    return rf"""
, s0 as (select temp_text, regexp_replace(lower(trim(temp_text)), 'ph\s*[0-9]+(\.[0-9]+)?\s*,?\s*', '', 'g') as s from v),
s1 as (select temp_text, {SQL_PREPASS} as pre from s0),
s2 as (select *, regexp_replace(replace(replace(trim(pre),'×','x'),'X','x'),'\s+',' ','g') as t from s1),
s3 as (select *, regexp_matches(t,'(?i)^\s*[0-9.+\-eEx^ ]') as hit,
  trim(regexp_extract(t,'(?i)^\s*([0-9.+\-ex^ ]+(?:\s*(?:±|{joint})\s*[0-9.+\-ex^ ]+)?)\s*(.*)$',1)) as g1,
  trim(regexp_extract(t,'(?i)^\s*([0-9.+\-ex^ ]+(?:\s*(?:±|{joint})\s*[0-9.+\-ex^ ]+)?)\s*(.*)$',2)) as g2 from s2),
s4 as (select *, case when hit then g1 else coalesce(t,'') end as seg, coalesce(hit and g2<>'', false) as had_unit from s3),
s5 as (select *, regexp_replace(regexp_replace(translate(lower(seg),'–—−','---'),'\bto\b','-','g'),'\s*±\s*[0-9.e+\-]+','','g') as u from s4),
s6 as (select *, regexp_extract_all({dashed}, '{tokens}') as toks from s5),
s7 as (select *, case when len(toks)=0 then null when len(toks)=1 then {value('toks[1]')}
   else (({value('toks[1]')}) + ({value('toks[2]')}))/2 end as num,
  case when regexp_matches(pre,'(?i){lead}c\b') then 'C' when regexp_matches(pre,'(?i){lead}k\b') then 'K'
   when regexp_matches(pre,'(?i){lead}f\b') then 'F' end as unit,
  coalesce(trim(pre)='', true) as gone from s6),
r as (select temp_text, pre, seg, had_unit, num, round(case when gone then null when unit='C' then num when unit='K' then num-273.15
   when unit='F' then (num-32)*5/9 when not had_unit then num end, 6) as temperature_C,
  case when gone then 'unavailable' when num is null then 'failed' when unit is not null then 'valid'
   when not had_unit then 'assumed' else 'unrecognized' end as temperature_status from s7)
"""


def _counted(df, *columns):
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


@query("first_int", over("v_dirty", f"select id_text, ({SQL_FIRST_INT})::double as cid, count(*) as n from v group by all"))
def first_int(spark, sf_dir):
    df = view(spark, sf_dir, "v_dirty", spread=True).select("id_text", F.col("id_text").alias("cid"))
    return _counted(parsing.normalize_ids(df, ["cid"]), "id_text", F.col("cid").cast("double").alias("cid"))


@query("first_int_of_list", "select l_orderkey, l_linenumber, case when l_partkey%3>0 then l_partkey::double end as cid from lineitem")
def first_int_of_list(spark, sf_dir):
    df = spark.sql("""select l_orderkey, l_linenumber, case l_partkey%3 when 0 then cast(array() as array<bigint>)
                      when 1 then array(l_partkey, l_suppkey) else array(l_partkey) end as cid from {lineitem}""",
                   lineitem=spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    return parsing.normalize_ids(df, ["cid"]).withColumn("cid", F.col("cid").cast("double"))


@query("normalize_id", over("v_dirty", f"select id_text, ({SQL_NORMAL_ID})::double as cid, count(*) as n from v group by all"))
def normalize_id(spark, sf_dir):
    df = view(spark, sf_dir, "v_dirty", spread=True).select("id_text", F.col("id_text").alias("cid"))
    return _counted(parsing.normalize_ids(df, ["cid"], strict=True), "id_text", F.col("cid").cast("double").alias("cid"))


@query("clean_ph_simple", over("v_dirty", f"select ph_text, {SQL_PH_SIMPLE} as pH_value, count(*) as n from v group by all"))
def clean_ph_simple(spark, sf_dir):
    df = parsing.standardize_ph(view(spark, sf_dir, "v_dirty"), "ph_text")
    return _counted(df, "ph_text", "pH_value")


@query("clean_temp_simple", over("v_dirty", f"select temp_text, round({SQL_TEMP_SIMPLE},6) as temperature_C, count(*) as n from v group by all"))
def clean_temp_simple(spark, sf_dir):
    df = parsing.standardize_temperature(view(spark, sf_dir, "v_dirty"), "temp_text")
    return _counted(df, "temp_text", F.round("temperature_C", 6).alias("temperature_C"))


@query("clean_ph_rich", over("v_dirty", SQL_PH_RICH + "select ph_text, pH_value, pH_status, count(*) as n from r group by all"))
def clean_ph_rich(spark, sf_dir):
    df = parsing.standardize_ph(view(spark, sf_dir, "v_dirty"), "ph_text", "rich")
    return _counted(df, "ph_text", "pH_value", "pH_status")


@query("temp_prepass", over("v_dirty", sql_temperature(False) + "select temp_text, pre, count(*) as n from r group by all"))
def temp_prepass(spark, sf_dir):
    df = view(spark, sf_dir, "v_dirty")
    return _counted(df, "temp_text", X.temperature_prepass(X.without_ph(F.col("temp_text"))).alias("pre"))


@query("numeric_segment", over("v_dirty", sql_temperature(False) + "select pre, seg, had_unit, count(*) as n from r group by all"))
def numeric_segment(spark, sf_dir):
    df = parsing.temperature_steps(view(spark, sf_dir, "v_dirty"), F.col("temp_text"))
    return _counted(df, F.col("_pre").alias("pre"), F.col("_segment.segment").alias("seg"),
                    F.col("_segment.had_unit").alias("had_unit"))


@query("numeric_or_range", over("v_dirty", sql_temperature(False) + "select seg, round(num,6) as num, count(*) as n from r group by all"))
def numeric_or_range(spark, sf_dir):
    df = parsing.temperature_steps(view(spark, sf_dir, "v_dirty"), F.col("temp_text"))
    return _counted(df, F.col("_segment.segment").alias("seg"), F.round("_number", 6).alias("num"))


RICH = "select temp_text, temperature_C, temperature_status, count(*) as n from r group by all"


@query("clean_temp_rich", over("v_dirty", sql_temperature(False) + RICH))
def clean_temp_rich(spark, sf_dir):
    df = parsing.standardize_temperature(view(spark, sf_dir, "v_dirty"), "temp_text", "rich")
    return _counted(df, "temp_text", F.round("temperature_C", 6).alias("temperature_C"), "temperature_status")


@query("clean_temp_strict", over("v_dirty", sql_temperature(True) + RICH))
def clean_temp_strict(spark, sf_dir):
    df = parsing.standardize_temperature(view(spark, sf_dir, "v_dirty"), "temp_text", "rich", strict_parity=True)
    return _counted(df, "temp_text", F.round("temperature_C", 6).alias("temperature_C"), "temperature_status")


@query("clean_temp_assay", over("v_assay", sql_temperature(False) + RICH))
def clean_temp_assay(spark, sf_dir):
    df = parsing.standardize_temperature(view(spark, sf_dir, "v_assay"), "temp_text", "rich")
    return _counted(df, "temp_text", F.round("temperature_C", 6).alias("temperature_C"), "temperature_status")


@query("parse_status_counts", over("v_dirty", sql_temperature(False) + "select temperature_status as status, count(*) as n from r group by all"))
def parse_status_counts(spark, sf_dir):
    df = parsing.standardize_temperature(view(spark, sf_dir, "v_dirty"), "temp_text", "rich")
    return parsing.parse_status_counts(df, "temperature_status")


@query("expand_code_levels", over("v_assay", """
select row_id, code, try_cast(split_part(code,'.',1) as double) as code_level1, try_cast(split_part(code,'.',2) as double) as code_level2,
 try_cast(split_part(code,'.',3) as double) as code_level3, try_cast(nullif(split_part(code,'.',4),'-') as double) as code_level4 from v"""))
def expand_code_levels(spark, sf_dir):
    df = view(spark, sf_dir, "v_assay").select("row_id", "code")
    levels = parsing.expand_codes(df, "code")
    return levels.withColumns({c: F.col(c).cast("double") for c in levels.columns[2:]})


@query("split_code_list", over("v_dirty", """
, p as (select l_orderkey, l_linenumber, codes,
  case when codes is null or trim(codes) in ('','None','nan','NaN','null') then []
   else list_filter(list_transform(string_split(codes, case when contains(codes,';') then ';' else ',' end), lambda x: trim(x)), lambda x: x<>'') end as l from v)
select codes, array_to_string(l,'|') as joined, len(l) as n_codes, count(*) as n from p group by all"""))
def split_code_list(spark, sf_dir):
    df = view(spark, sf_dir, "v_dirty").withColumn("l", X.code_list(F.col("codes")))
    return _counted(df, "codes", F.array_join("l", "|").alias("joined"), F.size("l").cast("bigint").alias("n_codes"))
