"""Views that stand in for a measurement table. The same text runs in Spark and in the check engine."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from assayflow.sources.tables import spread_out

VIEWS = {
    "v_assay": """
select concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string),
                 cast(l_partkey as string), cast(l_suppkey as string)) as row_id,
 p_brand as grp, l_partkey as small_grp, l_extendedprice as a, l_quantity as b,
 case l_partkey%8 when 0 then 'pH 7.5' when 1 then '6.5-7.5' when 2 then 'neutral' when 3 then 'unknown'
   when 5 then '8' when 6 then '15.2' when 7 then '7.0 - 8.0' end as ph_text,
 case l_suppkey%9 when 0 then '37 °C' when 1 then '310 K' when 2 then 'room temperature' when 3 then '98.6 F'
   when 5 then 'not mentioned' when 6 then '20 - 25 °C' when 7 then '30 ± 2 °C' when 8 then '150 C' end as temp_text,
 case when l_partkey%5=0 then null else 40+(l_partkey%61) end as similarity,
 case when l_partkey%10<7 then null else l_tax end as sparse_col,
 concat_ws('.', cast(1+l_partkey%7 as string), cast(l_suppkey%20 as string), cast(l_linenumber as string),
   case when l_partkey%11=0 then '-' else cast(l_partkey%99 as string) end) as code,
 case l_partkey%4 when 0 then concat('[',cast(l_partkey as string),', ',cast(l_suppkey as string),']')
   when 1 then cast(l_partkey as string) when 2 then '[]' end as id_text
from {lineitem} join {part} on l_partkey=p_partkey""",
    "v_heavy": """
select event_id as row_id, event_type as grp,
 round(power(10, case when event_type='purchase' and event_id%8=0 then 6.0
                      when event_type='view' and event_id%12=0 then 3.7 when value>0 then log10(value) end),6) as a,
 1.0 as b
from {events}""",
    # Groups with a missing key, missing and useless measures.
    "v_gaps": """
select event_id as row_id, case when user_id%5=0 then null else event_type end as grp,
 case when event_id%11=0 then null when event_id%13=0 then -value when event_id%17=0 then cast('NaN' as double)
      when event_id%19=0 then cast('Infinity' as double) else value end as a,
 case when event_id%7=0 then 0.0 when event_id%23=0 then null else 1.0+user_id%40 end as b
from {events}""",
    "v_seq": "select doc_id as row_id, case when doc_id%17=0 then null else text end as sequence from {documents}",
    "v_notation": "select page_id as row_id, url as notation from {pages}",
    "v_corr5": """
select l_extendedprice as x0, l_extendedprice*1.07+l_tax as x1, l_quantity as x2, l_discount as x3,
 case when l_partkey%7=0 then null else l_quantity*2 end as x4 from {lineitem}""",
    # Every way of writing ids, pH values, temperatures and code lists that the readers know.
    "v_dirty": """
select l_orderkey, l_linenumber,
 case l_orderkey%16 when 0 then concat(q, ' °C') when 1 then concat(q, '-', q5, ' °C')
  when 2 then concat(q, ' to ', q5, ' °C') when 3 then concat(q3, ' x 10^1 °c') when 4 then concat(k, ' K')
  when 5 then concat(q, '.5 ± 0.5 °C') when 6 then concat('pH 7.4, ', q, ' °C') when 7 then 'room temperature'
  when 8 then concat('Room Temperature (', q, ' °C)') when 9 then 'RT' when 10 then ' ' when 11 then 'not mentioned'
  when 12 then q when 13 then concat(q, ' bar') when 14 then 'warm' end as temp_text,
 case l_orderkey%17 when 0 then concat('pH ', q3, '.5') when 1 then 'neutral' when 2 then concat(q3, '–7.5')
  when 3 then '7.0 to 8.0' when 4 then 'nd' when 5 then 'negligible' when 6 then '7.5.3' when 7 then '  '
  when 8 then 'Alkaline buffer' when 9 then 'n/a' when 10 then concat('ph', q3) when 11 then 'buffer'
  when 12 then 'acidic' when 13 then concat(q3, '.0 - 8.0') when 14 then concat('-', q3)
  when 15 then 'standard 7.2' end as ph_text,
 case l_partkey%13 when 0 then concat('[', p, ', 3]') when 1 then concat('[''', p, ''']') when 2 then '[]'
  when 3 then concat(q, '.7') when 4 then '1e3' when 5 then concat('007', q) when 6 then concat('CID:', p)
  when 7 then concat(q, ', ', q5) when 8 then concat('-', q) when 9 then 'none' when 10 then concat(' ', p, ' ')
  when 11 then '[ ]' end as id_text,
 case l_suppkey%7 when 0 then concat(c1, '; ', c2, ' ;') when 1 then concat(c1, ', ', c2) when 2 then c1
  when 3 then ' ' when 4 then 'nan' when 5 then concat(c1, ';', c2, ';', c1, ',', c2) end as codes
from (select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  cast(cast(l_quantity as int) as string) as q, cast(cast(l_quantity as int)+5 as string) as q5,
  cast(1+cast(l_quantity as int)%3 as string) as q3, cast(273+cast(l_quantity as int) as string) as k,
  cast(l_partkey as string) as p,
  concat_ws('.', cast(1+l_partkey%7 as string), cast(l_suppkey%20 as string)) as c1,
  concat_ws('.', cast(1+l_suppkey%7 as string), cast(l_partkey%30 as string)) as c2 from {lineitem}) t""",
    # A flat lookup of reaction values: some codes missing, some values useless.
    "v_lookup": """
select concat_ws('.', cast(1+l_partkey%5 as string), cast(l_suppkey%17 as string)) as code,
 case when l_linenumber%2=0 then 'km' else 'kcat' end as measure,
 case when l_orderkey%10=0 then -1.0 else l_extendedprice/1000 end as value from {lineitem}""",
    # log10 targets with predictions of two models.
    "v_predicted": """
select case when l_linenumber%2=0 then 'km_value' else 'kcat_value' end as target, l_extendedprice as y,
 l_quantity*(p_retailprice+l_discount) as p1, l_quantity*1000*(1+l_tax) as p2
from {lineitem} join {part} on l_partkey=p_partkey""",
}


# Tables that are only looked up; spreading them would be a shuffle for nothing.
LOOKUPS = {"part"}


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A given table; ``spread`` is for queries whose work per row is heavy."""
    scan = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread_out(scan) if spread and name not in LOOKUPS else scan


def view(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    text = VIEWS[name]
    used = set(re.findall(r"\{(\w+)\}", text))
    return spark.sql(text, **{t: table(spark, sf_dir, t, spread) for t in used})


def text_of(name: str) -> str:
    """The view as plain SQL over the registered table names."""
    return re.sub(r"\{(\w+)\}", r"\1", VIEWS[name])


def over(name: str, rest: str, alias: str = "v") -> str:
    """A statement whose common table expression is the view."""
    return f"with {alias} as ({text_of(name)})\n{rest}"
