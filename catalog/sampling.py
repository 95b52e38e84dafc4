"""Sampling, splitting and top lists."""

from pyspark.sql import functions as F

from assayflow.operators import sampling
from catalog import query
from catalog.views import over, table, view

BUCKET = "(('0x'||substr(md5({id}),1,8))::bigint % {n})::int"
EVENT = "event_id::varchar"


@query("top_k", "select event_id, value from events order by value desc, event_id limit 20")
def top_k(spark, sf_dir):
    return sampling.top_k(table(spark, sf_dir, "events").select("event_id", "value"), "value", 20, "event_id")


@query("capped_sample", f"select event_id, event_type from events order by md5({EVENT}) limit 500")
def capped_sample(spark, sf_dir):
    return sampling.capped_sample(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_id", 500)


@query("stratified_sample", f"""
with c as (select event_type, count(*) as n, sum(count(*)) over () as total from events group by event_type),
t as (select event_type, case when 400>=total then n else
  least(n, greatest(case when event_type='view' then 150 else 60 end, floor(n*(400.0/total))::bigint)) end as take from c),
r as (select event_id, event_type, row_number() over (partition by event_type order by md5({EVENT})) as rn from events)
select event_id, event_type from r join t using (event_type) where rn <= take""")
def stratified_sample(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "event_type")
    return sampling.stratified_sample(df, "event_id", "event_type", 400, {"view": 150}, 60)


@query("stratified_sample_null_labels", over("v_gaps", f"""
, c as (select grp, count(*) as n, sum(count(*)) over () as total from v group by grp),
t as (select grp, case when 400>=total then n else least(n, greatest(60, floor(n*(400.0/total))::bigint)) end as take from c),
r as (select row_id, grp, row_number() over (partition by grp order by md5(row_id::varchar)) as rn from v)
select row_id, r.grp from r join t on r.grp is not distinct from t.grp where rn <= take"""))
def stratified_sample_null_labels(spark, sf_dir):
    df = view(spark, sf_dir, "v_gaps").select("row_id", "grp")
    return sampling.stratified_sample(df, "row_id", "grp", 400, {}, 60)


@query("hash_split", f"select event_id, {BUCKET.format(id=EVENT, n=100)} < 20 as is_test from events")
def hash_split(spark, sf_dir):
    return sampling.hash_split(table(spark, sf_dir, "events").select("event_id"), "event_id", 20)


@query("tuning_subset", f"""
with s as (select event_id from events order by md5({EVENT}) limit 800)
select event_id, {BUCKET.format(id="'tune-'||" + EVENT, n=100)} < 25 as is_validation from s""")
def tuning_subset(spark, sf_dir):
    return sampling.tuning_subset(table(spark, sf_dir, "events").select("event_id"), "event_id", 800)


@query("fold_counts", f"select {BUCKET.format(id=chr(39) + 'fold-' + chr(39) + '||' + EVENT, n=3)} as fold, count(*) as n from events group by 1")
def fold_counts(spark, sf_dir):
    folds = sampling.hash_folds(table(spark, sf_dir, "events").select("event_id"), "event_id", 3)
    return folds.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@query("id_union", """
select event_id from events where value > 150 union select event_id from events where event_type = 'purchase'
union select event_id from events where user_id < 20""")
def id_union(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    return sampling.id_union(df.filter("value > 150").select("event_id"), df.filter("event_type = 'purchase'").select("event_id"),
                             df.filter("user_id < 20").select("event_id"))
