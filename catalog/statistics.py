"""Aggregates behind the diagnostics."""

from pyspark.sql import functions as F

from assayflow.functions.notation import folded_bits
from assayflow.operators import stats
from catalog import query
from catalog.views import over, table, view


def _round(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


LOGS = "l as (select row_id, grp, case when a>0 and not isnan(a) and not isinf(a) then log10(a) end as x from v)"


@query("group_quartiles", over("v_gaps", f""", {LOGS}
select grp, count(*) as n_rows, count(x) as n_valid, round(quantile_cont(x,0.25),6)+0.0 as q1,
 round(quantile_cont(x,0.75),6)+0.0 as q3 from l group by grp"""))
def group_quartiles(spark, sf_dir):
    return _round(stats.group_quartiles(view(spark, sf_dir, "v_gaps"), "grp", "a"), "q1", "q3")


# The same rows through the route for groups that are too large for one task.
@query("group_quartiles_narrowed", over("v_gaps", f""", {LOGS}
select grp, count(*) as n_rows, count(x) as n_valid, round(quantile_cont(x,0.25),6)+0.0 as q1,
 round(quantile_cont(x,0.75),6)+0.0 as q3 from l group by grp"""))
def group_quartiles_narrowed(spark, sf_dir):
    return _round(stats.group_quartiles(view(spark, sf_dir, "v_gaps"), "grp", "a", limit=100), "q1", "q3")


@query("group_flag_rate", over("v_gaps", """
select grp, round(avg(case when a>100 then 1 else 0 end),6) as rate from v group by grp"""))
def group_flag_rate(spark, sf_dir):
    return _round(stats.group_flag_rate(view(spark, sf_dir, "v_gaps"), "grp", F.col("a") > 100), "rate")


@query("median_mad", over("v_heavy", """
, l as (select grp, log10(a) as x from v), m as (select grp, quantile_cont(x,0.5) as med from l group by grp)
select grp, round(med,6)+0.0 as med_x, round(quantile_cont(abs(x-med),0.5),6)+0.0 as mad_x from l join m using (grp) group by grp, med"""))
def median_mad(spark, sf_dir):
    logs = view(spark, sf_dir, "v_heavy").select("grp", F.log10("a").alias("x"))
    return _round(stats.group_median_mad(logs, ["x"], ["grp"]), "med_x", "mad_x")


def _pair(x, y):
    return f"""select '{x}' as x, '{y}' as y, round(covar_pop({x},{y}) filter ({x} is not null and {y} is not null) /
 nullif(stddev_pop({x}) filter ({y} is not null) * stddev_pop({y}) filter ({x} is not null), 0), 6)+0.0 as r,
 count(*) filter ({x} is not null and {y} is not null) as n from v"""


CORR5 = ["x0", "x1", "x2", "x3", "x4"]
PAIRS5 = [(CORR5[i], CORR5[j]) for i in range(5) for j in range(i + 1, 5)]


@query("corr_pairs", over("v_corr5", " union all ".join(_pair(x, y) for x, y in PAIRS5)))
def corr_pairs(spark, sf_dir):
    return _round(stats.corr_pairs(view(spark, sf_dir, "v_corr5", spread=True), CORR5), "r")


@query("corr_pairs_gram", over("v_corr5", " union all ".join(_pair(x, y) for x, y in PAIRS5)))
def corr_pairs_gram(spark, sf_dir):
    return _round(stats.corr_pairs(view(spark, sf_dir, "v_corr5"), CORR5, "gram"), "r")


@query("corr_pairs_wide", """
with e as (select vec_id, unnest(embedding)::double as x, generate_subscripts(embedding,1) as i from embeddings),
p as (select a.i as i, b.i as j, corr(a.x,b.x) as r, count(*) as n from e a join e b on a.vec_id=b.vec_id and a.i<b.i group by 1,2)
select 'd'||(i-1) as x, 'd'||(j-1) as y, round(r,6)+0.0 as r, n from p""")
def corr_pairs_wide(spark, sf_dir):
    columns = [f"d{i}" for i in range(64)]
    df = table(spark, sf_dir, "embeddings").select(*[F.col("embedding")[i].cast("double").alias(c)
                                                     for i, c in enumerate(columns)])
    return _round(stats.corr_pairs(df, columns), "r")


@query("label_share", """
select event_type, count(*) as n, round(count(*)*100.0/(select count(*) from events),6) as percent from events group by event_type""")
def label_share(spark, sf_dir):
    return _round(stats.label_share(table(spark, sf_dir, "events"), "event_type"), "percent")


def _histogram_sql(bins):
    return f"""with l as (select log10(value) as x from events where value>0),
s as (select min(x) as lo, max(x) as hi, count(*) as n from l), w as (select lo, hi, {bins} as k from s),
c as (select least(floor((x-lo)/((hi-lo)/k)), k-1)::int as bin, count(*) as n from l, w group by 1),
b as (select unnest(range(k))::int as bin, lo, (hi-lo)/k as w from w)
select b.bin, round(lo+b.bin*w,6)+0.0 as lo, round(lo+(b.bin+1)*w,6)+0.0 as hi, coalesce(n,0) as n from b left join c using (bin)"""


@query("log_histogram", _histogram_sql("least(80, greatest(20, floor(sqrt(n))::int))"))
def log_histogram(spark, sf_dir):
    return _round(stats.log_histogram(table(spark, sf_dir, "events"), "value"), "lo", "hi")


@query("log_histogram_fixed_bins", _histogram_sql("60"))
def log_histogram_fixed_bins(spark, sf_dir):
    return _round(stats.log_histogram(table(spark, sf_dir, "events"), "value", 60), "lo", "hi")


@query("fence_positions", """
with l as (select log10(l_extendedprice) as x from lineitem where l_extendedprice>0),
q as (select min(x) as x_min, max(x) as x_max, quantile_cont(x,0.25) as q1, quantile_cont(x,0.75) as q3 from l),
f as (select *, q1-1.5*(q3-q1) as fence_lo, q3+1.5*(q3-q1) as fence_hi from q)
select round(x_min,6) as x_min, round(x_max,6) as x_max, round(fence_lo,6) as fence_lo, round(fence_hi,6) as fence_hi,
 round((fence_lo-x_min)/(x_max-x_min)*100,4) as lo_percent, round((fence_hi-x_min)/(x_max-x_min)*100,4) as hi_percent from f""")
def fence_positions(spark, sf_dir):
    df = stats.fence_positions(table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return _round(_round(df, "x_min", "x_max", "fence_lo", "fence_hi"), "lo_percent", "hi_percent", digits=4)


BITS = """n as (select page_id as row_id, url as t from pages),
r as (select row_id, unnest(list_distinct(list_transform(range(1, len(t)-1), lambda i: substr(t, i::bigint, 3)))) as s from n),
o as (select distinct row_id, (('0x'||substr(md5(s),1,8))::bigint % 256)::int as bit from r)"""


@query("bit_variance", f"""with {BITS},
c as (select bit, count(*) as n_on from o group by bit), t as (select count(*)::double as n from pages)
select b.bit, coalesce(n_on,0) as n_on, round(coalesce(n_on,0)/n*(1-coalesce(n_on,0)/n),6) as variance
from (select unnest(range(256))::int as bit) b left join c using (bit), t""")
def bit_variance(spark, sf_dir):
    df = view(spark, sf_dir, "v_notation").select(folded_bits(F.col("notation"), 256).alias("bits"))
    return _round(stats.bit_variance(df, "bits", 256), "variance")


@query("list_length_stats", """
with l as (select len(string_split(text,' '))::double as x from documents)
select count(x) as n, round(avg(x),4) as mean, round(stddev_samp(x),4) as std, min(x) as "min", quantile_cont(x,0.25) as q25,
 quantile_cont(x,0.5) as q50, quantile_cont(x,0.75) as q75, max(x) as "max" from l""")
def list_length_stats(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select(F.split("text", " ").alias("words"))
    return _round(stats.list_length_stats(df, "words"), "mean", "std", digits=4)


@query("distinct_values", "select distinct p_brand from part")
def distinct_values(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_brand").distinct()


@query("quantile_cut", """
with q as (select quantile_cont(value,0.01) as cut from events)
select event_id, value < cut as is_low from events, q""")
def quantile_cut(spark, sf_dir):
    return stats.quantile_cut(table(spark, sf_dir, "events"), "value", 0.01).select("event_id", "is_low")
