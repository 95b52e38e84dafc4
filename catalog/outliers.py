"""Outlier queries."""

from pyspark.sql import functions as F

from assayflow.functions.numbers import safe_ratio
from assayflow.operators import outliers as O
from assayflow.operators import parsing
from assayflow.operators.isolation import IsolationForest
from assayflow.operators.stats import histogram
from assayflow.sources.tables import cut_lineage, scope
from catalog import query
from catalog.parsing import SQL_PH_SIMPLE, SQL_TEMP_SIMPLE
from catalog.views import over, table, view

GRID = (1.5, 2.0, 2.5, 3.0, 3.5, 4.0)
MEASURES = ("xa", "xb", "xr")


def _log(x):
    return f"case when {x}>0 and not isnan({x}) and not isinf({x}) then log10({x}) end"


def _sql_outside(fence):
    return " or ".join(f"coalesce({x}<q1{x}-{fence}*(q3{x}-q1{x}) or {x}>q3{x}+{fence}*(q3{x}-q1{x}), false)" for x in MEASURES)


def sql_adaptive(group, source="v", small=50):
    """Common table expressions that end in ``f``: every row with its group's fence and its flag."""
    quartiles = ", ".join(f"quantile_cont({x},0.25) as q1{x}, quantile_cont({x},0.75) as q3{x}" for x in MEASURES)
    rates = ", ".join(f"avg(case when {_sql_outside(k)} then 1 else 0 end) as r{i}" for i, k in enumerate(GRID))
    chosen = " ".join(f"when r{i}<=0.05 then {k}" for i, k in enumerate(GRID))
    return f"""
l as (select *, {group} as g, {_log('a::double')} as xa, {_log('b::double')} as xb, {_log('a::double/nullif(b::double,0)')} as xr from {source}),
q as (select g, count(*) as size, {quartiles} from l group by g),
j as (select l.*, q.* exclude (g) from l join q on l.g is not distinct from q.g),
r as (select g, {rates} from j group by g),
c as (select q.g, case when size<{small} then 1.5 {chosen} end as fence from q join r on q.g is not distinct from r.g),
f as (select j.*, c.fence, fence is not null and ({_sql_outside('fence')}) as hit from j join c on j.g is not distinct from c.g)"""


SUMMARY = """ select g as grp, fence::double as fence, count(*) as n_rows, count(*) filter (hit) as n_flagged,
 round(sum(case when hit then a::double else 0 end),2) as flagged_sum from f group by all"""


def _summary(flagged, group="grp"):
    return flagged.groupBy(F.col(group).alias("grp"), F.col("hit_fence").alias("fence")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("hit").alias("n_flagged"),
        F.round(F.sum(F.when(F.col("hit"), F.col("a").cast("double")).otherwise(0.0)), 2).alias("flagged_sum"))


def _adaptive(spark, sf_dir, name, group="grp", **options):
    return O.adaptive_iqr(view(spark, sf_dir, name, spread=True), "a", "b", group, name="hit", keep_fence=True, **options)


@query("adaptive_iqr", over("v_assay", "," + sql_adaptive("grp") + SUMMARY))
def adaptive_iqr(spark, sf_dir):
    return _summary(_adaptive(spark, sf_dir, "v_assay"))


@query("adaptive_iqr_small_groups", over("v_assay", "," + sql_adaptive("small_grp") + SUMMARY))
def adaptive_iqr_small_groups(spark, sf_dir):
    return _summary(_adaptive(spark, sf_dir, "v_assay", "small_grp"), "small_grp")


@query("adaptive_iqr_all_branches", over("v_heavy", "," + sql_adaptive("grp") + SUMMARY))
def adaptive_iqr_all_branches(spark, sf_dir):
    return _summary(_adaptive(spark, sf_dir, "v_heavy"))


@query("adaptive_iqr_missing_values", over("v_gaps", "," + sql_adaptive("grp") + """
 select row_id, fence::double as fence, hit from f"""))
def adaptive_iqr_missing_values(spark, sf_dir):
    return _adaptive(spark, sf_dir, "v_gaps").select("row_id", F.col("hit_fence").alias("fence"), "hit")


# All groups through the narrowing route, as for groups that are too large for one task.
@query("adaptive_iqr_narrowed", over("v_heavy", "," + sql_adaptive("grp") + SUMMARY))
def adaptive_iqr_narrowed(spark, sf_dir):
    return _summary(_adaptive(spark, sf_dir, "v_heavy", limit=500))


@query("adaptive_iqr_mad", over("v_heavy", "," + sql_adaptive("grp") + """,
m as (select g, quantile_cont(xa,0.5) as ma, quantile_cont(xb,0.5) as mb, quantile_cont(xr,0.5) as mr from l group by g),
d as (select l.g, quantile_cont(abs(xa-ma),0.5) as da, quantile_cont(abs(xb-mb),0.5) as db, quantile_cont(abs(xr-mr),0.5) as dr
 from l join m on l.g is not distinct from m.g group by l.g),
z as (select f.*, hit or (fence is null and (coalesce(abs(xa-ma)/(1.4826*nullif(da,0))>5,false)
 or coalesce(abs(xb-mb)/(1.4826*nullif(db,0))>5,false) or coalesce(abs(xr-mr)/(1.4826*nullif(dr,0))>5,false))) as bad
 from f join m on f.g is not distinct from m.g join d on f.g is not distinct from d.g)
select g as grp, fence::double as fence, count(*) as n_rows, count(*) filter (bad) as n_flagged,
 round(sum(case when bad then a::double else 0 end),2) as flagged_sum from z group by all"""))
def adaptive_iqr_mad(spark, sf_dir):
    return _summary(_adaptive(spark, sf_dir, "v_heavy", fallback="mad"))


def _fixed_sql(fence=1.5):
    return f"""
l as (select *, {_log('a::double')} as xa, {_log('b::double')} as xb, {_log('a::double/nullif(b::double,0)')} as xr from v),
q as (select {', '.join(f'quantile_cont({x},0.25) as q1{x}, quantile_cont({x},0.75) as q3{x}' for x in MEASURES)} from l)"""


@query("fixed_iqr", over("v_gaps", "," + _fixed_sql() + f" select row_id, {_sql_outside(1.5)} as hit from l, q"))
def fixed_iqr(spark, sf_dir):
    return O.fixed_iqr(view(spark, sf_dir, "v_gaps"), "a", "b", name="hit").select("row_id", "hit")


@query("iqr_bounds", over("v_assay", "," + _fixed_sql() + " union all ".join(
    f" select '{n}' as measure, round(q1{x}-1.5*(q3{x}-q1{x}),6)+0.0 as lo, round(q3{x}+1.5*(q3{x}-q1{x}),6)+0.0 as hi from q"
    for n, x in zip(("a", "b", "ratio"), MEASURES))))
def iqr_bounds(spark, sf_dir):
    df = view(spark, sf_dir, "v_assay")
    values = {"a": F.col("a"), "b": F.col("b"), "ratio": safe_ratio(F.col("a"), F.col("b"))}
    rows = [(n, *b) for n, b in O.iqr_bounds(df, values).items()]
    return spark.createDataFrame(rows, "measure string, lo double, hi double").withColumns(
        {c: F.round(c, 6) + F.lit(0.0) for c in ("lo", "hi")})


# --- domain rules, sequence of stages, reasons ---

PARSED = f"""
p as (select *, {SQL_PH_SIMPLE} as ph, {SQL_TEMP_SIMPLE} as temp from v),
dm as (select *, coalesce(ph<=0 or ph>14,false) or coalesce(temp< -10 or temp>120,false) or coalesce(a<=0,false)
  or coalesce(b<=0,false) as dom from p)"""


def _parsed(spark, sf_dir, name="v_assay"):
    df = view(spark, sf_dir, name, spread=True)
    df = parsing.standardize_ph(df, "ph_text", value="ph")
    df = parsing.standardize_temperature(df, "temp_text", value="temp")
    # Texts are read once; the outlier stages pass over the written numbers.
    return cut_lineage(df.select("row_id", "grp", "a", "b", "ph_text", "temp_text", "ph", "temp"))


def _rules():
    return O.default_rules("ph", "temp", ("a", "b"))


@query("domain_rules", over("v_assay", "," + PARSED + """
 select ph_text, temp_text, dom, count(*) as n from dm group by all"""))
def domain_rules(spark, sf_dir):
    df = _parsed(spark, sf_dir)
    return (df.withColumn("dom", O.domain_flag(df, _rules())).groupBy("ph_text", "temp_text", "dom")
            .agg(F.count(F.lit(1)).alias("n")))


@query("aligned_flags", over("v_assay", "," + PARSED + ", s as (select * from dm where not dom)," + sql_adaptive("grp", "s") + """
 select grp, count(*) as n_rows, count(*) filter (hit) as n_flagged from (
  select dm.grp, false as hit from dm where dom union all select grp, hit from f) group by grp"""))
def aligned_flags(spark, sf_dir):
    labelled = O.sequential_labels(_parsed(spark, sf_dir), row_id=["row_id"], a="a", b="b", group="grp",
                                   rules=_rules(), isolation=False)
    return labelled.groupBy("grp").agg(F.count(F.lit(1)).alias("n_rows"),
                                       F.count_if(F.col("outcome") == "kinetics_drop").alias("n_flagged"))


@query("sequential_two_stage", over("v_assay", "," + PARSED + ", s as (select * from dm where not dom)," + sql_adaptive("grp", "s") + """
 select grp, count(*) as n_kept, round(sum(a),2) as kept_sum from f where not hit group by grp"""))
def sequential_two_stage(spark, sf_dir):
    kept = O.apply_outlier_strategy(_parsed(spark, sf_dir), row_id=["row_id"], a="a", b="b", group="grp",
                                    rules=_rules(), isolation=False)
    return kept.groupBy("grp").agg(F.count(F.lit(1)).alias("n_kept"), F.round(F.sum("a"), 2).alias("kept_sum"))


@query("sequential_labels", over("v_assay", "," + PARSED + ", s as (select * from dm where not dom)," + sql_adaptive("grp", "s") + """
 select outcome, count(*) as n, round(sum(a),1) as total from (select 'domain_drop' as outcome, a from dm where dom
  union all select case when hit then 'kinetics_drop' else 'kept' end, a from f) group by outcome"""))
def sequential_labels(spark, sf_dir):
    labelled = O.sequential_labels(_parsed(spark, sf_dir), row_id=["row_id"], a="a", b="b", group="grp",
                                   rules=_rules(), isolation=False)
    return labelled.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("a"), 1).alias("total"))


@query("independent_masks", over("v_assay", "," + PARSED + "," + _fixed_sql().replace("from v)", "from dm)") + f"""
 select dom as domain, kin as kinetics, count(*) as n from (select dom, {_sql_outside(1.5)} as kin from l, q) group by all"""))
def independent_masks(spark, sf_dir):
    flags = O.independent_masks(_parsed(spark, sf_dir), a="a", b="b", rules=_rules(), isolation=False)
    return flags.groupBy("domain", "kinetics").agg(F.count(F.lit(1)).alias("n"))


FLAGS_SQL = """select l_orderkey, l_linenumber, l_quantity>45 as domain, l_discount>=0.09 as iso, l_tax>=0.07 as kinetics from lineitem"""


def _flags(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    return df, {"domain": F.col("l_quantity") > 45, "iso": F.col("l_discount") >= 0.09, "kinetics": F.col("l_tax") >= 0.07}


@query("priority_label", f"""with v as ({FLAGS_SQL})
select l_orderkey, l_linenumber, case when domain then 'domain' when iso then 'iso' when kinetics then 'kinetics' else 'regular' end as label from v""")
def priority_label(spark, sf_dir):
    df, flags = _flags(spark, sf_dir)
    label = O.priority_label(flags, ("domain", "iso", "kinetics"))
    return df.select("l_orderkey", "l_linenumber", label.alias("label"))


@query("reason_counts", f"""with v as ({FLAGS_SQL})
select case when domain then 'domain' when kinetics then 'kinetics' else 'iso' end as reason, count(*) as n
from v where domain or kinetics or iso group by 1""")
def reason_counts(spark, sf_dir):
    df, flags = _flags(spark, sf_dir)
    return O.reason_counts(df, flags, ("domain", "kinetics", "iso"))


@query("flag_totals", f"""with v as ({FLAGS_SQL})
select 'domain' as flag, count(*) filter (domain) as n from v union all select 'iso', count(*) filter (iso) from v
union all select 'kinetics', count(*) filter (kinetics) from v""")
def flag_totals(spark, sf_dir):
    df, flags = _flags(spark, sf_dir)
    return O.flag_totals(df, flags)


# --- isolation forest: no statement in SQL, tested with planted outliers ---

ISO_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem", spread=True).select(*LINE_ID, *ISO_COLUMNS)


@query("isolation_forest")
def isolation_forest(spark, sf_dir):
    df = _lines(spark, sf_dir)
    return IsolationForest(ISO_COLUMNS, LINE_ID).fit(df).flag(df, "iso")


@query("isolation_scores")
def isolation_scores(spark, sf_dir):
    with scope() as held:
        scored, cut = O.score_once(held, _lines(spark, sf_dir), ISO_COLUMNS, LINE_ID, 0.01, "score")
    return scored.withColumns({"threshold": F.lit(cut), "iso": F.col("score") < F.lit(cut)})


@query("sequential_three_stage")
def sequential_three_stage(spark, sf_dir):
    return O.apply_outlier_strategy(_parsed(spark, sf_dir), row_id=["row_id"], a="a", b="b", group="grp",
                                    rules=_rules(), iso_columns=["a", "b", "ph", "temp"])


@query("sequential_labels_three_stage")
def sequential_labels_three_stage(spark, sf_dir):
    labelled = O.sequential_labels(_parsed(spark, sf_dir), row_id=["row_id"], a="a", b="b", group="grp",
                                   rules=_rules(), iso_columns=["a", "b", "ph", "temp"])
    return labelled.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("independent_masks_three")
def independent_masks_three(spark, sf_dir):
    masks = O.independent_masks(_parsed(spark, sf_dir), a="a", b="b", rules=_rules(), row_id=["row_id"],
                                iso_columns=["a", "b", "ph", "temp"])
    return masks.groupBy("domain", "kinetics", "iso").agg(F.count(F.lit(1)).alias("n"))


@query("iso_score_histogram")
def iso_score_histogram(spark, sf_dir):
    df = _lines(spark, sf_dir)
    scored = IsolationForest(ISO_COLUMNS, LINE_ID).fit(df).score(df, "score")
    return histogram(scored, F.col("score"), 60)
