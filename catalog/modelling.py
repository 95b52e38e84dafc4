"""Model and evaluation queries. Boosted models and searches run at their defaults, the published settings."""

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from assayflow.operators import boosting, evaluation, models
from assayflow.sources.tables import cut_lineage
from catalog import query
from catalog.views import over, table, view

PREDICTED = ", p as (select target, log10(y) as y, log10(p1) as p1, log10(p2) as p2 from v)"


def _predicted(spark, sf_dir):
    return view(spark, sf_dir, "v_predicted").select("target", *[F.log10(c).alias(c) for c in ("y", "p1", "p2")])


def _scores_sql(p, by=""):
    return f"""count(*) as n, round(avg(abs(y-{p})),6) as mae, round(sqrt(avg((y-{p})*(y-{p}))),6) as rmse,
 round(1-avg((y-{p})*(y-{p}))/var_pop(y),5) as r2,
 round(1-avg((power(10,y)-power(10,{p}))*(power(10,y)-power(10,{p})))/var_pop(power(10,y)),5) as r2_orig from p"""


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ("mae", "rmse")} | {c: F.round(c, 5) for c in ("r2", "r2_orig")})


@query("regression_metrics", over("v_predicted", PREDICTED + " select " + _scores_sql("p1")))
def regression_metrics(spark, sf_dir):
    return _rounded(evaluation.regression_metrics(_predicted(spark, sf_dir), "y", "p1"))


STACKED = """, s as (select target, 'first' as model, log10(y) as y, log10(p1) as p from v
 union all select target, 'second', log10(y), log10(p2) from v),
m as (select target, model, avg(abs(y-p)) as mae, sqrt(avg((y-p)*(y-p))) as rmse, 1-avg((y-p)*(y-p))/var_pop(y) as r2,
 1-avg((power(10,y)-power(10,p))*(power(10,y)-power(10,p)))/var_pop(power(10,y)) as r2_orig from s group by target, model),
e as (unpivot m on mae, rmse, r2, r2_orig into name metric value value)"""


def _stacked(spark, sf_dir):
    df = _predicted(spark, sf_dir)
    return df.select("target", "y", F.inline(F.array(
        F.struct(F.lit("first").alias("model"), F.col("p1").alias("p")),
        F.struct(F.lit("second").alias("model"), F.col("p2").alias("p")))))


@query("results_table", over("v_predicted", STACKED + " select target, model, metric, round(value,5) as value from e"))
def results_table(spark, sf_dir):
    return evaluation.results_table(_stacked(spark, sf_dir), "y", "p").withColumn("value", F.round("value", 5))


@query("best_model", over("v_predicted", STACKED + """
 select target, arg_max(model, value) as model, round(max(value),5) as value from e where metric='r2' group by target"""))
def best_model(spark, sf_dir):
    best = evaluation.best_model(evaluation.results_table(_stacked(spark, sf_dir), "y", "p"))
    return best.withColumn("value", F.round("value", 5))


@query("parity_data", over("v_predicted", """
, l as (select target, log10(y+1e-30) as a, log10(p1+1e-30) as p from v),
q as (select quantile_cont(x,0.01)*1.1 as lo, quantile_cont(x,0.99)*1.1 as hi from (select a as x from l union all select p from l))
select target, round(a,6) as actual_log, round(p,6) as predicted_log, round(lo,6) as limit_lo, round(hi,6) as limit_hi from l, q"""))
def parity_data(spark, sf_dir):
    df = evaluation.parity_data(view(spark, sf_dir, "v_predicted").select("target", "y", "p1"), "y", "p1")
    names = ("actual_log", "predicted_log", "limit_lo", "limit_hi")
    return df.select("target", *[F.round(c, 6).alias(c) for c in names])


@query("target_rows", over("v_gaps", """
, f as (select row_id, case when isnan(a) or isinf(a) then null else a end as a, b from v)
select row_id, target, round(log10(x),6)+0.0 as label from (
 select row_id, 'kcat_value' as target, a as x from f union all select row_id, 'km_value', b from f
 union all select row_id, 'kcat_km', a/nullif(b,0) from f) where x>0"""))
def target_rows(spark, sf_dir):
    df = view(spark, sf_dir, "v_gaps").withColumnsRenamed({"a": "kcat_value", "b": "km_value"})
    rows = evaluation.target_rows(df, ["row_id"], ["kcat_value", "km_value", "kcat_km", "absent"],
                                  {"kcat_km": ("kcat_value", "km_value")})
    return rows.withColumn("label", F.round("label", 6) + F.lit(0.0))


# --- fitted models ---

ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
COLUMNS = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size"]


def _rows(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem", spread=True).join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    df = VectorAssembler(inputCols=COLUMNS, outputCol="features").transform(df)
    return cut_lineage(models.model_rows(df, "l_extendedprice", "features", ID), small_parts=True)


@query("gbt_regression")
def gbt_regression(spark, sf_dir):
    """500 trees of depth 6, as published."""
    rows = _rows(spark, sf_dir)
    return models.evaluate(models.fit(models.boosted_trees(), models.train_part(rows)), rows)


# --- trees from histograms: the same trees stated in SQL, level by level ---

TREE = boosting.Settings(rounds=1, depth=3, rows=1.0, columns=1.0, bins=16, rate=1.0, l2=1.0)
GAPS = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size_gaps"]
SCORE = "power({g} / 1048576, 2) / ({h} + 1)"


def _gap_rows(spark, sf_dir):
    """Line items with five features, one of which has gaps, and the log10 price as label."""
    df = table(spark, sf_dir, "lineitem", spread=True).join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    df = df.withColumn("p_size_gaps", F.when(F.col("l_suppkey") % 3 > 0, F.col("p_size")))
    df = df.withColumn("features", F.array(*[F.col(c).cast("double") for c in GAPS]))
    return cut_lineage(models.model_rows(df, "l_extendedprice", "features", ID))


def _first_tree_sql(depth: int = 3) -> str:
    """Level by level: sums per node, feature and bin, all cuts with missing values on either side, the best one, and the nodes below it."""
    number = "concat_ws('-',l_orderkey,l_linenumber,l_partkey,l_suppkey)"
    sql = [f"""with d as (select row_number() over () as r, log10(l_extendedprice) as y, {", ".join(f"cast({c} as double) as x{i}" for i, c in enumerate([
        "l_quantity", "l_discount", "l_tax", "p_retailprice", "case when l_suppkey % 3 > 0 then p_size end"]))}
  from lineitem join part on l_partkey = p_partkey where l_extendedprice > 0 and ('0x'||substr(md5({number}),1,8))::bigint % 100 >= 20),
base as (select round(avg(y), 6) as b from d),
g as (select r, cast(round((b - y) * 1048576) as bigint) as g from d, base),
u as ({" union all ".join(f"select r, {i} as f, x{i} as x from d" for i in range(5))}),
q as (select f, unnest(quantile_cont(x, [{", ".join(f"{k}/16.0" for k in range(1, 16))}])) as cut from u where x is not null group by f),
cuts as (select f, cut, row_number() over (partition by f order by cut) - 1 as k from (select distinct f, cut from q)),
-- a missing value has bin -1
bins as (select r, u.f, case when x is null then -1 else count(k) filter (cut <= x) end as bin from u left join cuts using (f) group by r, u.f, x),
n0 as (select r, 0 as node from d)"""]
    for level in range(depth):
        sql.append(f"""
s{level} as (select node, f, bin, sum(g) as g, count(*) as h from n{level} join g using (r) join bins using (r) group by node, f, bin),
t{level} as (select node, f, sum(g) as g, sum(h) as h, coalesce(sum(g) filter (bin = -1), 0) as mg, coalesce(sum(h) filter (bin = -1), 0) as mh from s{level} group by node, f),
l{level} as (select node, f, k, cut, coalesce(sum(s.g), 0) as lg, coalesce(sum(s.h), 0) as lh from t{level} t join cuts using (f) left join s{level} s using (node, f)
  where bin is null or (bin >= 0 and bin <= k) group by node, f, k, cut),
c{level} as (select node, f, k, cut, side, lg + side * mg as lg, lh + side * mh as lh, g, h from l{level} join t{level} using (node, f), (values (0), (1)) v(side) where side = 0 or mh > 0),
b{level} as (select *, 0.5 * ({SCORE.format(g="lg", h="lh")} + {SCORE.format(g="(g-lg)", h="(h-lh)")} - {SCORE.format(g="g", h="h")}) as gain from c{level}
  where lh >= 1 and h - lh >= 1 qualify row_number() over (partition by node order by gain desc, f, side, k) = 1 and gain > 0),
n{level + 1} as (select r, 2 * node + case when (bin = -1 and side = 1) or (bin >= 0 and bin <= k) then 1 else 2 end as node
  from n{level} join b{level} using (node) join bins using (r, f))""")
    inner = " union all ".join(f"""select node, f, cut, side = 1 as missing_left, gain, h, null as value from b{k}""" for k in range(depth))
    # A leaf is a node without a split.
    leaves = " union all ".join(f"""select node, null, null, null, null, count(*), -(sum(g) / 1048576) / (count(*) + 1) from n{k} join g using (r)
  {f"where node not in (select node from b{k})" if k < depth else ""} group by node""" for k in range(depth + 1))
    return ",".join(sql) + f"""
select node, cast(f as integer) as feature, round(cut, 6) as cut, missing_left, round(gain, 4) as gain, cast(h as bigint) as n, round(value, 6) + 0.0 as value from ({inner} union all {leaves})"""


def _numbered(tree: boosting.Tree) -> list[int]:
    """Numbers of the nodes as in a heap: below i come 2 i + 1 and 2 i + 2."""
    number = [0] * len(tree.feature)
    for n, f in enumerate(tree.feature):
        if f >= 0:
            number[tree.left[n]], number[tree.right[n]] = 2 * number[n] + 1, 2 * number[n] + 2
    return number


@query("gbt_first_tree", _first_tree_sql())
def gbt_first_tree(spark, sf_dir):
    """The first tree of second-order boosting on the training rows: three levels, gaps sent to the side that gains more."""
    model = boosting.boost(models.train_part(_gap_rows(spark, sf_dir)), ID, TREE)
    numbers = spark.createDataFrame(list(enumerate(_numbered(model.trees[0]))), "node int, number int")
    nodes = model.table(spark).join(numbers, "node")
    return nodes.select(F.col("number").alias("node"), "feature", F.round("cut", 6).alias("cut"), "missing_left", F.round("gain", 4).alias("gain"),
                        F.col("weight").cast("long").alias("n"), (F.round("value", 6) + 0.0).alias("value"))


@query("gbt_second_order")
def gbt_second_order(spark, sf_dir):
    """500 trees of depth 6 with an l2 of 1 on shares of rows and columns, as published."""
    rows = _gap_rows(spark, sf_dir)
    model = boosting.boost(models.train_part(rows), ID)
    return models.evaluate(model, rows)


@query("gbt_leafwise_l1")
def gbt_leafwise_l1(spark, sf_dir):
    """Best leaf first, absolute loss, median leaves; stops after 5 trees without improvement on a quarter of the training rows."""
    rows = _gap_rows(spark, sf_dir)
    s = boosting.Settings(rounds=20, leaves=7, rate=0.4, l1=0.001, l2=0.001, min_weight=20, bins=64, loss="absolute")
    model, _ = boosting.boost_until(models.train_part(rows), ID, F.col("l_orderkey") % 4 == 0, s, patience=5)
    return models.evaluate(model, rows)


@query("forest_out_of_bag")
def forest_out_of_bag(spark, sf_dir):
    """100 trees on bootstrap weights, grown until no split gains anything, as published."""
    rows = _gap_rows(spark, sf_dir)
    model, score = boosting.bagged_forest(models.train_part(rows), ID)
    return models.evaluate(model, rows).withColumns({"out_of_bag_n": F.lit(score["n"]).cast("long"), "out_of_bag_r2": F.lit(score["r2"])})


@query("random_search")
def random_search(spark, sf_dir):
    """15 draws from the published space (300 to 700 trees of depth 4 to 8) and 3 folds."""
    fitted = models.random_search(models.train_part(_rows(spark, sf_dir)), ID)
    return models.search_report(fitted)


@query("ridge")
def ridge(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    return models.evaluate(models.ridge(models.train_part(rows)), rows)


# With one feature the penalised slope is sxy / (sxx + alpha).
@query("ridge_one_feature", """
with d as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, log10(l_quantity) as x, log10(l_extendedprice) as y,
  ('0x'||substr(md5(concat_ws('-',l_orderkey,l_linenumber,l_partkey,l_suppkey)),1,8))::bigint % 100 < 20 as is_test from lineitem),
m as (select avg(x) as mx, avg(y) as my, count(*)*covar_pop(x,y)/(count(*)*var_pop(x)+1000) as w from d where not is_test)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, is_test, round(my+w*(x-mx),5) as prediction from d, m""")
def ridge_one_feature(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").withColumn("x", F.log10("l_quantity"))
    rows = models.model_rows(models.assemble(df, ["x"]), "l_extendedprice", "features", ID)
    fitted = models.ridge(models.train_part(rows), alpha=1000.0)
    return fitted.transform(rows).select(*ID, "is_test", F.round("prediction", 5).alias("prediction"))


@query("random_forest")
def random_forest(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    forest = models.random_forest(maxDepth=4, featureSubsetStrategy="all")
    held_out = models.held_out_fold_r2(forest, models.train_part(rows), ID)
    return models.evaluate(models.fit(forest, models.train_part(rows)), rows).withColumn("held_out_r2", F.lit(held_out))


@query("rf_tuned")
def rf_tuned(spark, sf_dir):
    """All 15 draws and the whole subset of 30,000 rows; forests are smaller than the published ones."""
    rows = _rows(spark, sf_dir)
    space = {"numTrees": models.Even(5, 20, True), "maxDepth": models.Even(2, 5, True)}
    return models.evaluate(models.tuned_forest(models.train_part(rows), ID, space=space), rows)


@query("gbt_l1")
def gbt_l1(spark, sf_dir):
    """20 draws of at most 2,000 rounds with a wait of 50, as published."""
    rows = _rows(spark, sf_dir)
    model = models.early_stopped_trees(models.train_part(rows), ID, models.GBT_L1_SEARCH, loss="absolute")
    return models.evaluate(model, rows)


@query("gbt_early_stop")
def gbt_early_stop(spark, sf_dir):
    """20 draws of at most 2,000 rounds with a wait of 50, as published."""
    rows = _rows(spark, sf_dir)
    return models.evaluate(models.early_stopped_trees(models.train_part(rows), ID), rows)


@query("feature_importance")
def feature_importance(spark, sf_dir):
    model = models.fit(models.random_forest(numTrees=20, maxDepth=4), models.train_part(_rows(spark, sf_dir)))
    return models.feature_importance(model, COLUMNS)


@query("batch_prediction")
def batch_prediction(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    return models.predict(models.ridge(models.train_part(rows)), rows).select(*ID, "predicted")


@query("compare_models")
def compare_models(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").withColumns({"kcat_value": F.col("l_extendedprice"), "km_value": F.col("l_quantity")})
    df = VectorAssembler(inputCols=["l_discount", "l_tax", "l_suppkey"], outputCol="features").transform(df)
    fits = {"Ridge": models.ridge, "RF": lambda train: models.random_forest(numTrees=20, maxDepth=3).fit(train)}
    predictions = models.compare_models(df, ["kcat_value", "km_value", "absent"], "features", ID, fits)
    return evaluation.results_table(predictions)
