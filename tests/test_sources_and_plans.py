import os

import pytest
from pyspark.sql import functions as F

from assayflow.operators.models import boosted_trees
from assayflow.operators.notations import add_notation_features
from assayflow.operators.parsing import standardize_ph
from assayflow.operators.sequences import add_sequence_features
from assayflow.plans.explore import diagnostics, drop_report
from assayflow.plans.preprocess import preprocess
from assayflow.plans.train import train
from assayflow.operators.quantiles import exact_quantiles
from assayflow.sources.tables import (NamedTables, cut_lineage, free, read_bundle, read_table, scope, spread_out, write_bundle,
                                      write_table)


def test_nan_becomes_null(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0), (3, None)], "id int, x double")
    write_table(df, str(tmp_path / "t"))
    assert [r["x"] for r in read_table(spark, str(tmp_path / "t")).orderBy("id").collect()] == [None, 1.0, None]


def test_filters_and_columns_reach_the_reader(spark, sf_dir):
    df = spread_out(read_table(spark, f"{sf_dir}/lineitem.parquet", ["l_partkey", "l_tax"])).filter("l_partkey > 10")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_partkey,10)" in plan and "ReadSchema: struct<l_partkey:bigint,l_tax:double>" in plan


def test_bundle_and_named_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, [0.5], 2.0)], "id int, features array<double>, km_value double")
    write_bundle(df, str(tmp_path / "b"), "id", "features", ["kcat_value", "km_value"], {"names": ["a"]})
    rows, meta = read_bundle(spark, str(tmp_path / "b"))
    assert rows.columns == ["id", "features", "km_value"] and meta == {"names": ["a"], "targets": ["km_value"]}
    tables = NamedTables(spark, str(tmp_path / "named"))
    assert tables.save(df, "first").count() == 1
    with pytest.raises(FileNotFoundError):
        tables.load("second")


def test_cut_lineage_lands_in_the_shared_folder(spark):
    df = cut_lineage(spark.range(3))
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert df.inputFiles() and all(f"{folder}/tables/" in path for path in df.inputFiles())


def _raw(spark, sf_dir, path):
    """A measurement table with the expected column names, made from the given tables."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").join(spark.read.parquet(f"{sf_dir}/part.parquet"),
                                                                  F.col("l_partkey") == F.col("p_partkey"))
    text = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("d"), "text")
    urls = spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.col("page_id").alias("u"), "url")
    n = F.col("l_partkey")
    raw = (lines.join(text, n % 200 == F.col("d"), "left").join(urls, n % 25 == F.col("u"), "left").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_id"),
        F.lit("1.0 s^-1").alias("kcat"), F.when(n % 50 > 0, F.col("l_extendedprice")).alias("kcat_value"),
        F.col("l_quantity").alias("km_value"), F.col("p_brand").alias("enzyme"),
        F.when(n % 8 == 0, "15.2").when(n % 8 == 1, "neutral").otherwise("pH 7.5").alias("pH"),
        F.when(n % 9 == 0, "150 C").otherwise(F.concat((n % 50).cast("string"), F.lit(" °C"))).alias("temperature"),
        F.col("text").alias("sequence"), F.col("url").alias("smiles"), F.concat(F.lit("["), n, F.lit("]")).alias("cid"),
        F.concat_ws(".", n % 6, n % 4, n % 3, n % 90).alias("enzyme_ecs"),
        F.when(n % 3 > 0, 50 + n % 50).cast("double").alias("max_enzyme_similarity"),
        F.when(n % 10 == 0, 1.0).alias("mostly_missing")))
    write_table(raw, path)
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("cid"), "p_size", "p_retailprice")


def test_whole_jobs(spark, sf_dir, tmp_path):
    properties = _raw(spark, sf_dir, str(tmp_path / "raw"))
    tables = NamedTables(spark, str(tmp_path / "out"))
    done = preprocess(spark, str(tmp_path / "raw"), ["row_id"], tables, properties,
                      iso_columns=["kcat_value", "km_value", "temperature_C"])
    derived, clean = tables.load("derived"), tables.load("clean")
    assert {"pH_value", "temperature_C", "aa_A", "tok_atoms", "fp_bits", "enzyme_ecs_level4", "p_size"} <= set(derived.columns)
    assert not {"kcat", "mostly_missing"} & set(derived.columns)
    assert 0 < clean.count() < derived.count()
    assert clean.filter("pH_value > 14 or temperature_C > 120").count() == 0
    rows, meta = read_bundle(spark, f"{tables.root}/bundle")
    assert rows.count() == clean.count() and meta["names"] == done.model.names

    scores = train(clean, ["row_id"], estimator=boosted_trees(maxIter=3, maxDepth=3, stepSize=0.5), path=str(tmp_path / "models"))
    assert {r["target"] for r in scores.collect()} == {"kcat_value", "km_value"}

    report = {r["outcome"]: r["n"] for r in drop_report(derived, ["row_id"], iso_columns=["kcat_value", "km_value"]).collect()}
    assert sum(report.values()) == derived.count()
    slim = derived.select("row_id", "kcat_value", "km_value", "pH_value", "temperature_C", "tok_atoms", "fp_bits")
    pictures = diagnostics(slim, ["row_id"], iso_columns=["kcat_value", "km_value"])
    assert all(t.count() > 0 for t in pictures.values())


def test_projections_also_run_on_streams(spark, sf_dir, tmp_path):
    source = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("text").alias("sequence"), F.lit("pH 7").alias("pH"))
    source.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(source.schema).parquet(str(tmp_path / "in"))
    out = add_notation_features(add_sequence_features(standardize_ph(stream, per_text=False)), "sequence")
    run = out.writeStream.format("memory").queryName("derived").trigger(availableNow=True).option(
        "checkpointLocation", str(tmp_path / "ck")).start()
    run.awaitTermination(120)
    assert spark.table("derived").filter("pH_value = 7").count() == source.count()


def _written(spark):
    """Names of the intermediate tables that exist."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir").removeprefix("file:")
    return set(os.listdir(f"{folder}/tables")) if os.path.isdir(f"{folder}/tables") else set()


def test_a_scope_deletes_what_it_does_not_keep(spark):
    before = _written(spark)
    with scope() as outer:
        with scope() as inner:
            first = cut_lineage(spark.range(3))
            second = cut_lineage(first.where("id > 0"), last=[first])
            assert len(_written(spark) - before) == 1
            third = inner.keep(cut_lineage(second.where("id > 1")))
        assert len(_written(spark) - before) == 1 and third.count() == 1
        fourth = outer.keep(cut_lineage(third))
    assert len(_written(spark) - before) == 1 and [r["id"] for r in fourth.collect()] == [2]
    free(fourth, spark.range(1))
    assert _written(spark) == before


def test_a_scope_deletes_on_failure_also_what_was_half_written(spark):
    before = _written(spark)
    with pytest.raises(Exception, match="three"), scope():
        cut_lineage(spark.range(3))
        cut_lineage(spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("three"))).otherwise(F.col("id")).alias("x")))
    assert _written(spark) == before


def test_settings_come_back(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key)
    cut_lineage(spark.range(3))
    assert spark.conf.get(key) == was


def test_narrowing_leaves_only_what_its_result_reads(spark):
    before = _written(spark)
    df = spark.range(20_000).select((F.col("id") % 2).alias("g"), F.sqrt("id").alias("x"))
    found = exact_quantiles(df, ["x"], [0.5], ["g"], limit=50)
    assert len(_written(spark) - before) <= 3
    expected = df.groupBy("g").agg(F.percentile("x", F.array(F.lit(0.5))).alias("q_x"))
    assert sorted(r["q_x"] for r in found.collect()) == sorted(r["q_x"] for r in expected.collect())
