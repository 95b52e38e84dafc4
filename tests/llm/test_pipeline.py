"""The queries of this subpackage against their SQL, and the stages of the pipeline."""

import corpus_pipeline
import pytest

import catalog
from assayflow.llm import decontaminate, queries
from catalog.check import canonical, check_engine
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def engine():
    return check_engine(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf_dir, engine, name):
    found = queries.QUERIES[name](spark, sf_dir).toPandas()
    assert len(found) and len(set(found.columns)) == len(found.columns)
    if name in queries.ORACLE:
        wanted = engine.execute(queries.ORACLE[name]).fetchdf()
        assert sorted(found.columns) == sorted(wanted.columns) and canonical(found) == canonical(wanted)


def test_stages_keep_the_columns(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, ids = docs.columns, {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert kept <= ids and docs.columns == (columns if name != "mixing" else [*columns, "copies"])
        assert name != "lines" or kept == ids
        if name == "decontamination":
            again = decontaminate.find_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
            assert again.where("size(starts) > 0").count() == 0
        ids = kept
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "decontamination", "mixing"]


def test_the_other_queries_do_not_know_of_these():
    assert not set(catalog.QUERIES) & set(queries.QUERIES)
