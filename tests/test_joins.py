"""Results do not depend on the join strategy: no broadcast, and hot keys split."""

import pytest

import catalog
from catalog.check import check_engine, compare

catalog.load_all()

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
}


@pytest.fixture
def shuffled(spark):
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["adaptive_iqr", "adaptive_iqr_missing_values", "adaptive_iqr_mad", "code_list_enrich",
                                  "enrich_left_join", "clean_temp_rich", "group_quartiles_narrowed"])
def test_without_broadcast(shuffled, sf_dir, name):
    assert compare(shuffled, check_engine(sf_dir), sf_dir, name) is None
