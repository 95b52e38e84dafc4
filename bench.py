"""Time the headline queries: one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

import catalog

HEADLINES = [
    "scan_clean", "missing_fraction", "basic_clean", "winsorize", "clean_ph_rich", "clean_temp_rich", "first_int",
    "code_list_enrich", "enrich_left_join", "letter_composition", "weighted_composition", "bigram_score",
    "folded_fingerprint", "bit_variance", "group_quartiles", "corr_pairs", "corr_pairs_wide", "log_histogram",
    "adaptive_iqr", "adaptive_iqr_small_groups", "adaptive_iqr_mad", "fixed_iqr", "sequential_two_stage",
    "sequential_labels", "isolation_forest", "sequential_three_stage", "corr_prune", "median_impute", "standardize",
    "prepare_features", "stratified_sample", "hash_split", "regression_metrics", "parity_data", "gbt_regression", "ridge",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    catalog.load_all()
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_linenumber").count().collect()  # start the engine
    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()  # no query runs on what another one kept
    print(json.dumps({"metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
