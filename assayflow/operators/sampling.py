"""Samples, splits and top lists. Every random choice is a hash of the row id.

A row's fate does not depend on partitioning, so lost executors and reruns change nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayflow.functions.numbers import hash_bucket, hash_percent, hash_rank, id_hash
from assayflow.operators.quantiles import order_statistics


def _ids(row_id: Sequence[str] | str) -> list[Column]:
    return [F.col(c) for c in ([row_id] if isinstance(row_id, str) else row_id)]


def top_k(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc(by), tie).limit(k)


def smallest_hashes(df: DataFrame, row_id: Sequence[str] | str, label: str, take: dict[str | None, int],
                    counts: dict[str | None, int], limit: int | None = None) -> DataFrame:
    """Exactly ``take[label]`` rows per label: those with the smallest id hash. A missing label is a label.

    The hash at the wanted rank is found by narrowing a histogram, after which the sample is a filter: rows
    below that hash are in, and only rows equal to it are ever ranked.
    """
    key = lambda c: "" if c is None else f"={c}"
    spark, rank_of = df.sparkSession, hash_rank(*_ids(row_id))
    rows = df.withColumn("_key", F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("")))
    partial = {key(c): n for c, n in take.items() if 0 < n < counts[c]}
    inside = {key(c): counts[c] for c in take}
    targets = spark.createDataFrame([(c, n - 1, 0.0, float(16 ** 13), 0, inside[c]) for c, n in partial.items()],
                                    "measure string, rank bigint, lo double, hi double, below bigint, inside bigint")
    plan = [(key(c), None, n) for c, n in take.items() if n >= counts[c]]
    if partial:
        wanted = rows.join(targets.select(F.col("measure").alias("_key")), "_key", "left_semi")
        edges = order_statistics(wanted.select(F.col("_key").alias("measure"), rank_of.alias("x")), targets, (), limit)
        plan += [(r["measure"], r["value"], partial[r["measure"]]) for r in edges.collect()]
    plan = spark.createDataFrame(plan, "_key string, _edge double, _take bigint")
    found = rows.join(plan, "_key")
    sure = found.filter(F.col("_edge").isNull() | (rank_of < F.col("_edge")))
    below = found.filter(rank_of < F.col("_edge")).groupBy("_key").agg(F.count(F.lit(1)).alias("_below"))
    ties = found.filter(rank_of == F.col("_edge")).join(below, "_key", "left")
    in_order = Window.partitionBy("_key").orderBy(id_hash(*_ids(row_id)), *_ids(row_id))
    ties = (ties.withColumn("_rank", F.row_number().over(in_order))
            .filter(F.col("_rank") <= F.col("_take") - F.coalesce("_below", F.lit(0))))
    return sure.select(*df.columns).unionByName(ties.select(*df.columns))


def capped_sample(df: DataFrame, row_id: Sequence[str] | str, n: int, limit: int | None = None) -> DataFrame:
    """All rows when there are no more than n, else n of them."""
    total = df.count()
    if total <= n:
        return df
    labelled = df.withColumn("_label", F.lit("all"))
    return smallest_hashes(labelled, row_id, "_label", {"all": n}, {"all": total}, limit).drop("_label")


def stratified_sample(df: DataFrame, row_id: Sequence[str] | str, label: str, size: int,
                      floors: dict[str, int], default_floor: int, limit: int | None = None) -> DataFrame:
    """Proportional share per label, at least a floor, at most the label's rows.

    A table of no more than ``size`` rows comes back whole. Labels are few: their counts are fetched.
    """
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    if total <= size:
        return df
    share = size / total
    take = {c: min(n, max(floors.get(c, default_floor), int(n * share))) for c, n in counts.items()}
    return smallest_hashes(df, row_id, label, take, counts, limit)


def hash_split(df: DataFrame, row_id: Sequence[str] | str, test_percent: int = 20,
               name: str = "is_test") -> DataFrame:
    """Mark about ``test_percent`` of the rows: a projection, no shuffle."""
    return df.withColumn(name, hash_percent(*_ids(row_id)) < test_percent)


def hash_folds(df: DataFrame, row_id: Sequence[str] | str, folds: int = 3, name: str = "fold",
               salt: str = "fold") -> DataFrame:
    """Assign cross-validation folds, independent of :func:`hash_split`."""
    return df.withColumn(name, hash_bucket(folds, F.lit(salt), *_ids(row_id)))


def tuning_subset(df: DataFrame, row_id: Sequence[str] | str, n: int = 30_000, validation_percent: int = 25,
                  name: str = "is_validation", limit: int | None = None) -> DataFrame:
    """A capped sample with a validation mark, chosen independently of the sample."""
    sample = capped_sample(df, row_id, n, limit)
    return sample.withColumn(name, hash_bucket(100, F.lit("tune"), *_ids(row_id)) < validation_percent)


def id_union(*tables: DataFrame) -> DataFrame:
    """Row ids that occur in any of the tables, each once."""
    united = tables[0]
    for t in tables[1:]:
        united = united.unionByName(t)
    return united.distinct()
