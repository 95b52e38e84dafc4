"""Exact quantiles and order statistics whose task state does not grow with the data.

``percentile`` keeps a map of all values of a group in one task. It is used only while the values
of the largest group, over all columns, are known to fit. Larger groups are narrowed down first: a histogram per group tells which bin
holds the wanted rank, the next pass bins only the rows of that bin, and so on until the bracket
holds few rows or one value. Every pass shuffles bin counts, never rows, so a hot group costs as
little as any other, and the result is the same value ``percentile`` would give.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayflow.functions.numbers import nan_to_null
from assayflow.operators.joins import join_groups
from assayflow.sources.tables import cut_lineage, scope

# Values that one aggregation state may hold: for a whole table there is one state, for groups a task
# holds up to spark.sql.objectHashAggregate.sortBased.fallbackThreshold (128) of them at a time.
VALUES_OF_TABLE = 3_000_000
VALUES_OF_GROUP = 100_000
BINS = 4096


def exact_quantiles(df: DataFrame, values: Sequence[str], probs: Sequence[float],
                    by: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    """One row per group: ``n_rows``, and per value column ``n_<value>`` and the array ``q_<value>``.

    Linear interpolation between neighbours; NULL and NaN are left out; missing keys form one group.
    ``limit`` is the number of values up to which a group is worked out in one task.
    """
    by, values, probs = list(by), list(values), [float(p) for p in probs]
    df = df.select(*by, *[nan_to_null(F.col(v).cast("double")).alias(v) for v in values])
    counts = [F.count(F.lit(1)).alias("n_rows"), *[F.count(v).alias(f"n_{v}") for v in values]]
    largest = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    limit = (limit or (VALUES_OF_GROUP if by else VALUES_OF_TABLE)) // max(len(values), 1)
    if largest <= limit:
        return _in_one_task(df, values, probs, by, counts)

    sizes = cut_lineage(df.groupBy(*by).agg(*counts))
    if not by:
        return _narrowed(df, sizes, values, probs, by, limit)
    large = sizes.filter(F.col("n_rows") > limit)
    keys = large.select(*by)
    few = _in_one_task(join_groups(df, keys, by, "left_anti"), values, probs, by, counts)
    many = _narrowed(join_groups(df, keys, by, "left_semi"), large, values, probs, by, limit)
    return few.unionByName(many)


def _in_one_task(df, values, probs, by, counts) -> DataFrame:
    wanted = F.array(*[F.lit(p) for p in probs])
    return df.groupBy(*by).agg(*counts, *[F.percentile(v, wanted).alias(f"q_{v}") for v in values])


def _narrowed(df, sizes, values, probs, by, limit) -> DataFrame:
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with scope() as held:
            return held.keep(cut_lineage(_quantiles_by_ranks(df, sizes, values, probs, by, limit)))
    finally:
        df.unpersist()


def _quantiles_by_ranks(df, sizes, values, probs, by, limit) -> DataFrame:
    rows = long_form(df, values, by)
    keys = [*by, "measure"]
    position = lambda p: F.lit(p) * (F.col("n") - 1)
    ranks = F.array_distinct(F.array(*[end(position(p)) for p in probs for end in (F.floor, F.ceil)]))
    extent = rows.groupBy(*keys).agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    targets = (extent.withColumn("rank", F.explode(ranks))
               .select(*keys, "rank", "lo", "hi", F.lit(0).cast("bigint").alias("below"),
                       F.col("n").alias("inside")))
    found = (order_statistics(rows, targets, by, limit)
             .groupBy(*keys)
             .agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at")))
    per_measure = join_groups(found, extent.select(*keys, "n"), keys).withColumn(
        "q", F.array(*[_interpolate(F.col("at"), position(p)) for p in probs]))
    wide = per_measure.groupBy(*by).agg(
        *[F.max(F.when(F.col("measure") == v, F.col("q"))).alias(f"q_{v}") for v in values])
    if by:
        return join_groups(sizes, wide, by, "left")
    one = wide.first()
    return sizes.withColumns({f"q_{v}": F.lit(one[f"q_{v}"]) for v in values})


def _interpolate(at: Column, position: Column) -> Column:
    low, high = F.floor(position), F.ceil(position)
    return F.when(low == high, at[low]).otherwise(
        (high - position) * at[low] + (position - low) * at[high])


def long_form(df: DataFrame, values: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Rows (group, measure, x) without missing values."""
    pairs = F.array(*[F.struct(F.lit(v).alias("measure"), F.col(v).cast("double").alias("x")) for v in values])
    return (df.select(*by, F.inline(pairs)).filter(F.col("x").isNotNull()))


def order_statistics(rows: DataFrame, targets: DataFrame, by: Sequence[str] = (),
                     limit: int | None = None) -> DataFrame:
    """The values at 0-based ranks: (group, measure, rank, value).

    ``rows`` holds (group, measure, x). ``targets`` holds (group, measure, rank) with a bracket
    ``lo``..``hi`` known to contain the rank, ``below`` rows before it and ``inside`` rows in it. Each pass
    replaces the table of brackets, so two of them exist at most.
    """
    limit = min(limit or VALUES_OF_GROUP, VALUES_OF_GROUP)
    keys = [*by, "measure"]
    bracket = [*keys, "rank", "lo", "hi", "below", "inside"]
    settled = (F.col("inside") <= limit) | (F.col("lo") == F.col("hi"))
    targets = cut_lineage(targets.select(*bracket))
    while not targets.filter(~settled).isEmpty():
        wide = targets.filter(~settled)
        # Ranks in the same bracket share its bins, so a row is counted once for all of them.
        bins = (_rows_in_bracket(rows, wide.select(*keys, "lo", "hi", "below").distinct(), keys)
                .withColumn("bin", _bin(F.col("x"), F.col("lo"), F.col("hi")))
                .groupBy(*keys, "below", "bin")
                .agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("x").alias("inside")))
        in_order = Window.partitionBy(*keys, "below").orderBy("bin")
        bins = bins.withColumn("start", F.col("below") + F.sum("inside").over(in_order) - F.col("inside"))
        narrowed = (join_groups(wide.select(*keys, "rank", "below"), bins, [*keys, "below"])
                    .filter((F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("start") + F.col("inside")))
                    .select(*keys, "rank", "lo", "hi", F.col("start").alias("below"), "inside"))
        targets = cut_lineage(targets.filter(settled).select(*bracket).unionByName(narrowed), last=[targets])

    single = targets.filter(F.col("lo") == F.col("hi")).select(*keys, "rank", F.col("lo").alias("value"))
    gathered = (_rows_in_bracket(rows, targets.filter(F.col("lo") < F.col("hi")), keys)
                .groupBy(*keys, "rank", "below")
                .agg(F.sort_array(F.collect_list("x")).alias("xs"))
                .select(*keys, "rank", F.get("xs", (F.col("rank") - F.col("below")).cast("int")).alias("value")))
    return single.unionByName(gathered)


def _bin(x: Column, lo: Column, hi: Column) -> Column:
    """Bins of equal width that never fall with x. The ends have bins of their own.

    So every pass tells the ends apart, also when they are infinite or too far apart for a double.
    """
    share = F.try_divide(x / 2 - lo / 2, hi / 2 - lo / 2)
    inner = F.floor(F.coalesce(F.nanvl(share, F.lit(0.5)), F.lit(0.5)) * (BINS - 2))
    return (F.when(x == lo, F.lit(0).cast("bigint")).when(x == hi, F.lit(BINS - 1).cast("bigint"))
            .otherwise(F.least(inner, F.lit(BINS - 3)) + 1))


def _rows_in_bracket(rows, targets, keys) -> DataFrame:
    return (join_groups(rows, targets, keys)
            .filter(F.col("x").between(F.col("lo"), F.col("hi"))))


def quantile_values(df: DataFrame, values: Sequence[str], probs: Sequence[float],
                    limit: int | None = None) -> dict[str, list[float] | None]:
    """Quantiles of whole columns as driver-side numbers: one fixed-size row is fetched."""
    if not values:
        return {}
    # Columns are addressed by position so that their names may hold any character.
    renamed = df.select(*[F.col(f"`{v}`").alias(f"v{i}") for i, v in enumerate(values)])
    row = exact_quantiles(renamed, renamed.columns, probs, limit=limit).first()
    return {v: row[f"q_v{i}"] for i, v in enumerate(values)}


def medians(df: DataFrame, values: Sequence[str], limit: int | None = None) -> dict[str, float | None]:
    found = quantile_values(df, values, [0.5], limit)
    return {v: q[0] if q else None for v, q in found.items()}
