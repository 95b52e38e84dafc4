"""Aggregates behind the diagnostics: quartiles, correlation, histograms, counts."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayflow import defaults
from assayflow.functions.numbers import finite, flag, log10_positive
from assayflow.operators.joins import join_groups
from assayflow.operators.quantiles import exact_quantiles, quantile_values
from assayflow.sources.tables import cut_lineage

NARROW_COLUMNS = 6
#: A column varies if its variance is more than this share of its mean square about a middle value.
CONSTANT = 1e-13


def group_quartiles(df: DataFrame, group: str, value: str, limit: int | None = None) -> DataFrame:
    """(group, n_rows, n_valid, q1, q3) of log10 of the positive values."""
    logs = df.select(group, log10_positive(F.col(value)).alias("x"))
    found = exact_quantiles(logs, ["x"], [0.25, 0.75], [group], limit)
    return found.select(group, "n_rows", F.col("n_x").alias("n_valid"),
                        F.get("q_x", 0).alias("q1"), F.get("q_x", 1).alias("q3"))


def group_flag_rate(df: DataFrame, group: str, flagged: Column) -> DataFrame:
    """Share of flagged rows per group; rows without a value count in the denominator."""
    return df.groupBy(group).agg(F.avg(flag(flagged).cast("int")).alias("rate"))


def group_median_mad(df: DataFrame, values: Sequence[str], by: Sequence[str] = (),
                     limit: int | None = None) -> DataFrame:
    """Per group: ``med_<v>`` and ``mad_<v>``, the median distance from the median."""
    middle = exact_quantiles(df, values, [0.5], by, limit)
    middle = middle.select(*by, *[F.get(f"q_{v}", 0).alias(f"med_{v}") for v in values])
    if by:
        middle = cut_lineage(middle)  # its size decides how it is joined
        rows = join_groups(df.select(*by, *values), middle, by)
        distances = rows.select(*by, *[F.abs(F.col(v) - F.col(f"med_{v}")).alias(v) for v in values])
    else:
        center = middle.first()
        middle = df.sparkSession.createDataFrame([center], middle.schema)
        distances = df.select(*[F.abs(F.col(v) - F.lit(center[f"med_{v}"])).alias(v) for v in values])
    spread = exact_quantiles(distances, values, [0.5], by, limit)
    spread = spread.select(*by, *[F.get(f"q_{v}", 0).alias(f"mad_{v}") for v in values])
    if by:
        return join_groups(middle, spread, by)
    width = spread.first()
    return middle.withColumns({c: F.lit(width[c]) for c in spread.columns})


# --- correlation ---------------------------------------------------------------------------------

def corr_pairs(df: DataFrame, columns: Sequence[str], route: str | None = None) -> DataFrame:
    """Pearson correlation of every pair of columns over the rows where both are known.

    (x, y, r, n); r is NULL when either column is constant. A handful of columns is one aggregate ("aggregate");
    more go through a Gram matrix ("gram"). ``route`` chooses one of them.
    """
    if len(columns) < 2:
        return df.sparkSession.createDataFrame([], "x string, y string, r double, n bigint")
    narrow = len(columns) <= NARROW_COLUMNS if route is None else route == "aggregate"
    return _corr_aggregate(df, columns) if narrow else _corr_gram(df, columns)


def _corr_aggregate(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Moments per pair, over the rows of the pair only; Spark merges them without losing digits."""
    rows = df.select(*[finite(F.col(c)).alias(f"x{i}") for i, c in enumerate(columns)])
    pairs = list(combinations(range(len(columns)), 2))
    aggregates = []
    for p, (i, j) in enumerate(pairs):
        x, y = F.col(f"x{i}"), F.col(f"x{j}")
        xs, ys = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
        aggregates += [F.covar_pop(x, y).alias(f"c{p}"), F.stddev_pop(xs).alias(f"x{p}"), F.stddev_pop(ys).alias(f"y{p}"), F.count(xs).alias(f"n{p}")]
    row = rows.agg(*aggregates).first()
    found = []
    for p, (i, j) in enumerate(pairs):
        spread = (row[f"x{p}"] or 0.0) * (row[f"y{p}"] or 0.0)
        found.append((columns[i], columns[j], row[f"c{p}"] / spread if spread else None, row[f"n{p}"]))
    return df.sparkSession.createDataFrame(found, "x string, y string, r double, n bigint")


def _pearson(n: float, x: float, y: float, xx: float, yy: float, xy: float) -> float | None:
    """Correlation from sums; None when either column varies by no more than rounding does."""
    if not n:
        return None
    spread_x, spread_y = xx / n - (x / n) ** 2, yy / n - (y / n) ** 2
    if spread_x <= CONSTANT * xx / n or spread_y <= CONSTANT * yy / n:
        return None
    return float((xy / n - x / n * y / n) / (spread_x * spread_y) ** 0.5)


def _corr_gram(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One Gram matrix of (present, x, x*x) holds all pairwise-complete sums.

    The matrix is added up in a tree on the executors; what reaches the driver has the size of the
    column list.
    """
    k = len(columns)
    values = df.select(F.array(*[finite(F.col(c)) for c in columns]).alias("x"))
    # Centred by the median and scaled by the quartiles: a far value moves neither, so it costs other rows no digits.
    middle = values.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.percentile_approx("x", [0.25, 0.5, 0.75], 1000).alias("q")).collect()
    quartiles = {r["i"]: r["q"] or [0.0, 0.0, 0.0] for r in middle}
    centre = F.lit([float(quartiles[i][1]) for i in range(k)]) if quartiles else F.lit([0.0] * k)
    scale = F.lit([float(quartiles[i][2] - quartiles[i][0]) or 1.0 for i in range(k)]) if quartiles else F.lit([1.0] * k)
    scaled = F.zip_with(F.zip_with("x", centre, lambda x, m: x - m), scale, lambda x, s: x / s)
    values = values.select(scaled.alias("x"))
    parts = F.concat(F.transform("x", lambda x: x.isNotNull().cast("double")), F.transform("x", lambda x: F.coalesce(x, F.lit(0.0))),
                     F.transform("x", lambda x: F.coalesce(x * x, F.lit(0.0))))
    vectors = MLUtils.convertVectorColumnsFromML(values.select(array_to_vector(parts).alias("v")), "v")
    gram = RowMatrix(vectors).computeGramianMatrix().toArray()
    n, sx, sxx, xy = gram[:k, :k], gram[k:2 * k, :k], gram[2 * k:, :k], gram[k:2 * k, k:2 * k]
    found = [(columns[i], columns[j], _pearson(n[i, j], sx[i, j], sx[j, i], sxx[i, j], sxx[j, i], xy[i, j]), int(n[i, j]))
             for i, j in combinations(range(k), 2)]
    return df.sparkSession.createDataFrame(found, "x string, y string, r double, n bigint")


# --- counts and shares ---------------------------------------------------------------------------

def count_by(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def label_share(df: DataFrame, label: str) -> DataFrame:
    """Rows per label and their percentage of all rows."""
    total = max(df.count(), 1)
    return count_by(df, label).withColumn("percent", F.col("n") * 100.0 / F.lit(float(total)))


def profile_columns(df: DataFrame) -> DataFrame:
    """(column, data_type, n_rows, n_known) in one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in df.columns])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(t).alias("data_type"), F.col("_rows").alias("n_rows"),
                 F.col(c).alias("n_known")) for c, t in df.dtypes])))


def list_length_stats(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of the list lengths."""
    lengths = df.select(F.size(column).cast("double").alias("x")).filter(F.col("x") >= 0)
    quartiles = quantile_values(lengths, ["x"], [0.25, 0.5, 0.75], limit)["x"] or [None] * 3
    return lengths.agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"), *[F.lit(q).cast("double").alias(name)
                                   for name, q in zip(("q25", "q50", "q75"), quartiles)],
        F.max("x").alias("max"))


def bit_variance(df: DataFrame, bits_column: str, bits: int) -> DataFrame:
    """(bit, n_on, variance) for every bit number; the population variance of a 0/1 column is p(1-p).

    Set bits are counted inside each task first, so the shuffle carries at most ``bits`` rows per task.
    """
    n = df.count()
    on = (df.select(F.explode(bits_column).alias("bit")).groupBy("bit").agg(F.count(F.lit(1)).alias("n_on")))
    every = df.sparkSession.range(bits).select(F.col("id").cast("int").alias("bit"))
    p = F.try_divide(F.col("n_on").cast("double"), F.lit(float(n)))
    return (every.join(on, "bit", "left")
            .select("bit", F.coalesce("n_on", F.lit(0)).alias("n_on"))
            .withColumn("variance", p * (1 - p)))


# --- histograms and cuts -------------------------------------------------------------------------

def histogram(df: DataFrame, value: Column, bins: int | None = None) -> DataFrame:
    """(bin, lo, hi, n) over equal widths; without ``bins``, the square root of n within 20..80."""
    rows = df.select(value.alias("x")).filter(F.col("x").isNotNull())
    low, high, n = rows.agg(F.min("x"), F.max("x"), F.count("x")).first()
    if not n:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n bigint")
    bins = bins or min(80, max(20, int(n ** 0.5)))
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    place = F.least(F.floor((F.col("x") - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = rows.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin", (F.lit(low) + F.col("bin") * F.lit(width)).alias("lo"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
        F.coalesce("n", F.lit(0)).alias("n"))


def log_histogram(df: DataFrame, value: str, bins: int | None = None) -> DataFrame:
    return histogram(df, log10_positive(F.col(value)), bins)


def fence_positions(df: DataFrame, value: str, fence: float = defaults.FENCE,
                    limit: int | None = None) -> DataFrame:
    """Range of log10 values, the fences, and where the fences lie in percent of the range."""
    logs = df.select(log10_positive(F.col(value)).alias("x"))
    q1, q3 = quantile_values(logs, ["x"], [0.25, 0.75], limit)["x"] or (None, None)
    low, high = ((q1 - fence * (q3 - q1), q3 + fence * (q3 - q1)) if q1 is not None else (None, None))
    span = F.when(F.col("x_max") > F.col("x_min"), F.col("x_max") - F.col("x_min")).otherwise(F.lit(1e-6))
    percent = lambda bound: (F.col(bound) - F.col("x_min")) / span * 100
    return (logs.agg(F.min("x").alias("x_min"), F.max("x").alias("x_max"))
            .withColumns({"fence_lo": F.lit(low).cast("double"), "fence_hi": F.lit(high).cast("double")})
            .withColumns({"lo_percent": percent("fence_lo"), "hi_percent": percent("fence_hi")}))


def quantile_cut(df: DataFrame, score: str, q: float, name: str = "is_low",
                 limit: int | None = None) -> DataFrame:
    """Flag scores strictly below their quantile."""
    found = quantile_values(df, [score], [q], limit)[score]
    below = flag(F.col(score) < F.lit(found[0])) if found else F.lit(False)
    return df.withColumn(name, below)
