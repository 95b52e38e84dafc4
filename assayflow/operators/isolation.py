"""Isolation forest (Liu, Ting and Zhou 2008) as a Spark job.

Each tree grows on a small random sample of fixed size, so trees are grown in parallel, one group
per tree. The grown forest is a table of at most trees x (2 x sample - 1) nodes, whatever the size
of the data, and is sent to the executors once; rows are scored where they lie.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayflow import defaults
from assayflow.functions.numbers import finite, flag
from assayflow.operators.quantiles import exact_quantiles, quantile_values
from assayflow.sources.tables import cut_lineage

# Parameters of the published algorithm.
TREES = 100
SAMPLE = 256
EULER_GAMMA = 0.5772156649015329

OVERSAMPLING = 1.6
# Nodes are numbered as in a heap: the children of i are 2 i + 1 and 2 i + 2. A leaf has no feature.
NODES = "tree int, node int, size int, feature int, threshold double, path double"


def isolation_features(df: DataFrame, prefix: str = "fp_") -> list[str]:
    """All numeric columns apart from fingerprints; internal columns start with an underscore."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)
            and not f.name.startswith((prefix, "_"))]


def average_path(n: float) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    if n <= 1:
        return 0.0
    if n <= 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


class IsolationForest:
    def __init__(self, columns: Sequence[str], row_id: Sequence[str],
                 contamination: float = defaults.CONTAMINATION, seed: int = defaults.SEED,
                 trees: int = TREES, sample: int = SAMPLE):
        self.columns, self.row_id = list(columns), list(row_id)
        self.contamination, self.seed = contamination, seed
        self.trees, self.sample = trees, sample

    def fit(self, df: DataFrame, limit: int | None = None) -> "FittedForest":
        known = df.select(*[finite(F.col(c)).alias(n) for c, n in zip(self.columns, _names(self.columns))])
        middle = exact_quantiles(known, known.columns, [0.5], limit=limit).first()
        center = {c: (middle[f"q_{n}"] or [0.0])[0] for c, n in zip(self.columns, _names(self.columns))}
        samples = self._samples(df, center, middle["n_rows"])
        grow = _grower(len(self.columns), self.sample, self.seed)
        nodes = samples.groupBy("tree").applyInPandas(grow, NODES).toPandas()
        return FittedForest(self, center, nodes)

    def _samples(self, df: DataFrame, center: dict[str, float], n: int) -> DataFrame:
        """At most ``sample`` rows per tree, picked by a hash of the row id.

        One rule at any table size: a row is a candidate for each tree with the same chance p, independently. The first
        such tree of a row is drawn from the geometric distribution, which leaves most rows of a large table
        after one hash; only rows that have one are asked about the trees after it.
        """
        ids = F.concat_ws("-", F.lit(self.seed), *[F.col(c).cast("string") for c in self.row_id])
        rows = df.select(ids.alias("id"), *_filled(self.columns, center))
        chance = min(1.0, OVERSAMPLING * self.sample / max(n, 1))
        uniform = lambda text: F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(16 ** 13)
        first = F.lit(0) if chance == 1 else F.floor(F.log1p(-uniform(F.concat_ws("-", F.lit("first"), "id"))) / F.lit(math.log1p(-chance)))
        rows = rows.withColumn("first", first.cast("bigint")).filter(F.col("first") < self.trees)
        trees = F.filter(F.sequence(F.col("first").cast("int"), F.lit(self.trees - 1)),
                         lambda t: (t == F.col("first")) | (uniform(F.concat_ws("-", F.lit("later"), t.cast("string"), F.col("id"))) < chance))
        rows = rows.withColumn("tree", F.explode(trees)).withColumn("digest", F.md5(F.concat_ws("-", "tree", "id")))
        in_order = Window.partitionBy("tree").orderBy("digest", *_names(self.columns))
        return (rows.withColumn("rank", F.row_number().over(in_order))
                .filter(F.col("rank") <= self.sample).drop("id", "digest", "first"))


def _names(columns: Sequence[str]) -> list[str]:
    return [f"x{i}" for i in range(len(columns))]


def _filled(columns: Sequence[str], center: dict[str, float]) -> list:
    return [F.coalesce(finite(F.col(c)), F.lit(center[c])).alias(n) for c, n in zip(columns, _names(columns))]


def _grower(width: int, sample: int, seed: int):
    """The function that grows one tree from its sample, the same for any partitioning."""

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows["tree"].iloc[0])
        x = rows.sort_values("rank")[[f"x{i}" for i in range(width)]].to_numpy()
        rng = np.random.default_rng([seed, tree])
        deepest = math.ceil(math.log2(max(min(sample, len(x)), 2)))
        nodes = []
        waiting = [(np.arange(len(x)), 0, 0)]
        while waiting:
            members, depth, node = waiting.pop()
            grown = {"tree": tree, "node": node, "size": len(members), "feature": -1, "threshold": np.inf,
                     "path": depth + average_path(len(members))}
            nodes.append(grown)
            low, high = x[members].min(axis=0), x[members].max(axis=0)
            varying = np.flatnonzero(high > low)
            if depth >= deepest or len(members) < 2 or not len(varying):
                continue
            feature = int(rng.choice(varying))
            cut = float(rng.uniform(low[feature], high[feature]))
            if cut <= low[feature]:
                cut = float(np.nextafter(low[feature], np.inf))
            goes_left = x[members, feature] < cut
            grown.update(feature=feature, threshold=cut)
            waiting.append((members[goes_left], depth + 1, 2 * node + 1))
            waiting.append((members[~goes_left], depth + 1, 2 * node + 2))
        return pd.DataFrame(nodes)

    return grow


class FittedForest:
    """The grown trees with the medians that stand in for missing values."""

    def __init__(self, forest: IsolationForest, center: dict[str, float], nodes: pd.DataFrame):
        self.forest, self.center, self.nodes = forest, center, nodes

    def score(self, df: DataFrame, name: str = "iso_score") -> DataFrame:
        """Add the score, minus 2 ** (-mean path / expected path): higher is more normal."""
        if self.nodes.empty:
            return df.withColumn(name, F.lit(None).cast("double"))
        sample = int(self.nodes["size"].max())
        depth, expected = math.ceil(math.log2(max(sample, 2))), max(average_path(sample), 1.0)
        shared = df.sparkSession.sparkContext.broadcast(self._full_trees(depth))

        @F.pandas_udf("double")
        def anomaly(*columns: pd.Series) -> pd.Series:
            features, thresholds, paths = shared.value
            n = len(columns[0])
            values = np.concatenate([c.to_numpy(dtype=float) for c in columns])
            row, total = np.arange(n), np.zeros(n)
            for feature, threshold, path in zip(features, thresholds, paths):
                node = np.zeros(n, dtype=np.int64)
                for _ in range(depth):
                    value = values.take(feature.take(node) * n + row)
                    node = 2 * node + 1 + (value >= threshold.take(node))
                total += path.take(node)
            return pd.Series(-np.exp2(-total / len(paths) / expected))

        return df.withColumn(name, anomaly(*_filled(self.forest.columns, self.center)))

    def _full_trees(self, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Trees as arrays of equal depth; below an early leaf the way leads left to its path length."""
        tree = self.nodes["tree"].rank(method="dense").to_numpy(dtype=int) - 1
        shape = (tree.max() + 1, 2 ** (depth + 1) - 1)
        features, thresholds, paths = np.zeros(shape, int), np.full(shape, np.inf), np.zeros(shape)
        for t, node, feature, cut, path in zip(tree, self.nodes["node"], self.nodes["feature"],
                                               self.nodes["threshold"], self.nodes["path"]):
            features[t, node], thresholds[t, node] = max(feature, 0), cut
            while node < 2 ** depth - 1 and feature < 0:
                node = 2 * node + 1
            paths[t, node] = path
        return features, thresholds, paths

    def threshold_of(self, scored: DataFrame, column: str, limit: int | None = None) -> float:
        """The score below which the contamination share of the scored rows lies."""
        found = quantile_values(scored, [column], [self.forest.contamination], limit)[column]
        return found[0] if found else float("-inf")

    def flag(self, df: DataFrame, name: str = "iso", score: str | None = None,
             threshold: float | None = None, limit: int | None = None) -> DataFrame:
        """Flag rows whose score is strictly below the threshold, by default that of these rows.

        Rows are scored once: the scored rows are written, and the threshold is found there.
        """
        column = score or "_iso_score"
        scored = self.score(df, column)
        if threshold is None:
            scored = cut_lineage(scored)
            threshold = self.threshold_of(scored, column, limit)
        scored = scored.withColumn(name, flag(F.col(column) < F.lit(threshold)))
        return scored if score else scored.drop(column)
