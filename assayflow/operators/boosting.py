"""Trees grown from histograms: second-order boosting, level by level or best leaf first, and forests with an out-of-bag score.

Features are cut into quantile bins once. To grow nodes, every task adds up gradients and second derivatives per node, feature and
bin over its rows; the sums of a feature meet in one task, which finds the best split of each node. A job returns
one row per node, whatever the size of the data. Gradients are whole multiples of 2^-20, so sums do not depend on the order of
addition and the same rows give the same trees for any partitioning. A missing value goes to the side that gains
more. What rows need between trees is one number, kept beside their bins in a written table that replaces its predecessor, so plans do
not grow with the number of trees. That table holds a block of rows per record, each column as the bytes of an array: a pass costs
a few array steps per block, and a row is only followed down to the nodes that grow.

A table whose rows fit one task needs no pass per level: the whole training runs there, on the same sums and so with the same trees, and
trainings of a search run side by side.
"""

from __future__ import annotations

import heapq
import math
import pickle
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field, fields, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assayflow import defaults
from assayflow.functions.numbers import finite
from assayflow.operators.quantiles import quantile_values
from assayflow.sources.tables import cut_lineage, free, scope, settings

#: Bin of a missing value, and gradients per unit.
MISSING, UNIT = 255, 1 << 20
#: Sums that one job holds per task, and trees between two writes of the rows.
CELLS, REWRITE = 1 << 22, 2
#: Distinct values of a feature that a task counts.
DISTINCT = 100_000
#: Bits of a number that one pass for medians looks at, and numbers of a leaf that are gathered in the end.
DIGIT, GATHERED = 16, 10_000
#: Rows of a node that one task grows to its end, and rows times trees that are dealt out at a time.
FINISHED, DEALT = 50_000, 50_000_000
#: Bytes of the rows that one task trains on alone, and those of a row beside its bins.
ALONE, ROW = 1 << 26, 59
#: Rows of a block. Blocks are large records, so few of them are read at a time.
WRITING = {"spark.sql.execution.arrow.maxRecordsPerBatch": "65536"}
READING = {"spark.sql.execution.arrow.maxBytesPerBatch": "16m", "spark.sql.parquet.columnarReaderBatchSize": "64"}


@dataclass(frozen=True)
class Settings:
    """``leaves`` grows the best leaf first up to that many; without it trees grow level by level to ``depth``. Trees of a forest
    without ``depth`` grow until no split gains anything.

    ``l1`` and ``l2`` shrink leaf values, a split must gain more than ``min_gain`` and leave ``min_weight`` on both sides. ``rows``
    and ``columns`` are the shares that a tree sees. ``loss`` is "squared" or "absolute"; the leaves of the latter are medians. ``measure``
    says the same of the error on check rows.
    """

    rounds: int = 500
    rate: float = 0.05
    depth: int | None = 6
    leaves: int | None = None
    l1: float = 0.0
    l2: float = 1.0
    min_gain: float = 0.0
    min_weight: float = 1.0
    rows: float = 0.8
    columns: float = 0.8
    bins: int = 255
    loss: str = "squared"
    seed: int = defaults.SEED
    measure: str = "squared"


@dataclass(eq=False)
class Tree:
    """Nodes as lists, or as arrays once grown; a leaf has feature -1. ``cut`` is the number of a cut: rows below it go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    weight: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, found: "Split", values: tuple[float, float]) -> tuple[int, int]:
        children = len(self.feature), len(self.feature) + 1
        self.feature[node], self.cut[node], self.missing_left[node] = found.feature, found.cut, found.missing_left
        self.left[node], self.right[node] = children
        self.gain[node], self.weight[node] = found.gain, found.h
        for value, weight in zip(values, (found.h_left, found.h - found.h_left), strict=True):
            for name, start in (("feature", -1), ("cut", 0), ("missing_left", False), ("left", 0), ("right", 0), ("gain", 0.0)):
                getattr(self, name).append(start)
            self.value.append(value)
            self.weight.append(weight)
        return children

    def leading(self, nodes: Iterable[int]) -> list[bool]:
        """For each node whether one of ``nodes`` is it or lies below it."""
        wanted = set(nodes)
        found = [n in wanted for n in range(len(self.feature))]
        for n in reversed(range(len(found))):  # children come after their parent
            if self.feature[n] >= 0:
                found[n] = found[n] or found[self.left[n]] or found[self.right[n]]
        return found

    def parts(self, bins: np.ndarray, rows: np.ndarray, leading: list[bool] | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves with the numbers of their rows, of ``rows``; only leaves on a leading path. ``bins`` has a line per feature."""
        waiting = [(0, rows)]
        while waiting:
            node, some = waiting.pop()
            if not len(some) or leading is not None and not leading[node]:
                continue
            if self.feature[node] < 0:
                yield node, some
                continue
            x = bins[self.feature[node]][some]
            left = (x <= self.cut[node]) & (x != MISSING)
            if self.missing_left[node]:
                left |= x == MISSING
            waiting += [(self.right[node], some[~left]), (self.left[node], some[left])]

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Tree) and all(list(getattr(self, f.name)) == list(getattr(other, f.name)) for f in fields(Tree))

    def packed(self) -> "Tree":
        """The same tree as arrays, which take a tenth of the memory."""
        kinds = (np.int32, np.int32, np.bool_, np.int32, np.int32, np.float64, np.float64, np.float64)
        return Tree(*[np.array(getattr(self, f.name), kind) for f, kind in zip(fields(Tree), kinds, strict=True)])

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of bins, a step per level."""
        t = self.packed()
        node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while True:
            rows = rows[t.feature[node[rows]] >= 0]
            if not len(rows):
                return node
            at = node[rows]
            x = bins[rows, t.feature[at]]
            left = np.where(x == MISSING, t.missing_left[at], x <= t.cut[at])
            node[rows] = np.where(left, t.left[at], t.right[at])


@dataclass(frozen=True)
class Split:
    gain: float
    feature: int
    cut: int
    missing_left: bool
    g_left: float
    h_left: float
    g: float
    h: float


def _shrunk(g, l1):
    return g if not l1 else np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def best_splits(g: np.ndarray, h: np.ndarray, s: Settings) -> tuple[np.ndarray, ...]:
    """Per node (rows of sums, the last bin is that of missing values) the best cut: gain, cut, side of missing values, sums of the left side.

    Gain is half of what the squared gradient over the weight grows by, less ``min_gain``; no allowed cut gives minus infinity. Ties go to
    the lower cut, and missing values to the right.
    """
    total_g, total_h = g.sum(axis=1), h.sum(axis=1)
    below_g, below_h = np.cumsum(g[:, :-2], axis=1), np.cumsum(h[:, :-2], axis=1)
    if not below_g.shape[1]:
        none = np.zeros(len(g))
        return np.full(len(g), -np.inf), none.astype(int), none.astype(bool), none, none
    score = lambda a, b: _shrunk(a / UNIT, s.l1) ** 2 / np.maximum(b / UNIT + s.l2, 1e-300)
    options = []
    for extra in (0, 1) if h[:, -1].any() else (0,):  # missing values right, missing values left
        left_g, left_h = below_g + extra * g[:, -1:], below_h + extra * h[:, -1:]
        right_g, right_h = total_g[:, None] - left_g, total_h[:, None] - left_h
        gain = 0.5 * (score(left_g, left_h) + score(right_g, right_h) - score(total_g, total_h)[:, None]) - s.min_gain
        least = np.maximum(s.min_weight * UNIT, 1)
        allowed = (left_h >= least) & (right_h >= least) & ((h[:, -1:] > 0) | (extra == 0))
        options.append((np.where(allowed, gain, -np.inf), left_g, left_h))
    rows = np.arange(len(g))
    if len(options) == 1:
        place = options[0][0].argmax(axis=1)
        return options[0][0][rows, place], place, np.zeros(len(g), bool), options[0][1][rows, place], options[0][2][rows, place]
    places = [o[0].argmax(axis=1) for o in options]
    gains = np.stack([o[0][rows, p] for o, p in zip(options, places, strict=True)])
    side = gains.argmax(axis=0)
    place = np.where(side == 1, places[1], places[0])
    pick = lambda k: np.where(side == 1, options[1][k][rows, place], options[0][k][rows, place])
    return gains.max(axis=0), place, side == 1, pick(1), pick(2)


def _mixed(u: np.ndarray, turn: int) -> np.ndarray:
    """53 bits per row and turn, from the hash of the row's id."""
    with np.errstate(over="ignore"):
        x = u.astype(np.uint64) + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(11)


def _uniform(u: np.ndarray, turn: int) -> np.ndarray:
    """A number from 0 to 1 per row and turn."""
    return _mixed(u, turn).astype(np.float64) / float(1 << 53)


#: Chances of 0, 1, 2, ... draws of a row in a bootstrap sample as large as the table.
POISSON = np.cumsum(np.exp(-1) / np.cumprod([1, *range(1, 12)]))
#: The same as whole numbers of 53 bits: a draw more for each that is reached.
POISSON_BITS = [np.uint64(v) for v in np.ceil(POISSON * float(1 << 53))]


def _draws_by_head() -> np.ndarray:
    """Draws of a row by the first 16 of its 53 bits; -1 where the others decide."""
    head = np.arange(1 << 16, dtype=np.uint64) << np.uint64(37)
    low, high = (sum((x >= least).astype(np.int8) for least in POISSON_BITS) for x in (head, head + np.uint64((1 << 37) - 1)))
    return np.where(low == high, low, -1).astype(np.int8)


DRAWS = _draws_by_head()


def bootstrap_weights(u: np.ndarray, tree: int) -> np.ndarray:
    """How often a tree draws each row."""
    x = _mixed(u, tree)
    drawn = DRAWS[(x >> np.uint64(37)).view(np.int64)]
    for row in np.flatnonzero(drawn < 0):
        drawn[row] = sum(x[row] >= least for least in POISSON_BITS)
    return drawn.astype(np.int64)


def ordered_bits(x: np.ndarray) -> np.ndarray:
    """Doubles as whole numbers of the same order."""
    bits = (x + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))


def ordered_numbers(bits: np.ndarray) -> np.ndarray:
    """The doubles again."""
    return np.where(bits >> np.uint64(63), bits & np.uint64((1 << 63) - 1), ~bits).view(np.float64)


# --- rows ----------------------------------------------------------------------------------------

def _values(df: DataFrame, features: str) -> Column:
    """Features as doubles, whether they come as a vector or as an array; what is not finite is missing."""
    column = vector_to_array(F.col(features)) if isinstance(df.schema[features].dataType, VectorUDT) else F.col(features)
    return F.transform(column, lambda x: finite(x))


def quantile_cuts(df: DataFrame, values: str, width: int, bins: int) -> list[np.ndarray]:
    """Distinct quantiles of every feature, at most ``bins`` - 1 of them. Features x bins numbers reach the driver.

    Features of at most ``DISTINCT`` values per task are counted by value; the others go through exact quantiles of their columns.
    """
    probs = [k / bins for k in range(1, bins)]
    found = _counted_quantiles(df, values, width, probs)
    many = [i for i in range(width) if i not in found]
    each = df.select(*[F.get(values, F.lit(i)).alias(f"f{i}") for i in many])
    found |= {int(n[1:]): q for n, q in quantile_values(each, each.columns, probs).items()}
    return [np.unique(found[i]) if found[i] else np.zeros(0) for i in range(width)]


def _counted_quantiles(df: DataFrame, values: str, width: int, probs: list[float]) -> dict[int, list[float] | None]:
    """Quantiles by feature number, of features with few distinct values per task."""
    most = min(DISTINCT, max(1, CELLS // max(width, 1)))

    def run(batches):
        held = [(np.zeros(0), np.zeros(0, np.int64))] * width
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            for i in (i for i in range(width) if held[i] is not None):
                x = flat[:, i]
                x, n = np.unique(x[~np.isnan(x)] + 0.0, return_counts=True)
                x, place = np.unique(np.concatenate([held[i][0], x]), return_inverse=True)
                total = np.zeros(len(x), np.int64)
                np.add.at(total, place, np.concatenate([held[i][1], n]))
                held[i] = (x, total) if len(x) <= most else None
        for i, kept in enumerate(held):
            x, n = (np.array([np.nan]), np.array([0])) if kept is None else kept
            yield pa.RecordBatch.from_pydict({"i": pa.array(np.full(len(x), i), pa.int32()), "x": x, "n": n})

    counts = cut_lineage(df.select(values).mapInArrow(run, "i int, x double, n long").groupBy("i", "x").agg(F.sum("n").alias("n")))
    many = {r["i"] for r in counts.where(F.isnan("x")).select("i").collect()}
    ended = counts.where(~F.col("i").isin(many) if many else F.lit(True)).withColumn("end", F.sum("n").over(Window.partitionBy("i").orderBy("x")))
    sizes = {r["i"]: r["n"] for r in ended.groupBy("i").agg(F.sum("n").alias("n")).collect()}
    # The value at a rank is the first whose running count exceeds it.
    wanted = [(i, r) for i, n in sizes.items() for r in sorted({int(end(p * (n - 1))) for p in probs for end in (np.floor, np.ceil)})]
    ranks = df.sparkSession.createDataFrame(wanted, "i int, r long")
    at = {(r["i"], r["r"]): r["x"] for r in ended.join(F.broadcast(ranks), "i").where("r < end and r >= end - n").select("i", "r", "x").collect()}
    free(counts)

    def quantile(i: int, p: float) -> float:
        position = p * (sizes[i] - 1)
        low, high = int(np.floor(position)), int(np.ceil(position))
        a, b = at[i, low], at[i, high]
        return a if a == b else (high - position) * a + (position - low) * b

    return {i: [quantile(i, p) for p in probs] if sizes.get(i) else None for i in range(width) if i not in many}


def _binned(values: pa.Array, cuts: list[np.ndarray]) -> np.ndarray:
    flat = values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), len(cuts))
    made = np.empty(flat.shape, np.uint8)
    for i, c in enumerate(cuts):
        made[:, i] = np.where(np.isnan(flat[:, i]), MISSING, np.searchsorted(c, flat[:, i], side="right"))
    return made


BLOCKS = "u binary, y binary, margin binary, is_check binary, bins binary"


def _bin_rows(df: DataFrame, cuts: list[np.ndarray], base: float) -> DataFrame:
    """A block per Arrow batch."""
    def run(batches):
        for batch in batches:
            y = batch.column("y").to_numpy()
            block = {"u": batch.column("u").to_numpy(), "y": y, "margin": np.full(len(y), base),
                     "is_check": batch.column("is_check").to_numpy(zero_copy_only=False), "bins": np.ascontiguousarray(_binned(batch.column("values"), cuts).T)}
            yield pa.RecordBatch.from_pydict({n: pa.array([v.tobytes()], pa.binary()) for n, v in block.items()})

    return df.select("u", "y", "values", "is_check").mapInArrow(run, BLOCKS)


@dataclass
class Block:
    """Some rows; ``bins`` has a line per feature."""

    u: np.ndarray
    y: np.ndarray
    margin: np.ndarray
    is_check: np.ndarray
    bins: np.ndarray


def _blocks(batch: pa.RecordBatch, width: int) -> Iterator[Block]:
    kinds = (("u", np.int64), ("y", np.float64), ("margin", np.float64), ("is_check", np.bool_), ("bins", np.uint8))
    for k in range(batch.num_rows):
        u, y, margin, is_check, bins = (np.frombuffer(batch.column(n)[k].as_py(), kind) for n, kind in kinds)
        yield Block(u, y, margin, is_check, bins.reshape(width, len(y)))


@dataclass
class Growing:
    """What a task needs to know: trees that rows have not been moved by yet, the trees that grow, and their open nodes."""

    width: int
    size: int
    settings: Settings
    done: list[Tree]
    trees: dict[int, Tree]
    open: dict[int, list[int]]
    columns: dict[int, list[int]]
    bootstrap: bool = False
    check: bool = False

    def margin(self, block: Block) -> np.ndarray:
        return moved(block.margin, block.bins.T, self.done, self.settings.rate)

    def weights(self, block: Block, tree: int) -> np.ndarray:
        taken = ~block.is_check
        if self.bootstrap:
            return taken * bootstrap_weights(block.u, tree)
        return taken & (_uniform(block.u, tree) < self.settings.rows) if self.settings.rows < 1 else taken


def moved(margin: np.ndarray, bins: np.ndarray, trees: Iterable[Tree], rate: float) -> np.ndarray:
    for tree in trees:
        margin = margin + rate * np.array(tree.value)[tree.leaf_of(bins)]
    return margin


def _gradients(y: np.ndarray, margin: np.ndarray, loss: str) -> np.ndarray:
    """Whole numbers, as doubles."""
    slope = np.sign(margin - y) if loss == "absolute" else margin - y
    return np.rint(slope * UNIT)


def _loss(rest: np.ndarray, measure: str) -> int:
    """The sum of the errors, in whole units."""
    return int(np.rint((np.abs(rest) if measure == "absolute" else rest ** 2) * UNIT).sum())


SUMS = "tree int, node int, feature int, g array<long>, h array<long>"


def _partial_sums(job: Growing):
    """Per open node and feature the sums of a partition; the check loss comes as feature -1."""
    def run(batches):
        slots = [(t, n) for t, nodes in job.open.items() for n in nodes]
        first = {t: slots.index((t, nodes[0])) for t, nodes in job.open.items()}
        leading = {t: job.trees[t].leading(nodes) for t, nodes in job.open.items()}
        g, h = (np.zeros((len(slots), job.width, job.size), np.int64) for _ in range(2))
        loss, checked = 0, 0
        for block in (b for batch in batches for b in _blocks(batch, job.width)):
            margin = job.margin(block)
            slope = _gradients(block.y, margin, job.settings.loss)
            if job.check:
                held = block.is_check
                loss += _loss(margin[held] - block.y[held], job.settings.measure)
                checked += int(held.sum())
            for t, nodes in job.open.items():
                weight = job.weights(block, t)
                found = list(job.trees[t].parts(block.bins, np.flatnonzero(weight > 0), leading[t]))
                if not found:
                    continue
                number = {n: k for k, n in enumerate(nodes)}
                rows = np.concatenate([r for _, r in found])
                some = np.repeat([256 * number[n] for n, _ in found], [len(r) for _, r in found])
                drawn = weight[rows].astype(np.float64) if job.bootstrap else None
                weighted, total = slope[rows] if drawn is None else slope[rows] * drawn, slice(first[t], first[t] + len(nodes))
                for i in job.columns[t]:
                    at = some + block.bins[i][rows]
                    for sums, what in ((g, weighted), (h, drawn)):
                        made = np.bincount(at, what, minlength=256 * len(nodes)).astype(np.int64).reshape(len(nodes), 256)
                        # The bin of missing values comes last.
                        sums[total, i, :-1] += made[:, :job.size - 1]
                        sums[total, i, -1] += made[:, MISSING]
        out = [(t, n, i, g[k, i], h[k, i] * UNIT) for k, (t, n) in enumerate(slots) for i in job.columns[t] if h[k, i].any()]
        if job.check and checked:
            out.append((-1, -1, -1, np.array([loss]), np.array([checked])))
        if out:
            tree, node, feature, a, b = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([*[pa.array(x, pa.int32()) for x in (tree, node, feature)], *[pa.array(list(x), pa.list_(pa.int64())) for x in (a, b)]],
                                             names=["tree", "node", "feature", "g", "h"])
    return run


def _feature_splits(s: Settings, sizes: list[int]):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        feature = int(rows["feature"].iloc[0])
        nodes, place = np.unique(rows["node"].to_numpy(), return_inverse=True)
        g, h = (np.zeros((len(nodes), len(rows[c].iloc[0])), np.int64) for c in ("g", "h"))
        np.add.at(g, place, np.stack(rows["g"].to_list()))
        np.add.at(h, place, np.stack(rows["h"].to_list()))
        made = {"tree": rows["tree"].iloc[0], "node": nodes, "feature": feature}
        if feature < 0:
            return pd.DataFrame(made | {"gain": g[:, 0] / UNIT / h[:, 0], "cut": 0, "missing_left": False, "g_left": 0, "h_left": 0, "g": 0, "h": 0})
        used = [*range(sizes[feature] + 1), g.shape[1] - 1]  # bins of this feature, then the missing values
        gain, cut, missing_left, g_left, h_left = best_splits(g[:, used], h[:, used], s)
        return pd.DataFrame(made | {"gain": gain, "cut": cut, "missing_left": missing_left, "g_left": g_left.astype(np.int64), "h_left": h_left.astype(np.int64),
                                    "g": g.sum(axis=1), "h": h.sum(axis=1)})
    return run


def _search(rows: DataFrame, job: Growing, sizes: list[int]) -> tuple[dict[tuple[int, int], Split], float | None]:
    """The best split of every open node, and the mean squared error on the check rows if asked for."""
    sums = rows.mapInArrow(_partial_sums(job), SUMS)
    each = sums.groupBy("tree", "feature").applyInPandas(
        _feature_splits(job.settings, sizes), "tree int, node int, feature int, gain double, cut int, missing_left boolean, g_left long, h_left long, g long, h long")
    order = F.struct("gain", (-F.col("feature")).alias("f"), "cut", "missing_left", "g_left", "h_left", "g", "h")
    found, error = {}, None
    with settings(rows.sparkSession, READING):
        best = each.groupBy("tree", "node").agg(F.max(order).alias("b")).collect()
    for r in best:
        b = r["b"]
        if r["node"] < 0:
            error = b["gain"]
        else:
            found[r["tree"], r["node"]] = Split(b["gain"], -b["f"], b["cut"], b["missing_left"], b["g_left"] / UNIT, b["h_left"] / UNIT, b["g"] / UNIT, b["h"] / UNIT)
    return found, error


def _leaf_value(g: float, h: float, s: Settings) -> float:
    return float(-_shrunk(g, s.l1) / (h + s.l2)) if h + s.l2 > 0 else 0.0


def _child_values(found: Split, s: Settings) -> tuple[float, float]:
    return _leaf_value(found.g_left, found.h_left, s), _leaf_value(found.g - found.g_left, found.h - found.h_left, s)


def _worth(found: Split | None) -> bool:
    return found is not None and found.gain > 0 and np.isfinite(found.gain)


# --- models --------------------------------------------------------------------------------------

@dataclass
class FittedTrees:
    """Trees with the cuts of their features. A boosted model adds trees up, a forest takes their mean."""

    trees: list[Tree]
    cuts: list[np.ndarray]
    base: float
    rate: float
    features: str
    mean: bool = False

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per node: rows with ``feature`` below ``cut`` go left."""
        rows = []
        for t, tree in enumerate(Tree(*[np.asarray(getattr(tree, f.name)).tolist() for f in fields(Tree)]) for tree in self.trees):
            for n, f in enumerate(tree.feature):
                leaf = f < 0
                rows.append((t, n, None if leaf else f, None if leaf else float(self.cuts[f][tree.cut[n]]), None if leaf else tree.missing_left[n],
                             None if leaf else tree.left[n], None if leaf else tree.right[n], tree.value[n] if leaf else None,
                             None if leaf else tree.gain[n], tree.weight[n]))
        return spark.createDataFrame(rows, "tree int, node int, feature int, cut double, missing_left boolean, left int, right int, value double, gain double, weight double")

    @staticmethod
    def from_table(nodes: DataFrame, cuts: list[list[float]], **facts) -> "FittedTrees":
        """The trees of a node table again."""
        trees: dict[int, Tree] = {}
        arrays = [np.array(c, float) for c in cuts]
        for r in nodes.orderBy("tree", "node").collect():
            tree, leaf = trees.setdefault(r["tree"], Tree(*[[] for _ in fields(Tree)])), r["feature"] is None
            cut = 0 if leaf else int(np.searchsorted(arrays[r["feature"]], r["cut"]))
            for f, v in zip(fields(Tree), (-1 if leaf else r["feature"], cut, r["missing_left"], r["left"], r["right"], r["value"], r["gain"], r["weight"]), strict=True):
                getattr(tree, f.name).append(v or 0)
        return FittedTrees([trees[t].packed() for t in sorted(trees)], arrays, **facts)

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """Add the prediction. Rows are scored where they lie, in batches."""
        shared = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def score(values: pd.Series) -> pd.Series:
            m = shared.value
            if not len(values):
                return pd.Series(dtype=float)
            bins = _binned(pa.array(values, pa.list_(pa.float64())), m.cuts) if m.cuts else np.zeros((len(values), 0), np.uint8)
            total = moved(np.full(len(bins), 0.0 if m.mean else m.base), bins, m.trees, 1.0 if m.mean else m.rate)
            return pd.Series(total / max(len(m.trees), 1) if m.mean else total)

        return df.withColumn(name, score(_values(df, self.features)))

    def error_sums(self, batches: Iterable[pa.RecordBatch], loss: str) -> tuple[np.ndarray, int]:
        """Sums of the errors after 1, 2, ... trees over rows of values and y, and their number."""
        sums, n = np.zeros(len(self.trees)), 0
        for batch in batches:
            y = batch.column("y").to_numpy()
            bins = _binned(batch.column("values"), self.cuts)
            margin, n = np.full(len(y), self.base), n + len(y)
            for k, tree in enumerate(self.trees):
                margin = margin + self.rate * np.asarray(tree.value)[tree.leaf_of(bins)]
                rest = margin - y
                sums[k] += (np.abs(rest) if loss == "absolute" else rest ** 2).sum()
        return sums, n

    def importance(self) -> np.ndarray:
        """Share of the gain of all splits per feature."""
        total = np.zeros(len(self.cuts))
        for tree in self.trees:
            for f, gain in zip(tree.feature, tree.gain, strict=True):
                if f >= 0:
                    total[f] += gain
        return total / total.sum() if total.sum() else total


def medians_by_digits(table: DataFrame, numbers: Callable, groups: list[int]) -> dict[int, float]:
    """Exact medians of what ``numbers`` makes of the Arrow batches of a table: groups with numbers of theirs, as ordered bits.

    Counts per digit tell where the middle lies, until few numbers are left to be gathered. Groups without numbers have no median.
    """
    def heads(batches, wanted):
        for group, bits in numbers(batches):
            for k, (_, head, shift) in ((k, w) for k, w in enumerate(wanted) if w[0] == group):
                yield k, bits if not shift else bits[bits >> np.uint64(64 - shift) == np.uint64(head)], shift

    def counts(wanted: list[tuple[int, int, int]]) -> DataFrame:
        """Numbers per group whose first ``shift`` bits are ``head``, by the digit that follows; ``below`` come before, ``all`` are in the group."""
        def run(batches):
            n = np.zeros((len(wanted), 1 << DIGIT), np.int64)
            for k, bits, shift in heads(batches, wanted):
                n[k] += np.bincount((bits >> np.uint64(64 - shift - DIGIT)).astype(np.int64) & ((1 << DIGIT) - 1), minlength=1 << DIGIT)
            slot, digit = np.nonzero(n)
            yield pa.RecordBatch.from_pydict({"slot": pa.array(slot, pa.int32()), "digit": pa.array(digit, pa.int32()), "n": n[slot, digit]})
        each = table.mapInArrow(run, "slot int, digit int, n long").groupBy("slot", "digit").agg(F.sum("n").alias("n"))
        ended = F.sum("n").over(Window.partitionBy("slot").orderBy("digit"))
        return each.withColumns({"below": ended - F.col("n"), "all": F.sum("n").over(Window.partitionBy("slot"))})

    def gathered(wanted: list[tuple[int, int, int]]):
        def run(batches):
            for k, bits, _ in heads(batches, wanted):
                yield pa.RecordBatch.from_pydict({"slot": pa.array(np.full(len(bits), k), pa.int32()), "bits": bits.view(np.int64)})
        return table.mapInArrow(run, "slot int, bits long").groupBy("slot").agg(F.collect_list("bits").alias("bits")).collect()

    ranks, few, found = {}, {}, {}
    open_ = {(group, 0, 0): [] for group in groups}
    while open_:
        wanted, following = list(open_), {}
        here = F.col("below") + F.col("n")
        if not ranks:  # the first pass also tells how many numbers a group has
            looked = counts(wanted).where((F.col("below") <= F.floor(F.col("all") / 2)) & (here > F.floor((F.col("all") - 1) / 2))).collect()
            ranks = {wanted[r["slot"]][0]: ((r["all"] - 1) // 2, r["all"] // 2) for r in looked}
            open_ = {(group, 0, 0): [(rank, 0) for rank in sorted(set(both))] for group, both in ranks.items()}
        else:
            holds = [(F.col("slot") == k) & (F.col("below") <= rank - below) & (here > rank - below) for k, w in enumerate(wanted) for rank, below in open_[w]]
            looked = counts(wanted).where(reduce(lambda a, b: a | b, holds)).collect()
        for r in looked:
            group, head, shift = wanted[r["slot"]]
            for rank, below in open_[group, head, shift]:
                start = below + r["below"]
                if start <= rank < start + r["n"]:
                    place = (group, head << DIGIT | r["digit"], shift + DIGIT)
                    if place[2] == 64:
                        found[group, rank] = place[1]
                    else:
                        (few if r["n"] <= GATHERED else following).setdefault(place, []).append((rank, start))
        open_ = following
    wanted = list(few)
    for r in gathered(wanted) if wanted else ():
        values = np.sort(np.array(r["bits"], np.int64).view(np.uint64))
        for rank, start in few[wanted[r["slot"]]]:
            found[wanted[r["slot"]][0], rank] = int(values[rank - start])
    value = lambda group, rank: float(ordered_numbers(np.array([found[group, rank]], np.uint64))[0])
    return {g: value(g, a) if a == b else 0.5 * value(g, a) + 0.5 * value(g, b) for g, (a, b) in ranks.items()}


def known_rows(train: DataFrame, row_id: Sequence[str] | str, s: Settings, features: str = "features", label: str = "label", check: Column | None = None) -> DataFrame:
    """(u, y, values, is_check): a hash of the row's id, label and features as numbers, and whether the row only measures the error. Rows without label are out."""
    ids = [row_id] if isinstance(row_id, str) else list(row_id)
    return train.select(F.xxhash64(F.lit(s.seed), *[F.col(c) for c in ids]).alias("u"), finite(F.col(label).cast("double")).alias("y"),
                        _values(train, features).alias("values"), F.coalesce(check if check is not None else F.lit(False), F.lit(False)).alias("is_check")).where("y is not null")


class Training:
    """Boosting that can be carried on: ``grow`` adds trees, ``model`` gives those up to a round, ``close`` deletes the written rows.

    ``train`` has ``features`` (a vector or an array) and ``label``; rows with a missing label take no part. ``check`` is a condition for the rows that
    only measure the error. The trees depend on the rows and their ids alone, not on partitions.
    """

    def __init__(self, train: DataFrame, row_id: Sequence[str] | str, settings: Settings = Settings(), features: str = "features", label: str = "label",
                 check: Column | None = None, bootstrap: bool = False):
        if settings.depth is None and not settings.leaves and not bootstrap:
            raise ValueError("boosted trees need a depth or a number of leaves")
        self.settings, self.features, self.bootstrap = settings, features, bootstrap
        self.trees, self.pending, self.errors = [], [], []
        with scope() as held:
            self.rows = held.keep(self._prepared(train, [row_id] if isinstance(row_id, str) else list(row_id), label, check))

    def _prepared(self, train: DataFrame, ids: list[str], label: str, check: Column | None) -> DataFrame:
        s = self.settings
        known = cut_lineage(known_rows(train, ids, s, self.features, label, check))
        fit = known.where(~F.col("is_check"))
        facts = fit.agg(F.max(F.size("values")), F.avg("y")).first()
        self.width, mean = facts[0] or 0, facts[1] or 0.0
        if s.loss == "absolute":
            labels = lambda batches: ((0, ordered_bits(batch.column("y").to_numpy())) for batch in batches)
            mean = medians_by_digits(fit.select("y"), labels, [0]).get(0, mean)
        self.base = 0.0 if self.bootstrap else round(mean, 6)
        if not 2 <= s.bins <= MISSING:
            raise ValueError(f"bins must be from 2 to {MISSING}")
        self.cuts = quantile_cuts(fit, "values", self.width, s.bins)
        with settings(train.sparkSession, WRITING):
            return cut_lineage(_bin_rows(known, self.cuts, self.base), last=[known])

    def __enter__(self) -> "Training":
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        free(self.rows)

    def model(self, rounds: int | None = None) -> FittedTrees:
        return FittedTrees(self.trees[:rounds], self.cuts, self.base, self.settings.rate, self.features, mean=self.bootstrap)

    def _columns(self, tree: int) -> list[int]:
        return tree_columns(self.settings, tree, self.width)

    def _splits(self, trees: dict[int, Tree], open_: dict[int, list[int]], check: bool = False) -> dict[tuple[int, int], Split]:
        """Best splits of open nodes, as many at once as tasks may hold sums for."""
        size = max((len(c) for c in self.cuts), default=0) + 2
        most, found = max(1, CELLS // max(self.width * size, 1)), {}
        nodes = [(t, n) for t, some in open_.items() for n in some]
        for i in range(0, len(nodes), most):
            part: dict[int, list[int]] = {}
            for t, n in nodes[i:i + most]:
                part.setdefault(t, []).append(n)
            job = Growing(self.width, size, self.settings, self.pending, {t: trees[t] for t in part}, part, {t: self._columns(t) for t in part},
                          self.bootstrap, check and i == 0)
            more, error = _search(self.rows, job, [len(c) for c in self.cuts])
            found |= more
            if error is not None:
                self.errors.append(error)
        return found

    def grow_trees(self, numbers: list[int], check: bool = False) -> dict[int, Tree]:
        """Trees that do not depend on each other, all levels or leaves at once."""
        s, trees = self.settings, {t: Tree() for t in numbers}
        found = self._splits(trees, {t: [0] for t in trees}, check)
        for (t, _), split in found.items():
            trees[t].value[0], trees[t].weight[0] = _leaf_value(split.g, split.h, s), split.h
        if s.leaves:
            for t in numbers:
                self._grow_leaves(t, trees[t], found.get((t, 0)))
            return trees
        level = 0
        while True:
            open_: dict[int, list[int]] = {}
            for (t, n), split in sorted(found.items(), key=lambda item: item[0]):
                # Without a depth, nodes that fit one task are finished there.
                if _worth(split) and (s.depth is not None or split.h > FINISHED):
                    below = trees[t].split(n, split, _child_values(split, s))
                    open_.setdefault(t, []).extend(c for c in below if s.depth is not None or trees[t].weight[c] > FINISHED)
            level += 1
            if not any(open_.values()) or level == s.depth:
                break
            found = self._splits(trees, open_)
        return trees

    def _grow_leaves(self, number: int, tree: Tree, root: Split | None) -> None:
        """Split the leaf that gains most, until there are ``leaves`` of them.

        A pass looks below all leaves that may be next, in a trial tree that is grown ahead; the tree is then grown from what is known.
        """
        trial, known = Tree(), {0: root}
        while True:
            made, missing = self._best_first(trial, known, tree.value[0], tree.weight[0])
            if not missing:
                break
            below = [n for node in missing for n in trial.split(node, known[node], _child_values(known[node], self.settings))]
            known |= dict.fromkeys(below) | {n: split for (_, n), split in self._splits({number: trial}, {number: below}).items()}
        tree.__dict__.update(made.__dict__)

    def _best_first(self, trial: Tree, known: dict[int, Split | None], value: float, weight: float) -> tuple[Tree, list[int]]:
        """The tree as far as the splits of the trial tree are known, and the nodes of that to look below: those that gain most among the leaves."""
        tree, leaves = Tree(value=[value], weight=[weight]), 1
        waiting = [(-known[0].gain, 0, 0)] if _worth(known[0]) else []
        while waiting and leaves < self.settings.leaves:
            _, node, at = heapq.heappop(waiting)
            if trial.feature[at] < 0 and leaves + 1 < self.settings.leaves:
                others = heapq.nsmallest(self.settings.leaves - leaves - 1, waiting)
                return tree, [at, *[n for _, _, n in others if trial.feature[n] < 0]]
            children = tree.split(node, known[at], _child_values(known[at], self.settings))
            leaves += 1
            if leaves < self.settings.leaves:
                for n, below in zip(children, (trial.left[at], trial.right[at]), strict=True):
                    if _worth(known[below]):
                        heapq.heappush(waiting, (-known[below].gain, n, below))
        return tree, []

    def grow(self, rounds: int, patience: int | None = None) -> "Training":
        """Add up to ``rounds`` trees; stop when the check error has not improved for ``patience`` trees."""
        for _ in range(rounds):
            number = len(self.trees)
            tree = self.grow_trees([number], check=True)[number]
            if patience is not None and self.stopped(patience):
                break
            if self.settings.loss == "absolute":
                self._take_medians(tree)
            self.trees.append(tree)
            self.pending = [*self.pending, tree]
            if len(self.pending) == REWRITE:
                self._move_rows()
        return self

    def stopped(self, patience: int) -> bool:
        """Whether the least error, which counts trees from 0, lies ``patience`` trees back."""
        return _waited(self.errors, patience)

    def _take_medians(self, tree: Tree) -> None:
        """The median of what is left of the labels, per leaf."""
        leaves = [n for n, f in enumerate(tree.feature) if f < 0]
        most = max(1, CELLS >> DIGIT)
        for i in range(0, len(leaves), most):
            for leaf, middle in self._medians(tree, leaves[i:i + most]).items():
                tree.value[leaf] = middle

    def _medians(self, tree: Tree, leaves: list[int]) -> dict[int, float]:
        job, leading = Growing(self.width, 0, self.settings, self.pending, {}, {}, {}), tree.leading(leaves)

        def numbers(batches):
            for block in (b for batch in batches for b in _blocks(batch, job.width)):
                rest = block.y - job.margin(block)
                for leaf, rows in tree.parts(block.bins, np.flatnonzero(~block.is_check), leading):
                    yield leaf, ordered_bits(rest[rows])

        with settings(self.rows.sparkSession, READING):
            return medians_by_digits(self.rows, numbers, leaves)

    def _move_rows(self) -> None:
        job = Growing(self.width, 0, self.settings, self.pending, {}, {}, {})

        def run(batches):
            for batch in batches:
                margin = pa.array([job.margin(b).tobytes() for b in _blocks(batch, job.width)], pa.binary())
                yield pa.RecordBatch.from_arrays([margin if n == "margin" else c for n, c in zip(batch.schema.names, batch.columns, strict=True)], names=batch.schema.names)

        with settings(self.rows.sparkSession, READING):
            self.rows = cut_lineage(self.rows.mapInArrow(run, self.rows.schema), last=[self.rows])
        self.pending = []

    def check_error(self) -> float:
        """The error on the check rows with all trees."""
        job = Growing(self.width, 0, self.settings, self.pending, {}, {}, {})

        def run(batches):
            loss, n = 0, 0
            for block in (b for batch in batches for b in _blocks(batch, job.width)):
                rest = (job.margin(block) - block.y)[block.is_check]
                loss, n = loss + _loss(rest, job.settings.measure), n + len(rest)
            yield pa.RecordBatch.from_pydict({"loss": [loss], "n": [n]})

        with settings(self.rows.sparkSession, READING):
            found = self.rows.mapInArrow(run, "loss long, n long").agg(F.sum("loss"), F.sum("n")).first()
        return found[0] / UNIT / found[1] if found[1] else float("nan")


# --- tables of one task --------------------------------------------------------------------------

def rows_of_one_task(known: DataFrame) -> bool:
    """Whether one task can hold the rows (and there are some)."""
    n, width = known.agg(F.count("*"), F.max(F.size("values"))).first()
    return n > 0 and n * ((width or 0) + ROW) <= ALONE


def _task_quantiles(x: np.ndarray, bins: int) -> np.ndarray:
    """The cuts that ``quantile_cuts`` finds."""
    x = np.sort(x[~np.isnan(x)] + 0.0)
    if not len(x):
        return np.zeros(0)
    position = np.array([k / bins for k in range(1, bins)]) * (len(x) - 1)
    low, high = np.floor(position), np.ceil(position)
    a, b = x[low.astype(np.int64)], x[high.astype(np.int64)]
    return np.unique(np.where(a == b, a, (high - position) * a + (position - low) * b))


def _middle(x: np.ndarray) -> float:
    """The median of sorted numbers."""
    a, b = float(x[(len(x) - 1) // 2]), float(x[len(x) // 2])
    return a if a == b else 0.5 * a + 0.5 * b


class Chunk:
    """Some rows on the way through a training: those that only measure the error come last."""

    def __init__(self, u: np.ndarray, y: np.ndarray, held: np.ndarray, bins: np.ndarray, base: float):
        order = np.argsort(held, kind="stable")
        self.n, self.n_fit = len(y), int((~held).sum())
        self.u, self.y, self.bins, self.margin = u[order], y[order], np.ascontiguousarray(bins[:, order]), np.full(len(y), base)

    def begin(self, s: Settings, tree: int, bootstrap: bool) -> None:
        self.slope = _gradients(self.y, self.margin, s.loss)
        self.place, self.leaf, self.drawn = (np.zeros(self.n, kind) for kind in (np.int64, np.int64, np.int8))
        some = self.u[:self.n_fit]
        self.drawn[:self.n_fit] = bootstrap_weights(some, tree) if bootstrap else _uniform(some, tree) < s.rows if s.rows < 1 else 1

    def move(self, feature: np.ndarray, side: np.ndarray, nodes: np.ndarray) -> None:
        """Rows go to the open nodes of the next level, or to the place behind them."""
        x = self.bins.ravel()[feature[self.place] * self.n + np.arange(self.n)]
        self.place = side.ravel()[(self.place << 8) + x]
        np.copyto(self.leaf, np.append(nodes, 0)[self.place], where=self.place < len(nodes))

    def add(self, g: np.ndarray, h: np.ndarray, columns: list[int], weighted: bool) -> None:
        start = np.where(self.drawn > 0, self.place, g.shape[1] // 256 - 1) << 8
        weight = self.drawn.astype(np.float64) if weighted else None
        slope = self.slope * weight if weighted else self.slope
        for k, i in enumerate(columns):
            at = start + self.bins[i]
            g[k] += np.bincount(at, slope, minlength=g.shape[1])
            h[k] += np.bincount(at, weight, minlength=g.shape[1])


class Grower:
    """Trees over the chunks of one task."""

    def __init__(self, chunks: list[Chunk], s: Settings, cuts: list[np.ndarray], bootstrap: bool = False):
        self.chunks, self.settings, self.cuts, self.bootstrap = chunks, s, cuts, bootstrap

    def tree(self, number: int) -> Tree:
        """One tree, level by level; rows know their leaves after it."""
        s, columns = self.settings, tree_columns(self.settings, number, len(self.cuts))
        tree, open_ = Tree(), [0]
        for chunk in self.chunks:
            chunk.begin(s, number, self.bootstrap)
        for level in range(s.depth):
            best = self._splits(len(open_), columns)
            if not level:
                if not best or not best["h"][0]:
                    break
                tree.value[0], tree.weight[0] = _leaf_value(best["g"][0] / UNIT, best["h"][0] / UNIT, s), float(best["h"][0] / UNIT)
            feature, side, following = np.zeros(len(open_) + 1, np.int64), np.full((len(open_) + 1, 256), -1), []
            for k in np.flatnonzero((best["gain"] > 0) & np.isfinite(best["gain"])):
                found = Split(*[best[c][k].item() for c in ("gain", "feature", "cut", "missing_left")], *[float(best[c][k] / UNIT) for c in ("g_left", "h_left", "g", "h")])
                left, right = tree.split(open_[k], found, _child_values(found, s))
                feature[k] = found.feature
                side[k], side[k, :found.cut + 1] = len(following) + 1, len(following)
                side[k, MISSING] = len(following) + (not found.missing_left)
                following += [left, right]
            if not following:
                break
            side[side < 0] = len(following)
            for chunk in self.chunks:
                chunk.move(feature, side, np.array(following))
            open_ = following
        return tree.packed()

    def _splits(self, nodes: int, columns: list[int]) -> dict[str, np.ndarray]:
        """The best split of every open node, of equal ones that of the smaller feature."""
        used = [np.r_[0:len(self.cuts[i]) + 1, MISSING] for i in columns]
        best: dict[str, np.ndarray] = {}
        if not columns:
            return best
        g, h = (np.zeros((len(columns), 256 * (nodes + 1))) for _ in range(2))
        for chunk in self.chunks:
            chunk.add(g, h, columns, self.bootstrap)
        for k, (i, u) in enumerate(zip(columns, used, strict=True)):
            a, b = (x[k].reshape(-1, 256)[:nodes, u].astype(np.int64) for x in (g, h))
            b *= UNIT
            made = dict(zip(("gain", "cut", "missing_left", "g_left", "h_left"), best_splits(a, b, self.settings), strict=True))
            made |= {"feature": np.full(nodes, i), "g": a.sum(axis=1), "h": b.sum(axis=1)}
            best = {c: np.where(made["gain"] > best["gain"], x, best[c]) for c, x in made.items()} if best else made
        return best

    def _take_medians(self, tree: Tree) -> None:
        """The median of what is left of the labels, per leaf."""
        rest, leaf = (np.concatenate(x) for x in zip(*[(c.y[:c.n_fit] - c.margin[:c.n_fit], c.leaf[:c.n_fit]) for c in self.chunks], strict=True))
        order = np.lexsort((rest, leaf))
        first = np.searchsorted(leaf[order], np.arange(len(tree.feature) + 1))
        for node in np.flatnonzero(np.diff(first)):
            tree.value[node] = _middle(rest[order[first[node]:first[node + 1]]])

    def error(self) -> list[float]:
        """The mean error on the check rows, if there are some."""
        n = sum(c.n - c.n_fit for c in self.chunks)
        return [sum(_loss(c.margin[c.n_fit:] - c.y[c.n_fit:], self.settings.measure) for c in self.chunks) / UNIT / n] if n else []

    def grow(self, rounds: int, patience: int | None) -> tuple[list[Tree], list[float]]:
        """Trees, and the errors on the check rows after 0, 1, 2, ... trees."""
        s, trees, errors = self.settings, [], self.error()
        while len(trees) < rounds and not (patience is not None and _waited(errors, patience)):
            tree = self.tree(len(trees))
            if s.loss == "absolute":
                self._take_medians(tree)
            for chunk in self.chunks:
                chunk.margin += s.rate * tree.value[chunk.leaf]
            trees.append(tree)
            errors += self.error()
        return trees, errors


def _task_chunks(batches: Iterable[pa.RecordBatch], s: Settings) -> tuple[list[Chunk], list[np.ndarray], float]:
    """Chunks, cuts and base from all rows of a table."""
    table = pa.Table.from_batches(list(batches))
    u, y, held = (table.column(n).to_numpy() for n in ("u", "y", "is_check"))
    values = table.column("values").combine_chunks()
    flat = values.flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
    cuts, base = [_task_quantiles(flat[~held, i], s.bins) for i in range(flat.shape[1])], 0.0
    if (~held).any():
        # A sum that does not depend on the order of rows.
        base = round(_middle(np.sort(y[~held])) if s.loss == "absolute" else math.fsum(y[~held]) / int((~held).sum()), 6)
    bins = _binned(values, cuts).T if cuts else np.zeros((0, len(y)), np.uint8)
    parts = [slice(i, i + 65536) for i in range(0, len(y), 65536)]
    return [Chunk(u[p], y[p], held[p], bins[:, p], base) for p in parts], cuts, base


def _waited(errors: list[float], patience: int) -> bool:
    """Whether the least error, which counts trees from 0, lies ``patience`` trees back."""
    return bool(errors) and len(errors) - 1 - int(np.argmin(errors)) >= patience


def tree_columns(s: Settings, tree: int, width: int) -> list[int]:
    """The features that a tree sees: its share of them, rounded up."""
    some = max(1, math.ceil(s.columns * width - 1e-9)) if width else 0
    return sorted(np.random.default_rng([s.seed, tree]).permutation(width)[:some].tolist())


def train_alone(known: DataFrame, s: Settings, rounds: int, features: str = "features", patience: int | None = None, trees: bool = True) -> tuple[FittedTrees | None, list[float]]:
    """A whole training in one task: the model, if ``trees`` are wanted, and the errors on the check rows."""
    def run(batches):
        chunks, cuts, base = _task_chunks(batches, s)
        grown, errors = Grower(chunks, s, cuts).grow(rounds, patience)
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps((FittedTrees(grown, cuts, base, s.rate, features) if trees else None, errors))]})

    return pickle.loads(known.repartition(1).mapInArrow(run, "model binary").collect()[0][0])


def training_errors(train: DataFrame, row_id: Sequence[str] | str, check: Column, settings: Settings, patience: int, features: str = "features", label: str = "label") -> list[float]:
    """The errors on the check rows after 0, 1, 2, ... trees, until ``patience`` trees have brought nothing."""
    known = known_rows(train, row_id, settings, features, label, check)
    if rows_of_one_task(known):
        return train_alone(known, settings, settings.rounds, features, patience, trees=False)[1]
    with Training(train, row_id, settings, features, label, check) as run:
        run.grow(settings.rounds, patience)
        return run.errors if len(run.errors) > len(run.trees) else [*run.errors, run.check_error()]


def error_of_rounds(model: FittedTrees, df: DataFrame, loss: str, label: str = "label") -> list[float]:
    """The mean error of a boosted model after 1, 2, ... trees."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        sums, n = shared.value.error_sums(batches, loss)
        yield pa.RecordBatch.from_pydict({"tree": pa.array(np.arange(len(sums)), pa.int32()), "error": sums, "n": np.full(len(sums), n)})

    rows = df.select(finite(F.col(label).cast("double")).alias("y"), _values(df, model.features).alias("values")).where("y is not null")
    if rows_of_one_task(rows):
        rows = rows.repartition(1)
    found = rows.mapInArrow(run, "tree int, error double, n long").groupBy("tree").agg((F.sum("error") / F.sum("n")).alias("error")).collect()
    return [r["error"] for r in sorted(found, key=lambda r: r["tree"])]


def boost(train: DataFrame, row_id: Sequence[str] | str, settings: Settings = Settings(), features: str = "features", label: str = "label") -> FittedTrees:
    """Second-order boosting of a fixed number of trees."""
    known = known_rows(train, row_id, settings, features, label)
    if not settings.leaves and settings.depth is not None and 2 <= settings.bins <= MISSING and rows_of_one_task(known):
        return train_alone(known, settings, settings.rounds, features)[0]
    with Training(train, row_id, settings, features, label) as run:
        return run.grow(settings.rounds).model()


def boost_until(train: DataFrame, row_id: Sequence[str] | str, check: Column, settings: Settings = Settings(), patience: int = 50,
                features: str = "features", label: str = "label") -> tuple[FittedTrees, list[float]]:
    """The trees up to the least error on the check rows, and the errors (mean squares) after 0, 1, 2, ... trees.

    Each tree is grown once: training goes on until ``patience`` trees have brought nothing.
    """
    with Training(train, row_id, settings, features, label, check) as run:
        run.grow(settings.rounds, patience)
        if len(run.errors) == len(run.trees):
            run.errors.append(run.check_error())
        return run.model(int(np.argmin(run.errors))), run.errors


# --- forests -------------------------------------------------------------------------------------

def bagged_forest(train: DataFrame, row_id: Sequence[str] | str, trees: int = 100, settings: Settings | None = None, features: str = "features",
                  label: str = "label") -> tuple["FittedTrees | WholeForest", dict[str, float]]:
    """A forest on bootstrap weights, and its out-of-bag R2 with the number of rows that it rests on.

    A tree draws a row as often as a hash of the row's id and the tree says. Every row is scored by the trees that did not draw it, and the score
    compares the mean of those with the label; rows that all trees drew are left out, as no tree can speak for them. Without settings, trees
    grow until no split gains anything.
    """
    s = replace(settings or Settings(depth=None, columns=1.0), l1=0.0, l2=0.0, rate=1.0)
    if s.depth is None:
        return _whole_forest(train, row_id, trees, s, features, label)
    with Training(train, row_id, s, features, label, bootstrap=True) as run:
        grown = run.grow_trees(list(range(trees)))
        run.trees = [grown[t] for t in range(trees)]
        return run.model(), out_of_bag(run)


def forest(train: DataFrame, row_id: Sequence[str] | str, trees: int, settings: Settings, features: str = "features", label: str = "label") -> FittedTrees:
    """A forest on bootstrap weights alone."""
    with Training(train, row_id, replace(settings, l1=0.0, l2=0.0, rate=1.0), features, label, bootstrap=True) as run:
        grown = run.grow_trees(list(range(trees)))
        run.trees = [grown[t] for t in range(trees)]
        return run.model()


def out_of_bag(run: Training) -> dict[str, float]:
    forest, width = run.trees, run.width

    def score(batches):
        for block in (b for batch in batches for b in _blocks(batch, width)):
            total, n = np.zeros(len(block.y)), np.zeros(len(block.y))
            for t, tree in enumerate(forest):
                out = np.flatnonzero(bootstrap_weights(block.u, t) == 0)
                for leaf, rows in tree.parts(block.bins, out):
                    total[rows] += tree.value[leaf]
                n[out] += 1
            known = n > 0
            yield pa.RecordBatch.from_pydict({"y": block.y[known], "p": total[known] / n[known]})

    with settings(run.rows.sparkSession, READING):
        found = run.rows.mapInArrow(score, "y double, p double").agg(
            F.count("*").alias("n"), F.avg(F.pow(F.col("y") - F.col("p"), F.lit(2.0))).alias("error"), F.var_pop("y").alias("spread")).first()
    return {"n": found["n"], "r2": 1 - found["error"] / found["spread"] if found["spread"] else float("nan")}


# --- forests of any depth ------------------------------------------------------------------------

def _grown_whole(bins: np.ndarray, slope: np.ndarray, weight: np.ndarray, s: Settings, columns: list[int]) -> Tree:
    """A tree over the drawn rows of a node (``bins`` has a line per feature), level by level until nothing gains.

    Rows are sorted by node and bin, so that a level costs by its rows, however many nodes they lie in.
    """
    feature, cut, missing_left, left, value, gain, total = ([np.zeros(1, k)] for k in (np.int32, np.int32, bool, np.int32, float, float, float))
    feature[0][:] = -1
    g, h = slope * weight, weight.astype(np.int64)
    value[0][:], total[0][:] = (-g.sum() / UNIT / h.sum() if h.sum() else 0.0), h.sum()
    node, made = np.zeros(len(slope), np.int64), 1
    g = g.astype(np.int64)
    while len(node):
        m = len(feature[-1])
        # Nodes whose rows are all alike are leaves.
        low, high = np.full(m, np.inf), np.full(m, -np.inf)
        np.minimum.at(low, node, slope)
        np.maximum.at(high, node, slope)
        mixed = low < high
        sum_g, sum_h = np.bincount(node, g, m), np.bincount(node, h, m)
        best = {"gain": np.zeros(m), "feature": np.full(m, -1), "cut": np.zeros(m, np.int64), "left": np.zeros(m, bool)}
        for i in columns:
            _offer(best, i, node, bins[i], g, h, sum_g, sum_h, s)
        split = mixed & (best["feature"] >= 0)
        if not split.any():
            break
        at = np.flatnonzero(split)
        for held, found in ((feature, "feature"), (cut, "cut"), (missing_left, "left"), (gain, "gain")):
            held[-1][at] = best[found][at]  # the nodes of a level lie in one array
        left[-1][at] = made + 2 * np.arange(len(at))
        stays = split[node]
        bins, slope, g, h, node = bins[:, stays], slope[stays], g[stays], h[stays], (np.cumsum(split) - 1)[node[stays]]
        f, c, side = (best[k][split][node] for k in ("feature", "cut", "left"))
        x = bins[f, np.arange(len(node))]
        node = 2 * node + np.where(np.where(x == MISSING, side, x <= c), 0, 1)
        n = 2 * len(at)
        made += n
        below_g, below_h = np.bincount(node, g, n), np.bincount(node, h, n)
        for held, start in ((feature, np.full(n, -1, np.int32)), (cut, np.zeros(n, np.int32)), (missing_left, np.zeros(n, bool)), (left, np.zeros(n, np.int32)),
                            (value, -below_g / UNIT / below_h), (gain, np.zeros(n)), (total, below_h.astype(float))):
            held.append(start)
    feature, cut, missing_left, left, value, gain, total = (np.concatenate(x) for x in (feature, cut, missing_left, left, value, gain, total))
    return Tree(feature, cut, missing_left, left, np.where(feature < 0, 0, left + 1).astype(np.int32), value, gain, total)


def _offer(best: dict[str, np.ndarray], i: int, node: np.ndarray, x: np.ndarray, g: np.ndarray, h: np.ndarray, sum_g: np.ndarray, sum_h: np.ndarray, s: Settings) -> None:
    """Put the best cut of a feature in place where it gains more than what is there."""
    key = node << 8 | x
    order = np.argsort(key, kind="stable")
    key = key[order]
    ends = np.flatnonzero(np.append(key[1:] != key[:-1], True))
    of, bin_ = key[ends] >> 8, key[ends] & 255
    all_g, all_h = np.cumsum(g[order])[ends].astype(float), np.cumsum(h[order])[ends].astype(float)
    before_g, before_h = np.cumsum(sum_g) - sum_g, np.cumsum(sum_h) - sum_h
    left_g, left_h = all_g - before_g[of], all_h - before_h[of]
    gap = bin_ == MISSING
    gap_g, gap_h = np.zeros(len(sum_g)), np.zeros(len(sum_g))
    gap_at = np.flatnonzero(gap)
    first = np.append(True, of[1:] != of[:-1])[gap_at]
    gap_g[of[gap_at]] = sum_g[of[gap_at]] - np.where(first, 0.0, left_g[gap_at - 1])
    gap_h[of[gap_at]] = sum_h[of[gap_at]] - np.where(first, 0.0, left_h[gap_at - 1])
    score = lambda a, b: (a / UNIT) ** 2 / np.maximum(b + s.l2, 1e-300)
    whole = score(sum_g, sum_h)
    for side in (False, True):
        some = np.flatnonzero(~gap & (gap_h[of] > 0)) if side else np.flatnonzero(~gap)
        k = of[some]
        a, b = left_g[some] + side * gap_g[k], left_h[some] + side * gap_h[k]
        made = 0.5 * (score(a, b) + score(sum_g[k] - a, sum_h[k] - b) - whole[k]) - s.min_gain
        made[(b < max(s.min_weight, 1)) | (sum_h[k] - b < max(s.min_weight, 1))] = -np.inf
        # The first of the greatest in a node.
        order = np.lexsort((bin_[some], -made, k))
        top = order[np.append(True, k[order][1:] != k[order][:-1])] if len(order) else order
        better = top[made[top] > best["gain"][k[top]]]
        at = k[better]
        best["gain"][at], best["feature"][at], best["cut"][at], best["left"][at] = made[better], i, bin_[some][better], side


def packed_tree(tree: Tree) -> bytes:
    return zlib.compress(pickle.dumps(tree), 1)


def unpacked_tree(packed: bytes) -> Tree:
    return pickle.loads(zlib.decompress(packed))


def _bytes_column(rows: np.ndarray) -> pa.Array:
    """One binary value per line of an array of bytes."""
    n, width = rows.shape
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(rows))])


def _bytes_lines(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def _means(parts: Iterable[DataFrame]) -> DataFrame | None:
    """(row, p, n): sums and numbers of predictions over tables of (row, p, n); one written table is held at a time."""
    total = None
    for part in parts:
        more = part if total is None else total.unionByName(part)
        total = cut_lineage(more.groupBy("row").agg(F.sum("p").alias("p"), F.sum("n").alias("n")), last=[x for x in (total,) if x is not None])
    return total


@dataclass
class WholeForest:
    """A forest whose trees end in a table: ``tops`` are what passes grew, ``ends`` (tree, node, packed) grow on from their leaves."""

    tops: list[Tree]
    ends: list[tuple[list[int], DataFrame]]
    cuts: list[np.ndarray]
    features: str

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """Add the mean of the trees. Rows are dealt out by tree and top leaf to where the rest of the tree is, some trees at a time."""
        rows, width, cuts = cut_lineage(df.withColumn("__row", F.monotonically_increasing_id())), len(self.cuts), self.cuts
        known = rows.select(F.col("__row").alias("row"), _values(rows, self.features).alias("values"))

        def predicted(numbers: list[int], ends: DataFrame) -> DataFrame:
            tops = {t: self.tops[t] for t in numbers}

            def deal(batches):
                for batch in batches:
                    bins, ids = _binned(batch.column("values"), cuts), batch.column("row").to_numpy()
                    for t, tree in tops.items():
                        for leaf, some in tree.parts(bins.T, np.arange(len(ids))):
                            yield pa.RecordBatch.from_pydict({"tree": pa.array(np.full(len(some), t), pa.int32()), "node": pa.array(np.full(len(some), leaf), pa.int32()),
                                                              "row": ids[some], "bins": _bytes_column(bins[some])})

            def score(some: pa.Table, end: pa.Table) -> pa.Table:
                if not len(some):
                    return pa.table({"row": pa.array([], pa.int64()), "p": pa.array([], pa.float64())})
                tree = unpacked_tree(end.column("packed")[0].as_py())
                return pa.table({"row": some.column("row"), "p": tree.value[tree.leaf_of(_bytes_lines(some.column("bins"), width))]})

            dealt = known.mapInArrow(deal, "tree int, node int, row long, bins binary")
            each = dealt.groupBy("tree", "node").cogroup(ends.groupBy("tree", "node")).applyInArrow(score, "row long, p double")
            return each.select("row", "p", F.lit(1).cast("long").alias("n"))

        with settings(df.sparkSession, {"spark.sql.parquet.columnarReaderBatchSize": "16"}):  # ends of trees are large values
            total = _means(predicted(*part) for part in self.ends)
        mean = total.select(F.col("row").alias("__row"), (F.col("p") / F.col("n")).alias(name))
        return rows.join(mean, "__row").drop("__row")


def _whole_forest(train: DataFrame, row_id: Sequence[str] | str, trees: int, s: Settings, features: str, label: str) -> tuple[WholeForest, dict[str, float]]:
    """Passes split nodes until each fits one task; then rows are dealt out by tree and node, and the rest of a tree grows where they meet."""
    with Training(train, row_id, s, features, label, bootstrap=True) as run:
        run.rows = cut_lineage(run.rows.withColumn("block", F.monotonically_increasing_id()), last=[run.rows])
        top, width, ends, n = run.grow_trees(list(range(trees))), run.width, [], 0
        for tree in top.values():
            n = max(n, int(tree.weight[0]))
        many = max(1, DEALT // max(n, 1))
        columns = {t: run._columns(t) for t in top}

        def finish(table: pa.Table) -> pa.Table:
            t, node = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
            bins, weight, y = _bytes_lines(table.column("bins"), width), table.column("weight").to_numpy(), table.column("y").to_numpy()
            drawn = weight > 0
            tree = _grown_whole(np.ascontiguousarray(bins[drawn].T), _gradients(y[drawn], np.zeros(int(drawn.sum())), s.loss), weight[drawn], s, columns[t])
            out = np.flatnonzero(~drawn)
            rows = table.column("row").to_numpy()[out]
            made = {"tree": pa.array(np.full(len(out) + 1, t), pa.int32()), "node": pa.array(np.full(len(out) + 1, node), pa.int32()),
                    "packed": pa.array([packed_tree(tree), *[None] * len(out)], pa.binary()), "row": pa.array([None, *rows.tolist()], pa.int64()),
                    "y": pa.array(np.append(np.nan, y[out])), "p": pa.array(np.append(np.nan, tree.value[tree.leaf_of(bins[out])]))}
            return pa.table(made)

        def finished(numbers: list[int]) -> DataFrame:
            tops = {t: top[t] for t in numbers}

            def deal(batches):
                for batch in batches:
                    for block, number in zip(_blocks(batch, width), batch.column("block").to_pylist(), strict=True):
                        ids = (number << 16) + np.arange(len(block.y))
                        for t, tree in tops.items():
                            weight = bootstrap_weights(block.u, t)
                            for leaf, some in tree.parts(block.bins, np.arange(len(ids))):
                                yield pa.RecordBatch.from_pydict({"tree": pa.array(np.full(len(some), t), pa.int32()), "node": pa.array(np.full(len(some), leaf), pa.int32()),
                                                                  "row": ids[some], "y": block.y[some], "weight": weight[some], "bins": _bytes_column(block.bins[:, some].T)})

            with settings(run.rows.sparkSession, READING):
                dealt = run.rows.mapInArrow(deal, "tree int, node int, row long, y double, weight long, bins binary")
                done = cut_lineage(dealt.groupBy("tree", "node").applyInArrow(finish, "tree int, node int, packed binary, row long, y double, p double"))
            ends.append((numbers, cut_lineage(done.where("packed is not null").select("tree", "node", "packed"))))
            return done

        def scored() -> Iterator[DataFrame]:
            for i in range(0, trees, many):
                done = finished(list(range(i, min(i + many, trees))))
                # The label of a row rides along as a sum.
                yield done.where("row is not null").select("row", F.struct("p", "y").alias("b")).select("row", "b.p", "b.y", F.lit(1).cast("long").alias("n"))
                free(done)

        score = _out_of_bag_means(scored())
    return WholeForest([top[t] for t in range(trees)], ends, run.cuts, features), score


def _out_of_bag_means(parts: Iterable[DataFrame]) -> dict[str, float]:
    total = None
    for part in parts:
        more = part if total is None else total.unionByName(part)
        total = cut_lineage(more.groupBy("row").agg(F.sum("p").alias("p"), F.max("y").alias("y"), F.sum("n").alias("n")), last=[x for x in (total,) if x is not None])
    found = total.agg(F.count("*").alias("n"), F.avg(F.pow(F.col("y") - F.col("p") / F.col("n"), F.lit(2.0))).alias("error"), F.var_pop("y").alias("spread")).first()
    free(total)
    return {"n": found["n"], "r2": 1 - found["error"] / found["spread"] if found["spread"] else float("nan")}
