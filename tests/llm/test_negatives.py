"""Hard negatives against a comparison of all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from assayflow.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score string, id string, gid string, anchor string"


def _by_hand(rows, anchor):
    """Rows (id, vector, label) compared one by one."""
    used = []
    for i, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        used.append((i, [max(-negatives.LARGEST, min(negatives.LARGEST, math.floor(256 * x))) for x in vector], label))
    result = []
    for k, (i, v, label) in enumerate(used):
        if not anchor(i):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j is None, j or 0, other == label) for n, (j, w, other) in enumerate(used) if n != k)
        for top, p_null, p, _ in [s for s in scored if s[3]][:5]:
            fits = [s for s in scored if not s[3] and 80 * -top <= 100 * -s[0] <= 100 * -top][:5]
            result += [(i, None if p_null else p, rank, None if s[1] else s[2], -top, -s[0]) for rank, s in enumerate(fits, 1)]
    return sorted(result, key=str)


def _found(df):
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def _vectors(count, dims, seed, copies=0):
    rng = random.Random(seed)
    made = [(i, [rng.gauss(0.3, 1) for _ in range(dims)], rng.randrange(3)) for i in range(count)]
    return made + [(count + i, [1.5] * dims, rng.randrange(3)) for i in range(copies)]


def _frame(spark, rows):
    rounded = [(i, v, n, "s", "i", "g", "a") for i, v, n in rows]
    return spark.createDataFrame(rounded, SCHEMA)


def _as_floats(df):
    return [(r["vec_id"], r["embedding"], r["label"]) for r in df.select("vec_id", "embedding", "label").collect()]


@pytest.mark.parametrize("tile, cut, step", [(1024, 16384, 512), (7, 50, 16)])
def test_against_all_pairs(spark, monkeypatch, tile, cut, step):
    """Also with many small tiles, slices and steps, and a vector that a third of the rows share."""
    monkeypatch.setattr(negatives, "TILE", tile)
    monkeypatch.setattr(negatives, "SLICE", cut)
    monkeypatch.setattr(negatives, "STEP", step)
    df = _frame(spark, _vectors(400, 4, 1, copies=200))
    assert _found(negatives.mine(df, F.col("vec_id") % 10 == 0)) == _by_hand(_as_floats(df), lambda i: i % 10 == 0)


def test_members_stop_early(spark):
    """In few dimensions with clear clusters a walk ends long before its list does."""
    looked = []

    class Counting(negatives._Positives):
        def walk(self, rows):
            going = super().walk(rows)
            looked.append((self.seen, rows.num_rows))
            return going

    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(0)
    angle = np.sort(rng.uniform(-0.05, 0.05, 8))
    members = pa.table({"gid": np.arange(8), "label": np.zeros(8, int), "vec": [[int(1e4 * np.cos(a)), int(1e4 * np.sin(a))] for a in angle]})
    others = rng.uniform(-np.pi, np.pi, 8000)
    bound = 1e4 * np.cos(np.clip(np.abs(others) - 0.06, 0, np.pi))
    order = np.argsort(-bound)
    rows = pa.RecordBatch.from_pydict({"gid": np.arange(8000), "label": np.zeros(8000, int), "vec": [[int(1e4 * np.cos(others[i])), int(1e4 * np.sin(others[i]))] for i in order],
                                       "ids": [[int(i)] for i in order], "first": order, "bound": bound[order]})
    walker = Counting(members, 6)
    assert walker.walk(rows) is False and looked[0][0] < 3000
    for r in pa.Table.from_batches(walker.result()).to_pylist():
        assert r["score"] >= 0.99e8


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(100, [1.0, 2.0], 1), (100, [1.0, 2.0], 1), (100, [2.0, 1.0], 1), (None, [1.0, 1.5], 1), (None, [1.0, 1.6], 2), (3, None, 1), (4, [1.0, None], 1),
            (5, [nan, 1.0], 1), (6, [inf, 1.0], 2), (8, [1.0, 1.9], None), (9, [], 1), (10, [], 2), (11, [0.0, 0.0], 2), (200, [0.0, 0.0], 2), (12, [1.0], 1),
            (13, [1.0, 2.0, 5.0], 2), (14, [3e38, -3e38], 1), (300, [3e38, 3e38], 2), (15, [-1.0, -2.0], 1), (16, [1.0, 1.8], 2), (400, [-5.0, 1.0], 7)]
    df = _frame(spark, rows)
    assert _found(negatives.mine(df, F.col("vec_id") % 100 == 0)) == _by_hand(_as_floats(df), lambda i: i is not None and i % 100 == 0)


def test_no_rows_and_no_anchors(spark):
    empty = _frame(spark, [])
    assert negatives.mine(empty, F.col("vec_id") % 100 == 0).count() == 0
    df = _frame(spark, _vectors(20, 3, 2))
    none = negatives.mine(df, F.col("vec_id") == 777)
    assert none.count() == 0 and none.columns == negatives.mine(df, F.col("vec_id") == 7).columns
