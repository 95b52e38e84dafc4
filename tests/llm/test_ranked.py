"""Ranked search against a plain count of terms and scores."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from assayflow.llm import ranked

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return TERM.findall((text or "").translate(LOWER))


def _by_hand(docs, items, top=10):
    counted = [(i, Counter(_terms(t)), len(_terms(t))) for i, t in docs]
    total, words = sum(1 for d in counted if d[2]), sum(d[2] for d in counted)
    held = Counter(w for _, c, _ in counted for w in c)
    result = []
    for item, text in items:
        scored = []
        for i, c, n in counted:
            score = 0
            for w in _terms(text):
                if c[w]:
                    weight = math.floor(1000 * math.log((2 * total + 2) / (2 * held[w] + 1)))
                    score += weight * (1000000000 * c[w] // (1000 * c[w] + 8 * (25 + 75 * n * total // words)))
            if score > 0:
                scored.append((-score, i is None, i))
        result += [(item, rank, s[2], -s[0]) for rank, s in enumerate(sorted(scored)[:top], 1)]
    return sorted(result, key=str)


def _found(df, item="item_id"):
    return sorted(((r[item], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("bucket, block", [(4096, 8 << 20), (7, 300)])
def test_against_all_pairs(spark, monkeypatch, bucket, block):
    """Also with small buckets and several blocks of items; copies tie."""
    monkeypatch.setattr(ranked, "BUCKET", bucket)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["the", "Of", "É", "日本"]
    draw = lambda n: " ".join(rng.choices(words, [1 / (i + 1) for i in range(60)] + [40, 20, 3, 3], k=n))
    docs = [(i, draw(rng.choice([1, 5, 30, 200]))) for i in range(250)] + [(900 - i, "w3 w5 the w41") for i in range(40)]
    items = [(i, draw(rng.choice([1, 4, 12]))) for i in range(25)]
    found = ranked.rank(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), block_bytes=block)
    assert _found(found) == _by_hand(docs, items)


def test_odd_texts(spark, odd_docs, no_docs):
    items = [(1, "W1x0 w1x7919 short SHORT"), (1, "W1x0 w1x7919 short SHORT"), (None, "ééé w2x0"), (2, None), (3, ""), (4, " .,- "), (5, "é" * 3000), (6, "nowhere")]
    asked = spark.createDataFrame(items, "item_id int, text string").withColumns({"item": F.lit("x"), "rank": F.lit(1), "doc_id": F.lit(7), "score": F.lit(None)})
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert _found(ranked.rank(odd_docs, asked)) == _by_hand(docs, items)
    assert ranked.rank(no_docs, asked).count() == 0 and ranked.rank(odd_docs, asked.limit(0)).count() == 0


def test_short_vectors_are_passed_over():
    """A bucket that cannot reach the tenth score gives no survivors, and one that can gives exact scores."""
    import numpy as np
    import pyarrow as pa
    items = ranked.Items([(0, Counter({b"a": 1, b"b": 2}))], {b"a": 0, b"b": 1}, np.array([500, 900]), 100, 1000)
    batch = pa.RecordBatch.from_pydict({"n": [10, 10], "terms": [[0], [0, 1]], "counts": [[1], [1, 3]]})
    bucket = ranked.Bucket(batch, items)
    _, terms, weight, heavy, rest = items.items[0]
    found, scores = bucket.survivors(terms, weight, heavy, rest, 1)
    impact = lambda tf: 1000000000 * tf // (1000 * tf + 8 * 100)
    assert dict(zip(found.tolist(), scores.tolist(), strict=True)) == {0: 500 * impact(1), 1: 500 * impact(1) + 1800 * impact(3)}
    assert len(bucket.survivors(terms, weight, heavy, rest, int(rest[0] * bucket.longest) + 2)[0]) == 0
