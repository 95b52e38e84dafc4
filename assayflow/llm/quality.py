"""Quality classifier: random-indexing word vectors, pooled per document, and a small calibrated network.

Every token has a sparse random index vector, found from its hash. The vector of a word is the sum of the index
vectors of its neighbours over the whole corpus. Words are hashed into a fixed number of slots, so the table
of word vectors has one size at any scale and may be broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayflow.llm.common import append, cut_lineage, utf8

SLOTS, WIDTH = 1 << 13, 32
#: Bytes handled at once, so that a very long text needs no more memory than others. A token at a cut is two.
CHUNK = 1 << 20
#: Classes of bytes: 0 blank, 1 of a word (digits, letters, beyond ASCII), 2 punctuation.
KIND = np.array([1 if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b > 127 else 0 if b <= 32 else 2 for b in range(256)], np.uint8)
BASE = 0x9E3779B97F4A7C15


@cache
def index_vectors() -> np.ndarray:
    """Four entries of each row are 1 or -1, the others 0."""
    chance = np.random.default_rng(20)
    table = np.zeros((SLOTS, WIDTH), np.float32)
    for _ in range(4):
        table[np.arange(SLOTS), chance.integers(0, WIDTH, SLOTS)] = chance.choice([-1, 1], SLOTS)
    return table


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number, and of its inverse, modulo 2^64."""
    inverse = pow(BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        return tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(CHUNK, x, np.uint64)])) for x in (BASE, inverse))


def slots(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slots of the tokens of some texts and the number of the text of each, in pieces of bounded size.

    A token is a run of word bytes or of punctuation; case counts. Its slot comes from a polynomial hash.
    """
    held, owners, total = [], [], 0
    for number, text in enumerate(texts):
        for start in range(0, len(text), CHUNK // 2):
            part = text[start:start + CHUNK // 2]
            if total + len(part) + 1 > CHUNK or owners and number - owners[0] >= 256:
                yield _slots(held, owners)
                held, owners, total = [], [], 0
            held.append(part)
            owners.append(number)
            total += len(part) + 1
    if held:
        yield _slots(held, owners)


def _slots(parts: list[bytes], owners: list[int]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    kind = KIND[data]
    starts = np.flatnonzero(np.diff(kind, prepend=np.uint8(0)))
    ends = np.append(starts[1:], len(data))
    used = kind[starts] > 0
    starts, ends = starts[used], ends[used]
    up, down = _powers()
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data * up[:len(data)], dtype=np.uint64)])
        hashes = (sums[ends] - sums[starts]) * down[starts]
        hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    firsts = np.cumsum([0] + [len(p) + 1 for p in parts[:-1]])
    owner = np.array(owners)[np.searchsorted(firsts, starts, "right") - 1]
    return (hashes >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64), owner


def _contexts(batches):
    """Sums of the index vectors of the two tokens before and after, per slot, over one partition."""
    table, index, seen = np.zeros((SLOTS, WIDTH)), index_vectors().astype(np.int8), np.zeros(SLOTS)
    for batch in batches:
        for piece, owner in slots(list(batch["text"])):
            around = np.zeros((len(piece), WIDTH), np.int8)
            for away in (1, 2):
                same = (owner[away:] == owner[:-away]).astype(np.int8)[:, None]
                around[away:] += index.take(piece[:-away], axis=0) * same
                around[:-away] += index.take(piece[away:], axis=0) * same
            for j, column in enumerate(around.T.astype(np.float64, order="C")):
                table[:, j] += np.bincount(piece, column, SLOTS)
            seen += np.bincount(piece, minlength=SLOTS)
    used = np.flatnonzero(seen)
    if len(used):
        yield pd.DataFrame({"slot": used, "seen": seen[used], "sums": list(table[used])})


def word_vectors(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Word vectors (slots x 32) and slot counts over all texts. Partial sums have one row per slot and partition."""
    parts = docs.select(utf8(F.col(f"`{text}`")).alias("text")).mapInPandas(_contexts, "slot long, seen double, sums array<double>")
    sums = parts.groupBy("slot").agg(F.sum("seen").alias("seen"), *[F.sum(F.col("sums")[j]).alias(f"v{j}") for j in range(WIDTH)])
    table, seen = np.zeros((SLOTS, WIDTH)), np.zeros(SLOTS)
    for row in sums.collect():  # at most SLOTS rows
        seen[row[0]] = row[1]
        table[row[0]] = row[2:]
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.where(norm > 0, norm, 1)).astype(np.float32), seen


def pooled(texts: list[bytes], vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A row per text: weighted means of the word vectors and index vectors, and how long and varied it is."""
    sums = np.zeros((len(texts), 2 * WIDTH + 3))
    both = np.concatenate([vectors, index_vectors()], axis=1) * weights[:, None].astype(np.float32)
    for piece, owner in slots(texts):
        if not len(piece):
            continue
        first, last = owner[0], owner[-1] + 1
        tally = np.bincount((owner - first) * SLOTS + piece, minlength=(last - first) * SLOTS).reshape(last - first, SLOTS)
        sums[first:last, :2 * WIDTH] += tally.astype(np.float32) @ both
        sums[first:last, -3] += tally @ weights
        sums[first:last, -2] += tally.sum(axis=1)
        sums[first:last, -1] += (tally > 0).sum(axis=1)
    count = sums[:, -2]
    return np.column_stack([sums[:, :2 * WIDTH] / np.maximum(sums[:, -3:-2], 1e-9), np.log1p(count), sums[:, -1] / np.maximum(count, 1) ** 0.5])


@dataclass
class Model:
    vectors: np.ndarray
    weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, ...]
    temperature: float

    def features(self, texts: list[bytes]) -> np.ndarray:
        return (pooled(texts, self.vectors, self.weights) - self.centre) / self.scale

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        return sigmoid(forward(self.layers, self.features(texts))[0] / self.temperature)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def forward(layers, x):
    hidden = np.tanh(x @ layers[0] + layers[1])
    return hidden @ layers[2] + layers[3], hidden


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, seed: int = 7):
    """Two layers by Adam on mini-batches; one part in five is kept aside for the temperature."""
    chance = np.random.default_rng(seed)
    order = chance.permutation(len(y))
    aside, used = order[:len(y) // 5], order[len(y) // 5:]
    layers = [chance.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden), chance.normal(0, hidden ** -0.5, hidden), np.zeros(1)]
    first, second, step = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers], 0
    for epoch in range(epochs):
        rate = 0.01 * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        for part in np.array_split(chance.permutation(used), max(1, len(used) // 128)):
            if not len(part):
                continue
            out, h = forward(layers, x[part])
            wrong = (sigmoid(out) - y[part]) / len(part)
            back = np.outer(wrong, layers[2]) * (1 - h * h)
            slopes = [x[part].T @ back + 1e-4 * layers[0], back.sum(0), h.T @ wrong + 1e-4 * layers[2], wrong.sum(keepdims=True)]
            step += 1
            for p, g, m, v in zip(layers, slopes, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    temperature = 1.0
    if len(aside):
        out = forward(layers, x[aside])[0]
        choices = np.geomspace(0.25, 8, 60)
        temperature = float(choices[int(np.argmin([_loss(out / t, y[aside]) for t in choices]))])
    return tuple(layers), temperature


def _loss(out: np.ndarray, y: np.ndarray) -> float:
    p = np.clip(sigmoid(out), 1e-6, 1 - 1e-6)
    return float(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality", sample: int = 20000) -> Model:
    """Word vectors from all texts, then the network from at most ``sample`` labelled rows that are not held out.

    The sample is the labelled documents of the smallest id hashes, so it does not depend on partitioning.
    Labels other than 0 and 1 and null ids are left out; of several labels of an id the largest counts, of several texts of an
    id the one of the least hash. With no
    label, or an empty table, every score is one half or what the one class found says.
    """
    vectors, seen = word_vectors(docs, text)
    share = seen / max(seen.sum(), 1)
    weights = 1e-3 / (1e-3 + share)
    names = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
    names = names.where("id is not null and label in (0, 1)").where(~held_out(F.col("id"))).groupBy("id").agg(F.max("label").alias("label"))
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    chosen = names.join(texts.select("id"), "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = texts.join(F.broadcast(cut_lineage(chosen)), "id")  # at most ``sample`` rows
    shared = docs.sparkSession.sparkContext.broadcast((vectors, weights))

    def step(batches):
        for batch in batches:
            yield [pooled(batch, *shared.value).tolist()]

    rows = rows.select("id", "label", "text", F.xxhash64("text").alias("part"))
    each = append(rows, "text", "x array<double>", step, ["id", "label", "part"])
    found = each.groupBy("id", "label").agg(F.min_by("x", "part").alias("x")).collect()
    found.sort(key=lambda r: (r["id"], r["x"]))
    x = np.array([r["x"] for r in found]).reshape(len(found), 2 * WIDTH + 2)
    y = np.array([r["label"] for r in found], float)
    centre, scale = (x.mean(0), x.std(0) + 1e-3) if len(x) else (np.zeros(2 * WIDTH + 2), np.ones(2 * WIDTH + 2))
    layers, temperature = fit_network((x - centre) / scale, y)
    return Model(vectors, weights, centre, scale, layers, temperature)


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row with ``score``, the calibrated probability of label 1. Null and empty texts have a score as well."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batches):
        for batch in batches:
            yield [shared.value.probabilities(batch).tolist()]

    return append(docs, text, "score double", step, keep)


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The documents scored at least ``threshold``, with the columns they came with."""
    model = fit(docs, labels, text)
    packed = docs.select(F.struct("*").alias("row"), F.col(f"`{text}`").alias("text"))
    return score(packed, model, keep=["row"]).where(F.col("score") >= threshold).select("row.*")
