"""SimHash near-duplicates by covering locality-sensitive hashing.

The radius r is small. Every bit position gets a non-zero vector of r + 1 bits; table t (a non-zero vector of
r + 1 bits as well) looks at the positions whose vector has an odd inner product with t. r differing positions are
r linear equations in r + 1 unknowns, so some table looks at none of them: every pair within the radius shares
a bucket of at least one of the 2^(r+1) - 1 tables. No pair is lost by chance.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayflow.llm.common import append, components, cut_lineage
from assayflow.sources.tables import scope

BITS, SEED = 64, 42
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: bytes, words: int = 4) -> int:
    """A bit is 1 if it is set in over half of the hashes of the shingles (repeats count)."""
    found = text.translate(LOWER).split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(words, len(found))
    spans = zip(starts[:len(found) - width + 1].tolist(), ends[width - 1:].tolist(), strict=True)
    counts, block = np.zeros(BITS, np.int64), []
    for a, b in spans:
        block.append(xxhash.xxh64_intdigest(joined[a:b], SEED))
        if len(block) == 65536:
            counts += _set_bits(block)
            block = []
    counts += _set_bits(block)
    bits = 2 * counts > len(found) - width + 1
    return int(np.packbits(bits[::-1]).view(">u8")[0])


def _set_bits(hashes: list[int]) -> np.ndarray:
    rows = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None, words: int = 4) -> DataFrame:
    """All rows with ``fp``, the fingerprint as a signed long."""
    def step(batches):
        for texts in batches:
            yield [[v - (1 << 64) if v >> 63 else v for v in (fingerprint(t, words) for t in texts)]]
    return append(docs, text, "fp bigint", step, keep)


def masks(radius: int, turn: int = 0) -> list[int]:
    """The bit masks of the covering; ``turn`` shifts the positions, for another covering by the same rule."""
    tables = (1 << (radius + 1)) - 1
    vector = [1 + (i * (2 * turn + 1) + 7 * turn * (i // tables + 1)) % tables for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if bin(vector[i] & t).count("1") & 1) for t in range(1, tables + 1)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def links(points: DataFrame, radius: int = 4, block: int = 4096) -> DataFrame:
    """Links (a, b) that join the distinct longs ``fp`` into the components of "at most ``radius`` bits apart".

    Not all pairs are returned: within a bucket, links form a spanning forest, so a bucket of n points gives at
    most n - 1 rows. A bucket of more than ``block`` points is dealt out again by a second and a third covering
    within it; there, at least three quarters and seven eighths of the bits are fixed.
    """
    found = None
    keys = F.lit(0).cast("long")
    rows = points.select("fp", keys.alias("mask"), keys.alias("bucket"))
    for turn in range(3):
        last = turn == 2
        table = F.explode(F.array(*[F.lit(_signed(m)) for m in masks(radius, turn)])).alias("table")
        rows = rows.select("fp", "mask", "bucket", table).select(
            "fp", F.col("mask").bitwiseOR(F.col("table")).alias("mask"), F.col("bucket").alias("outer_bucket"), "table", F.col("mask").alias("outer_mask"))
        rows = rows.select("fp", "mask", F.xxhash64("outer_mask", "outer_bucket", "table",
                                                    F.col("fp").bitwiseAND(F.col("mask"))).alias("bucket"))
        sorted_rows = rows.repartition(F.col("bucket")).sortWithinPartitions("bucket", "fp")
        done = cut_lineage(sorted_rows.mapInPandas(_bucket_links(radius, None if last else block),
                                                   "a long, b long, fp long, mask long, bucket long"))
        pairs = done.where("fp is null").select("a", "b")
        found = pairs if found is None else found.union(pairs)
        rows = done.where("fp is not null").select("fp", "mask", "bucket")
        if last or rows.isEmpty():
            break
    return found.distinct()


def _bucket_links(radius: int, most: int | None):
    """Links within the runs of equal buckets of a sorted partition; runs longer than ``most`` pass through."""
    names = ["a", "b", "fp", "mask", "bucket"]

    def run(batches):
        kept: list[pd.DataFrame] = []
        for batch in batches:
            edge = batch["bucket"].iloc[-1]
            tail = batch["bucket"].to_numpy() == edge
            if tail.all() and (not kept or kept[0]["bucket"].iloc[-1] == edge):
                kept.append(batch)
                continue
            yield from settle(pd.concat([*kept, batch[~tail]]))
            kept = [batch[tail]]
        if kept:
            yield from settle(pd.concat(kept))

    def settle(rows: pd.DataFrame):
        key, fp = rows["bucket"].to_numpy(), rows["fp"].to_numpy()
        if not len(key):
            return
        cuts = np.flatnonzero(np.diff(key)) + 1
        starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(key)]])
        size = ends - starts
        pairs: list[np.ndarray] = []
        for n in range(2, 17):  # small buckets: all pairs of one size at once
            at = starts[size == n]
            for i in range(n - 1 if len(at) else 0):
                for j in range(i + 1, n):
                    near = np.bitwise_count(fp[at + i] ^ fp[at + j]) <= radius
                    pairs.append(np.stack([fp[at + i][near], fp[at + j][near]], axis=1))
        for s, e in zip(starts[size > 16], ends[size > 16], strict=True):
            if most is not None and e - s > most:
                over = rows.iloc[s:e]
                yield pd.DataFrame({"a": None, "b": None, "fp": over["fp"], "mask": over["mask"], "bucket": over["bucket"]})[names].astype("Int64")
            else:
                pairs.append(forest(fp[s:e], radius))
        found = np.concatenate(pairs) if pairs else ()
        if len(found):
            yield pd.DataFrame({"a": found[:, 0], "b": found[:, 1], "fp": None, "mask": None, "bucket": None}).astype("Int64")

    return run


def forest(points: np.ndarray, radius: int, block: int = 1024) -> np.ndarray:
    """Links that span the components of distinct points, found breadth first; memory is linear in the points."""
    left, found = points.copy(), []
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            ahead, reached = front[:block], np.full(len(left), -1)
            step = max(1, (1 << 20) // len(ahead))
            for i in range(0, len(left), step):
                near = np.bitwise_count(left[i:i + step, None] ^ ahead[None, :]) <= radius
                reached[i:i + step] = np.where(near.any(axis=1), near.argmax(axis=1), -1)
            hit = reached >= 0
            found.append(np.stack([ahead[reached[hit]], left[hit]], axis=1))
            front, left = np.concatenate([front[block:], left[hit]]), left[~hit]
    return np.concatenate(found) if found else np.empty((0, 2), points.dtype)


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = 4, words: int = 4) -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` and ``component_id``, the smallest id reachable from it.

    Documents link when their fingerprints differ in at most ``radius`` bits. Equal fingerprints are one point,
    so copies cost nothing beyond a partial aggregate. Null and empty texts have fingerprint zero and link like
    any other; null ids are never the smallest unless a component has no other; repeated rows all come back;
    an empty table gives an empty one. Other columns are not read, whatever their names.
    """
    given = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    with scope() as held:
        marked = held.keep(cut_lineage(fingerprints(given, "text", ["id"], words)))
        labels = held.keep(_labels(marked, radius))
    return marked.join(labels, "fp").select(F.col("id").alias(doc_id), "fp", "component_id")


def _labels(marked: DataFrame, radius: int) -> DataFrame:
    """Per fingerprint its component (one of its fingerprints) and the smallest id of it; written."""
    points = cut_lineage(marked.groupBy("fp").agg(F.min("id").alias("least")))
    groups = components(links(points, radius))
    linked = cut_lineage(points.join(groups.withColumnRenamed("node", "fp"), "fp"))
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    named = linked.join(least, "component").select("fp", "component", "component_id")
    return cut_lineage(points.join(named, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"), F.coalesce("component_id", "least").alias("component_id")))


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = 4, words: int = 4) -> DataFrame:
    """One row of each component stays, with all columns of the input: that of the smallest id, null ids last, then of the smallest text hash.

    Of rows that repeat this id and text, one stays, whichever. Components and edge cases are those
    of ``near_duplicates``. The rows are fingerprinted twice: once to find the components, once, whole, to be
    filtered, which is cheaper than writing all texts out.
    """
    packed = docs.select(F.struct("*").alias("row"), F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    packed = packed.withColumn("part", F.xxhash64("text"))
    with scope() as held:
        marked = cut_lineage(fingerprints(packed.select("id", "part", "text"), "text", ["id", "part"], words))
        labels = _labels(marked, radius)
        alike = marked.join(labels, "fp").groupBy("component", "id", "part").agg(F.count("*").alias("copies"))
        stays = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "part", "copies")).alias("stays")
        first = alike.groupBy("component").agg(stays)
        chosen = held.keep(cut_lineage(labels.join(first, "component").select("fp", "component", "stays")))
    found = fingerprints(packed, "text", ["row", "id", "part"], words).join(chosen, "fp")
    found = found.where(F.col("id").eqNullSafe(F.col("stays.id")) & (F.col("part") == F.col("stays.part")))
    # Only rows that repeat a row that stays need to be told apart.
    one = F.row_number().over(Window.partitionBy("component").orderBy("fp"))
    repeated = found.where("stays.copies > 1").withColumn("n", one).where("n = 1")
    return found.where("stays.copies = 1").select("row.*").union(repeated.select("row.*"))
