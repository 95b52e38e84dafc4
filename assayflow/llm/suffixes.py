"""Repeated passages by sparse suffix arrays.

A passage is at least ``LEAST`` words that occur, verbatim, more than once in the corpus. Suffixes are kept only at
minimisers: of every ``WINDOW`` consecutive runs of ``GRAM`` words, the run of the smallest hash. Since
WINDOW + GRAM - 1 = LEAST, every passage holds a kept position at the same place in all its occurrences. Kept suffixes
are sorted by their words and compared with their neighbours, which gives the longest match to the right; sorted by
the words before them, the longest to the left.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayflow.llm.common import cut_lineage, sift, utf8
from assayflow.sources.tables import scope

LEAST, GRAM = 50, 34
WINDOW = LEAST - GRAM + 1
#: Words compared on either side of a kept run. Longer passages are joined from the matches at the next kept positions.
REACH = LEAST - GRAM
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = a * _ODD[0] + b * _ODD[1]
        return (x ^ (x >> np.uint64(31))) * _ODD[2]


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of every word (words are separated by blanks, tabs and line ends)."""
    words = text.split()
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8)
    result, start = np.zeros(len(words), np.uint64), np.concatenate([[0], np.cumsum(sizes)])
    for low in range(0, len(words), 1 << 16):  # bounded memory for long texts
        high = min(low + (1 << 16), len(words))
        part, firsts = data[start[low]:start[high]], start[low:high] - start[low]
        place = np.arange(len(part)) - np.repeat(firsts, sizes[low:high])
        mixed = _mix(part.astype(np.uint64) + np.uint64(1), place.astype(np.uint64))
        result[low:high] = np.add.reduceat(mixed, firsts)
    return result


def kept_runs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the kept runs of a text; none in a text of fewer than LEAST words."""
    if len(words) < LEAST:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    runs, size = words, 1
    doubles = {1: words}
    while size * 2 <= GRAM:
        runs = _mix(runs[:-size], runs[size:])
        size *= 2
        doubles[size] = runs
    whole, covered = None, 0
    for size in sorted(doubles, reverse=True):
        if covered + size <= GRAM:
            piece = doubles[size][covered:]
            n = len(words) - covered - size + 1
            whole = piece[:n] if whole is None else _mix(whole[:n], piece[:n])
            covered += size
    smallest = np.lib.stride_tricks.sliding_window_view(whole, WINDOW).argmin(axis=1)
    places = np.unique(smallest + np.arange(len(smallest)))
    return places, whole[places].view(np.int64)


def _rows(batch: pa.RecordBatch, owner: list[int], names: list[str], more: dict[str, np.ndarray | list]) -> pa.RecordBatch:
    at = pa.array(owner, pa.int64())
    return pa.RecordBatch.from_pydict({n: batch.column(n).take(at) for n in names} | {k: pa.array(v) for k, v in more.items()})


def _keep(batches):
    for batch in batches:
        owner, places, hashes = [], [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            at, run = kept_runs(word_hashes(text))
            owner += [i] * len(at)
            places.append(at.astype(np.int32))
            hashes.append(run)
        if owner:
            yield _rows(batch, owner, ["id", "part"], {"place": np.concatenate(places), "run": np.concatenate(hashes)})


def _surround(batches):
    """For the marked places of a text, the words before and after the run."""
    for batch in batches:
        owner, out = [], {"run": [], "place": [], "before": [], "after": [], "n_before": [], "n_after": []}
        for i, (text, marks) in enumerate(zip(batch.column("text").to_pylist(), batch.column("marks").to_pylist(), strict=True)):
            words = np.maximum((word_hashes(text) >> np.uint64(32)).astype(np.uint32), 1)
            padded = np.concatenate([np.zeros(REACH, np.uint32), words, np.zeros(REACH, np.uint32)]).astype(">u4")
            for mark in marks:
                at = mark["place"]
                owner.append(i)
                out["run"].append(mark["run"])
                out["place"].append(at)
                out["before"].append(padded[at:at + REACH][::-1].tobytes())
                out["after"].append(padded[at + REACH + GRAM:at + GRAM + 2 * REACH].tobytes())
                out["n_before"].append(min(at, REACH))
                out["n_after"].append(min(len(words) - at - GRAM, REACH))
        if owner:
            made = _rows(batch, owner, ["id", "part"], {})
            kinds = {"run": pa.int64(), "place": pa.int32(), "before": pa.binary(), "after": pa.binary(), "n_before": pa.int32(), "n_after": pa.int32()}
            yield pa.RecordBatch.from_arrays([*made.columns, *[pa.array(v, kinds[k]) for k, v in out.items()]], names=["id", "part", *out])


def _compare(side: str):
    """Longest match of each row with the rows before and after it in a sorted partition.

    The first and the last row of a partition come back once more, whole, to be compared across partitions.
    """
    def run(batches):
        held, start, seen = None, True, 0
        number = TaskContext.get().partitionId()
        for batch in batches:
            if not len(batch):
                continue
            seen += len(batch)
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            new = matches(rows)
            edge = np.zeros(len(rows), bool)
            edge[0] = start
            start, held = False, batch.iloc[-1:]
            yield emit(rows, new, edge)
        if seen > 1:  # a row that is alone has come as the first one
            yield emit(held, np.zeros(1, np.int64), np.ones(1, bool), last=True)

    def matches(rows):
        words = np.frombuffer(b"".join(rows["context"]), ">u4").reshape(len(rows), REACH)
        run = rows["run"].to_numpy()
        same = np.cumprod(words[1:] == words[:-1], axis=1).sum(axis=1) * (run[1:] == run[:-1])
        twin = run[1:] == run[:-1]
        none = np.full(1, -1)
        best = np.maximum(np.concatenate([none, np.where(twin, same, -1)]), np.concatenate([np.where(twin, same, -1), none]))
        return np.minimum(best, rows["n"].to_numpy())

    def emit(rows, ext, edge, last=False):
        number = TaskContext.get().partitionId()
        out = pd.DataFrame({"id": rows["id"], "part": rows["part"], "place": rows["place"],
                            "ext": ext, "edge": np.where(edge, 2 * number + last, -1), "run": rows["run"], "n": rows["n"]})
        out["context"] = np.where(edge, rows["context"], None)
        return out

    return run


def _extents(suffixes: DataFrame, side: str, parts: int) -> DataFrame:
    """(id, part, place, ext): how far each kept run matches another occurrence on one side."""
    kind = suffixes.schema["id"].dataType.simpleString()
    schema = f"id {kind}, part long, place int, ext long, edge long, run long, n int, context binary"
    rows = suffixes.select("id", "part", "place", "run", F.col(f"n_{side}").alias("n"), F.col(side).alias("context"))
    order = ["run", "context", "id", "part", "place"]
    done = cut_lineage(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInPandas(_compare(side), schema))
    # Two rows per partition, in order, close the gaps between partitions.
    edges = done.where("edge >= 0").drop("ext").coalesce(1).sortWithinPartitions("edge", *order).drop("edge")
    across = edges.mapInPandas(_compare(side), schema)
    return done.union(across).select("id", "part", "place", "ext")


def _earlier(suffixes: DataFrame, side: str) -> DataFrame:
    """(around, least): for each run with its words on one side, the smallest id that shares the run and the first 0, 1, ... REACH of them.

    Most repeated runs have the same words around them wherever they occur; only the others are looked at prefix by prefix.
    """
    seen = cut_lineage(suffixes.groupBy("run", side).agg(F.min("id").alias("least")).withColumn("around", F.xxhash64("run", side)))
    several = cut_lineage(seen.groupBy("run").agg(F.count("*").alias("n")).where("n > 1").select("run"))
    alone = seen.join(several, "run", "left_anti").select("around", F.array_repeat("least", REACH + 1).alias("least"))
    each = seen.join(several, "run", "left_semi").select("run", side, "around", "least", F.explode(F.sequence(F.lit(0), F.lit(REACH))).alias("n"))
    each = each.select("around", "n", "least", F.expr(f"xxhash64(run, n, substring({side}, 1, 4 * n))").alias("head"))
    least = each.groupBy("head").agg(F.min("least").alias("least"))
    found = each.drop("least").join(least, "head").groupBy("around").agg(F.array_sort(F.collect_list(F.struct("n", "least"))).alias("least"))
    return cut_lineage(alone.union(found.select("around", F.transform("least", lambda x: x["least"]))), last=[seen, several])


def _later(suffixes: DataFrame) -> DataFrame:
    """(id, part, place, later_before, later_after): how far each kept run matches texts of smaller ids; -1 if none has it."""
    rows = suffixes.select("id", "part", "place", "n_before", "n_after", *[F.xxhash64("run", side).alias(f"at_{side}") for side in ("before", "after")])
    for side in ("before", "after"):
        found = _earlier(suffixes, side).select(F.col("around").alias(f"at_{side}"), F.col("least").alias(f"least_{side}"))
        smaller = F.filter(f"least_{side}", lambda x: x.isNotNull() & (F.col("id").isNull() | (x < F.col("id"))))
        rows = rows.join(found, f"at_{side}").withColumn(f"later_{side}", F.least(F.size(smaller) - 1, F.col(f"n_{side}")).cast("long")).drop(f"least_{side}")
    return rows.select("id", "part", "place", "later_before", "later_after")


def _spans(batches):
    """Repeated stretches of words per text, and those of them whose words occur in a text of a smaller id."""
    for batch in batches:
        all_starts, all_ends, later_starts, later_ends = [], [], [], []
        for found in batch.column("found").to_pylist():
            spans, later = [], []
            for row in found:
                for to, left, right in ((spans, row["before"], row["after"]), (later, row["later_before"], row["later_after"])):
                    if left is not None and right is not None and min(left, right) >= 0 and left + GRAM + right >= LEAST:
                        to.append((row["place"] - left, row["place"] + GRAM + right))
            for kept, starts, ends in ((spans, all_starts, all_ends), (later, later_starts, later_ends)):
                joined = join_spans(kept)
                starts.append([a for a, _ in joined])
                ends.append([b for _, b in joined])
        kind = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("part"), *[pa.array(x, kind) for x in (all_starts, all_ends, later_starts, later_ends)]],
                                         names=["id", "part", "starts", "ends", "later_starts", "later_ends"])


def join_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    joined: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if joined and a <= joined[-1][1]:
            joined[-1] = joined[-1][0], max(b, joined[-1][1])
        else:
            joined.append((a, b))
    return joined


def repeated_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Texts with repeated passages: (id, part, starts, ends, later_starts, later_ends), in words.

    ``part`` is the hash of the text, so that ids may repeat. ``starts`` and ``ends`` delimit the words of passages
    that occur more than once, ``later_*`` those that also occur in a document of a smaller id and may go, as far as
    such documents hold their words. No
    passage of LEAST words is missed. A stretch may be joined from two occurrences that overlap in a run of GRAM
    words. Null, empty and short texts hold none; repeated rows count as occurrences of each other;
    an empty table gives an empty one; other columns are not read.
    """
    given = docs.select(F.col(f"`{doc_id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("part"), utf8(F.col(f"`{text}`")).alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    with scope() as held:
        return held.keep(cut_lineage(_spans_of(_suffixes(given, kind), kind)))


def _suffixes(given: DataFrame, kind: str) -> DataFrame:
    """The kept runs that occur more than once, with the words around them; written."""
    kept = cut_lineage(given.mapInArrow(_keep, f"id {kind}, part long, place int, run long"))
    twice = cut_lineage(kept.groupBy("run").agg(F.count("*").alias("n")).where("n > 1").drop("n"))
    marks = sift(kept, "run", twice).join(twice, "run").select("id", "part", F.struct("place", "run").alias("mark"))
    marked = cut_lineage(marks.groupBy("id", "part").agg(F.collect_set("mark").alias("marks")), last=[kept, twice])
    texts = sift(given, "part", marked).alias("t").join(marked.alias("m"), F.expr("t.id <=> m.id and t.part = m.part"))
    around = texts.select("t.id", "t.part", "t.text", "m.marks").mapInArrow(
        _surround, f"id {kind}, part long, run long, place int, before binary, after binary, n_before int, n_after int")
    return cut_lineage(around, last=[marked])


def _spans_of(suffixes: DataFrame, kind: str) -> DataFrame:
    parts = int(suffixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides = [_extents(suffixes, side, parts).withColumnsRenamed({"ext": side}) for side in ("before", "after")]
    names = ["before", "after", "later_before", "later_after"]
    later = cut_lineage(_later(suffixes), last=[suffixes])
    both = sides[0].unionByName(sides[1], allowMissingColumns=True).unionByName(later, allowMissingColumns=True)
    best = both.groupBy("id", "part", "place").agg(*[F.max(c).alias(c) for c in names])
    grouped = best.groupBy("id", "part").agg(F.collect_list(F.struct("place", *names)).alias("found"))
    spans = grouped.mapInArrow(_spans, f"id {kind}, part long, starts array<long>, ends array<long>, later_starts array<long>, later_ends array<long>")
    return spans.where(F.size("starts") > 0)


def passage_report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: id, ``n_words``, ``n_repeated`` and ``n_later`` (words in such passages), ``starts``, ``ends``.

    Edge cases are those of ``repeated_passages``; documents without repeats have empty lists.
    """
    found = repeated_passages(docs, text, doc_id)
    content = F.col(f"`{text}`")
    rows = docs.select(F.col(f"`{doc_id}`").alias("__doc"), F.xxhash64(content).alias("__part"),
                       F.coalesce(F.regexp_count(content, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("n_words"))
    joined = rows.join(found, F.expr("__doc <=> id and __part = part"), "left")

    def total(a: str, b: str):
        return F.coalesce(F.aggregate(F.zip_with(a, b, lambda s, e: e - s), F.lit(0).cast("long"), lambda x, y: x + y), F.lit(0))

    none = F.array().cast("array<long>")
    return joined.select(F.col("__doc").alias(doc_id), "n_words", total("starts", "ends").alias("n_repeated"), total("later_starts", "later_ends").alias("n_later"),
                         F.coalesce("starts", none).alias("starts"), F.coalesce("ends", none).alias("ends"))


def drop_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """All rows and columns; passages that a document of a smaller id holds too are cut out of the text."""
    found = repeated_passages(docs, text, doc_id).select(F.col("id").alias("__id"), F.col("part").alias("__other"), F.arrays_zip("later_starts", "later_ends").alias("__spans"))
    packed = docs.select(F.struct("*").alias("__row"), F.col(f"`{doc_id}`").alias("__doc"), F.xxhash64(F.col(f"`{text}`")).alias("__part"))
    joined = packed.join(found, F.expr("__doc <=> __id and __part = __other"), "left")
    content = F.col("__row").getField(text)
    # A word and the blanks before it are one piece, so what stays keeps its layout.
    pieces = F.regexp_extract_all(content, F.lit(r"(?s)([\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+$)"), 1)
    kept = F.aggregate(F.array_sort("__spans"), F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("done")),
                       lambda s, span: F.struct(span["later_ends"].alias("at"),
                                                F.concat(s["done"], F.slice(pieces, (s["at"] + 1).cast("int"), (span["later_starts"] - s["at"]).cast("int"))).alias("done")),
                       lambda s: F.array_join(F.concat(s["done"], F.slice(pieces, (s["at"] + 1).cast("int"), F.greatest(F.size(pieces) - s["at"], F.lit(0)).cast("int"))), ""))
    changed = F.when(F.coalesce(F.size("__spans"), F.lit(0)) <= 0, content).otherwise(kept)
    return joined.select(*[changed.alias(c) if c == text else F.col(f"__row.`{c}`") for c in docs.columns])
