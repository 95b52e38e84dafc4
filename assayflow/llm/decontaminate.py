"""Benchmark decontamination with suffix arrays over shards of the training texts.

A shard is a batch of documents. Its suffixes (by words) are sorted; every test suffix is found by binary search,
which gives the range of equal training suffixes. Suffixes that cannot hold a whole window, because one of their
first words occurs in no test item, are left out before the sort. A document lies whole in one shard, so
its result needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayflow.llm.common import append, utf8

#: Bytes of words: 0-9, A-Z (lower-cased), a-z and everything beyond ASCII. All others separate.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


class TestBlock:
    """The words and windows of some test items, as arrays for searching."""

    def __init__(self, items: list[tuple], window: int):
        texts = [words_of(text) for _, text in items]
        self.ids = [item if item is None else str(item) for item, _ in items]
        self.vocabulary = {w: i + 1 for i, w in enumerate(sorted({w for t in texts for w in t}))}
        self.words = np.array([self.vocabulary[w] for t in texts for w in t] or [0], np.int32)
        ends = np.cumsum([len(t) for t in texts])
        self.windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        by_width: dict[int, list[tuple[int, int]]] = {}
        for item, (t, end) in enumerate(zip(texts, ends, strict=True)):
            width = min(window, len(t))
            for start in range(end - len(t), end - width + 1 if width else 0):
                by_width.setdefault(width, []).append((start, item))
        for width, rows in by_width.items():
            starts, items_at = (np.array(x, np.int64) for x in zip(*rows, strict=True))
            keys = suffix_keys(self.words, starts, width)
            order = np.argsort(keys, kind="stable")
            self.windows[width] = keys[order], starts[order], items_at[order]
        self.ends = ends


def suffix_keys(words: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """The first ``width`` words of suffixes as byte strings that sort like the words."""
    rows = np.lib.stride_tricks.sliding_window_view(words, width)[starts] if len(starts) else np.empty((0, width), np.int32)
    return np.ascontiguousarray(rows.astype(">i4")).view(f"S{4 * width}").ravel()


def search(texts: list[bytes], block: TestBlock) -> list[tuple[int, list[int], list[int], list[str], list[int]]]:
    """For each text: words, starts and ends of hit stretches, items, and the longest match (length, place, item)."""
    known, ids, counts = block.vocabulary.get, [], []
    for text in texts:
        found = words_of(text)
        counts.append(len(found))
        ids.append(np.fromiter((known(w, 0) for w in found), np.int32, len(found)))
        ids.append(np.zeros(1, np.int32))  # no match runs from one text into the next
    words = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    starts = np.cumsum([0] + [c + 1 for c in counts])
    stop = np.flatnonzero(words == 0)
    runs = stop[np.searchsorted(stop, np.arange(len(words)))] - np.arange(len(words))  # test words ahead of each place
    hits, found_items, longest = [], [], {}
    for width, (keys, places, items) in block.windows.items():
        suffixes = np.flatnonzero(runs >= width)
        if not len(suffixes):
            continue
        sorted_keys = suffix_keys(words, suffixes, width)
        order = np.argsort(sorted_keys, kind="stable")
        suffixes, sorted_keys = suffixes[order], sorted_keys[order]
        low = np.searchsorted(sorted_keys, keys, "left")
        high = np.searchsorted(sorted_keys, keys, "right")
        for i in np.flatnonzero(high > low):
            at = suffixes[low[i]:high[i]]
            docs = np.searchsorted(starts, at, "right") - 1
            if i == 0 or keys[i] != keys[i - 1]:
                hits.append(np.stack([at, np.full(len(at), width)], axis=1))
            item = items[i]
            found_items.append(np.stack([np.unique(docs), np.full(len(np.unique(docs)), item)], axis=1))
            first = places[i] == (block.ends[item - 1] if item else 0)
            fresh = at if first else at[words[at - 1] != block.words[places[i] - 1]]  # a match that began earlier is counted there
            if len(fresh):
                length = np.full(len(fresh), width)
                room, going = block.ends[item] - places[i], np.arange(len(fresh))
                while len(going):
                    going = going[length[going] < room]
                    ahead = block.words[places[i] + length[going]]
                    going = going[words[fresh[going] + length[going]] == ahead]
                    length[going] += 1
                for doc, place, n in zip((np.searchsorted(starts, fresh, "right") - 1).tolist(), fresh.tolist(), length.tolist(), strict=True):
                    longest[doc] = max(longest.get(doc, (0, 0, "")), (n, -int(place - starts[doc]), block.ids[item] or ""))
    spans: dict[int, list] = {}
    if hits:
        place, width = np.unique(np.concatenate(hits), axis=0).T
        end = np.maximum.accumulate(place + width)
        fresh = np.concatenate([[True], place[1:] > end[:-1]])
        for a, b in zip(place[fresh].tolist(), end[np.append(fresh[1:], True)].tolist(), strict=True):
            doc = int(np.searchsorted(starts, a, "right") - 1)
            spans.setdefault(doc, []).append((a - int(starts[doc]), b - int(starts[doc])))
    items_of: dict[int, set] = {}
    if found_items:
        for doc, item in np.unique(np.concatenate(found_items), axis=0).tolist():
            if block.ids[item] is not None:
                items_of.setdefault(doc, set()).add(block.ids[item])
    return [(n, [a for a, _ in spans.get(d, [])], [b for _, b in spans.get(d, [])], sorted(items_of.get(d, ())), longest.get(d))
            for d, n in enumerate(counts)]


def shards(texts: list[bytes], size: int) -> Iterator[list[bytes]]:
    held, total = [], 0
    for text in texts:
        held.append(text)
        total += len(text)
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


def _blocks(benchmark: DataFrame, item_id: str, text: str, limit: int) -> Iterator[list[tuple]]:
    """The test items in blocks of bounded size, so that what one step broadcasts is bounded too."""
    held, total, first = [], 0, True
    rows = benchmark.where(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{item_id}`").cast("string"), utf8(F.col(f"`{text}`")))
    for item, content in rows.toLocalIterator():
        held.append((item, bytes(content)))
        total += len(content) + 64
        if total >= limit:
            yield held
            held, total, first = [], 0, False
    if held or first:
        yield held


RESULT = ("n_words bigint, starts array<bigint>, ends array<bigint>, items array<string>, "
          "longest bigint, longest_at bigint, longest_item string")


def find_matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                 window: int = 10, keep: list[str] | None = None, shard_bytes: int = 4 << 20, block_bytes: int = 16 << 20) -> DataFrame:
    """Every row of ``docs`` with what the test items share with it verbatim.

    ``n_words``; ``starts`` and ``ends`` of the stretches of words inside any occurrence of a window (``window``
    consecutive words of an item; an item of fewer words is one window); ``items`` with occurring windows,
    sorted as strings; the length, first place and item of the longest verbatim match that holds a whole window. Items are searched in
    blocks of at most ``block_bytes`` of text, one pass over the batches each, so any number of items works.
    Null texts have no words and items of null text are left out; items of null id hit documents like others but appear in no list. An empty table of items hits nothing, an empty
    table of documents gives an empty one. Columns named like the new ones are replaced.
    """
    first = True
    found = docs if keep is None else docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text])])
    for items in _blocks(benchmark, item_id, item_text, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(TestBlock(items, window))

        def step(batches, shared=shared):
            for texts in batches:
                rows = [row for shard in shards(texts, shard_bytes) for row in search(shard, shared.value)]
                yield [[r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], [r[3] for r in rows],
                       [r[4][0] if r[4] else 0 for r in rows], [-r[4][1] if r[4] else None for r in rows],
                       [r[4][2] or None if r[4] else None for r in rows]]

        if first:
            found, first = append(found, text, RESULT, step), False
        else:
            before = found.select(F.struct(*[F.col(f"`{c}`") for c in found.columns]).alias("before"), F.col(f"`{text}`").alias("text"))
            found = _joined(append(before, "text", RESULT, step, ["before"]))
    return found if keep is None else found.select(*[F.col(f"`{c}`") for c in keep], *RESULT_NAMES)


RESULT_NAMES = ["n_words", "starts", "ends", "items", "longest", "longest_at", "longest_item"]


def _joined(both: DataFrame) -> DataFrame:
    """The results of one more block of items, united with those of the blocks before it."""
    spans = F.array_sort(F.concat(F.arrays_zip("before.starts", "before.ends"), F.arrays_zip("starts", "ends")))
    merged = F.aggregate(spans, F.expr("cast(array() as array<struct<a:bigint,b:bigint>>)"), lambda done, s: F.when(
        (F.size(done) > 0) & (s["starts"] <= F.element_at(done, -1)["b"]),
        F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["a"].alias("a"), F.greatest(F.element_at(done, -1)["b"], s["ends"]).alias("b")))))
        .otherwise(F.concat(done, F.array(F.struct(s["starts"].alias("a"), s["ends"].alias("b"))))))
    longer = F.col("longest") > F.col("before.longest")
    new = {"starts": F.col("__spans.a"), "ends": F.col("__spans.b"),
           "items": F.array_sort(F.array_union("before.items", "items")),
           "longest": F.greatest("longest", "before.longest"),
           "longest_at": F.when(longer, F.col("longest_at")).otherwise(F.col("before.longest_at")),
           "longest_item": F.when(longer, F.col("longest_item")).otherwise(F.col("before.longest_item"))}
    columns = both.schema["before"].dataType.names
    return both.withColumn("__spans", merged).select(*[new.get(c, F.col(f"before.`{c}`")).alias(c) for c in columns])


def hit_words(starts: str = "starts", ends: str = "ends"):
    """Number of words in the stretches, which are disjoint."""
    return F.aggregate(F.zip_with(ends, starts, lambda b, a: b - a), F.lit(0).cast("bigint"), lambda s, x: s + x)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = 10) -> DataFrame:
    """Documents without any occurrence of a window of a test item, with the columns they came with."""
    packed = docs.select(F.struct("*").alias("row"), F.col(f"`{text}`").alias("text"))
    return find_matches(packed, benchmark, "text", window=window, keep=["row", "items"][:1]).where(F.size("starts") == 0).select("row.*")
