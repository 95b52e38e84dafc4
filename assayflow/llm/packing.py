"""Best-fit packing of token sequences by sum of squares.

Every document becomes the ids of its tokens and an end mark; only documents longer than a sequence are cut. Pieces are
placed one by one, longest first, each where the squared counts of open sequences per remaining gap add up to the least:
gaps of one size do not pile up, so a fitting gap is nearly always open. Blocks of pieces are packed side by side; the pieces of
sequences that stay too empty are dealt out anew, until one block is left.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayflow.llm.common import cut_lineage, utf8
from assayflow.sources.tables import scope

LIMIT, END = 2048, 0
#: Pieces packed by one task, and the gap from which a sequence of a block is opened again for the next round.
BLOCK, TAIL = 8192, 32
#: Words whose ids a task remembers, and bytes of text and ids it handles at once.
REMEMBERED, AT_ONCE = 400_000, 4 << 20
#: The place after an ASCII letter where a run of ASCII punctuation begins that ends the word. Apostrophes may begin a match of their own.
WORD_END = re.compile(rb"(?<=[a-z])(?=[^a-z0-9\x80-\xff\s']+(?:\s|\Z))")


def chunks(text: bytes) -> list[bytes]:
    """Parts of a text that have the same ids alone as together.

    The vocabulary drops white space, and neither its normal form (NFC, lower case) nor its word pattern reaches across a
    white space, or from an ASCII letter into ASCII punctuation. Capitals are only kept where a special token might stand.
    """
    return (text if b"<|" in text else WORD_END.sub(b" ", text.lower())).split()


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers. The ids of words are remembered, up to a fixed number."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        from tokenizers import Tokenizer
        self.tokenizer, self.known = Tokenizer.from_str(vocabulary), {}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        parts = [chunks(t) for t in texts]
        wanted = set().union(*parts)
        if len(self.known) > REMEMBERED:
            self.known = {}
        known, others = self.known, []
        for word in wanted - known.keys():
            if word.islower() and word.isalpha():  # bytes: a-z only, which normal form and word pattern leave as they are
                known[word] = _binary([t.id for t in self.tokenizer.model.tokenize(word.decode())])
            else:
                others.append(word)
        for i in range(0, len(others), 1 << 14):
            some = others[i:i + (1 << 14)]
            found = self.tokenizer.encode_batch_fast([w.decode() for w in some], add_special_tokens=False)
            known.update((w, _binary(f.ids)) for w, f in zip(some, found, strict=True))
        end = END.to_bytes(4, "little")
        return [b"".join(map(known.__getitem__, p)) + end for p in parts]


def _binary(ids: list[int]) -> bytes:
    made = array("I", ids)
    if sys.byteorder == "big":
        made.byteswap()
    return made.tobytes()


@lru_cache(maxsize=1)
def _encoder(vocabulary: str) -> Encoder:
    """One per worker, so that its words serve all tasks that the worker runs."""
    return Encoder(vocabulary)


def tokenize(docs: DataFrame, vocabulary: str, text: str = "text", doc_id: str = "doc_id", limit: int = LIMIT) -> DataFrame:
    """One row per piece: ``id``, ``piece`` (from 0), ``start``, ``length`` and ``ids``, little-endian unsigned 32-bit numbers.

    ``vocabulary`` is the path of a tokenizer file on the driver. A null text is empty and has the end mark only.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_text(encoding="utf-8"))
    given = docs.select(F.col(f"`{doc_id}`").alias("id"), utf8(F.col(f"`{text}`")).alias("text"))
    kind = given.schema["id"].dataType.simpleString()

    def run(batches):
        encoder = _encoder(shared.value)
        for batch in batches:
            for at, texts in _portions(batch.column("text")):
                yield _pieces(batch.column("id"), at, encoder.encode(texts), limit)

    return given.mapInArrow(run, f"id {kind}, piece int, start bigint, length bigint, ids binary")


def _portions(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text.as_py())
        size += len(held[-1])
        if size >= AT_ONCE:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def _pieces(ids: pa.Array, first: int, encoded: list[bytes], limit: int) -> pa.RecordBatch:
    owner, piece, start, length, content = [], [], [], [], []
    for i, data in enumerate(encoded):
        for k, at in enumerate(range(0, len(data), 4 * limit)):
            cut = data[at:at + 4 * limit]
            owner.append(first + i)
            piece.append(k)
            start.append(at // 4)
            length.append(len(cut) // 4)
            content.append(cut)
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
         pa.array(content, pa.binary())], names=["id", "piece", "start", "length", "ids"])


def sum_of_squares(lengths: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For pieces in the order given: the sequence, the place in it, and the gap that its sequence is left with."""
    count = np.zeros(limit + 1)  # open sequences per gap; full ones do not count
    waiting: list[list[int]] = [[] for _ in range(limit + 1)]
    sequence, offset, gaps = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    for i, size in enumerate(lengths.tolist()):
        # Taking gap g: (n_g - 1)^2 - n_g^2 and, unless it is filled, (n_r + 1)^2 - n_r^2 for the rest r = g - size.
        opened = 2 * count[limit - size] + 1 if size < limit else 0
        cost = 1 - 2 * count[size:limit]
        cost[1:] += 2 * count[1:limit - size] + 1
        cost[count[size:limit] == 0] = np.inf
        best = int(cost.argmin()) if len(cost) else 0
        if len(cost) and cost[best] <= opened:
            gap = size + best
            at = waiting[gap].pop()
            count[gap] -= 1
        else:
            gap, at = limit, len(gaps)
            gaps.append(limit)
        sequence[i], offset[i] = at, limit - gap
        gaps[at] = gap - size
        if gap > size:
            count[gap - size] += 1
            waiting[gap - size].append(at)
    return sequence, offset, np.array(gaps, np.int64)[sequence] if len(gaps) else np.zeros(0, np.int64)


def _fill(limit: int, turn: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "key"], ascending=[False, True])
        sequence, offset, gap = sum_of_squares(rows["length"].to_numpy(), limit)
        number = (turn << 48) + (int(rows["block"].iloc[0]) << 16) + sequence
        return pd.DataFrame({"key": rows["key"], "length": rows["length"], "sequence_id": number, "offset": offset, "gap": gap})

    return run


def place(lengths: DataFrame, limit: int = LIMIT, block: int = BLOCK, tail: int = TAIL) -> DataFrame:
    """(key, sequence_id, offset) for rows of a unique ``key`` and a ``length`` of 1 to ``limit``.

    Blocks are random, so each has the same mix of lengths. After each round, sequences with a gap of ``tail`` or more are taken
    apart and their pieces dealt out again, unless they are most of the pieces: then the lengths, not the blocks, leave the gaps.
    """
    settled, left, turn, before = None, cut_lineage(lengths.select("key", "length")), 0, None
    while True:
        n = left.count()
        blocks = -(-n // block) or 1
        dealt = left.withColumn("block", F.pmod(F.xxhash64(F.lit(turn), "key"), F.lit(blocks)))
        placed = cut_lineage(dealt.groupBy("block").applyInPandas(
            _fill(limit, turn), "key long, length long, sequence_id long, offset long, gap long"), last=[left])
        last = blocks == 1 or (before is not None and 2 * n > before)
        done = (placed if last else placed.where(F.col("gap") < tail)).select("key", "sequence_id", "offset")
        settled = done if settled is None else settled.union(done)
        if last:
            return cut_lineage(settled)
        left, before, turn = cut_lineage(placed.where(F.col("gap") >= tail).select("key", "length")), n, turn + 1


def pack_pieces(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """All rows and columns, with ``sequence_id`` and ``offset``; ``length`` (1 to ``limit``) says what a row takes up.

    Only numbers and lengths are dealt out; the other columns are shuffled once, to meet their places.
    """
    with scope() as held:
        kept = held.keep(cut_lineage(pieces.withColumn("__key", F.monotonically_increasing_id())))
        placed = held.keep(place(kept.select(F.col("__key").alias("key"), "length"), limit))
    return kept.join(placed.withColumnRenamed("key", "__key"), "__key").select(*[kept[f"`{c}`"] for c in pieces.columns], "sequence_id", "offset")


def pack(docs: DataFrame, vocabulary: str, text: str = "text", doc_id: str = "doc_id", limit: int = LIMIT) -> DataFrame:
    """One row per piece: its document, ``piece``, ``start``, ``length``, ``ids``, ``sequence_id`` and ``offset``.

    The places of a sequence are filled without gaps from 0, by at most ``limit`` ids. Null and empty texts are one piece of the end mark;
    null ids, repeated ids and repeated rows are documents like any other; ties are broken by the order of the written pieces; an empty
    table gives an empty one. Other columns are not read, whatever their names. Long texts are cut after they are encoded
    whole, word by word, so memory grows with the longest text by a small factor only.
    """
    packed = pack_pieces(tokenize(docs, vocabulary, text, doc_id, limit), limit)
    return packed.select(F.col("id").alias(doc_id), "piece", "start", "length", "ids", "sequence_id", "offset")


def sequences(packed: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row per sequence of packed pieces: its ids, and (document, piece, offset, length) of what it holds, in order."""
    part = F.struct("offset", "piece", "length", F.col(f"`{doc_id}`").alias("document"), "ids")
    whole = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    ids = F.aggregate("parts", F.lit(b""), lambda done, p: F.concat(done, p["ids"]))
    return whole.select("sequence_id", ids.alias("ids"), F.transform("parts", lambda p: F.struct(
        p["document"].alias("document"), p["piece"].alias("piece"), p["offset"].alias("offset"), p["length"].alias("length"))).alias("parts"))
