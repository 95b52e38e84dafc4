"""Packing: every id comes back, sequences are gapless, and few are left with gaps."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from assayflow.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def _whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END]


def _check(pieces, limit):
    """Pieces follow each other in their document and lie side by side in their sequence."""
    by_sequence = defaultdict(list)
    for p in pieces:
        assert 1 <= p["length"] <= limit and p["start"] == limit * p["piece"]
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= limit
    return len(by_sequence)


def test_words_apart_have_the_ids_of_the_whole(tokenizer):
    letters = [*"aAbZ09 \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 'sStré'll.,!-<|>", "́", "̧", "İ", "ß", "Σ", "ς", "<|endoftext|>", "<|startoftext|>",
               "<|ENDOFTEXT|>", "漢字", "😀", "‍", "﻿", "가", " ́", "'ll", "'re", "　", "­", "\0", "≠", "x. ", "it's, "]
    rng = random.Random(3)
    encoder = packing.Encoder(open(PATH, encoding="utf-8").read())
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 16))) for _ in range(4000)]
    for text, ids in zip(texts, encoder.encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == _whole(tokenizer, text), repr(text)


def test_each_piece_goes_where_the_squares_grow_least():
    rng, limit = np.random.default_rng(0), 30
    lengths = rng.integers(1, limit + 1, 400)
    sequence, offset, _ = packing.sum_of_squares(lengths, limit)
    gaps = {}
    for at, size, place in zip(sequence.tolist(), lengths.tolist(), offset.tolist(), strict=True):
        assert place == limit - gaps.get(at, limit)

        def squares(changed):
            counts = np.bincount([g for g in changed.values() if g], minlength=limit + 1)
            return int((counts[1:] ** 2).sum())

        fits = [squares({**gaps, k: g - size}) for k, g in gaps.items() if g >= size] + [squares({**gaps, len(gaps): limit - size})]
        gaps[at] = gaps.get(at, limit) - size
        assert squares(gaps) == min(fits)


def test_query_gives_every_document_back(spark, sf_dir, docs, tokenizer):
    found = queries.op13_packed_sequences(spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    by_doc = defaultdict(list)
    for p in found:
        by_doc[p["doc_id"]].append(p)
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids, pieces = _whole(tokenizer, texts[doc]), sorted(pieces, key=lambda p: p["piece"])
        assert [p["piece"] for p in pieces] == list(range(-(-len(ids) // 2048)))
        for p in pieces:
            cut = ids[p["start"]:p["start"] + p["length"]]
            assert len(cut) == p["length"] and p["ids_crc32"] == zlib.crc32(np.array(cut, "<u4").tobytes())
        assert sum(p["length"] for p in pieces) == len(ids)
    least = -(-sum(p["length"] for p in found) // 2048)
    assert least <= _check(found, 2048) <= least + 2


def test_blocks_cost_few_sequences(spark):
    rng = random.Random(5)
    lengths = [min(100, int(rng.expovariate(1 / 40)) + 1) for _ in range(6000)]
    df = spark.createDataFrame(list(enumerate(lengths)), "key long, length long")
    placed = {r["key"]: r for r in packing.place(df, 100, block=500, tail=4).collect()}
    assert len(placed) == len(lengths)
    rows = [{"length": n, "start": 0, "piece": 0, **placed[k].asDict()} for k, n in enumerate(lengths)]
    assert _check(rows, 100) <= 1.01 * sum(lengths) / 100 + 1


def test_lengths_that_cannot_fill_end_the_rounds(spark):
    df = spark.range(3000).select(F.col("id").alias("key"), F.lit(60).cast("long").alias("length"))
    assert packing.place(df, 100, block=100).select("sequence_id").distinct().count() == 3000


def test_odd_documents(odd_docs, no_docs, tokenizer):
    packed = packing.pack(odd_docs, PATH, limit=64)
    found = packed.collect()
    assert _check(found, 64) and {p["length"] for p in found if p["doc_id"] in (3, 4, 5)} == {1}
    given = sorted((r["doc_id"] is None, r["doc_id"] or 0, tuple(_whole(tokenizer, r["text"]))) for r in odd_docs.collect())
    total = defaultdict(int)
    for p in found:
        total[p["doc_id"]] += p["length"]
    wanted = defaultdict(int)
    for missing, doc, ids in given:
        wanted[None if missing else doc] += len(ids)
    assert total == wanted
    whole = packing.sequences(packed).collect()
    assert sum(len(r["ids"]) for r in whole) == 4 * sum(total.values())
    assert all(len(r["ids"]) == 4 * sum(p["length"] for p in r["parts"]) for r in whole)
    assert packing.pack(no_docs, PATH).count() == 0
