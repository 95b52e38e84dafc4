"""Ranked lexical search by buckets of impact vectors.

A document is the vector of its impacts, one per term; an item is the vector of its term weights. Documents come in order of
the length of their vectors. By the inequality of Cauchy and Schwarz, a bucket whose longest vector times the length of the item is below the
item's tenth score holds nothing for it; once that is so for all items, the rest of a partition is passed over. Inside a bucket, an item
looks only at documents with one of its heaviest terms, the fewest without which the tenth score is out of reach, and
bounds what the other coordinates can add by the lengths that are left. Survivors are scored exactly, in whole numbers.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayflow.llm.common import cut_lineage, utf8
from assayflow.llm.decontaminate import words_of
from assayflow.sources.tables import scope

TOP = 10
#: Bytes of item texts searched in one pass over the documents, and documents in a bucket.
BLOCK_BYTES, BUCKET = 8 << 20, 4096
#: Weights are SCALE times logarithms; a document of mean size has the norm 100, FLAT of which do not depend on its size.
SCALE, FLAT = 1000, 25
#: Terms that are left out of the lengths at most; only terms of more than half of the documents are.
COMMON = 1000


def _counted(batch: pa.RecordBatch, vocabulary: dict[bytes, int]) -> pa.RecordBatch:
    """Per text its number of words and the counts of those in the vocabulary."""
    sizes, found = [], []
    for text in batch.column("text"):
        words = words_of(text.as_py())
        sizes.append(len(words))
        found.append(np.fromiter(map(vocabulary.get, words, repeat(-1)), np.int64, len(words)))
    owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
    terms = np.concatenate(found) if found else np.zeros(0, np.int64)
    width = len(vocabulary) + 1
    keys, counts = np.unique((owner * width + terms)[terms >= 0], return_counts=True)
    ends = np.concatenate([[0], np.cumsum(np.bincount(keys // width, minlength=len(found)))]).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in ((keys % width).astype(np.int32), counts.astype(np.int64))]
    return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), *lists], names=["id", "n", "terms", "counts"])


def _term_counts(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """Every document with ``n``, its number of words, and the places in the vocabulary and counts of its terms."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                yield _counted(batch.slice(at, 1024), shared.value)

    return docs.mapInArrow(run, "id long, n long, terms array<int>, counts array<long>")


def _norm(n: int, documents: int, words: int) -> int:
    return FLAT + (100 - FLAT) * n * documents // words


def _with_length(vectors: DataFrame, documents: int, words: int, common: list[int]) -> DataFrame:
    """Adds ``length``, that of the impact vector without common terms."""
    n = F.col("n").cast("decimal(38,0)")
    norm = F.expr(f"{FLAT} + (cast(n as decimal(18,0)) * cast({(100 - FLAT) * documents} as decimal(20,0))) div {words}") if words else n
    pairs = F.arrays_zip("terms", "counts")
    if common:
        pairs = F.filter(pairs, lambda p: ~F.array_contains(F.array(*[F.lit(t) for t in common]), p["terms"]))
    square = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + F.pow(
        F.floor(1000000000.0 * p["counts"] / (1000 * p["counts"] + 8 * F.col("norm"))), F.lit(2.0)))
    return vectors.withColumn("norm", norm.cast("long")).withColumn("length", F.sqrt(square)).drop("norm")


class Items:
    """The items of a block as weight vectors: the heaviest terms first, those of negative weight apart."""

    def __init__(self, items: list[tuple[int, Counter]], vocabulary: dict[bytes, int], weights: np.ndarray, documents: int, words: int):
        self.documents, self.words, self.terms = documents, words, len(vocabulary)
        self.light = weights <= 0
        self.items = []
        for number, counted in items:
            terms = np.array([vocabulary[w] for w in counted], np.int64)
            weight = np.array(list(counted.values()), np.int64) * weights[terms] if len(terms) else terms
            order = np.argsort(-weight, kind="stable")
            terms, weight = terms[order], weight[order]
            heavy = int((weight > 0).sum())
            # What all terms from the k-th on can weigh together.
            rest = np.sqrt(np.concatenate([np.cumsum((weight[:heavy].astype(float) ** 2)[::-1])[::-1], [0.0]]))
            self.items.append((number, terms, weight, heavy, rest))


class Bucket:
    """Documents of similar length, with postings per term."""

    def __init__(self, batch: pa.RecordBatch, items: Items):
        ends = batch.column("terms").offsets.to_numpy()
        terms = batch.column("terms").values.to_numpy()[ends[0]:ends[-1]].astype(np.int64)
        counts = batch.column("counts").values.to_numpy()[ends[0]:ends[-1]]
        owner = np.repeat(np.arange(batch.num_rows), np.diff(ends))
        sizes, place = np.unique(batch.column("n").to_numpy(), return_inverse=True)
        norms = np.array([_norm(int(n), items.documents, items.words) for n in sizes], np.int64)[place]
        impacts = 1_000_000_000 * counts // (1000 * counts + 8 * norms[owner])
        order = np.argsort(terms, kind="stable")
        self.docs, self.impacts = owner[order], impacts[order]
        self.starts = np.searchsorted(terms[order], np.arange(items.terms + 1))
        heavy = ~items.light[terms]
        self.squares = np.bincount(owner[heavy], impacts[heavy].astype(float) ** 2, minlength=batch.num_rows)
        self.longest = math.sqrt(self.squares.max(initial=0))

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.starts[term], self.starts[term + 1]
        return self.docs[a:b], self.impacts[a:b]

    def survivors(self, terms, weight, heavy, rest, needed: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may score ``needed`` or more, and their exact scores."""
        short = np.flatnonzero(rest * self.longest * (1 + 1e-9) < needed)
        focus = int(short[0]) if len(short) else heavy
        part, square = np.zeros(len(self.squares), np.int64), np.zeros(len(self.squares))
        for k in range(focus):
            docs, impacts = self.postings(terms[k])
            part[docs] += weight[k] * impacts
            square[docs] += impacts.astype(float) ** 2
        left = np.sqrt(np.maximum(self.squares - square, 0))
        found = np.flatnonzero((part > 0) & (part + rest[focus] * left * (1 + 1e-9) + 1 >= needed))
        scores = part[found]
        for k in range(focus, len(terms)) if len(found) else ():
            docs, impacts = self.postings(terms[k])
            if len(docs):
                at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
                scores += np.where(docs[at] == found, weight[k] * impacts[at], 0)
        good = scores >= needed
        return found[good], scores[good]


def _searched(shared: Broadcast, top: int):
    """The first documents of a partition for each item of the block."""
    def run(batches):
        items: Items = shared.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in items.items]
        needed, going = [1] * len(best), True
        for batch in batches:
            for at in range(0, batch.num_rows if going else 0, BUCKET):
                part = batch.slice(at, BUCKET)
                longest = part.column("length")[0].as_py() * (1 + 1e-6)
                if all(i[4][0] * longest < n for i, n in zip(items.items, needed, strict=True)):
                    going = False
                    break
                bucket = Bucket(part, items)
                ids, null = part.column("id").fill_null(np.iinfo(np.int64).max).to_numpy(), part.column("id").is_null().to_numpy(zero_copy_only=False)
                for i, (_, terms, weight, heavy, rest) in enumerate(items.items):
                    if rest[0] * bucket.longest * (1 + 1e-9) < needed[i]:
                        continue
                    found, scores = bucket.survivors(terms, weight, heavy, rest, needed[i])
                    if len(found):
                        merged = [np.concatenate(x) for x in zip(best[i], (scores, ids[found], null[found]), strict=True)]
                        order = np.lexsort((merged[2], merged[1], -merged[0]))[:top]
                        best[i] = tuple(x[order] for x in merged)
                        if len(order) == top:
                            needed[i] = int(best[i][0][-1])
        sizes = [len(b[0]) for b in best]
        if sum(sizes):
            number = np.repeat([i[0] for i in items.items], sizes)
            score, ids, null = (np.concatenate(x) for x in zip(*best, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(ids, mask=null), pa.array(score)], names=["item", "doc_id", "score"])
    return run


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _search_block(docs: DataFrame, items: list[tuple[int, Counter]], top: int) -> DataFrame:
    """(item, doc_id, score, rank) for a block of items; written."""
    context = docs.sparkSession.sparkContext
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, counted in items for w in counted}))}
    shared = context.broadcast(vocabulary)
    vectors = cut_lineage(_term_counts(docs, shared))
    facts = vectors.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    documents, words = facts["documents"], facts["words"]
    held = np.zeros(len(vocabulary), np.int64)
    for row in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        held[row["term"]] = row["count"]
    weights = np.array([math.floor(SCALE * math.log((2 * documents + 2) / (2 * d + 1))) for d in held.tolist()], np.int64)
    common = np.flatnonzero((weights <= 0) & (held > 0))[:COMMON].tolist()
    search = context.broadcast(Items(items, vocabulary, weights, documents, words))
    # A document without a term of the block scores nothing.
    rows = _with_length(vectors.where(F.size("terms") > 0), documents, words, common).sortWithinPartitions(F.desc("length"))
    found = cut_lineage(_best(rows.mapInArrow(_searched(search, top), "item long, doc_id long, score long"), top), last=[vectors])
    shared.destroy()
    search.destroy()
    return found


def rank(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id",
         top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``top`` documents of each item: the item's id, ``rank`` from 1, ``doc_id`` and ``score``.

    Terms are runs of ASCII letters, digits and everything beyond ASCII, with A-Z lower-cased. The score is a whole number: the sum over
    the item's terms, repeats included, of the term's weight and its impact in the document. Documents of score 0 or less are left out, equal scores
    come by ascending id, null ids last. Null and empty texts have no terms; rows that repeat an id are documents, or items, of their
    own; an empty table of documents or items gives an empty result. Other columns are not read, whatever their names. Items are taken in blocks of about
    ``block_bytes`` of text (one item at least), one pass over the documents each, so what is broadcast is bounded.
    """
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), utf8(F.col(f"`{text}`")).alias("text"))
    with scope() as held:
        asked = held.keep(cut_lineage(items.select(F.col(f"`{item_id}`").alias(item_id), utf8(F.col(f"`{item_text}`")).alias("text"))
                                      .withColumn("item", F.monotonically_increasing_id())))
        size = asked.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
        blocks, found = max(1, -(-size // block_bytes)), None
        for block in range(blocks):
            mine = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).select("item", "text")
            counted = [(r["item"], Counter(words_of(bytes(r["text"])))) for r in mine.toLocalIterator()]
            done = held.keep(_search_block(texts, counted, top))
            found = done if found is None else found.union(done)
    return asked.select("item", item_id).join(found, "item").select(item_id, F.col("rank").cast("int").alias("rank"), "doc_id", "score")


SQL = r"""
with d as (
  select row_number() over () as r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
tf as (select r, doc_id, term, count(*) as tf from d group by all),
n as (select r, count(*) as n from d group by r),
c as (select count(*) as docs, cast(sum(n) as bigint) as words from n),
w as (select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) as bigint) as w from tf, c group by term, docs),
i as (
  select row_number() over () as q, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
s as (
  select q, item_id, r, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words)))) as bigint) as score
  from i join tf using (term) join w using (term) join n using (r), c group by all)
select item_id, cast(row_number() over (partition by q order by score desc, doc_id) as integer) as rank, doc_id, score
from s where score > 0 qualify row_number() over (partition by q order by score desc, doc_id) <= 10
"""
