"""Mixing sources to target weights by fitting subset sums of document lengths.

Per source, documents are counted by exact length. The wanted total is met by whole passes over the source, an
even share of every length, and bounded-knapsack dynamic programming for what remains. Documents are
then taken by seeded hash within their length, as many as the counts say.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayflow.llm.common import cut_lineage

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
#: Parts that a length is dealt into for ranking, so that no task ranks a whole length.
PARTS = 1024
#: Bits in the table of reachable sums.
TABLE_BITS = 1 << 28


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Totals by weight that add up to ``share`` of all sizes; none is above ``most`` times its source's size."""
    left, open_, result = share * sum(sizes), list(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / total > most * sizes[i]]
        for i in full or open_:
            result[i] = most * sizes[i] if full else left * weights[i] / total
        left -= sum(result[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)] if full else []
    return result


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int) -> np.ndarray:
    """How many documents of each length add up to ``budget``, or to as little less as can be reached.

    The core is a bounded knapsack, solved exactly by reachable sums kept as the bits of an integer. For a large source
    its table would not fit: an even share of each length comes first there, then one more of seeded lengths while
    the rest stays above ``reach``, and the knapsack fits the rest with the documents left. Documents enter
    the table only until the budget is reached.
    """
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    order = np.random.default_rng(seed).permutation(len(lengths))
    reach = max(4 * int(lengths.max()), TABLE_BITS // (len(lengths) + int(np.log2(counts).sum())))
    taken = np.floor(counts * (budget / total)).astype(np.int64) if budget > reach else np.zeros_like(counts)
    left = budget - int((lengths * taken).sum())
    for i in order:
        if left - lengths[i] >= reach and taken[i] < counts[i]:
            taken[i] += 1
            left -= int(lengths[i])
    sums, history, mask = 1, [], (1 << (left + 1)) - 1
    for i in order:
        spare, block = int(min(counts[i] - taken[i], left // lengths[i])), 1
        while spare > 0 and not sums >> left & 1:
            block = min(block, spare)
            history.append((i, block, sums))
            sums |= sums << (block * int(lengths[i])) & mask
            spare -= block
            block *= 2
        if sums >> left & 1:
            break
    rest = sums.bit_length() - 1
    for i, block, before in reversed(history):
        if not before >> rest & 1:
            taken[i] += block
            rest -= block * int(lengths[i])
    return taken


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", weights: Sequence[float] = WEIGHTS,
        share: float = SHARE, most: float = MOST, seed: int = 0) -> DataFrame:
    """One row per document: its id, ``size``, ``source_size``, ``target`` (its source's) and ``copies``, how often it is taken.

    Size is the number of words; null and empty texts have none and are never taken. Sources are ordered by
    code point, null last, and weigh ``weights`` in turn; targets add up to ``share`` of all sizes, none above
    ``most`` times its source (the excess goes to the others by weight). One row per source reaches the driver,
    one row per source and length goes to the task of a source. Which documents of a length are taken is decided by a hash of
    id and size: reruns agree. Rows that repeat an id and size tie and are taken in any order, which shows
    in no result but their own counts. An empty table gives an empty one. Other columns are not read.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{source}`").alias("source"), count_words(F.col(f"`{text}`")).alias("size"))
    return _mixed(cut_lineage(rows), weights, share, most, seed).withColumnRenamed("id", doc_id)


def _mixed(rows: DataFrame, weights: Sequence[float], share: float, most: float, seed: int) -> DataFrame:
    """Adds source_size, target and copies to rows of id, source and size (other columns pass)."""
    spark, columns = rows.sparkSession, rows.columns
    lengths = cut_lineage(rows.groupBy("source", "size").agg(F.count("*").alias("n")))
    sources = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")).collect()
    sources.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    goals = targets([r["source_size"] for r in sources], [weights[i % len(weights)] for i in range(len(sources))], share, most)
    facts = spark.createDataFrame([(r["source"], r["source_size"], t) for r, t in zip(sources, goals, strict=True)],
                                  f"source {rows.schema['source'].dataType.simpleString()}, source_size long, target double")

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        known = group[group["size"] > 0].sort_values("size")
        if not len(known):
            return pd.DataFrame({"source": [], "size": [], "passes": [], "extra": []})
        whole, goal = int(known["source_size"].iloc[0]), float(known["target"].iloc[0])
        passes = min(int(goal // whole), int(most))
        extra = fit_counts(known["size"].to_numpy(), known["n"].to_numpy(), int(goal) - passes * whole, seed) if passes < most else 0 * known["n"]
        return pd.DataFrame({"source": known["source"], "size": known["size"], "passes": passes, "extra": extra})

    kind = rows.schema["source"].dataType.simpleString()
    same = lengths["source"].eqNullSafe(facts["source"])
    counted = lengths.join(facts, same).select(lengths["source"], "size", "n", "source_size", "target")
    plan = cut_lineage(counted.groupBy("source").applyInPandas(fitted, f"source {kind}, size long, passes long, extra long"))

    mark = F.xxhash64(F.lit(seed), "id", "size")
    part = F.pmod(F.xxhash64(F.lit(seed + 1), "id", "size"), F.lit(PARTS)).cast("int")
    marked = rows.withColumns({"__mark": mark, "__part": part})
    cuts = cut_lineage(_cuts(marked.where("size > 0").select("source", "size", "__part", "__mark"), plan))
    # One row per source and length: lengths add up to the words, so the distinct ones are about a root of them, and no text is shuffled.
    m, c = marked.alias("m"), F.broadcast(cuts.select(F.col("source").alias("__source"), F.col("size").alias("__size"), "passes", "cut_part", "take", "cut_mark", "ties", "tied")).alias("c")
    placed = m.join(c, F.expr("m.source <=> c.__source and m.size = c.__size"), "left").select("m.*", "passes", "cut_part", "take", "cut_mark", "ties", "tied")
    # The last term holds for rows of the cut mark, all of which are taken or only some.
    extra = F.expr("""case when cut_part is null or __part < cut_part then 1 when __part > cut_part or take = 0 then 0
                      when __mark < cut_mark then 1 when __mark > cut_mark then 0 when ties = tied then 1 end""")
    placed = placed.withColumn("extra", extra)
    done = placed.where("extra is not null")
    if not cuts.where("ties < tied").isEmpty():
        ranked = F.row_number().over(Window.partitionBy("source", "size").orderBy("id"))
        done = done.unionByName(placed.where("extra is null").withColumn("extra", F.when(ranked <= F.col("ties"), 1).otherwise(0)))
    done = done.withColumn("copies", F.coalesce(F.col("passes") + F.col("extra"), F.lit(0)).cast("long"))
    d, f = done.alias("d"), facts.alias("f")
    return d.join(F.broadcast(f), F.expr("d.source <=> f.source")).select(*[F.col(f"d.{c}") for c in columns], "source_size", "target", "copies")


def _cuts(marks: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source and length, where the documents that are taken end: all parts before ``cut_part`` are taken, and of that one ``take`` documents,
    those of a mark below ``cut_mark`` and ``ties`` of the ``tied`` ones of that mark. Without a ``cut_part`` all are taken.
    """
    keys = ["source", "size"]
    same = F.expr("p.source <=> q.source and p.size = q.size")
    parts = marks.groupBy(*keys, "__part").agg(F.count("*").alias("here"))
    ended = parts.withColumn("end", F.sum("here").over(Window.partitionBy(*keys).orderBy("__part")))
    q = F.broadcast(plan).alias("q")
    over = ended.alias("p").join(q, same).where("end > extra").select("p.source", "p.size", F.struct("__part", (F.col("extra") - F.col("end") + F.col("here")).alias("take")).alias("at"))
    first = over.groupBy(*keys).agg(F.min("at").alias("at")).select(*keys, F.col("at.__part").alias("cut_part"), F.col("at.take").alias("take"))
    first = cut_lineage(plan.alias("p").join(first.alias("q"), same, "left").select("p.*", "cut_part", "take"))
    q = F.broadcast(first.where("take > 0")).alias("q")
    inside = marks.alias("p").join(q, same).where("__part = cut_part").select("p.source", "p.size", "__mark", "take")
    tied = inside.groupBy(*keys, "__mark", "take").agg(F.count("*").alias("tied"))
    tied = tied.withColumn("end", F.sum("tied").over(Window.partitionBy(*keys).orderBy("__mark"))).where("end >= take and end - tied < take")
    last = tied.select(*keys, F.col("__mark").alias("cut_mark"), (F.col("take") - F.col("end") + F.col("tied")).alias("ties"), "tied")
    return first.alias("p").join(last.alias("q"), same, "left").select("p.*", "cut_mark", "ties", "tied")


def take_mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", seed: int = 0) -> DataFrame:
    """The documents that the mix takes, with ``copies`` (how often) after their own columns."""
    packed = docs.select(F.struct("*").alias("row"), F.col(f"`{doc_id}`").alias("id"), F.col(f"`{source}`").alias("source"), count_words(F.col(f"`{text}`")).alias("size"))
    chosen = _mixed(cut_lineage(packed), WEIGHTS, SHARE, MOST, seed).where("copies > 0")
    return chosen.select("row.*", F.col("copies").alias("copies"))
