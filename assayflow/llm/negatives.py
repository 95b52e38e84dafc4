"""Hard negatives by lists shared per cluster of anchors, after the index-free search for maximal inner products.

Anchors are clustered by direction. A cluster sees all candidates in one order: by the greatest inner product that any direction
in the cluster could have with them, norm x cos(angle to the centre - widest angle of the cluster). Every member walks the list
from its head and stops where the bound of all that follows is below what it still needs: from there on nothing can change its result, so the
result is exact. The first walk finds the positives of an anchor, the second the negatives whose scores lie just below
theirs. Lists are cut into slices and clusters into tiles, so that no task grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayflow.llm.common import cut_lineage
from assayflow.sources.tables import scope

POSITIVES, NEGATIVES = 5, 5
#: A negative scores between these percentages of the positive's score.
LOW, HIGH = 80, 100
#: Clusters of anchors, anchors of the sample that the centres are fitted on, anchors in a tile, candidates in a slice of a list.
CLUSTERS, SAMPLE, TILE, SLICE = 8, 4096, 1024, 16384
#: Candidates looked at between two checks of who is done.
STEP = 512
#: Components beyond this are taken as this, so that scores fit 64 bits.
LARGEST = 1 << 28
NONE = np.iinfo(np.int64).min


def whole_vector(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) per component; null if the vector or a component is null or not finite."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    part = lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int")
    return F.when(usable, F.transform(vector, part))


def _matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros, longer ones cut at ``width``."""
    ends = column.offsets.to_numpy()
    sizes, values = np.diff(ends), column.values.to_numpy()[ends[0]:ends[-1]].astype(np.float64)
    width = int(sizes.max(initial=0)) if width is None else width
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    row, place = np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(ends[:-1] - ends[0], sizes)
    made, fits = np.zeros((len(sizes), width)), place < width
    made[row[fits], place[fits]] = values[fits]
    return made


def _lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", vectors, vectors))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products as exact integers."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(a.shape[1], 1)
    if most < 1 << 53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def centres(sample: np.ndarray, clusters: int, seed: int = 0, rounds: int = 10) -> np.ndarray:
    """Directions of clusters of the sample, by means of unit vectors."""
    length = _lengths(sample)
    unit = sample[length > 0] / length[length > 0, None]
    if not len(unit):
        return np.zeros((1, sample.shape[1]))
    made = unit[np.random.default_rng(seed).permutation(len(unit))[:clusters]]
    for _ in range(rounds):
        nearest = (unit @ made.T).argmax(axis=1)
        sums = np.stack([unit[nearest == k].sum(axis=0) for k in range(len(made))])
        size = _lengths(sums)
        made = np.where(size[:, None] > 0, sums / np.maximum(size, 1e-300)[:, None], made)
    return made


def _angles(vectors: np.ndarray, middle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angles to every centre, and lengths. A zero vector lies in any direction."""
    length = _lengths(vectors)
    cosine = (vectors @ middle.T) / np.maximum(length, 1e-300)[:, None]
    return np.where(length[:, None] > 0, np.arccos(np.clip(cosine, -1, 1)), 0.0), length


def _placed(middle: np.ndarray):
    """Anchors with their cluster and angle."""
    def run(batches):
        for batch in batches:
            angle, _ = _angles(_matrix(batch.column("vec"), middle.shape[1]), middle)
            cluster = angle.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cluster.astype(np.int32)), pa.array(angle[np.arange(len(angle)), cluster])],
                                             names=[*batch.schema.names, "cluster", "angle"])
    return run


def _bounded(middle: np.ndarray, widest: np.ndarray):
    """Candidates with the greatest product, per unit of the anchor's length, that each cluster could have with them."""
    def run(batches):
        for batch in batches:
            vectors = _matrix(batch.column("vec"))
            cut = vectors[:, :middle.shape[1]] if vectors.shape[1] >= middle.shape[1] else np.pad(vectors, ((0, 0), (0, middle.shape[1] - vectors.shape[1])))
            length = _lengths(vectors)
            cosine = (cut @ middle.T) / np.maximum(length, 1e-300)[:, None]
            angle = np.where(length[:, None] > 0, np.arccos(np.clip(cosine, -1, 1)), 0.0)
            bound = length[:, None] * np.cos(np.clip(angle - widest - 1e-6, 0, np.pi))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(bound), pa.list_(pa.float64()))], names=[*batch.schema.names, "bounds"])
    return run


class _Members:
    """The anchors of a tile and what they have found so far in a slice of their list."""

    def __init__(self, rows: pa.Table):
        self.gid, self.label = rows["gid"].to_numpy(), rows["label"].to_numpy()
        self.vectors = _matrix(rows["vec"].combine_chunks())
        self.length = _lengths(self.vectors)
        self.seen, self.ids = 0, []
        self.found = np.zeros((4, 0), np.int64)  # slot, score, smallest id, candidate

    def walk(self, rows: pa.RecordBatch) -> bool:
        """Look at the next candidates in order of their bounds. False: nobody needs those that follow."""
        bounds, label = rows.column("bound").to_numpy(), rows.column("label").to_numpy()
        first = rows.column("first").to_numpy()
        for at in range(0, len(bounds), STEP):
            most = self.length * bounds[at]
            active = np.flatnonzero(most + 1e-6 * np.abs(most) + 1e-3 >= self.needed())
            if not len(active):
                return False
            part = rows.slice(at, STEP)
            scores = _products(self.vectors[active], _matrix(part.column("vec"), self.vectors.shape[1]))
            slot, hit, score = self.hits(active, scores, label[at:at + STEP])
            new = np.stack([slot, score, first[at:at + STEP][hit], self.seen + hit])
            self.seen += part.num_rows
            self.ids.append(part.select(["gid", "ids"]))
            self.keep(np.concatenate([self.found, new], axis=1))
        return True

    def keep(self, found: np.ndarray) -> None:
        """Per slot the first rows by score and smallest id."""
        found = found[:, np.lexsort((found[2], -found[1], found[0]))]
        starts = np.concatenate([[True], found[0, 1:] != found[0, :-1]]) if found.shape[1] else np.zeros(0, bool)
        rank = np.arange(found.shape[1]) - np.maximum.accumulate(np.where(starts, np.arange(found.shape[1]), 0))
        self.found = found[:, rank < self.most]
        last = rank == self.most - 1
        self.worst[found[0, last]] = found[1, last]

    def result(self) -> Iterator[pa.RecordBatch]:
        if not self.found.shape[1]:
            return
        ids = pa.Table.from_batches(self.ids).take(pa.array(self.found[3])).combine_chunks()
        anchor, high = self.owner(self.found[0])
        yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(high), pa.array(self.found[1]), ids["gid"].combine_chunks(), ids["ids"].combine_chunks()],
                                         names=["anchor", "high", "score", "gid", "ids"])


class _Positives(_Members):
    """Looks for the best candidates of the same label. One more than wanted, since the anchor finds itself."""

    most = POSITIVES + 1

    def __init__(self, rows: pa.Table, most: int):
        super().__init__(rows)
        self.most, self.worst = most, np.full(len(self.gid), NONE)

    def needed(self) -> np.ndarray:
        return self.worst.astype(np.float64)

    def hits(self, active, scores, label):
        row, hit = np.nonzero((self.label[active][:, None] == label[None, :]) & (scores >= self.worst[active][:, None]))
        return active[row], hit, scores[row, hit]

    def owner(self, slot):
        return self.gid[slot], np.zeros(len(slot), np.int64)


class _Negatives(_Members):
    """Looks for the best candidates of other labels, once for each score that a positive of the anchor has."""

    def __init__(self, rows: pa.Table, most: int, low: int, high: int):
        super().__init__(rows)
        self.most = most
        wanted = rows["highs"].combine_chunks()
        self.wide = int(np.diff(wanted.offsets.to_numpy()).max(initial=1))
        self.highs = np.full((len(self.gid), self.wide), -1)
        for i, some in enumerate(wanted.to_pylist()):
            self.highs[i, :len(some)] = some
        # The least and the greatest score of a window; in two steps, since 100 times a score may not fit 64 bits.
        hundreds, rest = self.highs // 100, self.highs % 100
        self.least = np.where(self.highs < 0, np.iinfo(np.int64).max, low * hundreds - (-low * rest // 100))
        self.greatest = np.where(self.highs < 0, -1, high * hundreds + high * rest // 100)
        self.worst = self.least.ravel().copy()

    def needed(self) -> np.ndarray:
        return self.worst.reshape(-1, self.wide).min(axis=1).astype(np.float64)

    def hits(self, active, scores, label):
        worst = self.worst.reshape(-1, self.wide)[active]
        row, hit = np.nonzero((self.label[active][:, None] != label[None, :]) & (scores >= worst.min(axis=1)[:, None])
                              & (scores <= self.greatest[active].max(axis=1)[:, None]))
        score, slots, places = scores[row, hit], [], []
        for j in range(self.wide):
            fits = np.flatnonzero((score >= worst[row, j]) & (score >= self.least[active[row], j]) & (score <= self.greatest[active[row], j]))
            slots.append(active[row[fits]] * self.wide + j)
            places.append(fits)
        at = np.concatenate(places)
        return np.concatenate(slots), hit[at], score[at]

    def owner(self, slot):
        return self.gid[slot // self.wide], self.highs.ravel()[slot]


def _walks(make: Callable[[pa.Table], _Members]):
    """Walk the lists of a sorted partition: the members of a tile come first, then its candidates by falling bound."""
    def run(batches):
        key, held, members, going = None, [], None, True
        for batch in batches:
            tile, piece = batch.column("tile").to_numpy(), batch.column("slice").to_numpy()
            member = batch.column("bound").is_null().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(tile) != 0) | (np.diff(piece) != 0) | (np.diff(member.astype(np.int8)) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(tile)], strict=True):
                if (tile[a], piece[a]) != key:
                    if members is not None:
                        yield from members.result()
                    key, held, members, going = (tile[a], piece[a]), [], None, True
                if member[a]:
                    held.append(batch.slice(a, b - a))
                elif held and going:
                    members = members or make(pa.Table.from_batches(held))
                    going = members.walk(batch.slice(a, b - a))
        if members is not None:
            yield from members.result()
    return run


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(vectors: DataFrame, anchors: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """One row per anchor, positive and negative: their ids, the rank of the negative, and the scores of both.

    ``anchors`` is a condition on the rows of ``vectors``. Components become whole numbers (``whole_vector``), scores are inner products. Positives are the first
    other rows of the anchor's label, negatives the first rows of another label whose score is between ``low`` and ``high`` percent of
    the positive's; higher scores come first, ties by smaller id, null ids last. A row with a null label, a null vector or a component that is
    null or not finite takes no part; components are held at 2^28 in size. Vectors of other lengths are filled up with zeros. Rows that
    repeat an id are rows of their own, each with its own results. Equal vectors of one label are compared once. Without
    anchors, and for an empty table, the result is empty. Other columns are read only by ``anchors``.
    """
    spark = vectors.sparkSession
    given = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"),
                           whole_vector(F.col(f"`{vector}`")).alias("vec"), F.coalesce(anchors, F.lit(False)).alias("is_anchor"))
    given = given.where("label is not null and vec is not null")
    with scope() as held:
        rows = held.keep(cut_lineage(given))
        groups = cut_lineage(_groups(rows, max(positives + 1, negatives)))
        queries = cut_lineage(groups.join(rows.where("is_anchor").select("label", "vec").distinct(), ["label", "vec"], "left_semi").select("gid", "label", "vec"))
        sample = queries.orderBy(F.xxhash64("gid"), "gid").limit(SAMPLE).select("vec").toArrow()["vec"].combine_chunks()
        if not len(sample):
            return spark.createDataFrame([], RESULT)
        middle = centres(_matrix(sample), CLUSTERS)
        placed = cut_lineage(queries.mapInArrow(_placed(middle), "gid long, label long, vec array<int>, cluster int, angle double"))
        facts = placed.groupBy("cluster").agg(F.max("angle").alias("widest"), F.count("*").alias("n")).collect()
        widest, tiles = np.zeros(len(middle)), np.zeros(len(middle), int)
        for r in facts:
            widest[r["cluster"]], tiles[r["cluster"]] = r["widest"], -(-r["n"] // TILE)
        slices = -(-groups.count() // SLICE) or 1
        lists = cut_lineage(groups.mapInArrow(_bounded(middle, widest), "gid long, label long, vec array<int>, ids array<long>, bounds array<double>"))
        members = cut_lineage(_tiled(placed, tiles))
        best = _walked(lists, members.withColumn("highs", F.lit(None).cast("array<long>")), tiles, slices, lambda t: _Positives(t, positives + 1))
        chosen = cut_lineage(_first(best, ["anchor"], positives + 1).select(
            "anchor", "rank", "score", "id", (F.col("anchor") == F.col("gid")).alias("own")))
        highs = chosen.where("score >= 0").groupBy(F.col("anchor").alias("gid")).agg(F.collect_set("score").alias("highs"))
        asking = cut_lineage(members.join(highs, "gid"), last=[members])
        found = cut_lineage(_first(_walked(lists, asking, tiles, slices, lambda t: _Negatives(t, negatives, low, high), low), ["anchor", "high"], negatives))
        return _result(rows, queries, chosen, found, held, positives)


def _groups(rows: DataFrame, most: int) -> DataFrame:
    """Equal vectors of one label: a number and their smallest ids. Spark cuts a frequent vector to ``most`` rows before the shuffle."""
    order = Window.partitionBy("label", "vec").orderBy(F.col("id").asc_nulls_last())
    few = rows.select("id", "label", "vec", F.row_number().over(order).alias("n")).where(F.col("n") <= most)
    ids = F.transform(F.array_sort(F.collect_list(F.struct("n", "id"))), lambda x: x["id"])
    return few.groupBy("label", "vec").agg(ids.alias("ids")).select(F.monotonically_increasing_id().alias("gid"), "label", "vec", "ids")


def _at(values: np.ndarray, place: Column) -> Column:
    return F.get(F.array(*[F.lit(int(v)) for v in values]), place)


def _tiled(placed: DataFrame, tiles: np.ndarray) -> DataFrame:
    before = np.concatenate([[0], np.cumsum(tiles)[:-1]])
    within = F.pmod(F.xxhash64("gid"), F.greatest(_at(tiles, F.col("cluster")), F.lit(1)))
    return placed.select("gid", "label", "vec", (_at(before, F.col("cluster")) + within).cast("int").alias("tile"))


def _walked(lists: DataFrame, members: DataFrame, tiles: np.ndarray, slices: int, make, low: int | None = None) -> DataFrame:
    """What the members find in their lists: (anchor, high, score, gid, ids), the best of each slice."""
    before = np.concatenate([[0], np.cumsum(tiles)[:-1]])
    piece = F.pmod(F.xxhash64(F.lit(1), "gid"), F.lit(slices)).cast("int").alias("slice")
    copies = lists.select("gid", "label", "vec", "ids", piece, F.posexplode("bounds").alias("cluster", "bound"))
    copies = copies.where(_at(tiles, F.col("cluster")) > 0)
    first, last = _at(before, F.col("cluster")), _at(before + tiles - 1, F.col("cluster"))
    copies = copies.select("*", F.explode(F.sequence(first, last)).alias("tile"))
    if low is not None:  # no member of the tile can use a candidate below this bound
        length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
        least = F.array_min("highs") * (low / 100)
        need = members.groupBy("tile").agg(F.min(F.when(length > 0, least / length).otherwise(F.lit(float("-inf")))).alias("need"))
        copies = copies.join(need, "tile").where(F.col("bound") + 1e-6 * F.abs("bound") + 1e-3 >= F.col("need"))
    names = ["tile", "slice", "gid", "label", "vec", "ids", "first", "bound", "highs"]
    last_id = F.lit(np.iinfo(np.int64).max)
    copies = copies.withColumns({"first": F.coalesce(F.get("ids", F.lit(0)), last_id), "highs": F.lit(None).cast("array<long>")})
    asked = members.withColumns({"slice": F.explode(F.sequence(F.lit(0), F.lit(slices - 1))), "ids": F.lit(None).cast("array<long>"),
                                 "first": F.lit(0).cast("long"), "bound": F.lit(None).cast("double")})
    order = ["tile", "slice", F.col("bound").desc_nulls_first()]
    both = asked.select(*names).union(copies.select(*names)).repartition("tile", "slice").sortWithinPartitions(*order)
    return both.mapInArrow(_walks(make), "anchor long, high long, score long, gid long, ids array<long>")


def _first(found: DataFrame, by: list[str], most: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "gid")
    each = found.select("anchor", "high", "score", "gid", F.explode("ids").alias("id"))
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


#: Parts that the anchors of one vector are dealt into for the last join.
SALTS = 16


def _result(rows, queries, chosen, found, held, positives) -> DataFrame:
    negatives = found.groupBy("anchor", "high").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("negatives"))
    slots = chosen.join(negatives, (chosen["anchor"] == negatives["anchor"]) & (chosen["score"] == negatives["high"]), "left").groupBy(chosen["anchor"]).agg(
        F.array_sort(F.collect_list(F.struct("rank", "id", "own", "score", "negatives"))).alias("slots"))
    known = queries.join(slots, F.col("gid") == F.col("anchor")).select("label", "vec", "slots", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    known = held.keep(cut_lineage(known))
    asked = rows.where("is_anchor").select("label", "vec", F.col("id").alias("anchor_id"), F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"))
    joined = asked.join(known, ["label", "vec", "salt"])
    # The anchor's own row goes; if it is not among the first of its copies, one more slot than wanted is there.
    own = F.filter("slots", lambda s: s["own"] & s["id"].eqNullSafe(F.col("anchor_id")))
    out = F.coalesce(F.get(own, F.lit(0))["rank"], F.lit(positives + 1))
    left = F.filter("slots", lambda s: s["rank"] != out)
    each = joined.select("anchor_id", F.explode(left).alias("p"))
    each = each.select("anchor_id", F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score"), F.explode("p.negatives").alias("n"))
    return each.select("anchor_id", "positive_id", F.col("n.rank").alias("rank"), F.col("n.id").alias("negative_id"), "positive_score", F.col("n.score").alias("negative_score"))


SQL = """
with g as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, cast(list_inner_product(a.v, b.v) as bigint) as score
  from g a join g b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (
  select anchor_id, id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select anchor_id, positive_id, cast(row_number() over (partition by anchor_id, positive_id order by score desc, id) as integer) as rank,
  id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id)
where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, id) <= 5
"""
