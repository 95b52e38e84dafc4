"""Chat formatting by perspective rotation: every participant in turn is the assistant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayflow.llm.common import cut_lineage
from assayflow.sources.tables import scope

#: A dialogue is rendered in blocks of this many turns or characters, whichever ends first, so that no task holds a long one.
BLOCK, CHARACTERS = 256, 1 << 20


def placed(turns: DataFrame) -> DataFrame:
    """Adds to rows of conv, turn, role and text their ``rank`` in the dialogue and the characters ``before`` them; written.

    Order is by number (null last), role, text. Ranges of the sorted rows are counted apart and their counts added up, so a dialogue of any
    length is spread over many tasks.
    """
    order = [F.col("turn").asc_nulls_last(), "role", "text", "key"]
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = cut_lineage(turns.withColumn("key", F.monotonically_increasing_id()))
    ranges = cut_lineage(numbered.repartitionByRange(parts, "conv", *order).withColumn("range", F.spark_partition_id()), last=[numbered])
    counts = ranges.groupBy("conv", "range").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("size"))
    ahead = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("conv", "range", *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"{c}_ahead") for c in ("n", "size")])
    within = Window.partitionBy("conv", "range").orderBy(*order)
    here = ranges.withColumns({"n": F.row_number().over(within) - 1,
                               "size": F.coalesce(F.sum(F.length("text")).over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    r, c = here.alias("r"), counts.alias("c")
    joined = r.join(c, F.expr("r.conv <=> c.conv and r.range = c.range"))
    return cut_lineage(joined.select("r.conv", "r.role", "r.text", (F.col("r.n") + F.col("n_ahead")).alias("rank"), (F.col("r.size") + F.col("size_ahead")).alias("before")),
                       last=[ranges])


def _blocks(rows: DataFrame, context: Sequence[str], block: int, characters: int) -> DataFrame:
    """conv, block (the rank of its first turn) and turns; a block that does not begin with a context turn has the last one before it in ``in_force``."""
    is_context = F.col("role").isin(*context)
    turn = F.struct("rank", "role", "text")
    whole = rows.groupBy("conv", F.floor(F.col("rank") / block), F.floor(F.col("before") / characters)).agg(
        F.min("rank").alias("block"), F.max(F.when(is_context, F.col("rank"))).alias("last_context"), F.array_sort(F.collect_list(turn)).alias("turns"))
    whole = cut_lineage(whole.select("conv", "block", "last_context", "turns"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    force = whole.select("conv", "block", F.max("last_context").over(earlier).alias("rank"))
    f, r = force.alias("f"), rows.where(is_context).alias("r")
    found = f.join(r, F.expr("f.conv <=> r.conv and f.rank = r.rank")).select("f.conv", "f.block", F.struct("r.rank", "r.role", "r.text").alias("in_force"))
    w, g = whole.alias("w"), found.alias("g")
    joined = w.join(g, F.expr("w.conv <=> g.conv and w.block = g.block"), "left")
    opens = F.when(~F.get("w.turns", F.lit(0))["role"].isin(*context), F.col("g.in_force"))
    return joined.select("w.conv", "w.block", "w.turns", F.when(opens.isNotNull(), F.array(opens)).otherwise(F.slice("w.turns", 1, 0)).alias("repeated"))


def rotate(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           context: Sequence[str] = ("system",), block: int = BLOCK, characters: int = CHARACTERS) -> DataFrame:
    """One row per dialogue, participant and block: conv_id, speaker, block, n_turns, text and mask.

    A participant is a distinct role that is not a ``context`` role. In the rendering for a speaker, the speaker's
    turns are the assistant's, other participants are users with their names, and context turns keep their role. Turns come in order of
    their number (null last), then role, then text; a block ends after ``block`` turns or, at the latest, with the turn that goes over a multiple
    of ``characters``. ``block`` is the place of its first turn in the dialogue, from 0, whatever the numbers. A later block begins with the context turn that is in force,
    the last one before it, unless its own first turn is one; without these, the blocks of a speaker join to the whole rendering, and ``n_turns`` does not
    count them. ``mask`` lists the stretches (start, end; in characters of the text from 0) to learn from: what the speaker says, with
    its end mark.
    Null roles are the participant "unknown", null texts are empty, null ids are one dialogue, repeated rows are repeated
    turns; a dialogue without participants and an empty table give no rows. Other columns are not read.
    """
    rows = turns.select(F.col(f"`{conv_id}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
                        F.coalesce(F.col(f"`{role}`"), F.lit("unknown")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    with scope() as held:
        ranked = placed(rows)
        blocks = held.keep(cut_lineage(_blocks(ranked, context, block, characters)))
        speakers = held.keep(cut_lineage(ranked.where(~F.col("role").isin(*context)).select(F.col("conv").alias("of"), F.col("role").alias("speaker")).distinct()))
    views = blocks.join(speakers, F.col("conv").eqNullSafe(F.col("of")))

    def segment(t: Column) -> Column:
        head = (F.when(t["role"] == F.col("speaker"), F.lit("<|assistant|>"))
                .when(t["role"].isin(*context), F.concat(F.lit("<|"), t["role"], F.lit("|>")))
                .otherwise(F.concat(F.lit("<|user name="), t["role"], F.lit("|>"))))
        head = F.concat(head, F.lit("\n"))
        return F.struct(F.concat(head, t["text"], F.lit("<|end|>\n")).alias("text"), F.length(head).alias("head"),
                        (t["role"] == F.col("speaker")).alias("own"))

    shown = views.withColumn("segments", F.transform(F.concat("repeated", "turns"), segment)).withColumn("sizes", F.transform("segments", lambda s: F.length(s["text"])))
    starts = F.aggregate("sizes", F.array(F.lit(0)), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n)))
    shown = shown.withColumn("starts", starts)
    spans = F.transform("segments", lambda s, i: F.struct((F.get("starts", i) + s["head"]).alias("start"), (F.get("starts", i + 1) - 1).alias("end"), s["own"].alias("own")))
    mask = F.transform(F.filter(spans, lambda s: s["own"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return shown.select(F.col("conv").alias(conv_id), "speaker", "block", F.size("turns").cast("long").alias("n_turns"),
                        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("text"), mask.alias("mask"))


SQL = """
with r as (
  select conv_id, coalesce(role, 'unknown') as role, coalesce(text, '') as text,
    row_number() over w - 1 as rank, coalesce(sum(length(coalesce(text, ''))) over (w rows between unbounded preceding and 1 preceding), 0) as before
  from conversations window w as (partition by conv_id order by turn nulls last, coalesce(role, 'unknown'), coalesce(text, ''))),
b as (select *, min(rank) over (partition by conv_id, rank // 256, before // 1048576) as block from r),
t as (
  select conv_id, block, rank, role, text, true as own_turn from b
  union all select f.conv_id, f.block, -1, c.role, c.text, false from b f join r c on f.conv_id = c.conv_id and c.role = 'system' and c.rank < f.rank
  where f.rank = f.block and f.role <> 'system'
  qualify row_number() over (partition by f.conv_id, f.block order by c.rank desc) = 1),
s as (select distinct conv_id, role as speaker from r where role <> 'system'),
v as (
  select conv_id, speaker, block, rank, role, text, own_turn,
    case when role = speaker then '<|assistant|>' when role = 'system' then '<|system|>' else '<|user name=' || role || '|>' end || chr(10) as head
  from t join s using (conv_id)),
w as (
  select *, sum(length(head) + length(text) + 8) over (partition by conv_id, speaker, block order by rank
    rows between unbounded preceding and current row) as past from v)
select conv_id, speaker, block, count_if(own_turn) as n_turns,
  string_agg(head || text || '<|end|>' || chr(10), '' order by rank) as text,
  coalesce(string_agg(case when role = speaker then cast(past - length(text) - 8 as bigint) || '-' || cast(past - 1 as bigint) end, ',' order by rank), '') as mask
from w group by conv_id, speaker, block
"""
