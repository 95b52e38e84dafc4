"""What several text operators share: written intermediate tables, row-preserving Arrow steps, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayflow.sources.tables import cut_lineage

__all__ = ["append", "components", "cut_lineage", "lower_ascii", "sift", "utf8"]

#: Words of 64 bits in the filter that spares rows without a partner a shuffle. It is broadcast and never larger.
FILTER = 1 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def utf8(text: str | Column) -> Column:
    """The bytes of a text; a null text has none."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else, whatever the locale."""
    return F.translate(text, UPPER, UPPER.lower())


def append(df: DataFrame, text: str, fields: str, step: Callable[[Iterator[list[bytes]]], Iterator[list[list]]],
           keep: list[str] | None = None) -> DataFrame:
    """Add columns computed from the bytes of one text column, row by row in Arrow batches.

    ``step`` gets the batches of a partition as lists of bytes and yields, for each, one list per new column.
    All other columns pass through unchanged (or only those named in ``keep``); a column of the same name
    as a new one is replaced. Nothing is shuffled and no row is identified by its content, so null ids and
    repeated rows need no care.
    """
    new = T._parse_datatype_string(fields)
    names = {f.name for f in new}
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    given = df.select(*[F.col(f"`{c}`") for c in kept], utf8(F.col(f"`{text}`")).alias("__text"))
    schema = T.StructType([f for f in given.schema if f.name != "__text"] + new.fields)

    def run(batches):
        batches = iter(batches)
        held: list[pa.RecordBatch] = []

        def texts():
            for batch in batches:
                held.append(batch)
                yield batch.column(batch.num_columns - 1).to_pylist()

        for columns in step(texts()):
            batch = held.pop()
            arrays = [batch.column(i) for i in range(batch.num_columns - 1)]
            arrays += [pa.array(values, type=kind) for values, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    kinds = [_arrow(f.dataType) for f in new]
    return given.mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    return {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
            "boolean": pa.bool_(), "binary": pa.binary()}[kind.simpleString()]


def sift(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose key may be among the keys of ``wanted``: none of those is lost, and few others pass.

    One bit per wanted key in a table of fixed size, so the broadcast does not grow with the data; when it fills up, more
    rows pass and later joins sort them out.
    """
    def word(c):
        return F.pmod(c, F.lit(FILTER)).cast("int")

    bit = F.expr(f"shiftleft(1L, cast(pmod(shiftright({key}, 24), 64) as int))")
    bits = wanted.select(word(F.col(key)).alias("__word"), bit.alias("__bit")).groupBy("__word").agg(F.bit_or("__bit").alias("__bits"))
    hit = rows.join(F.broadcast(bits), word(F.col(key)) == F.col("__word"))
    return hit.where(F.col("__bits").bitwiseAND(bit) != 0).drop("__word", "__bits")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the links (a, b) between longs: one row (node, component) per linked node.

    The component is the smallest node reachable. Large-star and small-star steps alternate until nothing
    changes, the distributed form of union-find: each step is a minimum per node, combined before the
    shuffle, and a join that adaptive execution splits at hot nodes. Every round is written out, so a lost
    executor repeats at most one round; links and labels stay on the executors.
    """
    links = cut_lineage(edges.where("a is not null and b is not null and a <> b")
                        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        found = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == state or found[0] == 0:
            break
        state = found
        links = cut_lineage(_small_star(_large_star(links)), last=[links])
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        links.select("v", "v").distinct())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    joined = links.join(least, "u")
    return (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m"))).where("u <> v").distinct())
