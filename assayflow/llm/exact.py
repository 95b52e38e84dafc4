"""Exact duplicates by stateful streaming.

A streaming aggregate keyed by the digest of the text is the memory of what was seen. Its state lives in RocksDB on the
executors' disks and, committed, in the shared folder; nothing expires. It keeps for each digest the
identifier and the content locator of the row that stays, and a count. On a hit, the full bytes are compared
with those at the locator, so that no two texts are taken for equal by their digest alone.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayflow.llm.common import sift
from assayflow.sources.tables import cut_lineage, shared_folder

STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Many small stores: no disk is set aside ahead of what is written.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes; a null text counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def remember(stream: DataFrame, memory: str, text: str = "text", doc_id: str = "doc_id") -> None:
    """Feed all that a stream offers now into the state under ``memory``. Called again, it goes on where it stopped."""
    keyed = stream.select(digest(F.col(f"`{text}`")).alias("digest"), F.col(f"`{doc_id}`").alias("id"),
                          F.col("_metadata.file_path").alias("file"))
    state = keyed.groupBy("digest").agg(F.max(F.struct("id", "file")).alias("stays"), F.count("*").alias("n"))
    with _settings(stream.sparkSession, STORE):
        run = (state.writeStream.outputMode("update").format("noop").option("checkpointLocation", memory)
               .trigger(availableNow=True).start())
        run.awaitTermination()


def recall(spark: SparkSession, memory: str) -> DataFrame:
    """The state: digest, the id (and file) of the row that stays, and how many rows have the digest."""
    with _settings(spark, STORE):
        state = spark.read.format("statestore").load(memory)
        stays, n = state.schema["value"].dataType.names
        return state.select("key.digest", F.col(f"value.{stays}.id").alias("keep_id"), F.col(f"value.{stays}.file").alias("file"),
                            F.col(f"value.{n}").alias("group_size"))


def exact_duplicates(spark: SparkSession, path: str, text: str = "text", doc_id: str = "doc_id", memory: str | None = None) -> DataFrame:
    """One row per row of the Parquet table at ``path``: id, keep_id, group_size, kept and text_sha256.

    Texts are equal when their bytes are; null counts as empty. Of equal texts the row of the largest id stays
    (a null id only if there is no other). Rows that repeat this id with this text all stay. An empty table
    gives an empty one; other columns are not read. Rows of a digest whose bytes differ from the text at its
    locator, which no known text does, are grouped again by their bytes.
    """
    memory = memory or f"{shared_folder(spark)}/memory/{uuid.uuid4().hex}"
    docs = spark.read.parquet(path)
    place = path.rstrip("/")
    place = f"{place[:-1]}[{place[-1]}]"  # a pattern may name one file; a plain path must be a folder
    remember(spark.readStream.schema(docs.schema).parquet(place), memory, text, doc_id)
    state = cut_lineage(recall(spark, memory))
    content = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), content.alias("content"), digest(F.col(f"`{text}`")).alias("digest"))
    alone = rows.select("id", "digest").join(state.where("group_size = 1"), "digest").select("id", "digest", "keep_id", "group_size")
    held = state.where("group_size > 1").drop("file")
    may_hit = sift(rows.withColumn("key", F.xxhash64("digest")), "key", held.select(F.xxhash64("digest").alias("key")))
    hits = may_hit.drop("key").join(held, "digest")
    stored = (hits.where(F.col("id").eqNullSafe(F.col("keep_id"))).groupBy(F.col("digest").alias("stored_digest"))
              .agg(F.min("content").alias("stored")))
    same = F.col("content") == F.col("stored")
    compared = cut_lineage(hits.join(stored, F.col("digest") == F.col("stored_digest"))
                           .select("id", "digest", "keep_id", "group_size", F.when(~same, F.col("content")).alias("other")))
    return alone.unionByName(_regrouped(compared)).select(
        F.col("id").alias(doc_id), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"))


def _regrouped(compared: DataFrame) -> DataFrame:
    """Rows whose bytes are not those at the locator form groups of their own, by their bytes."""
    names = ["id", "digest", "keep_id", "group_size"]
    others = compared.where("other is not null")
    if others.isEmpty():
        return compared.select(*names)
    own = others.groupBy("digest", "other").agg(F.max("id").alias("own_keep"), F.count("*").alias("own_size"))
    moved = own.groupBy("digest").agg(F.sum("own_size").alias("moved"))
    rest = (compared.where("other is null").join(moved, "digest", "left")
            .select("id", "digest", "keep_id", (F.col("group_size") - F.coalesce("moved", F.lit(0))).alias("group_size")))
    return rest.union(others.drop("keep_id", "group_size").join(own, ["digest", "other"])
                      .select("id", "digest", F.col("own_keep"), F.col("own_size")))


SQL = """
select doc_id, max(doc_id) over (partition by coalesce(text, '')) as keep_id, count(*) over (partition by coalesce(text, '')) as group_size,
  doc_id = max(doc_id) over (partition by coalesce(text, '')) as kept, sha256(coalesce(text, '')) as text_sha256
from documents
"""
