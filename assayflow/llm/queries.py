"""The operators as queries over the given tables, with the SQL that has to give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayflow.llm import budget, covering, decontaminate, exact, layout, lines, negatives, packing, quality, ranked, rotation, suffixes, urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the words of passages of 50 or more words that occur more than once."""
    return suffixes.passage_report(_table(spark, sf_dir, "documents"))


def op2_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.score(docs, model, keep=["doc_id"]).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op3_benchmark_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_matches(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", decontaminate.hit_words().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("starts") > 0).alias("contaminated"),
                        "longest", "longest_at", "longest_item")


def op4_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.extract(_table(spark, sf_dir, "pages"), keep=["page_id"])


def op5_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op6_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(spark, f"{sf_dir}/documents.parquet")


def op7_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(_table(spark, sf_dir, "documents"))


def op8_rotated_dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = rotation.rotate(_table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string")))
    return shown.withColumn("mask", F.array_join(spans, ","))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = covering.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = budget.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op11_ranked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of the ids is taken where they are made, so that ids of 4 bytes a token need not be shuffled for it."""
    import public_tokenizers
    pieces = packing.tokenize(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    digests = pieces.select(F.col("id").alias("doc_id"), "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack_pieces(digests)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_repeated_passages, op2_quality_scores, op3_benchmark_matches, op4_page_text, op5_url_verdicts, op6_exact_duplicates,
    op7_repeated_lines, op8_rotated_dialogues, op9_near_duplicates, op10_source_mix, op11_ranked_documents, op12_hard_negatives, op13_packed_sequences, pipeline)}

ORACLE = {"op5_url_verdicts": urls.SQL, "op6_exact_duplicates": exact.SQL, "op8_rotated_dialogues": rotation.SQL,
          "op11_ranked_documents": ranked.SQL, "op12_hard_negatives": negatives.SQL}
