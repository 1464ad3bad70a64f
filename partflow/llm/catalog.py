"""The registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.llm import centroids, conversations, decontaminate, language_id, packing, token_counts, token_file, topk_mtree, toxicity, warc
from partflow.llm.common import table
from partflow.llm.near_dedup import near_duplicates
from partflow.llm.substring_dedup import remove_repeats
from partflow.llm.suffix_dedup import remove_repeated_bytes
from partflow.llm.tokens import default_path
from partflow.session import scratch_path


def _remainder(modulus: int):
    """crc32 of doc_id as text, by ``modulus``."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(_remainder(3) == 1, F.lit(False))
    model = language_id.learn(docs.filter(~held_out).select("text", "lang"))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return language_id.predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_topk_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk_mtree.quantized(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    found = topk_mtree.search_topk(vectors, vectors.filter(F.col("vec_id") % 100 == 0))
    return found.select("query_id", "rank", "vec_id", "score")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.section_tokens(docs, default_path("byte_bpe_50k.json"))


def op6_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-shards")
    token_file.write_token_shards(table(spark, sf_dir, "documents"), path, default_path("word_bpe_49k.json"), end_id=1)
    docs = token_file.read_token_shards(spark.read.parquet(path))
    return docs.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), default_path("byte_bpe_50k.json"), end_id=0)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label")).filter(_remainder(5) != 0)
    scored = toxicity.score(docs, toxicity.learn(docs, labels))
    return scored.select("doc_id", F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings"))
    sha = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", sha.alias("centroid_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damage(table(spark, sf_dir, "conversations"))).withColumnRenamed("conv", "conv_id")


QUERIES = {
    "op1_language_id": op1_language_id,
    "op4_decontamination": op4_decontamination,
    "op2_near_dedup": op2_near_dedup,
    "op3_topk_mtree": op3_topk_mtree,
    "op5_token_counts": op5_token_counts,
    "op6_token_file": op6_token_file,
    "op7_packing": op7_packing,
    "op8_toxicity": op8_toxicity,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_warc": op10_warc,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_centroids": op12_centroids,
    "op13_conversation_repair": op13_conversation_repair,
}
