"""The contract queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm import huffman, language, media, minhash, mixing, packing, pii, quality, vectors, warc


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.read_archives(warc.write_archives(_table(spark, sf_dir, "pages")))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    field = quality.train(docs, _table(spark, sf_dir, "labels").select("doc_id", "quality"))
    scored = docs.select("doc_id", quality.held_out(F.col("doc_id"), 5, 0).alias("held_out"), quality.score_column(docs, field).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digests(media.to_media(_table(spark, sf_dir, "documents")))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("pii_spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("pii_spans", lambda s: s["kind"].isin(*pii.BASE))
    return found.select("doc_id", *[count(k) for k in pii.PATTERNS], F.sha2(pii.told(base), 256).alias("base_sha256"), pii.told(F.col("pii_spans")).alias("spans"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_texts(_table(spark, sf_dir, "documents"), shingle=4, percent=80)


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.read_files(huffman.encode_documents(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.predict(docs.select("doc_id", "text"), language.train(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id"), 3, 1).alias("held_out"), "lid.lang_pred", "lid.score")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (op1_warc, op2_quality, op3_media, op4_embedding_dedup, op5_pii, op6_packing, op7_minhash_dedup, op8_token_output, op9_mixing, op10_language)
    }


def oracle_sql() -> dict[str, str]:
    return {}
