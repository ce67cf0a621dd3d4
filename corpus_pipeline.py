"""From documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphloom.llm import minhash, mixing, packing, pii, quality
from graphloom.llm.idfilter import may_hold
from graphloom.llm.queries import tokenizer_path
from graphloom.storage import materialize


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str, least: float = 0.3) -> DataFrame:
    """Documents that the quality field scores ``least`` or more; learned from labels as in op2."""
    field = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))
    return docs.where(quality.score_column(docs, field) >= least)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest doc_id.

    Of rows that share a doc_id one stays. Rows without doc_id stay.
    """
    found = materialize(minhash.near_texts(docs, shingle=5, percent=80).select("doc_id", "kept").where("doc_id is not null"), "near-texts")
    dropped = found.where("not kept").select(F.col("doc_id").alias("dropped_id")).distinct()
    dropped = materialize(dropped, "dropped")
    asked = may_hold(dropped, "dropped_id", dropped.count())
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))  # columns of docs can't clash with those used here
    marked = asked(whole.select("row", F.col("row.doc_id").cast("long").alias("own_id")), "own_id")
    doubted = marked.where("asked").join(dropped, F.col("own_id") == F.col("dropped_id"), "left_anti")
    kept = marked.where("not asked").select("row", "own_id").union(doubted.select("row", "own_id"))  # what is surely kept needn't move
    if found.groupBy("doc_id").count().where("count > 1").limit(1).count():
        order = Window.partitionBy("own_id").orderBy(*[F.col(f"row.`{c}`") for c, kind in docs.dtypes if not kind.startswith("map")])
        kept = kept.withColumn("copy", F.row_number().over(order)).where("copy = 1 or own_id is null")
    return kept.select("row.*")


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data masked; n_chars is that of the masked text. No row goes."""
    found = pii.find_pii(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), text_col="row.text")
    text = F.when(F.size("pii_spans") > 0, pii.masked(F.col("pii_text"), F.col("pii_spans"))).otherwise(F.col("row.text"))
    kept = found.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns], F.size("pii_spans").alias("pii_found"))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        kept = kept.withColumn("n_chars", F.when(F.col("pii_found") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return kept.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: not at all, once or twice."""
    return mixing.mixed_documents(docs, mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 2048; a document taken twice is packed twice."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality", filter_quality),
    ("near_dedup", drop_near_duplicates),
    ("pii", mask_pii),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: Regular-expression spans, MinHash and tokens are beyond SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
