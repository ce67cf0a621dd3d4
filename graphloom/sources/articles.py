"""Article sources: JSON and JSON-lines folders, field mapping, and state by status."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphloom.config import STATUSES
from graphloom.functions import text as T

RAW = "title string, content string, source string, published_at variant, published variant, url string, _corrupt_record string"


def scan_json(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """All *.json and *.jsonl files below a folder: rows of raw fields, and quarantined rows.

    JSON-lines files hold a record a line; JSON files an array or one object. Blank lines are
    skipped; malformed lines and files go to quarantine with their path. A missing folder, or one
    without such files, gives empty tables.
    """
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        raw = spark.createDataFrame([], RAW).withColumn("path", F.lit(""))
    else:
        read = lambda glob, many: (
            spark.read.schema(RAW).option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("multiLine", many)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(folder).withColumn("path", F.col("_metadata.file_path"))
        )
        raw = read("*.jsonl", False).unionByName(read("*.json", True))
    # The reader wants a field beside the corrupt record in any query; this test holds for every row.
    read_too = F.length(F.concat_ws("", "title", "url")) >= 0
    good = raw.where(F.col("_corrupt_record").isNull() & read_too).drop("_corrupt_record")
    return good, raw.where(F.col("_corrupt_record").isNotNull() & read_too).select("path", "_corrupt_record")


def parse_articles(raw: DataFrame, now: str) -> DataFrame:
    """Articles of raw rows, with the columns of schema.ARTICLE and published_at_inferred.

    The date is published_at, or published where that is absent or empty; what fits no form is
    ``now`` and marked as inferred. The id is a hash of the url.
    """
    filled = lambda c: F.when(c.isNotNull() & (F.coalesce(F.try_variant_get(c, "$", "string"), F.lit("")) != ""), c)
    date = F.coalesce(filled(F.col("published_at")), F.col("published"))
    value, inferred = T.published_at(date, F.lit(now).cast("timestamp_ntz"))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return raw.select(
        F.sha2(text("url"), 256).alias("id"), text("title").alias("title"), text("content").alias("content"), text("source").alias("source"),
        value.alias("published_at"), text("url").alias("url"), F.lit("ingested").alias("status"), F.coalesce(inferred, F.lit(True)).alias("published_at_inferred"),
    )


def new_by_url(batch: DataFrame, stored: DataFrame, order: list[str]) -> DataFrame:
    """Rows of a batch whose url is neither empty nor stored; of rows that share a url the first."""
    first = Window.partitionBy("url").orderBy(*order)
    once = batch.where("url <> ''").withColumn("url_rank", F.row_number().over(first)).where("url_rank = 1").drop("url_rank")
    return once.join(stored.select("url").distinct(), "url", "left_anti").select(*batch.columns)


def ingest_counts(batch: DataFrame, inserted: DataFrame) -> DataFrame:
    """inserted, skipped, total."""
    n = inserted.agg(F.count("*").alias("inserted"))
    return batch.agg(F.count("*").alias("total")).join(n).select("inserted", (F.col("total") - F.col("inserted")).alias("skipped"), "total")


def with_status(articles: DataFrame, status: str) -> DataFrame:
    return articles.where(F.col("status") == status)


def first_nonempty(articles: DataFrame, statuses: tuple[str, ...]) -> DataFrame:
    """The rows of the first status in order that has rows at all."""
    rank = F.array_position(F.array(*[F.lit(s) for s in statuses]), F.col("status"))
    ranked = articles.where(F.col("status").isin(*statuses)).withColumn("status_rank", rank)
    best = ranked.agg(F.min("status_rank").alias("status_rank"))
    return ranked.join(F.broadcast(best), "status_rank").select(*articles.columns)  # one row


def update_status(articles: DataFrame, ids: DataFrame, status: str, forward_only: bool = True) -> DataFrame:
    """Articles with a new status for the given ids; a status never moves back if forward_only."""
    marked = articles.join(ids.select("id").distinct().withColumn("hit", F.lit(True)), "id", "left")
    place = lambda c: F.array_position(F.array(*[F.lit(s) for s in STATUSES]), c)
    moves = F.coalesce("hit", F.lit(False)) & (place(F.lit(status)) > place(F.col("status")) if forward_only else F.lit(True))
    return marked.withColumn("status", F.when(moves, status).otherwise(F.col("status"))).select(*articles.columns)
