"""Events from weekly clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions.text import iso_week
from graphloom.config import STATUSES


def weekly(articles: DataFrame) -> DataFrame:
    return articles.withColumn("temporal_window", iso_week(F.col("published_at")))


def events_by_week(articles: DataFrame, representatives: int = 3) -> DataFrame:
    """temporal_window, article_count, source_count, representatives (first ids).

    Representatives are ranked with a group limit, so that no list of all ids is made.
    """
    weeks = weekly(articles)
    counts = weeks.groupBy("temporal_window").agg(F.count("*").alias("article_count"), F.countDistinct("source").alias("source_count"))
    return counts.join(first_ids(weeks, ["temporal_window"], "id", representatives), "temporal_window")


def first_ids(rows: DataFrame, keys: list[str], order: str, k: int) -> DataFrame:
    """keys, representatives: the first k ids of each key; ranks are limited before the shuffle ends."""
    ranked = rows.select(*keys, "id", order).withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(order, "id"))).where(F.col("rank") <= k)
    return ranked.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "id"))), lambda s: s["id"]).alias("representatives"))


def build_events(members: DataFrame, articles: DataFrame, representatives: int = 3, excerpt: int = 300) -> DataFrame:
    """schema.EVENT from members (temporal_window, cluster_id, id, ord) and articles.

    An event holds the ids of its articles and a context with an excerpt of each, in order of ord.
    Its id is a hash of week and article ids.
    """
    told = members.join(articles.select("id", "title", "content"), "id")
    part = F.concat(F.lit("Title: "), "title", F.lit("\nExcerpt: "), F.substring("content", 1, excerpt), F.lit("..."))
    grouped = told.groupBy("temporal_window", "cluster_id").agg(F.array_sort(F.collect_list(F.struct("ord", "id", part.alias("part")))).alias("rows"))
    ids = F.transform("rows", lambda r: r["id"].cast("string"))
    return grouped.select(
        F.sha2(F.concat_ws("|", "temporal_window", F.array_join(ids, ",")), 256).alias("event_id"), "cluster_id", "temporal_window", ids.alias("article_ids"),
        F.slice(ids, 1, representatives).alias("representative_article_ids"), F.array_join(F.transform("rows", lambda r: r["part"]), "\n\n").alias("context"),
    )


def assign_clusters(articles: DataFrame, events: DataFrame) -> DataFrame:
    """Articles with cluster_id, temporal_window and status of their events; others are unchanged."""
    ids = events.select(F.explode("article_ids").alias("member"), F.col("cluster_id").alias("new_cluster"), F.col("temporal_window").alias("new_window"))
    joined = articles.join(ids, F.col("id").cast("string") == F.col("member"), "left")
    place = F.array_position(F.array(*[F.lit(s) for s in STATUSES]), F.col("status"))
    status = F.when(F.col("member").isNotNull() & (place < STATUSES.index("clustered") + 1), "clustered").otherwise(F.col("status"))
    own = [c for c in articles.columns if c not in ("cluster_id", "temporal_window", "status")]
    return joined.select(*own, F.col("new_cluster").alias("cluster_id"), F.col("new_window").alias("temporal_window"), status.alias("status"))
