"""The temporal graph as node and edge tables, and its metrics."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.storage import materialize

PART = "PARTICIPATES_IN"


def name_map(entities: DataFrame) -> DataFrame:
    """name_key, canonical_id: lower-case names and aliases; the last entity in order of ord wins."""
    names = F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))
    keys = entities.select("canonical_id", "ord", F.posexplode(names).alias("pos", "name"))
    return keys.groupBy(F.lower("name").alias("name_key")).agg(F.max_by("canonical_id", F.struct("ord", "pos")).alias("canonical_id"))


def resolve_names(triples: DataFrame, names: DataFrame) -> DataFrame:
    """Triples with source and target as canonical ids, or as they were where no entity fits."""
    one = names.select(F.col("name_key").alias("source_key"), F.col("canonical_id").alias("source_id"))
    two = names.select(F.col("name_key").alias("target_key"), F.col("canonical_id").alias("target_id"))
    out = triples.join(one, F.lower("source") == F.col("source_key"), "left").join(two, F.lower("target") == F.col("target_key"), "left")
    named = {"source": F.coalesce("source_id", "source").alias("source"), "target": F.coalesce("target_id", "target").alias("target")}
    return out.select(*[named.get(c, F.col(c)) for c in triples.columns])


def triple_edges(triples: DataFrame) -> DataFrame:
    """Up to three edges a triple: source and target take part in the event, and the relation itself."""
    full = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    edge = lambda sub, a, b, rel, raw: F.struct(F.lit(sub).alias("sub"), F.col(a).alias("source"), F.col(b).alias("target"), rel.alias("relation"), raw.cast("string").alias("original_relation"))
    label = F.coalesce(F.nullif("relation_canonical", F.lit("")), "relation")
    made = F.array(
        F.when(full("source") & full("event_id"), edge(0, "source", "event_id", F.lit(PART), F.lit(None))),
        F.when(full("target") & full("event_id"), edge(1, "target", "event_id", F.lit(PART), F.lit(None))),
        F.when(full("source") & full("target") & (F.col("source") != F.col("target")), edge(2, "source", "target", label, F.col("relation"))),
    )
    rows = triples.select("event_id", "ord", "confidence", F.explode(F.filter(made, lambda e: e.isNotNull())).alias("e"))
    return rows.select("e.source", "e.target", "e.relation", "confidence", "event_id", "e.original_relation", "ord", "e.sub")


def collapse_edges(edges: DataFrame, order: list[str]) -> DataFrame:
    """One edge per (source, target): the last written wins."""
    last = F.max_by(F.struct("relation", "confidence", "event_id", "original_relation"), F.struct(*order)).alias("last")
    return edges.groupBy("source", "target").agg(last).select("source", "target", "last.*")


def build_nodes(edges: DataFrame, entities: DataFrame, events: DataFrame) -> DataFrame:
    """schema.NODE: endpoints of edges, merged with entity and event attributes; all are kept."""
    ends = edges.select(F.explode(F.array("source", "target")).alias("id")).distinct()
    known = entities.select(F.col("canonical_id").alias("id"), F.col("canonical_name").alias("name"), F.col("entity_type").alias("type"), "mention_count", "aliases")
    event = events.select(
        F.col("event_id").alias("id"), F.col("label").alias("event_name"), "cluster_id", "temporal_window", F.size("article_ids").cast("long").alias("article_count")
    )
    out = ends.join(known, "id", "full_outer").join(event, "id", "full_outer")
    kind = F.coalesce("type", F.when(F.col("event_name").isNotNull(), "Event"))
    return out.select("id", F.coalesce("name", "event_name").alias("name"), kind.alias("type"), "mention_count", "cluster_id", "temporal_window", "aliases", "article_count")


def enrich_nodes(nodes: DataFrame, entities: DataFrame) -> DataFrame:
    """Full outer merge of node ids with entity attributes: id, name, mention_count."""
    return nodes.join(entities, "id", "full_outer").select("id", F.coalesce("name", "id").alias("name"), F.coalesce("mention_count", F.lit(0)).alias("mention_count"))


def graph_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node_count, edge_count, types other than Event, relations with PARTICIPATES_IN, relations without."""
    n = nodes.agg(F.count("*").alias("node_count"), F.countDistinct(F.when(F.col("type") != "Event", F.col("type"))).alias("entity_types"))
    e = edges.agg(F.count("*").alias("edge_count"), F.countDistinct("relation").alias("relation_types"), F.countDistinct(F.when(F.col("relation") != PART, F.col("relation"))).alias("relations_discovered"))
    return n.join(e)  # two single rows


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """id, degree (in and out); isolated nodes have 0."""
    ends = edges.select(F.explode(F.array("source", "target")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))
    return nodes.select("id").join(ends, "id", "left").select("id", F.coalesce("degree", F.lit(0)).alias("degree"))


def degree_centrality(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """id, centrality: degree over n - 1; 1 in a graph of one node."""
    n = nodes.agg(F.count("*").alias("n"))
    return degrees(nodes, edges).join(F.broadcast(n)).select("id", F.when(F.col("n") > 1, F.col("degree") / (F.col("n") - 1)).otherwise(1.0).alias("centrality"))


def betweenness(nodes: DataFrame, edges: DataFrame, most_edges: int = 5_000_000) -> DataFrame:
    """id, centrality: exact betweenness of a directed graph without weights, normalized.

    Sources are spread over tasks, each of which holds the adjacency; graphs of more than
    ``most_edges`` edges are refused, since that table is broadcast.
    """
    links = materialize(edges.select("source", "target").where("source <> target").distinct(), "links")  # read several times
    total = links.count()
    if total > most_edges:
        raise ValueError(f"{total} edges; betweenness holds {most_edges} at most")
    spark = nodes.sparkSession
    ids = [r.id for r in nodes.select("id").union(links.select("source")).union(links.select("target")).distinct().orderBy("id").collect()]
    place = {x: k for k, x in enumerate(ids)}
    out: list[list[int]] = [[] for _ in ids]
    for r in links.collect():
        out[place[r.source]].append(place[r.target])
    sent = spark.sparkContext.broadcast(out)
    n = len(ids)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        after, score = sent.value, np.zeros(n)
        for b in batches:
            for s in b["k"]:
                paths, depth, order, before = np.zeros(n), np.full(n, -1), [], [[] for _ in range(n)]
                paths[s], depth[s], queue = 1, 0, deque([s])
                while queue:
                    v = queue.popleft()
                    order.append(v)
                    for w in after[v]:
                        if depth[w] < 0:
                            depth[w] = depth[v] + 1
                            queue.append(w)
                        if depth[w] == depth[v] + 1:
                            paths[w] += paths[v]
                            before[w].append(v)
                share = np.zeros(n)
                for w in reversed(order):
                    for v in before[w]:
                        share[v] += paths[v] / paths[w] * (1 + share[w])
                    if w != s:
                        score[w] += share[w]
        yield pd.DataFrame({"k": np.arange(n), "score": score})

    if n == 0:
        return spark.createDataFrame([], "id string, centrality double")
    kind = dict(nodes.dtypes)["id"]
    named = spark.createDataFrame([(k, x) for k, x in enumerate(ids)], f"k long, id {kind}")
    parts = min(n, spark.sparkContext.defaultParallelism)
    scores = spark.range(n).withColumnRenamed("id", "k").repartition(parts).mapInPandas(run, "k long, score double").groupBy("k").agg(F.sum("score").alias("score"))
    scale = 1.0 / ((n - 1) * (n - 2)) if n > 2 else 1.0
    return named.join(scores, "k").select("id", (F.col("score") * scale).alias("centrality"))


def not_event(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.coalesce("type", F.lit("")) != "Event")


def top_by_mentions(nodes: DataFrame, k: int = 20) -> DataFrame:
    found = not_event(nodes).select("id", F.coalesce("name", "id").alias("name"), F.coalesce("mention_count", F.lit(0)).alias("mention_count"))
    return found.orderBy(F.desc("mention_count"), "id").limit(k)


def top_by_connections(nodes: DataFrame, edges: DataFrame, k: int = 20) -> DataFrame:
    found = not_event(nodes).select("id", F.coalesce("name", "id").alias("name")).join(degrees(nodes, edges), "id")
    return found.select("id", "name", "degree").orderBy(F.desc("degree"), "id").limit(k)


def events_by_window(nodes: DataFrame) -> DataFrame:
    return nodes.where("type = 'Event'").groupBy(F.coalesce("temporal_window", F.lit("unknown")).alias("temporal_window")).agg(F.count("*").alias("events"))


def neighbourhood(edges: DataFrame, start: DataFrame, hops: int = 2) -> DataFrame:
    """id, hop: nodes within some hops of the start nodes, in either direction."""
    both = edges.select("source", "target").union(edges.select("target", "source")).distinct()
    found = start.select("id", F.lit(0).alias("hop"))
    edge = found
    for hop in range(1, hops + 1):
        edge = edge.join(both, F.col("id") == F.col("source")).select(F.col("target").alias("id"), F.lit(hop).alias("hop")).distinct()
        found = found.union(edge)
    return found.groupBy("id").agg(F.min("hop").alias("hop"))


def endpoints_where(edges: DataFrame, condition) -> DataFrame:
    """Distinct ids at either end of the edges that meet a condition."""
    return edges.where(condition).select(F.explode(F.array("source", "target")).alias("id")).distinct()


def cooccurrence(participants: DataFrame, most: int = 1_000) -> DataFrame:
    """left_id, right_id, events: how many events two entities share, from event_id, id.

    Pairs are the result here; an event of more than ``most`` entities is an error, not a sample.
    """
    rows = participants.select("event_id", "id").distinct()
    size = rows.groupBy("event_id").count().where(F.col("count") > most).limit(1).count()
    if size:
        raise ValueError(f"an event has more than {most} entities")
    a, b = rows.select("event_id", F.col("id").alias("left_id")), rows.select("event_id", F.col("id").alias("right_id"))
    return a.join(b, "event_id").where("left_id < right_id").groupBy("left_id", "right_id").agg(F.count("*").alias("events"))
