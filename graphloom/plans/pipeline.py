"""The article pipeline as restartable stages, each a written table, and its command line."""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom import schema
from graphloom.config import Settings
from graphloom.functions.vectors import hashed_embedding
from graphloom.operators import answers, clustering, entities, events, graph, similarity, taxonomy
from graphloom.plans.models import embed_articles
from graphloom.sources import articles as A
from graphloom.sources import sinks
from graphloom.sources.taxonomy import seed_types
from graphloom.storage import materialize

STAGES = ("articles", "mentions", "entities", "vectors", "pairs", "members", "events", "triples", "edges", "nodes")


class Run:
    """Stages write below ``out``; a stage before ``from_stage`` is read as it stands.

    previous: the ``out`` of an earlier run, another folder. Its articles, mentions, entities and
    vectors are carried over: only urls that it lacks are read, tagged, resolved and embedded, and
    the entity table is merged. Pairs, clusters and all that follows are made of old and new
    articles together, so that late articles join the clusters of their week.
    """

    def __init__(self, spark: SparkSession, folder: str, out: str, now: str, settings: Settings = Settings(), from_stage: str = "articles", skip_llm: bool = False, client: Callable[[str], str] = answers.rule_answer, previous: str = ""):
        self.spark, self.folder, self.out, self.now, self.settings = spark, folder, out.rstrip("/"), now, settings
        self.first, self.skip_llm, self.client = STAGES.index(from_stage), skip_llm, client
        self.previous = previous.rstrip("/")
        if self.previous == self.out:
            raise ValueError("a run cannot carry over the folder that it writes")

    def path(self, name: str) -> str:
        return f"{self.out}/{name}"

    def stage(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if STAGES.index(name) >= self.first:
            make().write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.parquet(self.path(name))

    def stored(self, name: str, schema: str) -> DataFrame:
        """A table of the previous run; without one, an empty table of this schema."""
        return self.spark.read.parquet(f"{self.previous}/{name}") if self.previous else self.spark.createDataFrame([], schema)

    def grown(self, name: str, new: DataFrame) -> DataFrame:
        return self.stored(name, "").unionByName(new) if self.previous else new

    def gather(self) -> dict[str, DataFrame]:
        """The tables that grow from run to run: articles, mentions, entities, vectors."""
        s, t = self.settings, {}
        raw, _ = A.scan_json(self.spark, self.folder)
        stored = self.stored("articles", "id string, url string")
        t["articles"] = self.stage("articles", lambda: self.grown("articles", events.weekly(A.new_by_url(A.parse_articles(raw, self.now), stored, ["id", "title", "content"]))))
        arts = t["articles"]
        new = arts.join(stored.select("id"), "id", "left_anti").select(arts.columns)
        t["mentions"] = self.stage("mentions", lambda: self.grown("mentions", entities.rule_mentions(new)))
        told = t["mentions"].join(stored.select(F.col("id").alias("article_id")), "article_id", "left_anti")
        t["entities"] = self.stage("entities", self.entities(told))
        t["vectors"] = self.stage("vectors", lambda: self.grown("vectors", embed_articles(new, None, s.embedding_dim, s.content_chars)))
        return t

    def run(self) -> dict[str, DataFrame]:
        s, t = self.settings, self.gather()
        arts = t["articles"]
        t["pairs"] = self.stage("pairs", lambda: similarity.duplicate_pairs(t["vectors"], t["vectors"], s.duplicate_neighbours, s.duplicate_similarity))
        t["members"] = self.stage("members", self.members(arts, t["vectors"], t["pairs"]))
        t["events"] = self.stage("events", lambda: events.build_events(t["members"], arts, s.representatives, s.excerpt_chars))
        t["triples"] = self.stage("triples", self.triples(t["events"]))
        t["edges"] = self.stage("edges", self.edges(t["triples"], t["entities"]))
        t["nodes"] = self.stage("nodes", self.nodes(t["edges"], t["entities"], t["events"]))
        return t

    def entities(self, mentions: DataFrame) -> Callable[[], DataFrame]:
        def make():
            state = self.stored("entities", schema.ENTITY).drop("embedding_vector")
            told = mentions.withColumn("ord", F.format_string("%s:%010d", "article_id", "span_start"))
            found = entities.resolve(told, state, self.settings.embedding_dim, self.settings.entity_similarity, self.settings.fuzzy_ratio, self.settings.fuzzy_weight)
            out = materialize(entities.merge_entities(state, told, found, self.now), "merged-entities")
            vec = hashed_embedding(out, "canonical_name", "canonical_name", self.settings.embedding_dim).select(F.col("id").alias("canonical_name"), F.col("vector").alias("embedding_vector"))
            return out.join(vec, "canonical_name").select(*state.columns, "embedding_vector")

        return make

    def members(self, arts: DataFrame, vectors: DataFrame, pairs: DataFrame) -> Callable[[], DataFrame]:
        def make():
            rows = similarity.survivors(arts.select("id", "temporal_window"), pairs).join(vectors, "id").withColumn("ord", F.col("id"))
            labelled = clustering.cluster_windows(rows, self.settings.min_cluster_size, self.settings.event_similarity)
            return labelled.join(clustering.renumber(labelled), ["temporal_window", "label"]).select("temporal_window", "cluster_id", "id", "ord")

        return make

    def triples(self, found: DataFrame) -> Callable[[], DataFrame]:
        def make():
            if self.skip_llm:
                label = F.concat(F.lit("Event "), F.col("cluster_id").cast("string"))
                empty = found.where("false")
                return empty.select("event_id", label.alias("event_label"), F.lit(0).cast("long").alias("ord"), *[F.lit("").alias(c) for c in ("source", "relation", "target")], F.lit(0.5).alias("confidence"), F.lit("").alias("relation_canonical"))
            told = answers.parse_answers(answers.extract(found, self.client, self.settings.llm_workers, self.settings.prompt_chars))
            rows = answers.triples_of(told).join(told.select("event_id", "event_label"), "event_id")
            names = taxonomy.merge_relations(rows.select("relation", F.concat_ws("|", "event_id", F.format_string("%09d", "ord")).alias("ord")), self.settings.relation_similarity, self.settings.embedding_dim)
            from graphloom.functions.text import preprocess_relation

            named = names.select(F.col("relation").alias("phrase"), "relation_canonical")
            return rows.withColumn("phrase", preprocess_relation(F.col("relation"))).join(named, "phrase", "left").drop("phrase")

        return make

    def edges(self, triples: DataFrame, found: DataFrame) -> Callable[[], DataFrame]:
        def make():
            names = graph.name_map(found.withColumn("ord", F.col("canonical_id")))
            return graph.collapse_edges(graph.triple_edges(graph.resolve_names(triples, names)), ["event_id", "ord", "sub"])

        return make

    def nodes(self, edges: DataFrame, ents: DataFrame, found: DataFrame) -> Callable[[], DataFrame]:
        labels = self.spark.read.parquet(self.path("triples")).groupBy("event_id").agg(F.min("event_label").alias("told"))
        named = found.join(labels, "event_id", "left").withColumn("label", F.coalesce("told", F.concat(F.lit("Event "), F.col("cluster_id").cast("string"))))
        return lambda: graph.build_nodes(edges, ents, named)

    def export(self, tables: dict[str, DataFrame], seeds: str = "") -> None:
        """CSV tables, page and reports below ``out``, which must be a local folder here."""
        nodes, edges = tables["nodes"], tables["edges"]
        sinks.write_csv(sinks.nodes_table(nodes), self.path("nodes_csv"), True)
        sinks.write_csv(sinks.edges_table(edges), self.path("relationships_csv"), True)
        with open(self.path("graph.html"), "w") as f:
            f.write(sinks.html_page(nodes, edges))
        rows = lambda df: [r.asDict() for r in df.collect()]
        sinks.save_report({
            "graph_stats": rows(graph.graph_stats(nodes, edges))[0], "top_entities_by_mentions": rows(graph.top_by_mentions(nodes, self.settings.top_k)),
            "top_entities_by_connections": rows(graph.top_by_connections(nodes, edges, self.settings.top_k)), "event_frequency_by_window": rows(graph.events_by_window(nodes)),
            "settings": asdict(self.settings),
        }, self.path("metrics.json"))
        usage = taxonomy.relation_usage(tables["triples"])
        sinks.save_report({"generated_at": self.now, "entity_types": rows(seed_types(self.spark, seeds)), "relations": rows(usage.orderBy(F.desc("usage_count"), "relation_canonical").limit(1000))}, self.path("ontology.json"))


def main(given: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--input", default="data/raw/")
    p.add_argument("--out", default="data/out/")
    p.add_argument("--run-all", action="store_true")
    p.add_argument("--daily", action="store_true", help="carry over the tables of --previous")
    p.add_argument("--previous", default="", help="output folder of the run before")
    p.add_argument("--from-stage", default="articles", choices=STAGES)
    p.add_argument("--skip-llm", action="store_true")
    p.add_argument("--seed-types", default="")
    p.add_argument("--now", required=False, default="1970-01-01 00:00:00", help="stands for the date of articles without one")
    a = p.parse_args(given)
    if not (a.run_all or a.daily):
        p.print_help()
        return 1
    spark = SparkSession.builder.appName("graphloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    os.makedirs(a.out, exist_ok=True)
    run = Run(spark, a.input, os.path.abspath(a.out), a.now, from_stage=a.from_stage, skip_llm=a.skip_llm, previous=os.path.abspath(a.previous) if a.daily and a.previous else "")
    run.export(run.run(), a.seed_types)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
