"""Learned taxonomies of entity types and relations."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.config import Settings
from graphloom.functions.text import preprocess_relation, relation_name
from graphloom.functions.vectors import hashed_embedding, l2sq_similarity
from graphloom.operators.clustering import hdbscan
from graphloom.operators.similarity import nearest, nearest_type


def add_seed_types(types: DataFrame, seeds: DataFrame) -> DataFrame:
    """type_name, parent_name, is_auto_discovered, is_confirmed: seeds created if missing.

    A parent is kept only where it is itself a known type.
    """
    cols = ["type_name", "parent_name", "is_auto_discovered", "is_confirmed"]
    new = seeds.select(*cols).dropDuplicates(["type_name"]).join(types.select("type_name"), "type_name", "left_anti")
    every = types.select(*cols).unionByName(new.select(*cols))
    known = every.select(F.col("type_name").alias("known"))
    return every.join(known, F.col("parent_name") == F.col("known"), "left").select("type_name", F.col("known").alias("parent_name"), "is_auto_discovered", "is_confirmed")


def active_labels(types: DataFrame, limit: int = 50, generic: tuple[str, ...] = Settings().generic_labels) -> DataFrame:
    """type_name of the types with the most mentions; the generic labels where there is no type."""
    top = types.orderBy(F.desc("mention_count"), "type_name").limit(limit).select("type_name")
    spare = types.sparkSession.createDataFrame([(g,) for g in generic], "type_name string")
    none = types.agg(F.count("*").alias("n")).where("n = 0")
    return top.union(spare.join(none).select("type_name"))


def top_types(types: DataFrame, k: int = 20) -> DataFrame:
    return types.select("type_name", "mention_count").orderBy(F.desc("mention_count"), "type_name").limit(k)


def ontology_report(types: DataFrame, top: int = 20, discovered: int = 10) -> DataFrame:
    """One row: type_count, unconfirmed, discovered (first names), top_types (first names)."""
    counts = types.agg(F.count("*").alias("type_count"), F.count_if(~F.col("is_confirmed")).alias("unconfirmed"))
    names = lambda df, order, k, name: df.select("type_name", *order).orderBy(*order).limit(k).agg(F.array_sort(F.collect_list("type_name")).alias(name))
    first = names(types.where("is_auto_discovered"), ["type_name"], discovered, "discovered")
    best = types.select("type_name", (-F.col("mention_count")).alias("less")).orderBy("less", "type_name").limit(top).agg(F.array_sort(F.collect_list("type_name")).alias("top_types"))
    return counts.join(first).join(best)  # three single rows


def merge_types(types: DataFrame, entities: DataFrame, keep: int, gone: int) -> tuple[DataFrame, DataFrame]:
    """Types and entities after one type is merged into another: counts added, children re-parented."""
    moved = lambda c: F.when(F.col(c) == gone, F.lit(keep)).otherwise(F.col(c)).alias(c)
    extra = types.where(F.col("type_id") == gone).agg(F.coalesce(F.sum("mention_count"), F.lit(0)).alias("extra"))
    merged = types.where(F.col("type_id") != gone).join(extra)
    count = (F.col("mention_count") + F.when(F.col("type_id") == keep, F.col("extra")).otherwise(0)).alias("mention_count")
    parent = F.when(F.col("parent_type_id") == gone, F.lit(keep)).otherwise(F.col("parent_type_id"))
    parent = F.when(parent == F.col("type_id"), None).otherwise(parent).alias("parent_type_id")
    return merged.select("type_id", "type_name", parent, count), entities.select(*[moved(c) if c == "type_id" else F.col(c) for c in entities.columns])


def induce_types(suggestions: DataFrame, types: DataFrame, least: float = 0.82, dim: int = 64) -> DataFrame:
    """entity_name, type_name, is_new for rows entity_name, context, suggested_type.

    A suggestion takes the nearest known type of a cosine above ``least``, else is a new type
    itself. Without a suggestion the context takes the nearest type above ``least``, else Unknown.
    """
    keyed = suggestions.withColumn("suggested_type", F.nullif(F.trim("suggested_type"), F.lit(""))).withColumn("probe", F.coalesce("suggested_type", "context", F.lit("")))
    probes = hashed_embedding(keyed.select("probe").distinct(), "probe", "probe", dim)
    named = hashed_embedding(types.select("type_id", "type_name"), "type_id", "type_name", dim)
    best = nearest_type(probes, named.select(F.col("id").alias("type_id"), "vector"), least)
    known = best.join(types.select("type_id", F.col("type_name").alias("known_type")), "type_id").select(F.col("query_id").alias("probe"), "known_type")
    exact = types.select(F.col("type_name").alias("suggested_type"), F.lit(True).alias("exists"))
    out = keyed.join(known, "probe", "left").join(exact, "suggested_type", "left")
    name = F.coalesce(F.when(F.col("exists"), F.col("suggested_type")), "known_type", "suggested_type", F.lit("Unknown"))
    return out.select("entity_name", name.alias("type_name"), (F.col("exists").isNull() & F.col("known_type").isNull() & F.col("suggested_type").isNotNull()).alias("is_new"))


def relation_taxonomy(relations: DataFrame) -> DataFrame:
    """cluster_id, canonical, members, usage_count; unclustered relations are cluster -1."""
    grouped = relations.groupBy(F.coalesce("cluster_id", F.lit(-1)).alias("cluster_id")).agg(
        F.min_by("relation_canonical", "relation_id").alias("canonical"), F.count("*").alias("members"), F.sum("usage_count").alias("usage_count")
    )
    return grouped


def relation_usage(phrases: DataFrame) -> DataFrame:
    """relation_canonical, usage_count of preprocessed phrases."""
    return phrases.select(relation_name(preprocess_relation(F.col("relation"))).alias("relation_canonical")).groupBy("relation_canonical").agg(F.count("*").alias("usage_count"))


def merge_relations(phrases: DataFrame, least: float = 0.85, dim: int = 64) -> DataFrame:
    """relation, relation_canonical, usage_count: phrases under the name of the first alike.

    phrases: relation, ord. Distinct preprocessed phrases in order of first appearance take the
    nearest earlier name of an l2sq similarity above ``least``; replayed in blocks of phrases that
    could match at all.
    """
    from graphloom.functions.components import connected_components

    used = phrases.select(preprocess_relation(F.col("relation")).alias("phrase"), "ord").groupBy("phrase").agg(F.count("*").alias("usage_count"), F.min("ord").alias("ord"))
    used = used.withColumn("k", F.xxhash64("phrase"))
    vec = hashed_embedding(used, "k", "phrase", dim)
    near = nearest(vec, vec, 50).where(l2sq_similarity(F.col("cos")) > least).select("id1", "id2")
    blocks = connected_components(near, "id1", "id2")
    rows = used.join(vec, used["k"] == vec["id"]).join(blocks, used["k"] == blocks["node"], "left").select("phrase", "ord", "usage_count", "vector", F.coalesce("component", "k").alias("block"))

    def replay(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["ord", "phrase"], kind="stable")
        names: list[tuple[str, np.ndarray]] = []
        out = []
        for phrase, n, v in zip(group["phrase"], group["usage_count"], group["vector"], strict=True):
            v = np.asarray(v, np.float64)
            s = [max(0.0, 2 * float(u @ v) - 1) for _, u in names]
            best = int(np.argmax(s)) if s else -1
            if best >= 0 and s[best] > least:
                out.append((phrase, names[best][0], n))
            else:
                names.append((phrase.upper().replace(" ", "_"), v))
                out.append((phrase, names[-1][0], n))
        return pd.DataFrame(out, columns=["relation", "relation_canonical", "usage_count"])

    return rows.groupBy("block").applyInPandas(replay, "relation string, relation_canonical string, usage_count long")


def cluster_relations(relations: DataFrame, fewest: int = 5) -> DataFrame:
    """relation_id, cluster_id, canonical over a relation table with vectors; noise has no row.

    The relation taxonomy is a dimension: one task holds its vectors.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("relation_id", kind="stable").reset_index(drop=True)
        labels = hdbscan(np.array(group["vector"].tolist(), np.float64), 2, 2) if len(group) >= fewest else np.full(len(group), -1)
        group = group.assign(cluster_id=labels)[labels >= 0]
        best = group.sort_values(["usage_count", "relation_id"], ascending=[False, True]).drop_duplicates("cluster_id").set_index("cluster_id")["relation_canonical"]
        return pd.DataFrame({"relation_id": group["relation_id"], "cluster_id": group["cluster_id"], "canonical": group["cluster_id"].map(best)})

    rows = relations.select("relation_id", "relation_canonical", "usage_count", "vector", F.lit(1).alias("every"))
    return rows.groupBy("every").applyInPandas(run, f"relation_id {dict(relations.dtypes)['relation_id']}, cluster_id int, canonical string")


def most_used(relations: DataFrame) -> DataFrame:
    """cluster_id, canonical: each cluster's relation of the highest usage, the earlier on ties."""
    order = Window.partitionBy("cluster_id").orderBy(F.desc("usage_count"), "relation_id")
    ranked = relations.withColumn("use_rank", F.row_number().over(order)).where("use_rank = 1")
    return ranked.select("cluster_id", F.col("relation_canonical").alias("canonical"))
