"""Mentions and entities: rule tagger, candidate search, score fusion, resolution as merges."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions.components import connected_components
from graphloom.functions.fuzzy import fuzzy_join, indel_ratio
from graphloom.functions.text import normalize_entity, strip
from graphloom.functions.vectors import hashed_embedding, l2sq_similarity
from graphloom.operators.similarity import nearest
from graphloom.storage import deal, materialize


MENTION = "[A-Z][a-z]+"


def mention_texts(articles: DataFrame) -> DataFrame:
    """article_id, text of rule_mentions: without places the text between hits is not cut out."""
    return articles.select(F.col("id").alias("article_id"), F.explode(F.regexp_extract_all("content", F.lit(MENTION), F.lit(0))).alias("text"))


def rule_mentions(articles: DataFrame, kind: str = "Unknown", confidence: float = 0.7) -> DataFrame:
    """schema.MENTION of runs of a capital and small ASCII letters: the offline tagger.

    Places come from the text between hits, so that each mention has its own span.
    """
    hits, gaps = F.regexp_extract_all("content", F.lit(MENTION), F.lit(0)), F.split("content", MENTION, -1)
    told = articles.select(F.col("id").alias("article_id"), F.posexplode(F.arrays_zip(hits.alias("text"), F.slice(gaps, 1, F.size(hits)).alias("gap"))).alias("pos", "hit"))
    run = F.sum(F.length("hit.gap") + F.length("hit.text")).over(Window.partitionBy("article_id").orderBy("pos"))
    told = told.select("article_id", "hit.text", run.alias("span_end"))
    return told.select(
        "text", F.lit(kind).alias("entity_type"), F.lit(confidence).alias("confidence"), "article_id",
        (F.col("span_end") - F.length("text")).cast("int").alias("span_start"), F.col("span_end").cast("int").alias("span_end"),
    )


def mention_counts(mentions: DataFrame) -> DataFrame:
    return mentions.groupBy("text").agg(F.count("*").alias("mention_count"), F.countDistinct("article_id").alias("article_count"))


def fuse_scores(fuzzy: DataFrame, semantic: DataFrame, least: float = 0.88, weight: float = 0.4, hits: int = 3) -> DataFrame:
    """mention, canonical_id, score: the entity each mention resolves to.

    fuzzy: mention, canonical_id, ratio (0..1). semantic: mention, canonical_id, similarity, rank.
    A fuzzy candidate scores by both, zero where it is no semantic hit; the best above ``least``
    wins. Without one, the best of the first semantic hits above ``least`` does.
    """
    one = fuzzy.join(semantic.select("mention", "canonical_id", "similarity"), ["mention", "canonical_id"], "left")
    one = one.select("mention", "canonical_id", (weight * F.col("ratio") + (1 - weight) * F.coalesce("similarity", F.lit(0.0))).alias("score"), F.lit(1).alias("stage"))
    two = semantic.where(F.col("rank") <= hits).select("mention", "canonical_id", F.col("similarity").alias("score"), F.lit(2).alias("stage"))
    best = Window.partitionBy("mention").orderBy("stage", F.desc("score"), "canonical_id")
    return one.union(two).where(F.col("score") > least).withColumn("choice", F.row_number().over(best)).where("choice = 1").select("mention", "canonical_id", "score")


def upsert_exact(state: DataFrame, mentions: DataFrame) -> DataFrame:
    """canonical_name, mention_count: counts added where the stripped name exists, else new rows."""
    new = mentions.select(strip(F.col("text")).alias("canonical_name")).groupBy("canonical_name").agg(F.count("*").alias("added"))
    return state.select("canonical_name", "mention_count").join(new, "canonical_name", "full_outer").select("canonical_name", (F.coalesce("mention_count", F.lit(0)) + F.coalesce("added", F.lit(0))).alias("mention_count"))


def accumulate_aliases(resolved: DataFrame) -> DataFrame:
    """canonical_name, aliases: distinct texts other than the name itself, sorted."""
    return resolved.groupBy("canonical_name").agg(F.array_sort(F.collect_set(F.when(F.col("text") != F.col("canonical_name"), F.col("text")))).alias("aliases"))


def resolve(mentions: DataFrame, state: DataFrame, dim: int = 64, least: float = 0.88, ratio: float = 85.0, weight: float = 0.4) -> DataFrame:
    """mention_key, canonical_name, is_new, score for each distinct mention text of a batch.

    mentions: text, ord. state: canonical_name, aliases. Rounds: an exact name or alias, then fused
    candidates among state, then the rest of the batch among itself in order of first appearance,
    replayed in blocks of texts near enough to match, so that each text meets all earlier ones it could match.
    Where both tables have entity_type, a text whose first mention has a known type meets vectors of
    that type only; one of type ``Unknown`` or null meets those of all types.
    """
    kind = F.coalesce("entity_type", F.lit("Unknown")) if {"entity_type"} <= set(mentions.columns) & set(state.columns) else F.lit("Unknown")
    # Equal texts of a type become one row first, so that only distinct ones are stripped, normalized and sorted.
    seen = mentions.groupBy("text", kind.alias("entity_type")).agg(F.min("ord").alias("ord"))
    seen = deal(seen, F.xxhash64("text")).select(strip(F.col("text")).alias("mention_key"), "ord", "entity_type").where("mention_key <> ''")
    seen = seen.withColumn("norm", normalize_entity(F.col("mention_key"))).groupBy("mention_key", "norm").agg(F.min("ord").alias("ord"), F.min_by("entity_type", F.struct("ord", "entity_type")).alias("entity_type"))
    seen = materialize(seen, "mention-keys")
    names = state.select("canonical_name", F.explode(F.array_union(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("alias"))
    names = materialize(names, "aliases")
    exact = seen.join(names, seen["mention_key"] == names["alias"]).groupBy("mention_key").agg(F.min("canonical_name").alias("canonical_name"))
    rest = materialize(deal(seen.join(exact, "mention_key", "left_anti"), F.xxhash64("mention_key")), "unresolved")
    pool = names.select(F.col("canonical_name").alias("canonical_id"), F.lower("alias").alias("alias_norm"))
    fuzzy = fuzzy_join(rest, pool, "norm", "alias_norm", ratio).groupBy(F.col("left_key").alias("norm"), "canonical_id").agg((F.max("ratio") / 100).alias("ratio"))
    fuzzy = rest.select("mention_key", "norm").join(fuzzy, "norm").select(F.col("mention_key").alias("mention"), "canonical_id", "ratio")
    vec = hashed_embedding(rest, "mention_key", "norm", dim, short=True).join(rest.select(F.col("mention_key").alias("id"), "entity_type"), "id")
    vstate = hashed_embedding(state.select("canonical_name"), "canonical_name", "canonical_name", dim).join(state.select(F.col("canonical_name").alias("id"), kind.alias("entity_type")), "id")
    vec, vstate = materialize(vec, "mention-vectors"), materialize(vstate, "entity-vectors")
    near = nearest(vec.where("entity_type <> 'Unknown'"), vstate, 5, "entity_type").union(nearest(vec.where("entity_type = 'Unknown'"), vstate, 5))
    semantic = materialize(near.select(F.col("id1").alias("mention"), F.col("id2").alias("canonical_id"), l2sq_similarity(F.col("cos")).alias("similarity"), "rank"), "semantic")
    fused = materialize(fuse_scores(fuzzy, semantic, least, weight), "fused")
    fresh = materialize(rest.join(fused.select(F.col("mention").alias("mention_key")), "mention_key", "left_anti"), "fresh")
    return (
        exact.select("mention_key", "canonical_name", F.lit(False).alias("is_new"), F.lit(1.0).alias("score"))
        .union(fused.select("mention", "canonical_id", F.lit(False), "score"))
        .union(_within_batch(fresh, vec, least, ratio, weight))
    )


def _alike(rows: DataFrame, least: float, block: int = 1024) -> DataFrame:
    """src, dst: links that join all of the rows v, vector whose cosines reach ``least``, by matrix products of pairs of blocks."""
    blocks = max(1, -(-rows.count() // block))
    at = rows.withColumn("block", F.pmod(F.xxhash64(F.lit(1), "v"), F.lit(blocks)).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def link(group: pd.DataFrame) -> pd.DataFrame:
        x, v = np.array(group["vector"].tolist(), np.float64), group["v"].to_numpy()
        near = x @ x.T >= least
        root = np.arange(len(x))
        while True:
            low = np.minimum(root, np.where(near, root[None, :], len(x)).min(1))
            low = low[low]
            if (low == root).all():
                return pd.DataFrame({"src": v, "dst": v[root]})
            root = low

    return at.groupBy(F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second")).applyInPandas(link, "src long, dst long").where("src <> dst")


def _within_batch(fresh: DataFrame, vectors: DataFrame, least: float, ratio: float, weight: float) -> DataFrame:
    numbered = fresh.withColumn("k", F.xxhash64("mention_key"))
    vec = numbered.join(vectors.select(F.col("id").alias("mention_key"), "vector"), "mention_key").select(F.col("k").alias("id"), "vector")
    # A score above least needs this similarity at any ratio, so no other pair matters.
    bound = min(least, (least - weight) / (1 - weight))
    same = F.when(F.exists("vector", lambda x: x != 0), F.xxhash64("vector")).otherwise(F.col("id"))
    vec = materialize(vec.withColumn("v", same), "batch-vectors")  # equal vectors are compared once
    blocks = connected_components(_alike(vec.groupBy("v").agg(F.first("vector").alias("vector")), (1 + bound) / 2 - 1e-6 if bound > 0 else -2.0))
    rows = numbered.join(vec, numbered["k"] == vec["id"]).join(blocks, F.col("v") == F.col("node"), "left").select("mention_key", "norm", "ord", "vector", "entity_type", F.coalesce("component", "v").alias("block"))

    def replay(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["ord", "mention_key"], kind="stable")
        names: list[tuple[str, str, np.ndarray, str]] = []
        out = []
        for key, norm, v, kind in zip(group["mention_key"], group["norm"], group["vector"], group["entity_type"], strict=True):
            v = np.asarray(v, np.float64)
            best, score = None, least
            for name, other, u, its in names:
                sem = max(0.0, 2 * float(u @ v) - 1) if kind in ("Unknown", its) else 0.0
                if max(sem, weight + (1 - weight) * sem) <= score:
                    continue
                fz = indel_ratio(" ".join(sorted(norm.split())), " ".join(sorted(other.split())))
                total = weight * fz / 100 + (1 - weight) * sem if fz > ratio else sem
                if total > score:
                    best, score = name, total
            if best is None:
                names.append((key, norm, v, kind))
            out.append((key, best or key, best is None, score if best else 1.0))
        return pd.DataFrame(out, columns=["mention_key", "canonical_name", "is_new", "score"])

    return deal(rows, "block").groupBy("block").applyInPandas(replay, "mention_key string, canonical_name string, is_new boolean, score double")


def merge_entities(state: DataFrame, mentions: DataFrame, resolved: DataFrame, now: str) -> DataFrame:
    """The entity table after a batch: canonical_id, name, type, aliases, count, first and last seen.

    state: schema.ENTITY without vectors. mentions: text, entity_type, ord. resolved: mention_key,
    canonical_name. Counts add up, aliases other than the name are joined, a known type of the
    last mention wins, and unseen names become new entities under a hash of their name.
    """
    seen = F.lit(now).cast("timestamp")
    told = mentions.withColumn("mention_key", strip(F.col("text"))).join(resolved.select("mention_key", "canonical_name"), "mention_key")
    known = F.when(F.col("entity_type") != "Unknown", F.col("entity_type"))
    new = told.groupBy("canonical_name").agg(
        F.count("*").alias("added"), F.max_by(known, F.when(known.isNotNull(), F.col("ord"))).alias("new_type"),
        F.collect_set(F.when(F.col("mention_key") != F.col("canonical_name"), F.col("mention_key"))).alias("new_aliases"),
    )
    out = state.join(new, "canonical_name", "full_outer")
    none = F.array().cast("array<string>")
    return out.select(
        F.coalesce("canonical_id", F.sha2("canonical_name", 256)).alias("canonical_id"), "canonical_name", F.coalesce("new_type", "entity_type", F.lit("Unknown")).alias("entity_type"),
        F.array_sort(F.array_union(F.coalesce("aliases", none), F.coalesce("new_aliases", none))).alias("aliases"),
        (F.coalesce("mention_count", F.lit(0)) + F.coalesce("added", F.lit(0))).alias("mention_count"),
        F.coalesce("first_seen", seen).alias("first_seen"), F.when(F.col("added").isNotNull(), seen).otherwise(F.col("last_seen")).alias("last_seen"),
    )
