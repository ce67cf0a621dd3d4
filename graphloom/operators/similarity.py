"""Nearest neighbours, duplicates and nearest types."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions.components import connected_components
from graphloom.functions.vectors import cosine, l2sq_similarity
from graphloom.storage import deal

BLOCK = 65_536


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def top_pairs(a: np.ndarray, b: np.ndarray, k: int, least: float = -2.0, tile: int = 1024, chunk: int = 256) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """i, j, cosine: for each unit row of a the k rows of b of the highest cosine, exactly; ties at 12 places go to the smaller j.

    Products in single precision leave those that their error can't exclude, double precision tells
    these. Memory is a tile of products, whatever is tied.
    """
    error = (a.shape[1] + 8) * 2.0**-24  # of a product of unit vectors in single precision
    a32, b32 = a.astype(np.float32), b.astype(np.float32)
    told: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(a), chunk):
        x, x32 = a[at : at + chunk], a32[at : at + chunk]
        floor = np.full(len(x), least - error)
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        hits, held, due = [], 0, 1
        for n, lo in enumerate(range(0, len(b), tile), 1):
            s = x32 @ b32[lo : lo + tile].T
            if n == 1 and s.shape[1] > k:
                floor = np.maximum(floor, np.partition(s, -k, axis=1)[:, -k] - 2 * error)
            hit = np.flatnonzero(s >= floor[:, None].astype(np.float32))
            i, j = np.divmod(hit, s.shape[1])
            if len(hit) * 8 > s.size:
                c = (x @ b[lo : lo + tile].T).ravel()[hit]
            else:
                c = np.concatenate([np.zeros(0), *(np.einsum("ij,ij->i", x[i[o : o + 65_536]], b[lo + j[o : o + 65_536]]) for o in range(0, len(i), 65_536))])
            hits.append((i, j + lo, c))
            held += len(hit)
            if n == due or held > 500_000 or lo + tile >= len(b):
                i, j, c = map(np.concatenate, zip(best, *hits, strict=True))
                order = np.lexsort((j, -np.round(c, 12), i))
                i, j, c = i[order], j[order], c[order]
                place = np.arange(len(i)) - np.searchsorted(i, i)
                last = place == k - 1
                floor[i[last]] = np.maximum(floor[i[last]], c[last] - error - 1e-11)
                best, hits, held, due = (i[place < k], j[place < k], c[place < k]), [], 0, max(due, 2 * n)
        told.append((best[0] + at, *best[1:]))
    return tuple(map(np.concatenate, zip(*told, strict=True))) if told else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def nearest(queries: DataFrame, rows: DataFrame, k: int, key: str | None = None, block: int = BLOCK, least: float = -2.0) -> DataFrame:
    """id1, id2, cos, rank: the k rows of the highest cosine for each query, exactly.

    queries and rows have id and vector, and the equality key if given (a type, a week). Rows are
    dealt to blocks by a hash of their id, queries to parts; a task multiplies a part by a block and
    keeps k rows a query, and the k best over blocks are the result. Of equal vectors in a block
    only the k smallest ids can be among anyone's k best. A query is among its own neighbours where
    rows hold it. Ties go to the smaller id. Vectors that are null or hold null or non-finite
    components are nobody's neighbours and have none.
    """
    # The key gets a name of its own on each side, since both may come from one table.
    named = lambda df, name: df.withColumn(name, F.col(key).cast("string") if key else F.lit("")).where("vector is not null")
    count = F.count("*")
    # Some 48 pairs of a part and a block keep a cluster busy with few copies of a row; large tables have larger ones up to ``block``.
    n = named(rows, "key_n").groupBy("key_n").agg(F.greatest(F.ceil(count / block), F.least(F.lit(7), F.ceil(count / 2048))).cast("int").alias("blocks"))
    m = named(queries, "key_m").groupBy("key_m").agg(count.alias("m"))
    parts = F.greatest(F.ceil(F.col("m") / block), F.least(F.ceil(F.lit(48) / F.col("blocks")), F.ceil(F.col("m") / 512))).cast("int").alias("parts")
    sizes = n.join(m, F.col("key_n") == F.col("key_m")).select("key_n", "blocks", parts)
    place = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    two = named(rows, "key2").select("key2", F.col("id").alias("id2"), F.col("vector").alias("v2"))
    one = named(queries, "key1").select("key1", F.col("id").alias("id1"), F.col("vector").alias("v1"))
    two = two.join(sizes, F.col("key2") == F.col("key_n")).withColumn("block", place("id2", "blocks")).withColumn("part", each("parts")).drop("blocks", "parts", "key_n")
    one = one.join(sizes, F.col("key1") == F.col("key_n")).withColumn("part", place("id1", "parts")).withColumn("block", each("blocks")).drop("blocks", "parts", "key_n")
    kind1, kind2 = dict(one.dtypes)["id1"], dict(two.dtypes)["id2"]

    def units(t: pa.Table, ids: str, v: str) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Places of the rows in order of their ids, their unit vectors, and these as bytes."""
        x = t.column(v).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(t.num_rows, -1)
        order = np.argsort(t.column(ids).to_pandas().to_numpy(), kind="stable")
        order = order[np.isfinite(x[order]).all(1)]
        x = unit(x[order])
        return order, x, [r.tobytes() for r in x]

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        i = j = np.zeros(0, np.int64)
        c = np.zeros(0)
        if left.num_rows and right.num_rows:
            ids1, u, same1 = units(left, "id1", "v1")
            ids2, w, same2 = units(right, "id2", "v2")
            if len(u) and len(w):
                few = (pd.Series(same2).groupby(same2).cumcount() < k).to_numpy()
                # Equal queries are told once.
                kind, first = pd.factorize(np.array(same1, object))[0], ~pd.Series(same1).duplicated().to_numpy()
                i, j, c = top_pairs(u[first], w[few], k, least)
                at = np.searchsorted(i, kind, "left")
                many = np.searchsorted(i, kind, "right") - at
                take = np.repeat(at - np.cumsum(many) + many, many) + np.arange(many.sum())
                i, j, c = np.repeat(ids1, many), ids2[few][j[take]], c[take]
        return pa.table({"id1": left.column("id1").take(pa.array(i)), "id2": right.column("id2").take(pa.array(j)), "cos": pa.array(c)})

    one, two = deal(one, "key1", "block", "part"), deal(two, "key2", "block", "part")
    found = one.groupBy("key1", "block", "part").cogroup(two.groupBy("key2", "block", "part")).applyInArrow(best, f"id1 {kind1}, id2 {kind2}, cos double")
    rank = F.row_number().over(Window.partitionBy("id1").orderBy(F.desc(F.round("cos", 12)), "id2"))
    return found.where(F.col("cos") >= least).withColumn("rank", rank).where(F.col("rank") <= k)


def duplicate_pairs(queries: DataFrame, rows: DataFrame, k: int = 10, least: float = 0.95) -> DataFrame:
    """id1, id2, similarity, rank: neighbours other than itself among the k nearest, by l2sq similarity.

    The query itself takes one of the k places where rows hold it.
    """
    near = nearest(queries, rows, k).withColumn("similarity", l2sq_similarity(F.col("cos")))
    return near.where((F.col("id1") != F.col("id2")) & (F.col("similarity") >= least)).select("id1", "id2", "similarity", "rank")


def duplicate_groups(pairs: DataFrame) -> DataFrame:
    """id, duplicate_group_id: pairs in order (id1, rank); the last pair of either end wins."""
    group = F.concat(F.lit("dup_"), F.least(F.col("id1").cast("string"), F.col("id2").cast("string")))
    ends = pairs.select(F.explode(F.array("id1", "id2")).alias("id"), group.alias("group_id"), F.struct("id1", "rank").alias("at"))
    return ends.groupBy("id").agg(F.max_by("group_id", "at").alias("duplicate_group_id"))


def duplicate_components(pairs: DataFrame) -> DataFrame:
    """node, component over numeric ids: transitive groups."""
    return connected_components(pairs, "id1", "id2")


def survivors(rows: DataFrame, pairs: DataFrame, mode: str = "first") -> DataFrame:
    """Rows without duplicates. first: those with no smaller duplicate; reference: those in no pair as id1."""
    drop = pairs if mode == "reference" else pairs.where("id2 < id1")
    return rows.join(drop.select(F.col("id1").alias("id")).distinct(), "id", "left_anti")


def nearest_type(queries: DataFrame, types: DataFrame, least: float = 0.0) -> DataFrame:
    """Each query's type of the highest true cosine above ``least``; lengths that differ are skipped.

    The taxonomy is a small dimension; where its table is larger, the planner shuffles it.
    """
    pairs = queries.select(F.col("id").alias("query_id"), F.col("vector").alias("qv")).join(types.select("type_id", F.col("vector").alias("tv")), F.size("qv") == F.size("tv"))
    scored = pairs.withColumn("cos", cosine(F.col("qv"), F.col("tv"))).where(F.col("cos") > least)
    best = scored.groupBy("query_id").agg(F.max_by(F.struct("type_id", "cos"), F.struct(F.round("cos", 9), -F.col("type_id"))).alias("best"))
    return best.select("query_id", "best.type_id", "best.cos")

