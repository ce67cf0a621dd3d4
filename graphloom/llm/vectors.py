"""Near-duplicate vectors by a random-projection tree forest.

Equal vectors become one class. Trees of random splits with spill overlap send every class to one
or more leaves of each tree. The upper splits are fitted on a bounded sample of all classes; a leaf
that holds too many classes is split again by a bounded sample of its own, until leaves are small or
too dense to split. Within a leaf all cosines are computed by matrix products, and only what follows
from them leaves the task: how many vectors each class links with, and a star of links for each
local component. A pair that meets in several leaves counts in the first of them.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.components import connected_components
from graphloom.storage import materialize


@dataclass
class Node:
    direction: np.ndarray
    at: float
    low: Node | int
    high: Node | int


def spill(threshold: float, dim: int, depth: int, recall: float) -> tuple[float, int]:
    """Margin and number of trees that reach ``recall`` for pairs at the threshold with the fewest copies of a vector.

    Along a random direction a pair at the threshold differs by a normal number; a split parts it if
    that exceeds twice the margin and the median lies between.
    """
    apart, found = math.sqrt(2 - 2 * threshold), []
    for trees in range(4, 65):
        for c in (k / 20 for k in range(41)):
            beyond = 2 * (math.exp(-c * c / 2) / math.sqrt(2 * math.pi) - c * math.erfc(c / math.sqrt(2)) / 2)
            missed = 1 - (1 - min(1.0, apart * beyond / math.sqrt(2 * math.pi))) ** depth
            if missed**trees <= 1 - recall:
                copies = trees * (1 + math.erf(c * apart / 2 / math.sqrt(2))) ** depth
                found.append((copies, trees, c * apart / 2 / math.sqrt(dim)))
    _, trees, margin = min(found)
    return margin, trees


def fit_tree(sample: np.ndarray, rng: np.random.Generator, depth: int, margin: float, first_leaf: int, fewest: int = 16) -> tuple[Node | int, int]:
    """A tree of splits at medians along random directions; leaves are numbered from first_leaf."""
    if depth and len(sample) >= 2 * fewest:
        for _ in range(3):
            direction = rng.standard_normal(sample.shape[1])
            direction /= np.linalg.norm(direction)
            p = sample @ direction
            at = float(np.median(p))
            low, high = p < at + margin, p > at - margin
            if max(low.mean(), high.mean()) < 0.85:  # else a dense group lies across the split
                left, n = fit_tree(sample[low], rng, depth - 1, margin, first_leaf, fewest)
                right, n = fit_tree(sample[high], rng, depth - 1, margin, n, fewest)
                return Node(direction, at, left, right), n
    return first_leaf, first_leaf + 1


def leaves_of(tree: Node | int, x: np.ndarray, margin: float) -> list[tuple[int, np.ndarray]]:
    """(leaf, rows of x in it) for all leaves that get rows."""
    out, todo = [], [(tree, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if not len(rows):
            continue
        if isinstance(node, int):
            out.append((node, rows))
            continue
        p = x[rows] @ node.direction
        todo += [(node.low, rows[p < node.at + margin]), (node.high, rows[p > node.at - margin])]
    return out


def usable(vector: Column) -> Column:
    """True for a vector with components, all finite, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(vectors: list) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def local_roots(linked: np.ndarray, strip: int = 512) -> np.ndarray:
    """For a symmetric matrix of links, the smallest row of each row's component."""
    n = len(linked)
    root = np.arange(n)
    while True:
        low = np.concatenate([np.minimum(root[k : k + strip], np.where(linked[k : k + strip], root, n).min(1)) for k in range(0, n, strip)])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def first_met(a: list[np.ndarray], b: list[np.ndarray], leaf: int) -> np.ndarray:
    """False where two rows also share a leaf of a smaller number."""
    where: dict[int, int] = {}
    for leaves in (*a, *b):
        for k in leaves[leaves < leaf].tolist():
            where.setdefault(k, len(where))

    def table(rows):
        out = np.zeros((len(rows), max(1, len(where))), np.float32)
        for k, leaves in enumerate(rows):
            out[k, [where[x] for x in leaves[leaves < leaf].tolist()]] = 1
        return out

    return table(a) @ table(b).T == 0


def link_block(rows: pd.DataFrame, threshold: float, strip: int = 512) -> list[tuple[int, int | None, int]]:
    """Links within a block of a leaf, or between two: (class, None, vectors linked) and (class, root, 0)."""
    leaf = int(rows["leaf"].iloc[0])
    rows = rows.sort_values("rep", kind="stable")
    x, side = unit_rows(rows["v"].tolist()), rows["block"].to_numpy()
    one = rows["first"].iloc[0] == rows["second"].iloc[0]
    a = np.arange(len(x)) if one else np.flatnonzero(side == rows["first"].iloc[0])
    b = a if one else np.flatnonzero(side == rows["second"].iloc[0])
    if not len(a) or not len(b):
        return []
    other = x[b].T
    near = np.concatenate([x[a[k : k + strip]] @ other >= threshold for k in range(0, len(a), strip)])
    if one:
        np.fill_diagonal(near, False)
    i, j = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
    if not len(i):
        return []
    near, a, b = near[np.ix_(i, j)], a[i], b[j]
    met = [np.asarray(m) for m in rows["leaves"]]
    for k in range(0, len(a), strip):
        near[k : k + strip] &= first_met([met[r] for r in a[k : k + strip]], [met[r] for r in b], leaf)
    rep, n = rows["rep"].to_numpy(), rows["n"].to_numpy()
    out = [(int(rep[k]), None, int(c)) for k, c in zip(a, near @ n[b], strict=True) if c]
    if not one:
        out += [(int(rep[k]), None, int(c)) for k, c in zip(b, near.T @ n[a], strict=True) if c]
    both = np.union1d(a, b)
    full = np.zeros((len(both), len(both)), bool)
    full[np.ix_(np.searchsorted(both, a), np.searchsorted(both, b))] = near
    root = local_roots(full | full.T)
    return out + [(int(rep[both[k]]), int(rep[both[r]]), 0) for k, r in enumerate(root) if k != r]


def refine(routed: DataFrame, threshold: float, recall: float, depth: int, leaf_rows: int, sample_rows: int, seed: int, task_rows: int = 50_000) -> DataFrame:
    """Split leaves of over twice ``leaf_rows`` classes by trees fitted on ``sample_rows`` or so of their own, until none can be split."""
    classes, dense = routed.select("rep", "n", "v"), None
    for turn in range(1, 40):
        at = routed.select("rep", F.explode("leaves").alias("leaf"))
        large = at.groupBy("leaf").agg(F.count("*").alias("rows")).where(F.col("rows") > 2 * leaf_rows)
        large = materialize(large if dense is None else large.join(dense, "leaf", "left_anti"), "large-leaves")
        if not large.limit(1).count():
            return routed
        salt = F.pmod(F.xxhash64("rep"), F.ceil(F.col("rows") / task_rows))
        rows = routed.select("rep", "v", F.explode("leaves").alias("leaf")).join(large, "leaf").withColumn("salt", salt)

        def fitted(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("rep")
            leaf, x = int(group["leaf"].iloc[0]), unit_rows(group["v"].tolist())
            margin, _ = spill(threshold, x.shape[1], depth, recall)
            down = max(1, math.ceil(math.log2(group["rows"].iloc[0] / leaf_rows)))
            tree, n = fit_tree(x, np.random.default_rng([seed, turn, leaf & (1 << 63) - 1]), down, margin, 0)
            return pd.DataFrame({"leaf": [leaf], "leaves": [n], "rows": [group["rows"].iloc[0]], "tree": [pickle.dumps((tree, margin))]})

        drawn = rows.where(F.pmod(F.xxhash64(F.lit(turn), "rep", "leaf"), F.lit(1 << 20)) < F.lit(sample_rows * (1 << 20)) / F.col("rows"))
        trees = materialize(drawn.groupBy("leaf").applyInPandas(fitted, "leaf long, leaves long, rows long, tree binary"), "leaf-trees")
        split = trees.where("leaves > 1").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("rows") / task_rows) - 1)))

        def route(part: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
            if not len(part) or not len(tree):
                return pd.DataFrame({"rep": [], "leaf": [], "sub": []})
            root, margin = pickle.loads(tree["tree"].iloc[0])
            got = leaves_of(root, unit_rows(part["v"].tolist()), margin)
            rep = part["rep"].to_numpy()
            return pd.DataFrame({"rep": np.concatenate([rep[r] for _, r in got]), "leaf": part["leaf"].iloc[0], "sub": np.concatenate([np.full(len(r), k) for k, r in got])})

        gone = split.select("leaf").distinct()
        moved = rows.join(gone, "leaf", "left_semi").select("leaf", "salt", "rep", "v").groupBy("leaf", "salt").cogroup(split.groupBy("leaf", "salt")).applyInPandas(route, "rep long, leaf long, sub long")
        every = at.join(gone, "leaf", "left_anti").select("rep", "leaf").union(moved.select("rep", F.xxhash64("leaf", "sub").alias("leaf")))
        lists = every.groupBy("rep").agg(F.array_sort(F.collect_set("leaf")).alias("leaves"))
        routed = materialize(classes.join(lists, "rep"), "vector-leaves")
        kept = large.join(gone, "leaf", "left_anti").select("leaf")  # too dense, or no sample row: another sample won't help
        dense = materialize(kept if dense is None else dense.union(kept), "dense-leaves")
    return routed


def near_vectors(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9, recall: float = 0.99, leaf_rows: int = 2048,
    block_rows: int = 4096, sample_rows: int = 16_384, leaf_sample: int = 2048, seed: int = 17,
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    threshold: least cosine, in double precision. recall: share of the pairs at the threshold that
    the forest is laid out to find, by margin and number of trees; closer pairs are found more
    surely. leaf_rows: classes of a leaf, about. block_rows: a leaf that is too dense to split is
    compared in pairs of blocks. sample_rows, leaf_sample: how many classes the upper splits, and
    those of a leaf, are fitted on; every row is indexed and compared. Null, zero and non-finite vectors link with nothing.
    Vectors link only with others of their length. Repeated rows count as rows; those that share an
    id are one node of the components. A row without an id gets the component of its class.
    """
    spark = rows.sparkSession
    v = F.col(vector_col).cast("array<double>")
    keyed = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.when(usable(v), v).alias("v"))
    keyed = keyed.withColumn("k1", F.when(F.col("v").isNotNull(), F.xxhash64("v"))).withColumn("k2", F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(1), "v")))
    classes = keyed.where("v is not null").groupBy("k1", "k2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("v").alias("v")).where("rep is not null")
    classes = materialize(classes, "vector-classes")

    n = classes.count()
    drawn = classes.select("rep", "v").orderBy(F.xxhash64("rep"), "rep").limit(sample_rows).collect()
    dims: dict[int, list] = {}
    for r in drawn:
        dims.setdefault(len(r.v), []).append(r.v)
    forest: dict[int, list] = {}
    rng, number = np.random.default_rng(seed), 1
    depth = max(0, math.ceil(math.log2(max(1, n / leaf_rows))))
    for dim in sorted(dims):
        x = unit_rows(dims[dim])
        own = max(0, math.ceil(math.log2(max(1, n * len(x) / len(drawn) / leaf_rows))))
        margin, trees = spill(threshold, dim, depth, recall)
        forest[dim] = []
        for _ in range(trees if own else 1):
            tree, number = fit_tree(x, rng, own, margin, number)
            forest[dim].append((tree, margin))
    sent = spark.sparkContext.broadcast(forest)  # as many splits as sample_rows and trees allow

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            met: list[list[int]] = [[] for _ in range(len(b))]
            lengths = b["v"].map(len).to_numpy()
            for dim in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == dim)
                if dim not in sent.value:  # a length that the sample lacks: one leaf
                    for k in own:
                        met[k].append(-dim)
                    continue
                x = unit_rows(b["v"].iloc[own].tolist())
                for tree, margin in sent.value[dim]:
                    for leaf, part in leaves_of(tree, x, margin):
                        for k in own[part]:
                            met[k].append(leaf)
            yield b.assign(leaves=[sorted(m) for m in met])

    routed = materialize(classes.select("rep", "n", "v").mapInPandas(route, "rep long, n long, v array<double>, leaves array<long>"), "vector-leaves")
    routed = refine(routed, threshold, recall, depth, leaf_rows, leaf_sample, seed)
    sizes = routed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    at = routed.withColumn("leaf", F.explode("leaves")).join(sizes, "leaf")
    at = at.withColumn("block", F.pmod(F.xxhash64("rep", "leaf"), F.col("blocks")).cast("int"))
    at = at.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    at = at.withColumn("first", F.least("block", "other")).withColumn("second", F.greatest("block", "other")).drop("blocks", "other")

    def link(group: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame(link_block(group, threshold), columns=["rep", "root", "links"])
        return out.astype({"root": "Int64"})

    found = materialize(at.groupBy("leaf", "first", "second").applyInPandas(link, "rep long, root long, links long"), "vector-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = connected_components(found.where("root is not null").select(F.col("rep").alias("src"), F.col("root").alias("dst")))
    linked = links.join(parts, F.col("rep") == F.col("node"), "left").select("rep", "links", F.coalesce("component", "rep").alias("component"))
    told = classes.select("k1", "k2", "rep", "n").join(linked, "rep", "left").where("n > 1 or links is not null")
    told = materialize(told.select("k1", "k2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "rep").alias("component")), "vector-parts")
    out = keyed.select("vec_id", "k1", "k2").join(told, ["k1", "k2"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))
