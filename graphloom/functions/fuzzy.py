"""Token-sort ratio: normalized insert-delete similarity of sorted tokens."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.storage import deal, materialize


def token_sort(c: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(F.trim(c), r"\s+"), lambda t: t != "")), " ")


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence by bit rows: one big number holds a row of the table."""
    where: dict[str, int] = {}
    for k, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & where.get(ch, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    n = len(a) + len(b)
    return 100.0 if n == 0 else 200.0 * lcs_length(a, b) / n


def indel_ratio_column(a: str, b: str) -> Column:
    def ratios(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([indel_ratio(p, q) for p, q in zip(x, y, strict=True)], dtype="float64")

    return F.pandas_udf(ratios, "double")(a, b)


def _counts(texts: list[str], chars: dict[str, int], most: int) -> np.ndarray:
    """A row for each text: whether it has each character once, twice and so on, so that products count common characters."""
    out = np.zeros((len(texts), len(chars), most), np.float32)
    for k, t in enumerate(texts):
        seen: dict[int, int] = {}
        for ch in t:
            at = chars[ch]
            out[k, at, seen.get(at, 0)] = 1
            seen[at] = seen.get(at, 0) + 1
    return out.reshape(len(texts), -1)


def matches(left: list[str], right: list[str], least: float) -> list[tuple[str, str, float]]:
    """All pairs of a ratio above ``least``; the ratio is taken where enough characters are common."""
    chars = {c: k for k, c in enumerate(sorted(set("".join(left)) | set("".join(right))))}
    most = max((t.count(c) for t in (*left, *right) for c in set(t)), default=1)
    a, b = _counts(left, chars, most), _counts(right, chars, most)
    n = np.array([len(t) for t in left])[:, None] + np.array([len(t) for t in right])
    found = np.argwhere(200.0 * (a @ b.T) > least * n - 1e-6)
    told = ((left[i], right[j], indel_ratio(left[i], right[j])) for i, j in found)
    return [x for x in told if x[2] > least]


def least_common(n: int, m: int, least: float) -> int:
    """Fewest common characters, in order, that put the ratio of texts of these lengths above ``least``."""
    k = max(0, int(least * (n + m) / 200) - 1)
    while not 200.0 * k / (n + m) > least:
        k += 1
    return k


def drops(n: int, least: float, longer: bool) -> list[int]:
    """How many characters a text of n must lose to show what it shares with shorter or equal texts (``longer``), or with longer or equal ones."""
    found, m = set(), n
    while m and (k := least_common(n, m, least)) <= min(n, m):
        found.add(n - k)
        m += -1 if longer else 1
    return sorted(found)


def reach(least: float, keys: int = 8192, most: int = 32) -> int:
    """Texts up to this length have at most ``keys`` subsequences to tell, 0 if none."""
    n = 0
    while n < most and least > 0 and sum(comb(n + 1, k) for k in drops(n + 1, least, True)) <= keys:
        n += 1
    return n


def subsequences(texts: list[str], most: int) -> list[np.ndarray]:
    """Hashes of what is left of each text (all of one length) after losing 0, 1 to ``most`` characters: an array of a row a text for each number."""
    n, odd = len(texts[0]), np.uint64(0x9E3779B97F4A7C15)
    c = (np.array(texts, f"U{n}").view(np.uint32).reshape(-1, n).astype(np.uint64) + np.uint64(1)) * odd
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        c = (c ^ c >> np.uint64(shift)) * np.uint64(factor)
    left = [np.zeros((len(texts), 1), np.uint64)] + [np.zeros((len(texts), 0), np.uint64)] * most
    for p in range(n):
        left = [np.concatenate([kept * odd + c[:, p : p + 1], *([left[k - 1]] if k else [])], axis=1) for k, kept in enumerate(left)]
    return left


def _keys(texts: DataFrame, least: float, longer: bool, cells: int = 2_000_000) -> DataFrame:
    """text, side, common, key: the subsequences by which a text meets others as the longer or the shorter one."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column("text").to_pylist(), object)
            sides = batch.column("side").to_numpy(zero_copy_only=False)
            sizes = np.array([len(t) for t in names], np.int64)
            for n in np.unique(sizes).tolist():
                levels, here = drops(n, least, longer), np.flatnonzero(sizes == n)
                step = max(1, cells // sum(comb(n, k) for k in range(levels[-1] + 1)))
                for rows in (here[o : o + step] for o in range(0, len(here), step)):
                    left = subsequences(names[rows].tolist(), levels[-1])
                    for k in levels:
                        h = np.sort(left[k], axis=1)
                        new = np.ones(h.shape, bool)
                        new[:, 1:] = h[:, 1:] != h[:, :-1]
                        ends = np.concatenate([[0], new.sum(1).cumsum()]).astype(np.int32)
                        told = pa.ListArray.from_arrays(pa.array(ends), pa.array(h[new].view(np.int64)))
                        yield pa.RecordBatch.from_arrays([pa.array(names[rows], pa.string()), pa.array(sides[rows], pa.int32()), pa.array(np.full(len(rows), n - k, np.int32)), told], ["text", "side", "common", "keys"])

    made = texts.mapInArrow(tell, "text string, side int, common int, keys array<long>")
    return made.select("text", "side", "common", F.explode("keys").alias("key"))


def candidates(texts: DataFrame, least: float) -> DataFrame:
    """x, sx, y, sy: pairs of different texts, of a side 1 and a side 2 (3 is both), that share a subsequence long enough for a ratio above ``least``.

    Texts of n and m <= n characters pass if they have some number k of characters in common, in
    order, so they pass if and only if they have a subsequence of k characters in common. Each tells
    those as the longer and as the shorter text, and an equality join finds the pairs: work is by
    the texts and by the pairs that pass, up to equal hashes of 64 bits.
    """
    x = _keys(texts, least, True).select(F.col("text").alias("x"), F.col("side").alias("sx"), "common", "key")
    y = _keys(texts, least, False).select(F.col("text").alias("y"), F.col("side").alias("sy"), F.col("common").alias("shared"), F.col("key").alias("its"))
    n, k = F.length("x") + F.length("y"), F.col("common")
    above = lambda c: F.lit(200.0) * c / n > least
    longer = (F.length("x") > F.length("y")) | ((F.length("x") == F.length("y")) & (F.col("x") < F.col("y")))
    meets = (F.col("key") == F.col("its")) & (k == F.col("shared")) & longer & above(k) & ~above(k - 1)
    sides = (F.col("sx").bitwiseOR(F.col("sy"))) == 3
    return deal(x.join(y, meets & sides).select("x", "sx", "y", "sy"), "x", "y").distinct()


def _in_blocks(a: DataFrame, b: DataFrame, least: float, block: int) -> DataFrame:
    """left_sorted, right_sorted, ratio: blocks of texts of near lengths meet in pairs, matrix products count their common characters."""
    step = log(200.0 / least - 1)  # longest over shortest length that can still pass
    band = lambda c: F.floor(F.log(F.greatest(F.length(c), F.lit(1)).cast("double")) / step).cast("int")
    a = a.withColumn("band", F.explode(F.array(*[band(F.col("left_sorted")) + d for d in (-1, 0, 1)])))
    b = b.withColumn("band", band(F.col("right_sorted")))
    blocks = lambda df, name: df.groupBy("band").agg(F.ceil(F.count("*") / block).cast("int").alias(name))
    sizes = blocks(a, "n1").join(blocks(b, "n2"), "band")
    a = a.join(sizes, "band").select("band", "left_sorted", F.pmod(F.xxhash64("left_sorted"), F.col("n1")).cast("int").alias("b1"), F.explode(F.sequence(F.lit(0), F.col("n2") - 1)).alias("b2"))
    b = b.join(sizes, "band").select("band", "right_sorted", F.explode(F.sequence(F.lit(0), F.col("n1") - 1)).alias("b1"), F.pmod(F.xxhash64("right_sorted"), F.col("n2")).cast("int").alias("b2"))

    def meet(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        found = matches(x["left_sorted"].tolist(), y["right_sorted"].tolist(), least) if len(x) and len(y) else []
        return pd.DataFrame(found, columns=["left_sorted", "right_sorted", "ratio"]).astype({"ratio": "float64"})

    a, b = deal(a, "band", "b1", "b2"), deal(b, "band", "b1", "b2")
    return a.groupBy("band", "b1", "b2").cogroup(b.groupBy("band", "b1", "b2")).applyInPandas(meet, "left_sorted string, right_sorted string, ratio double")


def _by_subsequences(a: DataFrame, b: DataFrame, least: float, rows: int) -> DataFrame:
    """left_sorted, right_sorted, ratio of texts that are short enough to tell their subsequences."""
    texts = a.select(F.col("left_sorted").alias("text"), F.lit(1).alias("side")).union(b.select("right_sorted", F.lit(2)))
    texts = materialize(texts.groupBy("text").agg(F.sum("side").cast("int").alias("side")), "fuzzy-texts")
    # A small table would be read by few tasks, and each row makes hundreds.
    found = candidates(texts.repartition(min(1024, max(8, rows // 4096)), "text"), least)
    # Only written ratios are compared: the comparison would go below distinct() and tell them twice.
    found = materialize(found.withColumn("ratio", indel_ratio_column("x", "y")), "fuzzy-pairs").where(F.col("ratio") > least)
    one = found.where("sx & 1 = 1 and sy & 2 = 2").select(F.col("x").alias("left_sorted"), F.col("y").alias("right_sorted"), "ratio")
    two = found.where("sy & 1 = 1 and sx & 2 = 2").select("y", "x", "ratio")
    return one.union(two).union(texts.where("side = 3").select("text", "text", F.lit(100.0)))


def fuzzy_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, least: float = 85.0, top: int = 5, block: int = 512) -> DataFrame:
    """Each distinct left key with its ``top`` best right rows of a ratio above ``least``.

    Keys compare as sorted tokens. Short ones meet by the subsequences that they must share, so that
    only pairs that pass are compared. Pairs of which one text is too long for that meet in blocks:
    strings whose lengths differ too much are out, and so are those whose character counts overlap
    too little. Where either table fits in one block, all do: then blocks grow with the other only.
    """
    one = left.select(F.col(left_key).alias("left_key")).distinct().withColumn("left_sorted", token_sort(F.col("left_key")))
    two = right.select(F.struct(*right.columns).alias("own"), token_sort(F.col(right_key)).alias("right_sorted"))
    a = one.select("left_sorted").where("left_sorted <> ''").distinct()
    b = two.select("right_sorted").where("right_sorted <> ''").distinct()
    short, rows = reach(least), (a.count(), b.count())
    if min(rows) <= block or not short:
        met = _in_blocks(a, b, least, block)
    else:
        is_short = lambda c: F.length(c) <= short
        met = _by_subsequences(a.where(is_short("left_sorted")), b.where(is_short("right_sorted")), least, sum(rows))
        long_b = b.where(~is_short("right_sorted"))
        met = met.union(_in_blocks(a.where(~is_short("left_sorted")), b, least, block)).union(_in_blocks(a.where(is_short("left_sorted")), long_b, least, block))
    scored = one.join(met, "left_sorted").join(two, "right_sorted").select("left_key", "own.*", "ratio")
    order = Window.partitionBy("left_key").orderBy(F.desc("ratio"), *[F.asc(c) for c in right.columns if dict(right.dtypes)[c] != "array"])
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
