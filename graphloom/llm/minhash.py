"""Near-duplicate texts by an LSH forest over MinHash signatures.

Each tree of the forest is a sorted order of the documents' signatures, each turned so that the
tree's own values come first. Documents meet their neighbours in the orders, those of the longest
common prefix, at whatever depth their region of an order has company; and the centre of the region.
The likeliest candidate of each document, and then of each group found, is confirmed on full shingle
sets. Regions that still hold several groups are settled by their documents' rarest shingles, of
which two documents that link must share one; so no link within a region is lost, however crowded
it is, and no region's pairs are written out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions.components import connected_components
from graphloom.llm.idfilter import may_hold
from graphloom.storage import materialize

M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_words: dict[bytes, int] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * M2
    return x ^ (x >> np.uint64(29))


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of a text: A-Z lower-cased, cut at ASCII white space."""
    words = (text or "").encode().lower().split()
    if len(_words) > 200_000:
        _words.clear()
    try:
        return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    except KeyError:
        for w in words:
            if w not in _words:
                _words[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles.

    A text of fewer words is one shingle; a text without words has none.
    """
    w = word_hashes(text)
    if len(w) == 0:
        return w
    k = min(size, len(w))
    out = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        out = _mix(out * M1 + w[i : len(w) - k + 1 + i] * M3)
    return np.unique(out)


def hash_family(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, n, np.uint64), rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(sets: list[np.ndarray], family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A row of 16-bit MinHash values for each set; sets must not be empty."""
    if not sets:
        return np.zeros((0, len(family[0])), "<u2")
    whole = np.concatenate(sets)
    begin = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), len(family[0])), "<u2")
    for k, (add, odd) in enumerate(zip(*family, strict=True)):
        low = np.minimum.reduceat((whole ^ add) * odd >> np.uint64(8), begin)
        out[:, k] = _mix(low) & np.uint64(0xFFFF)
    return out


def sketch(docs: DataFrame, shingle: int, trees: int, depth: int, seed: int) -> DataFrame:
    """doc_id, n_shingles, k1, k2 (128 bits of the whole set; null without one), sig."""
    family = hash_family(trees * depth, seed)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part in _parts(b, "text"):
                sets = [shingle_set(t, shingle) for t in part["text"]]
                keys = [xxhash.xxh3_128_intdigest(s.tobytes()) if len(s) else None for s in sets]
                sig = iter(signatures([s for s in sets if len(s)], family))
                half = lambda k, by: None if k is None else ((k >> by) & (1 << 64) - 1) - (1 << 63)
                yield pd.DataFrame({
                    "doc_id": part["doc_id"], "n_shingles": [len(s) for s in sets], "k1": pd.array([half(k, 0) for k in keys], "Int64"), "k2": pd.array([half(k, 64) for k in keys], "Int64"),
                    "sig": [next(sig).tobytes() if len(s) else None for s in sets],
                })

    out = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.col("text").cast("string")).mapInPandas(run, "doc_id string, n_shingles long, k1 long, k2 long, sig binary")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def _parts(b: pd.DataFrame, col: str, most: int = 4 << 20) -> Iterator[pd.DataFrame]:
    """Slices of a batch of a bounded number of characters, a longer text alone."""
    size = b[col].map(lambda t: len(t or "")).cumsum().to_numpy()
    at = 0
    while at < len(b):
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, "right")))
        yield b.iloc[at:to]
        at = to


def regions(classes: DataFrame, trees: int, depth: int, shallow: int) -> DataFrame:
    """region, rep, n_region, n_shingles, key: the documents with a common prefix of ``shallow`` values in a tree, two at least, however many they are.

    key: the signature, turned so that the tree's own values come first; regions are stretches of its order.
    """
    width = 2 * depth
    prefix = F.xxhash64("tree", F.expr(f"substring(sig, 1 + tree * {width}, {2 * shallow})"))
    # Signatures wait until it is known who has neighbours.
    members = classes.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).select("rep", "tree", prefix.alias("region"))
    sizes = materialize(members.groupBy("region").agg(F.count("*").alias("n_region")).where("n_region > 1"), "region-sizes")
    key = F.concat(F.expr(f"substring(sig, 1 + tree * {width})"), F.expr(f"substring(sig, 1, tree * {width})"))
    return members.join(sizes, "region").join(classes.select("rep", "n_shingles", "sig"), "rep").select("region", "rep", "n_region", "n_shingles", key.alias("key"))


def _values(keys) -> np.ndarray:
    return np.frombuffer(b"".join(keys), "<u2").reshape(len(keys), -1)


def _fits(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes of two sets allow a link."""
    return 100 * np.minimum(n, m) >= percent * np.maximum(n, m)


def ordered_neighbours(members: DataFrame, least: float, percent: int) -> DataFrame:
    """Candidates a, b, est, centre of each tree's sorted order, a few for each document.

    A document meets those next to it in the order, with which it has the longest common prefix
    however deep its region is, and the centre of its stretch of the region: the one closest to the
    stretch's middle values, which in a group of edits is the original or near it (centre = 1). Rows
    with a = b are centres of stretches that are not whole regions, with their score as est.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for b in batches:
            b = b if rest is None else pd.concat([rest, b], ignore_index=True)
            rest = b.iloc[-1:]  # neighbours across batches
            region, rep, n, whole = (b[c].to_numpy() for c in ("region", "rep", "n_shingles", "n_region"))
            sig = _values(b["key"])
            same = np.flatnonzero(region[1:] == region[:-1])
            found = [(same, same + 1, (sig[same] == sig[same + 1]).mean(1))]
            begin = np.flatnonzero(np.concatenate([[True], region[1:] != region[:-1]]))
            heads, score = [], []
            for a, z in zip(begin.tolist(), [*begin[1:].tolist(), len(b)], strict=True):
                if z - a > 2:
                    own = sig[a:z]
                    near = (own == np.sort(own, axis=0)[(z - a) // 2]).sum(1)
                    c = int(near.argmax())
                    found.append((np.arange(a, z), np.full(z - a, a + c), (own == own[c]).mean(1)))
                    if z - a < whole[a]:
                        heads.append(a + c)
                        score.append(float(near[c]))
            centre = np.repeat([0] + [1] * (len(found) - 1), [len(x[0]) for x in found])
            i, j, est = (np.concatenate(x) for x in zip(*found, strict=True))
            good = (rep[i] != rep[j]) & (est >= least) & _fits(n[i], n[j], percent)
            i, j, est, centre = i[good], j[good], est[good], centre[good]
            pairs = pd.DataFrame({"region": region[i], "a": np.minimum(rep[i], rep[j]), "b": np.maximum(rep[i], rep[j]), "est": est, "centre": centre})
            yield pd.concat([pairs, pd.DataFrame({"region": region[heads], "a": rep[heads], "b": rep[heads], "est": score, "centre": 1})]) if heads else pairs

    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = members.repartitionByRange(n, "region", "key", "rep").sortWithinPartitions("region", "key", "rep")
    return order.mapInPandas(run, "region long, a long, b long, est double, centre int")


def centre_pairs(members: DataFrame, heads: DataFrame, least: float, percent: int) -> DataFrame:
    """a, b, est of every member of the regions of ``heads`` (region, head) with the head."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            est = (_values(b["key"]) == _values(b["head_key"])).mean(1) if len(b) else np.zeros(0)
            good = (est >= least) & _fits(b["n_shingles"].to_numpy(), b["n_head"].to_numpy(), percent)
            two = b.loc[good, ["rep", "head"]].to_numpy().reshape(-1, 2)
            yield pd.DataFrame({"a": two.min(1), "b": two.max(1), "est": est[good]})

    top = members.join(heads, "region").where("rep = head").select("region", "head", F.col("key").alias("head_key"), F.col("n_shingles").alias("n_head")).dropDuplicates(["region"])
    both = members.join(materialize(top, "centres"), "region").where("rep <> head").select("rep", "head", "n_shingles", "n_head", "key", "head_key")
    return both.mapInPandas(run, "a long, b long, est double")


def candidates(members: DataFrame, least: float, percent: int) -> DataFrame:
    """own, other, est, centre, both ways: candidates of all orders, whose number grows with that of documents."""
    near = materialize(ordered_neighbours(members, least, percent), "neighbours")
    pairs = near.where("a <> b").select("a", "b", "est", "centre")
    # Regions of several stretches get one centre more, the best of theirs.
    heads = near.where("a = b").groupBy("region").agg(F.max(F.struct("est", (-F.col("a")).alias("low"))).alias("top"), F.count("*").alias("n")).where("n > 1")
    heads = materialize(heads.select("region", (-F.col("top.low")).alias("head")), "heads")
    if heads.limit(1).count():
        pairs = pairs.union(centre_pairs(members, heads, least, percent).withColumn("centre", F.lit(1)))
    pairs = materialize(pairs.groupBy("a", "b").agg(F.max("est").alias("est"), F.max("centre").alias("centre")), "candidates")
    return pairs.selectExpr("a as own", "b as other", "est", "centre").union(pairs.selectExpr("b", "a", "est", "centre"))


def unsettled(members: DataFrame, parts: DataFrame, picks: list[DataFrame], least: float, percent: int, block_rows: int) -> DataFrame:
    """rep of documents that some region shows with one of another part, untried, that signatures and sizes allow.

    In regions of over ``block_rows`` members all are taken to be so unless they are one part.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for b in _with_end(batches):
            last = b is None
            b = rest if last else b if rest is None else pd.concat([rest, b], ignore_index=True)
            if b is None or not len(b):
                continue
            region = b["region"].to_numpy()
            begin = np.flatnonzero(np.concatenate([[True], region[1:] != region[:-1]]))
            if not last:
                rest, begin = b.iloc[begin[-1] :], begin[:-1]
            ends = [*begin[1:], len(b) if last else len(b) - len(rest)]
            rep, n, part = (b[c].to_numpy() for c in ("rep", "n_shingles", "part"))
            sig, tried = _values(b["key"]), [b[c].to_numpy() for c in names]
            for a, z in zip(begin, ends, strict=False):
                s, own = sig[a:z], rep[a:z]
                open_ = (part[a:z, None] != part[a:z]) & _fits(n[a:z, None], n[a:z], percent)
                i, j = np.nonzero(np.triu(open_))
                far = (s[i] == s[j]).mean(1) < least if len(i) <= 1 << 16 else np.concatenate([(s[i[k : k + (1 << 16)]] == s[j[k : k + (1 << 16)]]).mean(1) < least for k in range(0, len(i), 1 << 16)])
                open_[i[far], j[far]] = open_[j[far], i[far]] = False
                for picked in tried:
                    k = np.minimum(np.searchsorted(own, picked[a:z]), z - a - 1)
                    hit = np.flatnonzero(own[k] == picked[a:z])
                    open_[hit, k[hit]] = open_[k[hit], hit] = False
                yield pd.DataFrame({"rep": own[open_.any(1)]})

    names = [f"pick{k}" for k in range(len(picks))]
    named = members.join(parts, F.col("rep") == F.col("node"), "left").withColumn("part", F.coalesce("component", "rep")).drop("node", "component")
    split = materialize(named.groupBy("region").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("region"), "split")
    named = named.join(split, "region")
    crowded = named.where(F.col("n_region") > block_rows).select("rep")
    rows = named.where(F.col("n_region") <= block_rows)
    for name, picked in zip(names, picks, strict=True):
        rows = rows.join(picked.select(F.col("own").alias("rep"), F.col("other").alias(name)), "rep", "left").withColumn(name, F.coalesce(name, "rep"))
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select("region", "rep", "n_shingles", "part", "key", *names).repartition(n, "region").sortWithinPartitions("region", "rep")
    return crowded.union(rows.mapInPandas(run, "rep long")).distinct()


def _with_end(batches):
    yield from batches
    yield None


def rare_shingle_lists(docs: DataFrame, reps: DataFrame, shingle: int, percent: int, cells: int = 1 << 18) -> DataFrame:
    """list, rep, n, at: lists of those ``reps`` that share shingles among their rarest; linked ones meet in a list.

    Sets are put in one order for all, rare shingles first. Two sets that link share a shingle
    among the first ones of both, so far as their sizes ask for. How rare a shingle is, is told by
    counts in ``cells`` cells, the size of what is broadcast; a coarse count makes longer lists and
    loses none. Shingles of the same documents are one list, at the first place that each gives one.
    """
    asked = may_hold(reps, "rep", reps.count())
    own = asked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), "doc_id").where("asked").drop("asked")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(cells, np.int64)
        for b in batches:
            for t in b["text"]:
                np.add.at(total, (shingle_set(t, shingle) & np.uint64(cells - 1)).astype(np.int64), 1)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"cell": used, "n": total[used]})

    counted = own.select("text").mapInPandas(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # cells rows at most
    table = np.zeros(cells, np.int64)
    table[counted["cell"].to_numpy()] = counted["n"].to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for d, t in zip(b["doc_id"], b["text"], strict=True):
                s = shingle_set(t, shingle)
                n = len(s)
                if n:
                    times = sent.value[(s & np.uint64(cells - 1)).astype(np.int64)]
                    k = np.lexsort((s, times))[: n + percent * n // -100 + 1]
                    place = np.flatnonzero(times[k] > 1)  # one that occurs once is shared with none
                    rows.append((d, n, s[k[place]].view(np.int64), place.astype(np.int32)))
            yield pd.DataFrame(rows, columns=["rep", "n", "shingles", "places"])

    firsts = own.mapInPandas(first, "rep long, n long, shingles array<long>, places array<int>")
    firsts = materialize(firsts.join(reps.select("rep"), "rep", "left_semi"), "first-shingles")  # the bitmap lets others through
    flat = firsts.withColumn("x", F.explode(F.arrays_zip("shingles", "places"))).select(F.col("x.shingles").alias("shingle"), F.col("x.places").alias("at"), "rep", "n")
    # Lists whose keys fall together by chance are one longer list, which loses no pair.
    key = F.xxhash64(F.count("*"), F.bit_xor(F.xxhash64("rep")), F.bit_xor(F.xxhash64(F.lit(1), "rep")))
    shared = flat.groupBy("shingle").agg(key.alias("list"), F.count("*").alias("rows")).where("rows > 1").select("shingle", "list")
    return materialize(flat.join(shared, "shingle").groupBy("list", "rep", "n").agg(F.min("at").alias("at")), "lists")


def list_pairs(lists: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Pairs a < b of other parts that may be linked, every linked pair of the lists among them.

    What is left of two sets after a shared shingle must suffice for the similarity.
    """
    named = lists.join(parts, F.col("rep") == F.col("node"), "left").withColumn("part", F.coalesce("component", "rep")).drop("node", "component")
    indexed = F.expr(f"at <= n + floor(-{2 * percent} * n / {100 + percent})")
    live = named.groupBy("list").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.max(indexed).alias("any")).where("low <> high and any").select("list")
    named = materialize(named.join(live, "list", "left_semi"), "live-lists")
    x, y = named.alias("x"), named.where(indexed).alias("y")
    meet = x.join(y, F.expr(
        f"""x.list = y.list and x.part <> y.part and (y.n < x.n or y.n = x.n and y.rep < x.rep) and 100 * y.n >= {percent} * x.n
        and {100 + percent} * least(x.n - x.at, y.n - y.at) >= {percent} * (x.n + y.n)"""
    ))
    return meet.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).where("a <> b").distinct()


def confirm(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int, repeats: bool = False) -> DataFrame:
    """The pairs, a written table, whose full shingle sets have 100 * intersection >= percent * union.

    Where rows share a doc_id (repeats), one of their texts suffices, and equal ones go once.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, own = None, None
        for b in batches:
            keep = []
            for a, text, other in zip(b["a"], b["text_a"], b["text_b"], strict=True):
                if last is None or last[0] != a or last[1] != text:
                    last, own = (a, text), shingle_set(text, shingle)
                two = shingle_set(other, shingle)
                shared = len(np.intersect1d(own, two, assume_unique=True))
                keep.append(len(own) > 0 and 100 * shared >= percent * (len(own) + len(two) - shared))
            yield b.loc[keep, ["a", "b"]]

    asked = may_hold(pairs.select(F.explode(F.array("a", "b")).alias("id")), "id", 2 * pairs.count())  # else every text would move
    texts = asked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), "doc_id").where("asked").drop("asked")
    if repeats:
        texts = texts.groupBy("doc_id", F.xxhash64("text"), F.xxhash64(F.lit(1), "text")).agg(F.first("text").alias("text")).select("doc_id", "text")
    one = pairs.join(texts, F.col("b") == F.col("doc_id")).select("a", "b", F.col("text").alias("text_b"))
    two = one.join(texts, F.col("a") == F.col("doc_id")).select("a", "b", F.col("text").alias("text_a"), "text_b")
    return materialize(two.mapInPandas(run, "a long, b long").distinct(), "links")


def near_texts(
    docs: DataFrame, shingle: int = 5, percent: int = 80, trees: int = 12, depth: int = 6, shallow: int = 3, least: float = 0.6, seed: int = 29, block_rows: int = 256,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row.

    percent: least Jaccard similarity of shingle sets, in hundredths. shallow: two documents at 0.8
    share no region of ``trees`` with a chance of 0.0002. least: share of equal MinHash values below
    which a pair is not confirmed; at 72 values it is over four deviations under 0.8. block_rows:
    larger regions are not compared in pairs, but by their rare shingles; that leaves no pair out.
    Documents without words link with nothing. Rows that share a doc_id are one node. A row without
    doc_id is never the one kept, and gets the component of its class.
    """
    known = materialize(sketch(docs, shingle, trees, depth, seed), "sketches")
    repeats = known.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count() > 0
    classes = known.where("k1 is not null").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("n"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")
    )
    classes = materialize(classes.where("rep is not null"), "text-classes")
    members = materialize(regions(classes, trees, depth, shallow), "regions")
    near = candidates(members, least, percent)

    # Each document with its likeliest candidate and its likeliest centre, then each part with its likeliest one of another part.
    best = F.max(F.struct("est", (-F.col("other")).alias("other"), (-F.col("own")).alias("own"))).alias("best")
    chosen = lambda df, by: materialize(df.groupBy(by).agg(best).select((-F.col("best.own")).alias("own"), (-F.col("best.other")).alias("other")), "picks")
    pairs = lambda df: materialize(df.select(F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")).distinct(), "pairs")
    picks = [chosen(near, "own"), chosen(near.where("centre = 1"), "own")]
    tried = pairs(picks[0].union(picks[1]))
    parts = materialize(connected_components(confirm(tried, docs, shingle, percent, repeats), "a", "b"), "parts")
    left = near.join(tried.select("a", "b").union(tried.select("b", "a")).toDF("own", "other"), ["own", "other"], "left_anti")
    for side in ("own", "other"):
        left = left.join(parts.select(F.col("node").alias(side), F.col("component").alias(f"part_{side}")), side, "left").withColumn(f"part_{side}", F.coalesce(f"part_{side}", side))
    picks.append(chosen(left.where("part_own <> part_other"), "part_own"))
    more = pairs(picks[2])
    parts = _joined(parts, confirm(more, docs, shingle, percent, repeats))

    # What regions still leave open is decided by rare shingles.
    still = materialize(unsettled(members, parts, picks, least, percent, block_rows), "unsettled")
    if still.limit(1).count():
        lists = rare_shingle_lists(docs, still, shingle, percent)
        rest = materialize(list_pairs(lists, parts, percent).join(tried.union(more), ["a", "b"], "left_anti"), "rest")
        parts = _joined(parts, confirm(rest, docs, shingle, percent, repeats))

    told = classes.join(parts, F.col("rep") == F.col("node"), "left").where("n > 1 or component is not null")
    told = materialize(told.select("k1", "k2", F.coalesce("component", "rep").alias("component")), "text-parts")
    out = known.select("doc_id", "n_shingles", "k1", "k2").join(told, ["k1", "k2"], "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))


def _joined(parts: DataFrame, links: DataFrame) -> DataFrame:
    """Parts after further links a, b."""
    if not links.limit(1).count():
        return parts
    return materialize(connected_components(parts.select("node", "component").union(links), "node", "component"), "parts")
