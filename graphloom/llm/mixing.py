"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

A document's expected copies are its source's target over its source's size. The whole copies are
certain; the rest is a mass of words between none and the document's size. Two documents of a
source at a time move mass from one to the other, at random and without bias, until one of them
holds none or all of its words. Blocks of documents are folded this way, each leaves one residual,
and residuals are folded by the same rule in a tree of blocks. Mass never leaves a source, so its
taken words miss the target by less than the size of the last residual document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.storage import materialize

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, n, source_size, target from rows source, size.

    Sources in order of code points, null last, weigh ``weights`` in turn and share ``share`` times
    all sizes. A target stops at ``most`` times its source's size and the excess goes to the others
    by weight: the level to which the others fill is found over sources in order of their ceilings.
    """
    per = sizes.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    # Windows over one row per source, in one task: sources are taken to be few beside documents.
    named = per.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    named = named.withColumn("weight", weight).withColumn("ceiling", most * F.col("source_size"))
    order = Window.orderBy(F.col("ceiling") / F.col("weight"), "rank")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = share * F.sum("source_size").over(every) - F.coalesce(F.sum("ceiling").over(before), F.lit(0.0))
    full = F.col("ceiling") / F.col("weight") <= left / F.sum("weight").over(after)
    filled = named.withColumn("full", full)
    rest = share * F.sum("source_size").over(every) - F.sum(F.when(F.col("full"), F.col("ceiling")).otherwise(0.0)).over(every)
    level = rest / F.sum(F.when(~F.col("full"), F.col("weight"))).over(every)
    return filled.select("source", "n", "source_size", F.when(F.col("full"), F.col("ceiling")).otherwise(level * F.col("weight")).cast("double").alias("target"))


def _let(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _item(x: Column, mass: Column) -> Column:
    return F.struct(*[x[k].alias(k) for k in ("rank", "doc_id", "key", "copy", "size", "whole", "draw")], mass.alias("mass"))


def _moved(held: Column, x: Column) -> Column:
    """The two documents after one transfer, the settled one first."""
    gain = F.least(held["size"] - held["mass"], x["mass"])  # from x to held
    loss = F.least(held["mass"], x["size"] - x["mass"])  # from held to x
    up = x["draw"] * (gain + loss) < loss
    mine = F.when(up, F.when(gain == x["mass"], held["mass"] + gain).otherwise(held["size"])).otherwise(F.when(loss == held["mass"], 0.0).otherwise(held["mass"] - loss))
    other = F.when(up, F.when(gain == x["mass"], 0.0).otherwise(x["mass"] - gain)).otherwise(F.when(loss == held["mass"], x["mass"] + loss).otherwise(x["size"].cast("double")))

    def in_order(m):
        settled = (m["mine"] <= 0) | (m["mine"] >= held["size"])
        a, b = _item(held, m["mine"]), _item(x, m["other"])
        return F.when(settled, F.struct(a.alias("done"), b.alias("held"))).otherwise(F.struct(b.alias("done"), a.alias("held")))

    return _let(F.struct(mine.alias("mine"), other.alias("other")), in_order)


def _fold(rows: DataFrame, kind: str) -> DataFrame:
    """Fold each (source, block) of items: source, block, held, done."""
    items = rows.groupBy("source", "block").agg(F.array_sort(F.collect_list("item")).alias("items"))
    start = F.struct(F.col("items")[0].alias("held"), F.expr(f"cast(array() as array<{kind}>)").alias("done"))

    def step(acc, x):
        return _let(_moved(acc["held"], x), lambda m: F.struct(m["held"].alias("held"), F.array_append(acc["done"], m["done"]).alias("done")))

    folded = items.withColumn("folded", F.aggregate(F.slice("items", 2, F.size("items")), start, step))
    return folded.select("source", "block", "folded.held", "folded.done")


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, block: int = 64, seed: int = 41) -> DataFrame:
    """doc_id, key, source, size, source_size, target, copies, taken for every row.

    size: words of the text, null text none. taken: size times copies. key: a hash of the whole
    row; rows equal in doc_id and key are interchangeable. Draws depend on doc_id, key and seed
    only, so reruns agree. Empty documents are taken no times. An empty table gives no rows.
    """
    # Names are set apart first: other columns may clash with those used here.
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if not kind.startswith("map")]).alias("key"),
        F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"),
    )
    rows = rows.groupBy("doc_id", "key", "source", "size").agg(F.count("*").alias("times"))  # equal rows needn't meet in a task
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).drop("times")
    rows = materialize(rows, "sizes")
    targets = materialize(source_targets(rows, weights, share, most), "targets")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    with_rate = rows.join(targets, rows["source"].eqNullSafe(targets["source"])).drop(targets["source"]).withColumn("rate", rate)
    whole = F.floor(F.col("rate") + 1e-12)
    mass = F.greatest(F.lit(0.0), F.col("rate") - F.col("whole")) * F.col("size")
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "key", "copy"), F.lit(1 << 40)) / float(1 << 40)
    at = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "key", "copy"), F.ceil(F.col("n") / block))
    # Large documents settle first, so that what is left over is small.
    item = F.struct((-F.col("size")).alias("rank"), "doc_id", "key", "copy", "size", "whole", draw.alias("draw"), mass.alias("mass"))
    level = with_rate.withColumn("whole", whole).where("size > 0").select("source", at.alias("block"), item.alias("item"))
    kind = dict(level.dtypes)["item"]
    blocks = targets.agg(F.max(F.ceil(F.col("n") / block))).first()[0] or 1
    settled = None
    while True:
        folded = materialize(_fold(level, kind), "folded")
        done = folded.select("source", F.explode("done").alias("item"))
        settled = done if settled is None else settled.union(done)
        if blocks <= 1:
            break
        blocks = -(-blocks // block)
        level = folded.select("source", F.floor(F.col("block") / block).alias("block"), F.col("held").alias("item"))
    # A source's last residual is taken with the probability that its mass is of its size.
    last = F.pmod(F.xxhash64(F.lit(seed + 2), "held.doc_id", "held.key", "held.copy"), F.lit(1 << 40)) / float(1 << 40)
    final = F.when(last * F.col("held.size") < F.col("held.mass"), F.col("held.size")).otherwise(0).cast("double")
    settled = settled.union(folded.select("source", _item(F.col("held"), final).alias("item")))
    copies = (F.col("item.whole") + F.when(F.col("item.mass") > 0, 1).otherwise(0)).cast("int")
    settled = settled.select("item.doc_id", "item.key", "source", "item.size", copies.alias("copies"))
    settled = settled.union(rows.where("size = 0").select("doc_id", "key", "source", "size", F.lit(0)))
    out = settled.join(targets, settled["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    return out.select("doc_id", "key", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents as often as the mix takes them, with the columns of docs.

    Equal rows are taken as often as all of them together. Extra columns may have any name.
    """
    told = mixed.groupBy(F.col("doc_id").alias("mix_id"), F.col("key").alias("mix_key")).agg(F.sum("copies").alias("copies"), F.count("*").alias("times")).where("copies > 0")
    told = materialize(told, "copies")
    key = F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if not kind.startswith("map")])
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("own_id"), key.alias("own_key"))
    joined = own.join(told, F.col("own_id").eqNullSafe(F.col("mix_id")) & (F.col("own_key") == F.col("mix_key"))).select("row", "mix_id", "mix_key", "copies", "times")
    out = joined.where("times = 1").select("row", "copies")
    if told.where("times > 1").limit(1).count():  # one of equal rows stands for all
        out = out.union(joined.where("times > 1").groupBy("mix_id", "mix_key").agg(F.first("row").alias("row"), F.first("copies").alias("copies")).select("row", "copies"))
    return out.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("row.*")
