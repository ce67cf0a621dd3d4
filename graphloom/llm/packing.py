"""Best-fit decreasing packing of token sequences.

Best-fit decreasing depends on lengths alone, and lengths are whole numbers up to the capacity.
So the plan is made from the number of pieces of each length: a segment tree over remaining
capacities finds the tightest open bin in logarithmic time, and pieces of one length that meet
the same kind of bin are placed as one run. The plan is what placing piece by piece gives; its
size depends on the capacity, not on the number of documents. Pieces then find their place by
their rank among those of their length, which is counted in salted groups.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.tokens import Encoder
from graphloom.storage import materialize

#: Pieces of one length that one task ranks, about.
RANKED_TOGETHER = 250
_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, kind: str) -> Encoder:
    """One encoder for each Python worker, kept between tasks."""
    if (path, kind) not in _encoders:
        _encoders[path, kind] = Encoder(path, kind)
    return _encoders[path, kind]


class OpenBins:
    """Segment tree over remaining capacities 0..capacity; a leaf holds ranges of like bins."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.width)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(self.width)]

    def _count(self, r: int, change: int) -> None:
        k = r + self.width
        while k:
            self.open[k] += change
            k //= 2

    def push(self, r: int, first: int, n: int) -> None:
        if n and r:
            self.ranges[r].append((first, n))
            self._count(r, 1)

    def pop(self, r: int) -> tuple[int, int]:
        self._count(r, -1)
        return self.ranges[r].pop()

    def tightest(self, need: int) -> int | None:
        """The smallest remaining capacity of at least ``need`` that an open bin has."""
        k = need + self.width
        while not self.open[k]:
            while k & 1:  # a right child: nothing larger below its parent
                k //= 2
            if k == 0:
                return None
            k += 1
        while k < self.width:
            k = 2 * k if self.open[2 * k] else 2 * k + 1
        return k - self.width


def best_fit_plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Runs (length, first rank, end rank, first bin, pieces a bin, offset) and the number of bins."""
    bins, runs, opened = OpenBins(capacity), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = bins.tightest(length)
            if room is None:
                room, per = capacity, capacity // length
                first, n = opened, -(-left // per)
                opened += n
            else:
                per = room // length
                first, n = bins.pop(room)
            full, offset = min(n, left // per), capacity - room
            if full:
                runs.append((length, rank, rank + full * per, first, per, offset))
                bins.push(room - per * length, first, full)
                rank, left = rank + full * per, left - full * per
            if full < n and 0 < left < per:
                runs.append((length, rank, rank + left, first + full, left, offset))
                bins.push(room - left * length, first + full, 1)
                full, left = full + 1, 0
            bins.push(room, first + full, n - full)
    return runs, opened


def token_pieces(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Documents as token pieces: doc_id, piece, start, length, ids_crc32 (and ids with keep_ids).

    A document's ids end with ``end_id``; null or empty text is that id alone. Only documents
    over ``capacity`` are cut, into pieces of that many ids.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, end = encoder(path, "word"), int(end_id).to_bytes(4, "little")
        for b in batches:
            for at in range(0, len(b), 500):
                rows = []
                part = b.iloc[at : at + 500]
                for doc, ids in zip(part["doc_id"], enc.encode(part["text"].tolist()), strict=True):
                    ids += end
                    for k in range(0, len(ids), 4 * capacity):
                        p = ids[k : k + 4 * capacity]
                        rows.append((doc, k // (4 * capacity), k // 4, len(p) // 4, zlib.crc32(p), p))
                out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out if keep_ids else out.drop(columns="ids")

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInPandas(cut, schema)


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Give each row of a table with ``length`` (1..capacity) a sequence_id and an offset.

    pieces must be a written table, since it is read twice, and have doc_id, piece and
    ids_crc32, by which rows of one length are ranked; rows equal in all of these are
    interchangeable, and are ranked in one task. Null ids and repeated rows are packed like others.
    An empty table gives an empty result. Further columns may have any name but the two new ones.
    """
    spark = pieces.sparkSession
    counts = {int(r[0]): int(r[1]) for r in pieces.groupBy("length").count().collect()}  # capacity rows at most
    runs, _ = best_fit_plan(counts, capacity)
    by_length: dict[int, list[tuple]] = {}
    for length, *run in runs:
        by_length.setdefault(length, []).append(tuple(run))
    plan = spark.createDataFrame(
        [(length, -(-counts[length] // RANKED_TOGETHER), r) for length, r in by_length.items()],
        "length long, salts long, runs array<struct<first: long, past: long, bin: long, per: long, at: long>>",
    )
    rows = pieces.select(F.struct(*[F.col(f"`{c}`") for c in pieces.columns]).alias("row"), "length", "doc_id", "piece", "ids_crc32")
    salted = rows.join(F.broadcast(plan.select("length", "salts")), "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("salts"))).drop("salts")
    groups = salted.groupBy("length", "salt").count()
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(order) - 1).join(groups, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("base"))
    placed = ranked.join(F.broadcast(plan.select("length", "runs")), "length")  # a few runs for each length: bound by the capacity
    placed = placed.withColumn("run", F.expr("filter(runs, r -> r.first <= rank and rank < r.past)[0]"))
    return placed.select(
        "row.*",
        F.expr("run.bin + (rank - run.first) div run.per").alias("sequence_id"),
        F.expr("run.at + ((rank - run.first) % run.per) * length").alias("offset"),
    )


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Tokenize and pack: one row per piece with its sequence and offset."""
    return pack(materialize(token_pieces(docs, path, capacity, end_id, keep_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, n_ids, ids (little-endian 32-bit bytes)."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])
    whole = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"), whole.alias("ids"))


def ids_of(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, "<u4")
