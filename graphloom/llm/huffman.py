"""Token ids as canonical length-limited Huffman code.

File: magic, then a zlib-compressed table of code lengths (one byte for each id), then blocks.
A block stands alone: number of documents, number of ids, document ids, ids of each document,
bit offsets of every STRIDE-th id (checkpoints), then the code bits. Decoding looks up a window
of bits in a table; all checkpoints of a block are decoded side by side.
"""

from __future__ import annotations

import itertools
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.files import new_file, read_file
from graphloom.llm.packing import encoder
from graphloom.llm.tokens import CHARS
from graphloom.storage import materialize, scratch_path

MAGIC = b"GLHUF1\0\0"
STRIDE = 128
BLOCK_IDS = 1 << 18


def code_lengths(counts: np.ndarray, limit: int = 20) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits by package-merge; 0 for ids without counts."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n <= 1:
        out[used] = 1
        return out
    if n > 1 << limit:
        raise ValueError(f"{n} ids do not fit codes of {limit} bits")
    order = np.argsort(counts[used], kind="stable")
    leaves = counts[used][order].astype(np.float64)
    rows, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(limit - 1):
        pairs = rows[: len(rows) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, pairs])
        place = np.argsort(both, kind="stable")
        rows = both[place]
        is_leaf.append(place < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for flags in reversed(is_leaf):
        own = int(flags[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out[used[order]] = lengths
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    ls = lengths[order].astype(np.uint64)
    if len(order):
        step = np.uint64(1) << (ls.max() - ls)  # each code's share of the longest codes
        codes[order] = (np.cumsum(step) - step) >> (ls.max() - ls)
    return codes


class Codec:
    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.uint8)
        self.codes = canonical_codes(self.lengths)
        self.top = int(self.lengths.max(initial=1))
        self.left = self.codes << (64 - self.lengths.astype(np.uint64))  # codes at the upper end; without a code, 0
        self.left[self.lengths == 0] = 0
        used = np.flatnonzero(self.lengths)
        order = used[np.lexsort((used, self.lengths[used]))]
        span = 1 << (self.top - self.lengths[order].astype(np.int64))
        self.symbol = np.zeros(1 << self.top, np.uint32)
        self.size = np.ones(1 << self.top, np.uint8)
        filled = int(span.sum())
        self.symbol[:filled], self.size[:filled] = np.repeat(order, span), np.repeat(self.lengths[order], span)

    def bits(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Code bits of ids, and where each STRIDE-th id begins."""
        size = self.lengths[ids].astype(np.int64)
        if len(ids) and not size.all():
            raise ValueError("an id has no code")
        end = np.cumsum(size)
        begin = end - size
        total = int(end[-1]) if len(ids) else 0
        words = np.zeros(total // 32 + 2, np.uint64)
        if len(ids):
            value = self.left[ids] >> (begin & 31).astype(np.uint64)
            word = begin >> 5
            first = np.flatnonzero(np.diff(word, prepend=-1))
            words[word[first]] += np.add.reduceat(value >> np.uint64(32), first)
            words[word[first] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
        return words.astype(">u4").tobytes()[: -(-total // 8)], begin[::STRIDE]

    def ids(self, bits: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """The n ids that begin at the checkpoints."""
        data = np.frombuffer(bits + bytes(8), np.uint8).astype(np.uint32)
        out = np.empty((len(checkpoints), STRIDE), np.uint32)
        at = checkpoints.astype(np.int64)
        limit, mask = 8 * len(bits), np.uint32((1 << self.top) - 1)
        for k in range(STRIDE):
            if k == (n - 1) % STRIDE + 1 and len(at) == len(checkpoints):
                at = at[:-1]  # the last stretch is over
            if not len(at):
                break
            if int(at.max()) >= limit:
                raise ValueError("code bits end too early")
            byte, shift = at >> 3, (at & 7).astype(np.uint32)
            window = (data[byte] << 24) | (data[byte + 1] << 16) | (data[byte + 2] << 8) | data[byte + 3]
            window = (window >> (np.uint32(32 - self.top) - shift)) & mask  # top + 7 bits at most
            out[: len(at), k] = self.symbol[window]
            at = at + self.size[window]
        return out.reshape(-1)[:n]


def encode_block(codec: Codec, doc_ids: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    bits, points = codec.bits(ids)
    body = [doc_ids.astype("<i8").tobytes(), sizes.astype("<u4").tobytes(), points.astype("<u4").tobytes(), bits]
    return struct.pack("<IIII", len(doc_ids), len(ids), len(points), len(bits)) + b"".join(body)


def decode_blocks(file) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """document ids, ids of each, and all ids, block by block."""
    if file.read(8) != MAGIC:
        raise ValueError("not a Huffman id file")
    (n,) = struct.unpack("<I", file.read(4))
    codec = Codec(np.frombuffer(zlib.decompress(file.read(n)), np.uint8))
    while head := file.read(16):
        docs, ids, points, size = struct.unpack("<IIII", head)
        body = file.read(12 * docs + 4 * points + size)
        if len(body) != 12 * docs + 4 * points + size:
            raise ValueError("a block is cut off")
        at = np.frombuffer(body, "<u4", points, 12 * docs)
        yield np.frombuffer(body, "<i8", docs), np.frombuffer(body, "<u4", docs, 8 * docs), codec.ids(body[12 * docs + 4 * points :], at, ids)


#: Stands for a null doc_id in blocks.
NO_ID = -(1 << 63)


def token_blocks(docs: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """Ids of documents in ascending doc_id order, as blocks: part, block, docs, sizes, ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, end, part = encoder(path, "byte"), int(end_id).to_bytes(4, "little"), TaskContext.get().partitionId()
        kind = "<u2" if enc.whole.get_vocab_size() <= 1 << 16 else "<u4"
        block, doc, texts, chars = 0, [], [], 0

        def made():
            nonlocal block
            ids, sizes = enc.encode_all(texts, end)
            ends = np.cumsum(sizes)
            cuts = [0, *(np.flatnonzero(np.diff(ends // BLOCK_IDS)) + 1).tolist(), len(ends)]
            for a, z in itertools.pairwise(cuts):
                own = ids[ends[a] - sizes[a] : ends[z - 1]].astype(kind)
                yield pd.DataFrame({"part": [part], "block": [block], "wide": [kind == "<u4"], "docs": [np.array(doc[a:z], "<i8").tobytes()], "sizes": [sizes[a:z].astype("<u4").tobytes()], "ids": [own.tobytes()]})
                block += 1

        for b in batches:
            for d, text in zip(b["doc_id"].tolist(), b["text"].tolist(), strict=True):
                doc.append(NO_ID if pd.isna(d) else int(d))
                texts.append(text)
                chars += len(text or "") + 1
                if chars >= CHARS:
                    yield from made()
                    doc, texts, chars = [], [], 0
        if doc:
            yield from made()

    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).repartitionByRange(n, F.col("doc_id").asc_nulls_last()).sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "text")
    return materialize(ordered.mapInPandas(run, "part int, block int, wide boolean, docs binary, sizes binary, ids binary"), "token-blocks")


def _ids(row) -> np.ndarray:
    return np.frombuffer(row.ids, "<u4" if row.wide else "<u2")


def id_counts(blocks: DataFrame) -> np.ndarray:
    """How often each id occurs in all blocks; as many numbers as the vocabulary has."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0, np.int64)
        for b in batches:
            for row in b.itertuples():
                got = np.bincount(_ids(row), minlength=len(total))
                got[: len(total)] += total
                total = got
        used = np.flatnonzero(total)
        yield pd.DataFrame({"id": used, "n": total[used]})

    rows = blocks.select("wide", "ids").mapInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 0, np.int64)
    out[rows["id"].astype(int)] = rows["n"].astype(np.int64)
    return out


def write_files(blocks: DataFrame, folder: str, limit: int = 20) -> DataFrame:
    """Write blocks as files; the written table of files: uri, part, block, n_docs, n_ids."""
    lengths = blocks.sparkSession.sparkContext.broadcast(code_lengths(id_counts(blocks), limit).tobytes())  # a byte for each id of the vocabulary

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = lengths.value
        codec = Codec(np.frombuffer(table, np.uint8))
        packed = zlib.compress(table)

        def rows():
            for b in batches:
                yield from b.itertuples()

        last, todo = None, rows()
        row = next(todo, None)
        while row is not None:
            first, docs, ids = row, 0, 0
            with new_file(folder, f"{row.part:06d}-{row.block:08d}", ".huf") as (uri, out):
                out.write(MAGIC + struct.pack("<I", len(packed)) + packed)
                while row is not None and (row.part == first.part) and (last is None or row.block == last + 1):
                    out.write(encode_block(codec, d := np.frombuffer(row.docs, "<i8"), np.frombuffer(row.sizes, "<u4"), x := _ids(row)))
                    docs, ids, last = docs + len(d), ids + len(x), row.block
                    row = next(todo, None)
            last = None
            yield pd.DataFrame({"uri": [uri], "part": [first.part], "block": [first.block], "n_docs": [docs], "n_ids": [ids]})

    return materialize(blocks.mapInPandas(run, "uri string, part int, block int, n_docs long, n_ids long"), "huffman-files")


def read_files(files: DataFrame) -> DataFrame:
    """Documents read back from files: doc_id, start, n_tokens, ids_crc32."""
    before = Window.orderBy("part", "block").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    starts = files.select("uri", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for f in b.itertuples():
                start = int(f.start)
                with read_file(f.uri) as file:
                    for docs, sizes, ids in decode_blocks(file):
                        ends = np.cumsum(sizes.astype(np.int64))
                        begins = ends - sizes
                        raw = ids.astype("<u4").tobytes()
                        crc = [zlib.crc32(raw[4 * a : 4 * z]) for a, z in zip(begins.tolist(), ends.tolist(), strict=True)]
                        ids_ = pd.array(docs, dtype="Int64")
                        ids_[docs == NO_ID] = pd.NA
                        yield pd.DataFrame({"doc_id": ids_, "start": start + begins, "n_tokens": sizes.astype(np.int64), "ids_crc32": crc})
                        start += int(ends[-1]) if len(ends) else 0

    n = max(1, min(files.count(), 20_000))
    return starts.repartition(n, "uri").mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_documents(docs: DataFrame, path: str, end_id: int = 0, limit: int = 20) -> DataFrame:
    """Write the ids of all documents as Huffman files and return the table of files.

    Null or empty text is ``end_id`` alone. Null doc_id comes last. Repeated rows are written
    each; an empty table gives no file.
    """
    return write_files(token_blocks(docs, path, end_id), scratch_path(docs.sparkSession, "huffman"), limit)
