"""AVI motion-JPEG columns: write, index, decode, and find shots.

Frames are intra-coded JPEG. Payloads are stored by JPEG's lossless process (SOF3, predictor 1)
with a Huffman table in which category and extra bits of a difference always take nine bits
together, so that 192 samples are 216 bytes and whole documents are coded by array operations.
Frames with other tables, and baseline frames (SOF0), go through a general decoder.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH, HEIGHT, FPS = 16, 12, 25
FRAME = WIDTH * HEIGHT
CODED = FRAME * 9 // 8


def _nine_bits() -> np.ndarray:
    """Code and extra bits of each difference -255..255: category s has 8 - s ones and a zero."""
    d = np.arange(-255, 256)
    s = np.array([int(abs(x)).bit_length() for x in d])
    extra = np.where(d > 0, d, d + (1 << s) - 1)
    prefix = ((1 << (8 - s)) - 1) << 1
    return np.where(s == 0, 0b111111110, (prefix << s) | extra).astype(np.uint16)


ENCODE = _nine_bits()
DECODE = np.full(512, 999, np.int16)
DECODE[ENCODE] = np.arange(-255, 256)
# Segments of every frame: lossless frame header, Huffman table, scan header.
SOF3 = struct.pack(">HHBHHBBBB", 0xFFC3, 11, 8, HEIGHT, WIDTH, 1, 1, 0x11, 0)
DHT = struct.pack(">HHB", 0xFFC4, 28, 0) + bytes([1] * 9 + [0] * 7) + bytes(range(8, -1, -1))
SOS = struct.pack(">HHBBBBBB", 0xFFDA, 8, 1, 1, 0x00, 1, 0, 0)
HEAD = b"\xff\xd8" + SOF3 + DHT + SOS
EOI = np.array([0xFF, 0xD9], np.uint8)


def padded(text: str | None) -> bytes:
    """UTF-8 of a text, filled with spaces to a positive multiple of a frame."""
    data = (text or "").encode()
    return data.ljust(max(1, -(-len(data) // FRAME)) * FRAME, b" ")


def _chunk(name: bytes, data: bytes) -> bytes:
    return name + struct.pack("<I", len(data)) + data + b"\0" * (len(data) & 1)


def encode_avi(payload: bytes) -> bytes:
    """An AVI whose frames hold the payload, a positive multiple of 192 bytes, sample by sample."""
    x = np.frombuffer(payload, np.uint8).reshape(-1, HEIGHT, WIDTH).astype(np.int16)
    n = len(x)
    d = np.empty_like(x)
    d[:, :, 1:] = x[:, :, 1:] - x[:, :, :-1]
    d[:, 1:, 0] = x[:, 1:, 0] - x[:, :-1, 0]
    d[:, 0, 0] = x[:, 0, 0] - 128
    v = ENCODE[d + 255].reshape(n, -1, 8)
    raw = np.empty((n, FRAME // 8, 9), np.uint8)
    raw[:, :, 0] = v[:, :, 0] >> 1
    for k in range(1, 8):
        raw[:, :, k] = ((v[:, :, k - 1] & ((1 << k) - 1)) << (8 - k)) | (v[:, :, k] >> (k + 1))
    raw[:, :, 8] = v[:, :, 7] & 255
    raw = raw.reshape(n, CODED)
    full = raw == 255
    sizes = len(HEAD) + CODED + full.sum(1) + 2
    step = 8 + sizes + (sizes & 1)
    at = np.cumsum(step) - step
    movi = np.zeros(int(step.sum()), np.uint8)
    heads = np.frombuffer(b"00dc\0\0\0\0" + HEAD, np.uint8)
    movi[at[:, None] + np.arange(len(heads))] = heads
    movi[at[:, None] + np.arange(4, 8)] = sizes.astype("<u4").view(np.uint8).reshape(-1, 4)
    # A byte moves on by the zeros stuffed before it in its frame.
    movi[at[:, None] + len(heads) + np.arange(CODED) + np.cumsum(full, 1) - full] = raw
    movi[(at + 8 + sizes - 2)[:, None] + np.arange(2)] = EOI
    index = np.zeros(n, [("id", "S4"), ("flags", "<u4"), ("at", "<u4"), ("size", "<u4")])
    index["id"], index["flags"], index["at"], index["size"] = b"00dc", 0x10, at + 4, sizes
    most = int(sizes.max())
    avih = struct.pack("<14I", 1_000_000 // FPS, most * FPS, 0, 0x10, n, 0, 1, most, WIDTH, HEIGHT, 0, 0, 0, 0)
    strh = struct.pack("<4s4sIHHIIIIIIII4H", b"vids", b"MJPG", 0, 0, 0, 0, 1, FPS, 0, n, most, 0xFFFFFFFF, 0, 0, 0, WIDTH, HEIGHT)
    strf = struct.pack("<IiiHH4sIiiII", 40, WIDTH, HEIGHT, 1, 8, b"MJPG", FRAME, 0, 0, 0, 0)
    strl = b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf)
    hdrl = b"hdrl" + _chunk(b"avih", avih) + _chunk(b"LIST", strl)
    return _chunk(b"RIFF", b"AVI " + _chunk(b"LIST", hdrl) + _chunk(b"LIST", b"movi" + movi.tobytes()) + _chunk(b"idx1", index.tobytes()))


@dataclass
class Video:
    frames: np.ndarray  # n, height, width
    fps: float


def _chunks(data: memoryview, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    if end > len(data):
        raise ValueError("the file is cut off")
    while at + 8 <= end:
        name, size = bytes(data[at : at + 4]), struct.unpack_from("<I", data, at + 4)[0]
        if at + 8 + size > end:
            raise ValueError(f"chunk {name!r} is cut off")
        yield name, at + 8, at + 8 + size
        at += 8 + size + (size & 1)


def frame_index(data: bytes) -> tuple[np.ndarray, float]:
    """Begin and size of each video frame, from the index or else the movi list, and frames a second."""
    view = memoryview(data)
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI")
    fps, movi, index = float(FPS), None, None
    for name, a, z in _chunks(view, 12, 8 + struct.unpack_from("<I", data, 4)[0]):
        kind = bytes(view[a : a + 4])
        if name == b"LIST" and kind == b"hdrl":
            for inner, b, y in _chunks(view, a + 4, z):
                if inner == b"LIST" and bytes(view[b : b + 4]) == b"strl":
                    for leaf, c, _ in _chunks(view, b + 4, y):
                        if leaf == b"strh" and bytes(view[c : c + 4]) == b"vids":
                            scale, rate = struct.unpack_from("<II", data, c + 20)
                            fps = rate / scale if scale and rate else fps
        elif name == b"LIST" and kind == b"movi":
            movi = a, z
        elif name == b"idx1":
            index = np.frombuffer(data, [("id", "S4"), ("flags", "<u4"), ("at", "<u4"), ("size", "<u4")], (z - a) // 16, a)
    if movi is None:
        raise ValueError("no movi list")
    if index is None:
        found = [(a, z - a) for name, a, z in _chunks(view, movi[0] + 4, movi[1]) if name[2:] in (b"dc", b"db")]
        return np.array(found, np.int64).reshape(-1, 2), fps
    video = index[np.isin(index["id"], [b"00dc", b"00db"])]
    at = video["at"].astype(np.int64)
    if len(at) and at[0] < movi[0]:  # offsets count from the list's name, in some files from the file's begin
        at = at + movi[0]
    return np.stack([at + 8, video["size"].astype(np.int64)], 1), fps


class _Bits:
    def __init__(self, data: bytes):
        self.value, self.left, self.data, self.at = 0, 0, data.replace(b"\xff\x00", b"\xff"), 0

    def take(self, n: int) -> int:
        while self.left < n:
            byte = self.data[self.at] if self.at < len(self.data) else 255
            self.value, self.left, self.at = (self.value << 8 | byte) & 0xFFFFFFFF, self.left + 8, self.at + 1
        self.left -= n
        return self.value >> self.left & ((1 << n) - 1)

    def symbol(self, table: dict[tuple[int, int], int]) -> int:
        code = 0
        for n in range(1, 17):
            code = code << 1 | self.take(1)
            if (n, code) in table:
                return table[n, code]
        raise ValueError("no such code")

    def signed(self, n: int) -> int:
        v = self.take(n) if n else 0
        return v if not n or v >> (n - 1) else v - (1 << n) + 1


def _segments(data: bytes) -> tuple[dict, int]:
    """Tables and headers before the scan's data, and where that begins."""
    out: dict = {"q": {}, "huff": {}}
    at = 2
    if data[:2] != b"\xff\xd8":
        raise ValueError("no JPEG frame")
    while True:
        mark, size = struct.unpack_from(">HH", data, at)
        body = data[at + 4 : at + 2 + size]
        if mark == 0xFFC4:
            while body:
                counts, values, code, k = body[1:17], body[17:], 0, 0
                table = out["huff"][body[0]] = {}
                for n, c in enumerate(counts, 1):
                    for _ in range(c):
                        table[n, code] = values[k]
                        code, k = code + 1, k + 1
                    code <<= 1
                body = values[k:]
        elif mark == 0xFFDB:
            while body:
                wide = body[0] >> 4
                out["q"][body[0] & 15] = np.frombuffer(body, ">u2" if wide else np.uint8, 64, 1).astype(np.int64)
                body = body[1 + 64 * (1 + wide) :]
        elif mark in (0xFFC0, 0xFFC1, 0xFFC3):
            out["kind"], out["bits"], out["h"], out["w"] = mark & 15, *struct.unpack_from(">BHH", body)
            out["parts"] = [(body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(body[5])]
        elif mark == 0xFFDD:
            out["restart"] = struct.unpack(">H", body)[0]
        elif mark == 0xFFDA:
            out["scan"] = {body[1 + 2 * k]: body[2 + 2 * k] for k in range(body[0])}
            out["predictor"] = body[1 + 2 * body[0]]
            return out, at + 2 + size
        at += 2 + size


def _zigzag() -> list[int]:
    return [r * 8 + c for r, c in sorted(((r, c) for r in range(8) for c in range(8)), key=lambda p: (p[0] + p[1], p[0] if (p[0] + p[1]) % 2 else p[1]))]


def _cosines() -> np.ndarray:
    u, x = np.mgrid[0:8, 0:8]
    return np.where(u == 0, np.sqrt(0.125), 0.5) * np.cos((2 * x + 1) * u * np.pi / 16)


ZIGZAG, COSINES = _zigzag(), _cosines()


def decode_frame(data: bytes) -> np.ndarray:
    """Luma of any lossless (predictor 1, one component) or baseline JPEG frame, code by code."""
    s, at = _segments(data)
    if s.get("restart"):
        raise ValueError("restart intervals are not read")
    bits, h, w = _Bits(data[at:-2]), s["h"], s["w"]
    if s["kind"] == 3:
        if s["predictor"] != 1 or len(s["parts"]) != 1:
            raise ValueError("only predictor 1 and one component are read")
        table, out = s["huff"][s["scan"][s["parts"][0][0]] >> 4], np.zeros((h, w), np.int64)
        for r in range(h):
            for c in range(w):
                before = out[r, c - 1] if c else out[r - 1, 0] if r else 1 << (s["bits"] - 1)
                out[r, c] = before + bits.signed(bits.symbol(table)) & 0xFFFF
        return out.astype(np.uint8)
    wide, tall = max(p[1] for p in s["parts"]), max(p[2] for p in s["parts"])
    across, down = -(-w // (8 * wide)), -(-h // (8 * tall))
    luma, last = np.zeros((down * tall * 8, across * wide * 8)), dict.fromkeys(s["scan"], 0)
    for my in range(down):
        for mx in range(across):
            for k, (part, hs, vs, q) in enumerate(s["parts"]):
                tables = s["scan"][part]
                for by in range(vs):
                    for bx in range(hs):
                        block = np.zeros(64)
                        last[part] += bits.signed(bits.symbol(s["huff"][tables >> 4]))
                        block[0] = last[part] * s["q"][q][0]
                        n = 1
                        while n < 64:
                            run = bits.symbol(s["huff"][16 | tables & 15])
                            if run == 0:
                                break
                            n += run >> 4
                            if run & 15:
                                block[ZIGZAG[n]] = bits.signed(run & 15) * s["q"][q][n]
                            n += 1
                        if k == 0:
                            y, x = (my * vs + by) * 8, (mx * hs + bx) * 8
                            luma[y : y + 8, x : x + 8] = COSINES.T @ block.reshape(8, 8) @ COSINES + 128
    return np.clip(np.round(luma[:h, :w]), 0, 255).astype(np.uint8)


def decode_avi(data: bytes) -> Video:
    """All frames. Frames alike in their headers and coded by nine-bit tables are decoded at once."""
    index, fps = frame_index(data)
    whole = np.frombuffer(data, np.uint8)
    n = len(index)
    if n == 0:
        return Video(np.zeros((0, HEIGHT, WIDTH), np.uint8), fps)
    at, size = index[:, 0], index[:, 1]
    if int((at + size).max()) > len(whole):
        raise ValueError("a frame is cut off")
    h = len(HEAD)
    alike = int(size.min()) >= h + CODED + 2 and (whole[at[:, None] + np.arange(h)] == np.frombuffer(HEAD, np.uint8)).all()
    if not alike or not (whole[(at + size - 2)[:, None] + np.arange(2)] == EOI).all():
        return Video(np.stack([decode_frame(data[a : a + s]) for a, s in index.tolist()]), fps)
    body = size - h - 2
    begin = np.cumsum(body) - body
    raw = whole[np.repeat(at + h - begin, body) + np.arange(int(body.sum()))]
    keep = np.ones(len(raw), bool)
    keep[1:] = ~((raw[:-1] == 255) & (raw[1:] == 0))
    keep[begin] = True
    raw = raw[keep]
    if len(raw) != n * CODED or (np.add.reduceat(keep, begin, dtype=np.int64) != CODED).any():
        raise ValueError("a frame has another number of bits")
    b = raw.reshape(n, -1, 9).astype(np.uint16)
    v = np.empty((n, FRAME // 8, 8), np.uint16)
    for k in range(8):
        v[:, :, k] = (b[:, :, k] << (k + 1) | b[:, :, k + 1] >> (7 - k)) & 511
    d = DECODE[v].reshape(n, HEIGHT, WIDTH)
    if (d == 999).any():
        raise ValueError("no such code")
    d = d.astype(np.int32)
    d[:, 0, 0] += 128
    d[:, :, 0] = np.cumsum(d[:, :, 0], 1)
    return Video(np.cumsum(d, 2).astype(np.uint8), fps)


def histograms(frames: np.ndarray, bins: int = 16) -> np.ndarray:
    n = len(frames)
    value = frames.reshape(n, -1).astype(np.int64) * bins // 256 + np.arange(n)[:, None] * bins
    return np.bincount(value.ravel(), minlength=n * bins).reshape(n, bins)


def shot_starts(frames: np.ndarray, window: int = 12, factor: float = 3.0, least: float = 0.12) -> np.ndarray:
    """First frame of each shot.

    A frame begins a shot if its histogram differs from the one before by more than the mean of
    the last ``window`` differences (3 at least) plus ``factor`` deviations, and by ``least`` at least.
    """
    n = len(frames)
    if n == 0:
        return np.zeros(0, np.int64)
    h = histograms(frames)
    d = np.abs(np.diff(h, axis=0)).sum(1) / (2 * frames[0].size)
    one, two = np.concatenate([[0], np.cumsum(d)]), np.concatenate([[0], np.cumsum(d * d)])
    k = np.arange(n - 1)
    a = np.maximum(0, k - window)
    m = np.maximum(1, k - a)
    mean = (one[k] - one[a]) / m
    spread = np.sqrt(np.maximum(0, (two[k] - two[a]) / m - mean * mean))
    return np.concatenate([[0], 1 + np.flatnonzero((d > mean + factor * spread + 1e-9) & (d >= least) & (k > 2))]).astype(np.int64)


def to_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: each whole text as an AVI. Null or empty text is one frame of spaces."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 200):
                part = b.iloc[at : at + 200]
                yield pd.DataFrame({"doc_id": part["doc_id"], "n_bytes": [len((t or "").encode()) for t in part["text"]], "media": [encode_avi(padded(t)) for t in part["text"]]})

    return _whole_ids(docs.select("doc_id", F.col("text").cast("string")), run, "n_bytes long, media binary")


def _whole_ids(df: DataFrame, run, schema: str) -> DataFrame:
    """mapInPandas whose doc_id travels as text, since pandas would turn ids beside nulls to floats."""
    kind = dict(df.dtypes)["doc_id"]
    out = df.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(run, f"doc_id string, {schema}")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def clips(media: DataFrame) -> DataFrame:
    """Timed clips of each media row: doc_id, clip, first_frame, end_frame, start_s, end_s, brightness."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, data in zip(b["doc_id"], b["media"], strict=True):
                v = decode_avi(data)
                s = [*shot_starts(v.frames).tolist(), len(v.frames)]
                rows += [(doc, k, a, z, a / v.fps, z / v.fps, float(v.frames[a:z].mean())) for k, (a, z) in enumerate(zip(s, s[1:], strict=False))]
            yield pd.DataFrame(rows, columns=["doc_id", "clip", "first_frame", "end_frame", "start_s", "end_s", "brightness"])

    return _whole_ids(media.select("doc_id", "media"), run, "clip int, first_frame long, end_frame long, start_s double, end_s double, brightness double")


def media_digests(media: DataFrame) -> DataFrame:
    """What the stored bytes hold, read back: payload and media digests, and a feature of the shots."""

    def row(doc, n, data: bytes) -> tuple:
        v = decode_avi(data)
        payload = v.frames.tobytes()
        starts = shot_starts(v.frames)
        feature = f"frames={len(v.frames)};shots={len(starts)};cuts={zlib.crc32(starts.astype('<i8').tobytes()):08x};tones={zlib.crc32(histograms(v.frames).sum(0).astype('<i8').tobytes()):08x}"
        return doc, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(data), hashlib.sha256(data).hexdigest(), feature

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [row(*r) for r in zip(b["doc_id"], b["n_bytes"], b["media"], strict=True)]
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return _whole_ids(media, run, "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
