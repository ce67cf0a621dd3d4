"""WARC archives under Zstandard: a dictionary in a leading skippable frame, one frame per record."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.files import new_file, read_file
from graphloom.storage import materialize, scratch_path

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_FRAME = 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = "<urn:page:{}>"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@dataclass
class Record:
    """headers by lower-case name; block is what stands between header and end; error: what is wrong."""

    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""
    error: str | None = None


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {re.sub(r'[\x00-\x1f\x7f]', lambda m: f'%{ord(m[0]):02X}', v)}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> Record:
    """Check the version line, the header lines and the lengths of one decompressed frame."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    out = Record()
    if not sep or not re.fullmatch(rb"WARC/1\.[01]", first):
        out.error = "no WARC header"
        return out
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not re.fullmatch(rb"[!-9;-~]+", name):
            out.error = "bad header line"
            return out
        out.headers[name.decode().lower()] = value.strip().decode("utf-8", "replace")
    if missing := [k for k in ("warc-type", "warc-record-id", "warc-date", "content-length") if k not in out.headers]:
        out.error = f"no {missing[0]}"
    elif not re.fullmatch(r"[0-9]+", out.headers["content-length"]):
        out.error = "bad content-length"
    elif len(rest) != int(out.headers["content-length"]) + 4 or not rest.endswith(b"\r\n\r\n"):
        out.error = "content-length differs from the block"
    else:
        out.block = rest[:-4]
    return out


def http_parts(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, payload = block.partition(b"\r\n\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.decode("latin-1").partition(":") for x in head.split(b"\r\n")[1:])}, payload


def train_dictionary(records: list[bytes], size: int = 1 << 16) -> bytes:
    """A dictionary from these records; none where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, records).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def write_archive(out, records: Iterator[bytes], limit: int, sample: int = 200, sample_bytes: int = 1 << 22) -> tuple[int, bytes | None]:
    """Write records until the archive has ``limit`` bytes.

    The dictionary is trained on the archive's first records, up to ``sample`` of them or
    ``sample_bytes``; it only changes the compressed size. Returns the number written.
    """
    first, held = [], 0
    for r in records:
        first.append(r)
        held += len(r)
        if len(first) >= sample or held >= sample_bytes:
            break
    trained = train_dictionary(first)
    if trained:
        packed = zstandard.compress(trained)
        out.write(struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed)
    press = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(trained) if trained else None, write_checksum=True)
    n = size = 0
    for r in first:
        size += out.write(press.compress(r)) or 0
        n += 1
    while size < limit and (r := next(records, None)) is not None:
        size += out.write(press.compress(r)) or 0
        n += 1
    return n


def read_archive(file, chunk: int = 1 << 20) -> Iterator[Record]:
    """Records of an archive, frame by frame; memory is bound by the longest record.

    A frame that can't be decoded gives a record with an error; reading goes on at the next one.
    """
    data = file.read(chunk)
    trained = None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_FRAME:
        (size,) = struct.unpack_from("<I", data, 4)
        while len(data) < 8 + size and (more := file.read(chunk)):
            data += more
        content, data = data[8 : 8 + size], data[8 + size :]
        if len(content) < size:
            yield Record(error="the dictionary is cut off")
            return
        if content[:4] == struct.pack("<I", ZSTD_FRAME):
            content = zstandard.decompress(content)
        trained = zstandard.ZstdCompressionDict(content)
    frames = zstandard.ZstdDecompressor(dict_data=trained) if trained else zstandard.ZstdDecompressor()
    held = bytearray(data)  # from the beginning of a frame on
    while held or held.extend(file.read(chunk)) or held:
        one, parts, piece = frames.decompressobj(), [], bytes(held)
        try:
            while True:
                parts.append(one.decompress(piece))
                if one.eof:
                    break
                if not (piece := file.read(chunk)):
                    raise zstandard.ZstdError("a frame is cut off")
                held += piece
        except zstandard.ZstdError as e:
            yield Record(error=str(e))
            begin = struct.pack("<I", ZSTD_FRAME)
            while (at := held.find(begin, 1)) < 0 and (piece := file.read(chunk)):
                held = held[-3:] + piece if len(held) > 3 else held + piece
            held = held[at:] if at > 0 else bytearray()
            continue
        held = bytearray(one.unused_data)
        yield parse_record(b"".join(parts))


def plan_records(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """page_id, url, html, first_id: the smallest page_id among equal payloads, if there are several.

    Payloads under ``min_revisit_bytes`` stand alone. Rows that repeat a page_id and payload are
    all responses where they hold the smallest id; a null page_id never is the smallest.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.when(F.octet_length("html") >= min_revisit_bytes, F.sha1(F.col("html").cast("binary"))))
    several = rows.where("digest is not null").groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    return rows.join(materialize(several, "payloads"), "digest", "left").drop("digest")


def page_record(page_id, url, html: str, first_id, date: str) -> bytes:
    payload = html.encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    name = lambda k: RECORD.format("null" if pd.isna(k) else int(k))
    again = not pd.isna(first_id) and (pd.isna(page_id) or page_id != first_id)
    headers = [("WARC-Type", "revisit" if again else "response"), ("WARC-Record-ID", name(page_id)), ("WARC-Date", date)]
    headers += [("WARC-Target-URI", url)] * (url is not None)
    headers += [("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}")]
    if again:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", name(first_id))]
    return record_bytes([*headers, ("Content-Type", "application/http;msgtype=response")], http if again else http + payload)


def write_archives(pages: DataFrame, folder: str | None = None, min_revisit_bytes: int = 0, archive_bytes: int = 1 << 28, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write one record per page and return the written table of archives: uri, n_records."""
    folder = folder or scratch_path(pages.sparkSession, "warc")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def records():
            for b in batches:
                for r in b.itertuples(index=False):
                    yield page_record(r.page_id, r.url, r.html, r.first_id, date)

        todo = records()
        while (first := next(todo, None)) is not None:

            def rest(first=first):
                yield first
                yield from todo

            with new_file(folder, "pages", ".warc.zst") as (uri, out):
                n = write_archive(out, rest(), archive_bytes)
            yield pd.DataFrame({"uri": [uri], "n_records": [n]})

    rows = plan_records(pages, min_revisit_bytes).select(F.col("page_id").cast("decimal(20,0)").cast("string").alias("page_id"), "url", "html", F.col("first_id").cast("decimal(20,0)").cast("string").alias("first_id"))
    return materialize(rows.mapInPandas(_as_ids(run), "uri string, n_records long"), "archives")


def _as_ids(run):
    """Ids travel as text, since pandas would turn columns with nulls to floats."""

    def wrapped(batches):
        def whole():
            for b in batches:
                for c in ("page_id", "first_id"):
                    b[c] = pd.array([None if x is None else int(x) for x in b[c]], dtype="Int64").astype(object)
                yield b

        return run(whole())

    return wrapped


def read_archives(archives: DataFrame) -> DataFrame:
    """One row per record: page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload, error.

    A response's length and digest are those of the payload read, and error says where they differ
    from its headers. An archive that gives another number of sound records than were written gets
    one more row with an error that tells both. A revisit holds no payload: its length and digest are what it states.
    """
    number = lambda x: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?[0-9]+)>", x or "")) else None

    def row(r: Record) -> tuple:
        h = r.headers
        if r.error:
            return number(h.get("warc-record-id")), h.get("warc-target-uri"), h.get("warc-type"), None, None, None, None, r.error
        http, payload = http_parts(r.block)
        stated, length = h.get("warc-payload-digest", "").removeprefix("sha1:"), int(http.get("content-length", -1))
        digest, error = stated, None
        if h["warc-type"] == "response":
            digest = base32_sha1(payload)
            error = "payload differs from its digest" if digest != stated else "payload differs from its length" if length != len(payload) else None
            length = len(payload)
        return number(h["warc-record-id"]), h.get("warc-target-uri"), h["warc-type"], length, digest, number(h.get("warc-refers-to")), payload, error

    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload", "error"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def made(rows):
            out = pd.DataFrame(rows, columns=names)
            return out.astype({c: "Int64" for c in ("page_id", "payload_bytes", "refers_to")})

        for b in batches:
            for uri, written in zip(b["uri"], b["n_records"], strict=True):
                rows, size, sound = [], 0, 0
                with read_file(uri) as file:
                    for r in read_archive(file):
                        rows.append(row(r))
                        size += len(r.block)
                        sound += r.error is None
                        if len(rows) >= 1000 or size > 1 << 24:
                            yield made(rows)
                            rows, size = [], 0
                if sound != written:
                    rows.append((*[None] * 7, f"{sound} of {written} records read"))
                if rows:
                    yield made(rows)

    n = max(1, min(archives.count(), 20_000))
    return archives.select("uri", "n_records").repartition(n, "uri").mapInPandas(run, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary, error string")
