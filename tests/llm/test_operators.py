"""Operators over Spark: contract results against plain versions, and awkward rows."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from graphloom.llm import huffman, language, media, minhash, mixing, packing, pii, quality, queries, vectors, warc
from graphloom.llm.idfilter import may_hold
from graphloom.llm.queries import tokenizer_path
from tests.llm import reference

LONG = "Die Größe " * 20_000
TEXTS = [
    None, "", " \n\t", "one", "one two three", "A b c d e f g h", "a B c d e f g h", "Mail a.b@c.de, or 10.0.0.1 and 999.1.1.1", "pay 4111 1111 1111 1111 now +49 (30) 1234-5678",
    "IBAN DE89 3704 0044 0532 0130 00 account", "x%_@y.z_w@q.r", "1.2.3.4.5.6.7.8", "+1 2", "😀 mail é@b.co a@b.co", LONG, "THIS!! IS!! BAD!!\n" * 5, "the same text again and again\n" * 3, "the same text again and again\n" * 3,
]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, label int, digest string"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(k, t, None if k % 5 == 0 else "en", None if k % 4 == 3 else f"s{k % 4}", len(t or ""), 0.5, 7, 1, "d") for k, t in enumerate(TEXTS)]
    rows += [(None, "one two three", None, None, None, None, None, None, None), rows[5], rows[5]]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark, small):
    return {r.doc_id: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}


def rows_of(df, key):
    got = df.collect()
    assert len({r[key] for r in got}) == len(got)
    return {r[key]: r for r in got}


def test_op1(spark, small):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    got = rows_of(queries.op1_warc(spark, small), "page_id")
    assert got.keys() == pages.keys()
    for k, html in pages.items():
        data = html.encode()
        assert (got[k].payload_bytes, got[k].payload_digest, got[k].error) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), None)


def test_warc_repeats_nulls_and_clashes(spark):
    schema = "page_id long, url string, html string, digest string, first_id long"
    rows = [(5, "u", "same"), (3, None, "same"), (9, "v", "same"), (None, "w", "same"), (1, "x", None), (2, "y", ""), (7, "z", "long " * 300_000)]
    pages = spark.createDataFrame([(*r, "clash", 0) for r in rows], schema)
    got = rows_of(warc.read_archives(warc.write_archives(pages, archive_bytes=200)), "page_id")
    assert {k: (r.record_type, r.refers_to) for k, r in got.items()} == {
        5: ("revisit", 3), 3: ("response", None), 9: ("revisit", 3), None: ("revisit", 3), 1: ("response", None), 2: ("revisit", 1), 7: ("response", None),
    }
    assert got[7].payload_bytes == 1_500_000 and got[3].url is None and all(r.error is None for r in got.values()) and got[5].payload_bytes == 4
    assert all(r.record_type == "response" for r in warc.read_archives(warc.write_archives(pages, min_revisit_bytes=5)).collect())
    assert warc.read_archives(warc.write_archives(spark.createDataFrame([], schema))).count() == 0


def test_damaged_archive_loses_one_record(spark):
    pages = spark.createDataFrame([(k, "u", f"page {k} " * 50) for k in range(20)], "page_id long, url string, html string").coalesce(1)
    archives = warc.write_archives(pages)
    (uri,) = [r.uri for r in archives.collect()]
    path = uri.removeprefix("file://")
    with open(path, "rb") as f:
        data = bytearray(f.read())
    at = data.index(b"\x28\xb5\x2f\xfd", 12)  # the first record's frame
    data[at + 40] ^= 0xFF
    with open(path, "wb") as f:
        f.write(data)
    got = warc.read_archives(archives).collect()
    sound = [r.page_id for r in got if r.error is None]
    assert len(sound) == len(set(sound)) == 19 and [r.error for r in got if r.error][-1] == "19 of 20 records read"


def test_op2_and_awkward_texts(spark, small, docs, odd, none):
    got = rows_of(queries.op2_quality(spark, small), "doc_id")
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    held = [k for k in label if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(got[k].held_out == (zlib.crc32(str(k).encode()) % 5 == 0) and 0 <= got[k].score <= 1 for k in got)
    by = {y: np.array([got[k].score for k in held if label[k] == y]) for y in (0, 1)}
    assert len(by[0]) and (by[1][:, None] > by[0]).mean() > 0.97  # area under the curve
    assert all(r.predicted == int(r.score >= 0.3) for r in got.values())
    mine = spark.read.parquet(f"{small}/documents.parquet")
    field = quality.train(mine, spark.read.parquet(f"{small}/labels.parquet"))
    learned = sorted(k for k in label if label[k] is not None and k not in held and k in docs)
    plain = quality.fit([docs[k].text for k in learned], np.array([label[k] for k in learned]))  # in memory, at once
    assert np.allclose(field.weights, plain.weights, atol=1e-3) and np.allclose(field.moves, plain.moves, atol=1e-3)
    for k in list(docs)[:20]:  # marginals by a plain pass in both directions
        lines = quality.Lines([docs[k].text])
        e, up, down = plain.emissions(lines), [], [np.ones(2)]
        step = np.exp(plain.moves)
        for x in e:
            v = np.array([1, np.exp(x)]) * (up[-1] @ step if up else 1)
            up.append(v / v.sum())
        for x in e[:0:-1]:
            v = step @ (np.array([1, np.exp(x)]) * down[-1])
            down.append(v / v.sum())
        p = np.array([(a * b)[1] / (a * b).sum() for a, b in zip(up, reversed(down), strict=True)])
        assert np.isclose((p * (lines.size + 1e-3)).sum() / (lines.size + 1e-3).sum(), got[k].score, atol=2e-3)
    labels = spark.createDataFrame([(k, int(k != 15), 0) for k in range(18)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    field = quality.train(odd, labels)
    scored = odd.select("doc_id", "text", quality.score_column(odd, field).alias("s")).collect()
    assert len(scored) == odd.count() and all(0 <= r.s <= 1 for r in scored)
    assert quality.train(none, labels).constant == 0.5 and none.select(quality.score_column(none, field)).count() == 0


def test_quality_of_repeated_and_long_rows(spark):
    """A doc_id on many rows is learned from once; a text of many lines is learned from whole."""
    good, bad = "A good line of words.\n" * 3, "BAD!! BAD!!\n" * 5_000
    rows = spark.createDataFrame([(1, good)] * 5_000 + [(2, bad), (3, good + "More."), (4, "BAD!!\n" * 3), (7, None)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0), (7, 0), (99, 1)], "doc_id long, quality int")
    field = quality.train(rows, labels)
    got = {r.doc_id: r.s for r in rows.select("doc_id", quality.score_column(rows, field).alias("s")).distinct().collect()}
    assert min(got[1], got[3]) > 0.5 > max(got[2], got[4])


def test_op3(spark, small, docs, odd, none):
    got = rows_of(queries.op3_media(spark, small), "doc_id")
    for k, d in docs.items():
        payload = media.padded(d.text)
        assert len(payload) % 192 == 0 and payload.startswith((d.text or "").encode())
        r = got[k]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len((d.text or "").encode()), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
    stored = media.to_media(odd)
    told = media.media_digests(stored).collect()
    assert len(told) == odd.count() and len({r.media_sha256 for r in told if r.payload_sha256 == told[0].payload_sha256}) == 1
    timed = media.clips(stored).collect()
    assert all(r.start_s < r.end_s for r in timed) and {r.doc_id for r in timed} == {*range(len(TEXTS)), None}
    assert media.media_digests(media.to_media(none)).count() == 0


def plain_vectors(rows, threshold):
    x = {k: np.array(v, float) for k, v in rows if v is not None and len(v) and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))}
    near = {(a, b) for a in x for b in x if a != b and len(x[a]) == len(x[b]) and x[a] @ x[b] / np.linalg.norm(x[a]) / np.linalg.norm(x[b]) >= threshold}
    root = reference.components([k for k, _ in rows], near)
    return {k: (sum(a == k for a, _ in near), root[k], root[k] == k) for k, _ in rows}


def test_op4_against_brute_force(spark, small):
    rng = np.random.default_rng(0)
    centre = rng.normal(size=(300, 16))
    rows = [(int(k), [float(c) for c in centre[rng.integers(300)] + rng.normal(size=16) * 0.12]) for k in rng.permutation(2500)]
    rows += [(3000 + k, rows[0][1]) for k in range(40)]
    rows += [(4000, None), (4001, [0.0] * 16), (4002, [1.0, None] + [0.0] * 14), (4003, [float("nan")] * 16), (4004, [float("inf")] + [0.0] * 15), (4005, []), (4006, [1.0, 2.0]), (4007, [2.0, 4.0])]
    df = spark.createDataFrame([(k, v, 0, 5) for k, v in rows], "vec_id long, embedding array<float>, n int, rep int")
    want = plain_vectors([(r.vec_id, r.embedding) for r in df.collect()], 0.9)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(df, leaf_rows=200, block_rows=90).collect()}
    assert got.keys() == want.keys()
    found, all_ = sum(v[0] for v in got.values()), sum(v[0] for v in want.values())
    assert 0.97 * all_ <= found <= all_ and np.mean([got[k] == want[k] for k in want]) > 0.9
    exact = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(df, leaf_rows=10_000, block_rows=500).collect()}
    assert exact == want
    assert vectors.near_vectors(df.limit(0)).count() == 0
    assert queries.op4_embedding_dedup(spark, small).count() == spark.read.parquet(f"{small}/embeddings.parquet").count()


def test_leaves_stay_small_and_links_are_found(spark, monkeypatch):
    """Leaves beyond what the first sample can split are split by samples of their own; pairs just over the threshold are found."""
    rng, n = np.random.default_rng(1), 6_000
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    x = unit(rng.standard_normal((n, 64)))
    e = rng.standard_normal((n // 4, 64))
    e = unit(e - (e * x[: n // 4]).sum(1, keepdims=True) * x[: n // 4])
    c = rng.uniform(0.9001, 0.92, (n // 4, 1))
    x[n // 4 : n // 2] = c * x[: n // 4] + np.sqrt(1 - c * c) * e
    sizes, refine = [], vectors.refine

    def seen(*args):
        out = refine(*args)
        sizes.extend(r["count"] for r in out.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect())
        return out

    monkeypatch.setattr(vectors, "refine", seen)
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>").repartition(4)
    got = {r.vec_id: r.component_id for r in vectors.near_vectors(rows, leaf_rows=128, sample_rows=256, leaf_sample=256).collect()}
    assert max(sizes) <= 256 and sum(sizes) < 14 * n
    assert np.mean([got[n // 4 + k] == k for k in range(n // 4)]) > 0.97


def test_repeated_vector_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.01]), (None, [1.0, 0.0])], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in vectors.near_vectors(df).where("vec_id is not null").collect())
    assert [(r[0], r[2]) for r in got] == [(1, 1), (1, 1), (2, 1)]


def test_op5(spark, small, docs, odd, none):
    got = rows_of(queries.op5_pii(spark, small), "doc_id")
    for k, d in docs.items():
        assert got[k].base_sha256 == hashlib.sha256(",".join(reference.base_spans(d.text)).encode()).hexdigest()
    found = pii.find_pii(odd).collect()
    assert len(found) == odd.count()
    for r in found:
        base = [f"{s.kind}:{s.start}:{s.end}" for s in r.pii_spans if s.kind in pii.BASE]
        assert base == reference.base_spans(r.text), r.text[:80]
    iban = [r for r in found if r.doc_id == 9][0]
    assert [(s.kind, iban.text[s.start : s.end]) for s in iban.pii_spans if s.kind == "iban"] == [("iban", "DE89 3704 0044 0532 0130 00")] and iban.pii_spans[0].score > 0.8
    hidden = {r.doc_id: r.m for r in pii.find_pii(odd).select("doc_id", pii.masked(F.col("pii_text"), F.col("pii_spans")).alias("m")).collect()}
    assert hidden[7] == "Mail [EMAIL], or [IP] and 999.1.1.1" and hidden[8] == "pay [CARD] now [PHONE]" and hidden[13] == "😀 mail é@b.co [EMAIL]" and hidden[14] == LONG
    assert pii.find_pii(none).count() == 0


def test_many_spans_of_a_text(spark):
    """Time grows with the spans of a text, not with their square."""
    n = 60_000
    row = pii.find_pii(spark.createDataFrame([("é 10.1.1.1 " * n, 5, "kept")], "text string, pii_spans int, email string")).withColumn("m", pii.masked(F.col("pii_text"), F.col("pii_spans")))
    got = row.select(F.size("pii_spans").alias("n"), F.col("pii_spans")[n - 1]["start"].alias("last"), F.sha2("m", 256).alias("m"), "email").first()
    assert (got.n, got.last, got.email) == (n, 11 * (n - 1) + 2, "kept") and got.m == hashlib.sha256(("é [IP] " * n).encode()).hexdigest()


def plain_mask(text, spans):
    out, at = [], 0
    for s in spans:
        if s.start >= at:
            out += [text[at : s.start], f"[{s.kind.upper()}]"]
        at = max(at, s.end)
    return "".join([*out, text[at:]])


def test_pii_spans_of_random_texts(spark):
    rng = np.random.default_rng(5)
    parts = ["a", "B", "@", ".", "1", "25", "+", " ", "-", "_", "%", "(", ")", "é", "4111111111111111", "10.1.1.1", "x@y.z"]
    texts = ["".join(rng.choice(parts, rng.integers(1, 40))) for _ in range(1500)] + ["7" * 60_000, "a" * 200_000, "a@b.c " * 1000, "+1 (2" * 3000]
    got = pii.find_pii(spark.createDataFrame([(t,) for t in texts], "text string")).withColumn("m", pii.masked(F.col("pii_text"), F.col("pii_spans"))).collect()
    for r in got:
        assert r.m == plain_mask(r.pii_text, r.pii_spans)
        assert [f"{s.kind}:{s.start}:{s.end}" for s in r.pii_spans if s.kind in pii.BASE] == reference.base_spans(r.text if len(r.text) < 100_000 else ""), r.text[:100]


def pieces_of(texts, capacity=2048):
    enc = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    out = {}
    for k, t in texts.items():
        ids = np.array([*enc.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for a in range(0, len(ids), capacity):
            out[k, a // capacity] = (a, len(ids[a : a + capacity]), zlib.crc32(ids[a : a + capacity].tobytes()))
    return out


def fill_of(rows, capacity=2048):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
        assert end <= capacity
    return bins


def test_op6(spark, small, docs, odd, none):
    got = queries.op6_packing(spark, small).collect()
    want = pieces_of({k: d.text for k, d in docs.items()})
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    assert sorted(2048 - sum(n for _, n in p) for p in fill_of(got).values()) == reference.best_fit([w[1] for w in want.values()], 2048)
    path = tokenizer_path("word_bpe_49k.json")
    marked = {1: "x <|endoftext|> y", 2: "<|startoftext|>"}
    packed = packing.pack_documents(spark.createDataFrame(list(marked.items()), "doc_id long, text string"), path).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in packed} == pieces_of(marked)
    packed = packing.pack_documents(odd, path, keep_ids=True)
    fill_of(packed.collect())
    whole = packing.sequences(packed).collect()
    assert all(len(r.ids) == 4 * r.n_ids for r in whole) and sum(r.n_ids for r in whole) == packed.agg(F.sum("length")).first()[0]
    assert packing.pack_documents(none, path).count() == 0


def test_op7(spark, small, docs, odd, none):
    got = rows_of(queries.op7_minhash_dedup(spark, small), "doc_id")
    want = reference.near_texts({k: d.text for k, d in docs.items()}, 4)
    assert {k: (r.n_shingles, r.component_id, r.kept) for k, r in got.items()} == {k: (n, c, c == k) for k, (n, c) in want.items()}
    told = minhash.near_texts(odd, shingle=4).collect()
    assert len(told) == odd.count()
    part = {r.doc_id: r for r in told}
    assert part[0].n_shingles == part[1].n_shingles == part[2].n_shingles == 0 and part[2].component_id == 2 and part[0].kept
    assert part[6].component_id == 5 and part[17].component_id == 16 and part[None].component_id == 4 and not part[None].kept
    assert minhash.near_texts(none).count() == 0


def test_crowded_near_copies(spark):
    rng = np.random.default_rng(2)
    base = [f"w{k}" for k in rng.integers(0, 9999, 120)]
    texts = {}
    for k in range(400):
        words = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 5)):
            words[at] = f"x{rng.integers(99)}"
        texts[k] = " ".join(words)
    texts |= {1000 + k: " ".join(f"v{j}" for j in rng.integers(0, 9999, 60)) for k in range(50)}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_texts(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), shingle=4, block_rows=16).collect()}
    assert got == reference.near_texts(texts, 4)


def test_edits_of_an_original_in_the_middle(spark):
    """A crowded region held together by one text that is not its smallest: edits link with it and not with each other."""
    base = [f"w{k}" for k in range(300)]
    texts = {k: " ".join(f"x{k}_{i}" if i in {(k * 7 + j * 60) % 300 for j in range(5)} else w for i, w in enumerate(base)) for k in range(240)}
    texts[120] = " ".join(base)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_texts(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), shingle=5, block_rows=16).collect()}
    assert got == reference.near_texts(texts, 5)


def test_links_of_a_crowded_region_below_its_prefix(spark):
    """Texts that share a passage crowd a region; a link in it need not agree on more values than the region does."""
    rng = np.random.default_rng(4)
    rows = lambda pairs: spark.createDataFrame(pairs, "rep long, sig binary, n_shingles long")
    sig = rng.integers(0, 1 << 16, (200, 72)).astype("<u2")
    sig[:, :3] = 7  # one region of the first tree
    sig[150] = sig[20]
    sig[150, 3] += 1  # parted at the fourth value; the other trees are made to tell nothing
    for t in range(1, 12):
        sig[150, 6 * t] += 1
    made = rows([(k, s.tobytes(), 100) for k, s in enumerate(sig)])
    found = minhash.regions(made, 12, 6, 3)
    alone = spark.createDataFrame([], "node long, component long")
    left = lambda rows: sorted(r.rep for r in minhash.unsettled(found, alone, [], 0.6, 80, rows).collect())
    assert left(256) == [20, 150] and left(32) == list(range(200))


def from_template(n, others, planted, words=900, seed=1):
    """Texts of a template and words of their own, any two of Jaccard ``others``; each tenth shares more with the one before it."""
    share = lambda j: 2 * j / (1 + j)
    common, more = int(share(others) * words), int(share(planted) * words)
    texts, last = {}, None
    for k in range(n):
        own = [f"u{k}x{i}" for i in range(words - common)]
        if k % 10 == 1:
            own = last[: more - common] + own[more - common :]
        texts[k], last = " ".join([*(f"t{i}" for i in range(common)), *own]), own
    return texts


@pytest.mark.parametrize(("n", "others", "planted", "block_rows"), [(400, 0.77, 0.815, 256), (400, 0.77, 0.815, 32), (1500, 0.72, 0.83, 256), (300, 0.70, 0.85, 16)])
def test_links_among_texts_of_a_template(spark, n, others, planted, block_rows):
    """One crowded region of texts that are nearly alike; only planted pairs link."""
    texts = from_template(n, others, planted)
    sets = {k: reference.shingles(texts[k], 4) for k in (10, 11, 12)}
    alike = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert alike(10, 11) >= 0.8 > alike(10, 12)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in minhash.near_texts(rows, shingle=4, block_rows=block_rows).collect()}
    assert got == {k: k - 1 if k % 10 == 1 else k for k in texts}


def test_id_filter(spark):
    ids = spark.createDataFrame([(k * 7 - 900,) for k in range(500)] + [(None,), (-900,)], "id long")
    rows = spark.createDataFrame([(k,) for k in range(-3000, 3000)] + [(None,)], "id long")
    want = {k * 7 - 900 for k in range(500)}
    held = {r.id for r in may_hold(ids, "id", 500)(rows, "id").where("asked").collect()}
    assert want <= held and None not in held and len(held) < len(want) + 60
    assert want <= {r.id for r in may_hold(ids, "id", 500, 1 << 6)(rows, "id").where("asked").collect()}
    assert may_hold(ids.limit(0), "id", 0)(rows, "id").where("asked").count() == 0


def test_rows_that_repeat_a_doc_id(spark):
    words = " ".join(f"w{k}" for k in range(60))
    rows = [(1, words)] * 300 + [(1, "another text of this id")] + [(2, words + " end")] * 300 + [(3, "far from all of them")]
    got = minhash.near_texts(spark.createDataFrame(rows, "doc_id long, text string"), shingle=4).groupBy("doc_id", "component_id").count().collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 301), (2, 1, 300), (3, 3, 1)]


def test_op8(spark, small, docs, odd, none):
    got = rows_of(queries.op8_token_output(spark, small), "doc_id")
    enc = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    at = 0
    for k in sorted(docs):
        ids = np.array([*enc.encode(docs[k].text or "", add_special_tokens=False).ids, 0], "<u4")
        assert (got[k].start, got[k].n_tokens, got[k].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    path = tokenizer_path("byte_bpe_50k.json")
    marked = spark.createDataFrame([(1, "x <|endoftext|> y"), (2, "z")], "doc_id long, text string")
    first = min(huffman.read_files(huffman.encode_documents(marked, path)).collect(), key=lambda r: r.start)
    assert first.ids_crc32 == zlib.crc32(np.array([*enc.encode("x <|endoftext|> y", add_special_tokens=False).ids, 0], "<u4").tobytes())
    back = sorted(huffman.read_files(huffman.encode_documents(odd, path)).collect(), key=lambda r: r.start)
    assert len(back) == odd.count() and back[-1].doc_id is None and [r.start for r in back] == np.cumsum([0, *[r.n_tokens for r in back[:-1]]]).tolist()
    assert huffman.read_files(huffman.encode_documents(none, path)).count() == 0


def test_op8_in_small_blocks(spark, small, odd, monkeypatch):
    path = tokenizer_path("byte_bpe_50k.json")
    for table in (spark.read.parquet(f"{small}/documents.parquet").limit(60), odd):
        want = sorted(map(str, huffman.read_files(huffman.encode_documents(table, path)).collect()))
        with monkeypatch.context() as m:
            m.setattr(huffman, "BLOCK_IDS", 50)
            m.setattr(huffman, "CHARS", 3_000)
            blocks = huffman.token_blocks(table, path)
            assert blocks.count() > 3
            assert sorted(map(str, huffman.read_files(huffman.encode_documents(table, path)).collect())) == want


def targets_of(size):
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    full: set = set()
    while True:
        rest = [s for s in names if s not in full]
        level = (1.5 * sum(size.values()) - sum(2 * size[s] for s in full)) / max(1e-9, sum(weight[s] for s in rest))
        over = {s for s in rest if level * weight[s] > 2 * size[s]}
        if not over:
            return {s: float(2 * size[s]) if s in full else level * weight[s] for s in names}
        full |= over


def test_op9(spark, small, docs, odd, none):
    got = rows_of(queries.op9_mixing(spark, small), "doc_id")
    size = {k: len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) for k, d in docs.items()}
    source, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for k, d in docs.items():
        source[d.source] += size[k]
        largest[d.source] = max(largest[d.source], size[k])
        taken[d.source] += got[k].taken
        assert got[k].size == size[k] and 0 <= got[k].taken <= 2 * size[k]
    want = targets_of(source)
    for k, d in docs.items():
        assert got[k].source_size == source[d.source] and got[k].target == pytest.approx(want[d.source])
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in want)
    assert got == rows_of(queries.op9_mixing(spark, small), "doc_id")
    mixed = mixing.mix(odd)
    assert mixed.count() == odd.count() and mixed.where("size = 0 and taken > 0").count() == 0
    out = mixing.mixed_documents(odd, mixed)
    assert out.columns == odd.columns and out.count() == mixed.agg(F.sum("copies")).first()[0]
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none, mixing.mix(none)).count() == 0


def test_equal_rows_are_mixed_each_for_itself(spark):
    rows = [(1, "w " * 4, "s", 0, 0)] * 3_000 + [(None, "w " * 4, "s", 0, 0)] * 500 + [(k, "x " * 3, None, 0, 0) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_id int, copies int").repartition(5)
    mixed = mixing.mix(docs)
    assert mixed.count() == len(rows)
    for r in mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r.taken - r.target) <= 4
    out = mixing.mixed_documents(docs, mixed)
    assert out.columns == docs.columns and out.count() == mixed.agg(F.sum("copies")).first()[0]
    assert {r.copies for r in out.select("copies").distinct().collect()} == {0}


def test_columns_of_clashing_names(spark):
    pieces = spark.createDataFrame([(k, 0, 100 + k % 7, 5, 1, 2, 3, 4) for k in range(60)], "doc_id long, piece int, length long, ids_crc32 long, salt int, rank int, run int, base int")
    packed = packing.pack(pieces, 256)
    assert packed.columns == [*pieces.columns, "sequence_id", "offset"] and {tuple(r[4:8]) for r in packed.collect()} == {(1, 2, 3, 4)}
    docs = spark.createDataFrame([(1, "one two three four five six", 1, 2, 3, 4), (2, "one two three four five six", 5, 6, 7, 8)], "doc_id long, text string, asked int, own_id int, row int, dropped_id int")
    assert [tuple(r)[2:] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()] == [(1, 2, 3, 4)]


def test_mixing_is_unbiased(spark):
    rows = spark.createDataFrame([(k, "w " * (1 + k % 9), "s" if k < 300 else "t") for k in range(500)], "doc_id long, text string, source string")
    seen = [mixing.mix(rows, block=8, seed=s).select("doc_id", "copies", "target", "source_size").collect() for s in range(5)]
    rate = {r.doc_id: r.target / r.source_size for r in seen[0]}
    mean = np.mean([[r.copies - rate[r.doc_id] for r in one] for one in seen])
    assert abs(mean) < 0.05 and all(int(rate[r.doc_id] + 1e-9) <= r.copies <= int(rate[r.doc_id] + 1e-9) + 1 for one in seen for r in one)


def test_op10(spark, small, docs, odd, none):
    got = rows_of(queries.op10_language(spark, small), "doc_id")
    held = [k for k in docs if zlib.crc32(str(k).encode()) % 3 == 1]
    assert all(got[k].held_out == (k in set(held)) for k in docs)
    assert np.mean([got[k].lang_pred == docs[k].lang for k in held]) > 0.95
    def grams_of(text):
        low = [c if c.isalpha() else " " for c in f" {(text or '').lower()} "] + [" "] * 3
        for at in range(len(low) - 3):
            h = 0
            for k in range(language.ORDERS):
                h = ((h ^ ord(low[at + k])) * 0x9E3779B1 + k + 1) % 2**32
                yield (h ^ h >> 15) % language.BINS

    counts = defaultdict(lambda: np.full(language.BINS, 0.5))
    for k, d in docs.items():
        if k not in set(held) and d.lang is not None and d.text is not None:
            np.add.at(counts[d.lang], list(grams_of(d.text)), 1)
    logs = {lang: np.log(c / c.sum()) for lang, c in counts.items()}
    for k in list(docs)[:60]:  # a plain naive Bayes of the same bins
        each = {lang: table[list(grams_of(docs[k].text))].sum() for lang, table in logs.items()}
        top = max(each.values())
        if any(c.isalpha() for c in docs[k].text or ""):
            assert each[got[k].lang_pred] == top and got[k].score == pytest.approx(1 / sum(np.exp(v - top) for v in each.values()), abs=1e-3)
    told = language.predict(odd, language.train(odd)).select("doc_id", "text", "lid.*").collect()
    assert len(told) == odd.count() and all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.score <= 1 for r in told)
    empty = language.train(none)
    assert {r.lang_pred for r in language.predict(odd, empty).select("lid.lang_pred").collect()} == {"und"} and language.predict(none, empty).count() == 0


def test_rare_languages_among_many_unlabelled(spark):
    rows = [(k, "the cat", None) for k in range(5000)] + [(5000 + k, "der Hund", "de") for k in range(300)] + [(6000 + k, "le chien", "fr") for k in range(12)]
    langs, _ = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), fit_docs=50)
    assert langs == ["de", "fr"]


def test_stages_on_awkward_rows(spark, odd, none, small):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for given in (odd, none):
            made = stage(spark, given, small)
            assert made.columns == given.columns
            made.collect()
    kept = corpus_pipeline.drop_near_duplicates(spark, odd, small).collect()
    ids = [r.doc_id for r in kept]
    assert sorted(x for x in ids if x is not None) == [k for k in range(len(TEXTS)) if k not in (6, 17)] and ids.count(None) == 1
    assert corpus_pipeline.mask_pii(spark, odd, small).where("doc_id = 7").first().text == "Mail [EMAIL], or [IP] and 999.1.1.1"
    assert corpus_pipeline.pack_sequences(spark, none, small).count() == 0


def test_pipeline_against_plain_stages(spark, small, docs):
    """Each stage's decisions, by plain versions of what it decides on."""
    rows = spark.read.parquet(f"{small}/documents.parquet")
    good = corpus_pipeline.filter_quality(spark, rows, small)
    score = rows_of(queries.op2_quality(spark, small), "doc_id")
    kept = {r.doc_id: r.text for r in good.collect()}
    assert set(kept) == {k for k in docs if score[k].score >= 0.3}
    alone = corpus_pipeline.drop_near_duplicates(spark, good, small)
    want = reference.near_texts(kept, 5)
    kept = {r.doc_id: r.text for r in alone.collect()}
    assert set(kept) == {k for k, (_, c) in want.items() if c == k}
    masked = corpus_pipeline.mask_pii(spark, alone, small)
    hidden = {r.doc_id: r for r in masked.collect()}
    for k, t in kept.items():
        spans = [s.split(":") for s in reference.base_spans(t)]
        assert hidden[k].n_chars == len(hidden[k].text) and (spans or hidden[k].text == t) and not reference.base_spans(hidden[k].text)
    mixed = corpus_pipeline.mix_sources(spark, masked, small)
    copies = {r.doc_id: r.copies for r in mixing.mix(masked).collect()}
    times = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert times == {k: n for k, n in copies.items() if n}
    packed = corpus_pipeline.pack_sequences(spark, mixed, small).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == sorted((k, p, *v) for (k, p), v in pieces_of({k: hidden[k].text for k in times}).items() for _ in range(times[k]))
    fill_of(packed)
    assert sorted(map(tuple, corpus_pipeline.run(spark, small).select("doc_id", "piece", "ids_crc32").collect())) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in packed)
