"""Parts that need no Spark."""

from __future__ import annotations

import io
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from graphloom.llm import huffman, language, media, minhash, packing, quality, vectors, warc
from graphloom.llm.queries import tokenizer_path
from graphloom.llm.tokens import Encoder
from tests.llm import reference

ODD = ["", "a  b", " x", "x \n y", "it's we'll DON'T", "<|endoftext|> a", "x <|endoftext|> y", "a<|startoftext|>B<|endoftext|>", "<|EndOfText|> <|endoftext", "ﬁ ÇA İstanbul ΟΔΟΣ", "a\tb", "é x", "1234 5,6!! \n\n z ", "\n", "  ", "Ñé× ÷ª", "x" * 5000, "naïve Größe ÀÉ", "a\x1cb\x85c", "𝒳 emoji 😀 end"]


@pytest.mark.parametrize(("name", "kind"), [("word_bpe_49k.json", "word"), ("byte_bpe_50k.json", "byte")])
def test_encoder_is_the_library(name, kind):
    enc = Encoder(tokenizer_path(name), kind, remember=40)
    library = Tokenizer.from_file(tokenizer_path(name))

    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.text(st.sampled_from("abcXYZ 019.,'!é\n\t-ßÑ") | st.characters(codec="utf-8"), max_size=60), max_size=5))
    def run(texts):
        texts = [*texts, *ODD]
        whole = library.encode_batch(texts, add_special_tokens=False)
        assert [np.frombuffer(b, "<u4").tolist() for b in enc.encode(texts)] == [e.ids for e in whole]

    run()
    assert enc.encode([None]) == [b""]


@pytest.mark.parametrize(("name", "kind"), [("word_bpe_49k.json", "word"), ("byte_bpe_50k.json", "byte")])
def test_texts_side_by_side_ask_for_each_piece_once(name, kind):
    enc, library = Encoder(tokenizer_path(name), kind), Tokenizer.from_file(tokenizer_path(name))
    texts = ["the cat'", "s 'll", "", "'re", "e'd've'S ''t", "'", "tß' 12 é3", None, "ö" * 70, "no\0w", "l", "\n'm"] * 300
    asked, look_up = [], enc.look_up
    enc.look_up = lambda pieces: asked.extend(pieces) or look_up(pieces)
    ids, sizes = enc.encode_all(texts, (7).to_bytes(4, "little"))
    want = [[*library.encode(t or "", add_special_tokens=False).ids, 7] for t in texts]
    assert ids.tolist() == [i for ids in want for i in ids] and sizes.tolist() == [len(w) for w in want]
    assert 10 < len(asked) == len(set(asked) - {b""}) + asked.count(b"") < 40


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=80), st.integers(30, 40))
def test_plan_is_best_fit_decreasing(lengths, capacity):
    counts = {n: lengths.count(n) for n in set(lengths)}
    runs, opened = packing.best_fit_plan(counts, capacity)
    fill: dict[int, list] = {}
    for n, a, z, first, per, at in runs:
        for rank in range(a, z):
            fill.setdefault(first + (rank - a) // per, []).append((at + (rank - a) % per * n, n))
    for parts in fill.values():
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
        assert end <= capacity
    assert len(fill) == opened
    assert sorted(capacity - sum(n for _, n in p) for p in fill.values()) == reference.best_fit(lengths, capacity)


def test_huffman_lengths_are_optimal_and_limited():
    rng = np.random.default_rng(1)
    counts = rng.zipf(1.3, 300)
    free = huffman.code_lengths(counts, 40)
    import heapq

    heap = [(int(c), k, 0) for k, c in enumerate(counts)]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a[0] + b[0]
        heapq.heappush(heap, (a[0] + b[0], -1, 0))
    assert int((free * counts).sum()) == cost
    short = huffman.code_lengths(counts, 9)
    assert short.max() <= 9 and (0.5 ** short.astype(float)).sum() == 1
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9, int), 3)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2000), max_size=700))
def test_huffman_round_trip(ids):
    ids = np.array(ids, np.uint32)
    codec = huffman.Codec(huffman.code_lengths(np.bincount(ids, minlength=5)))
    bits, points = codec.bits(ids)
    assert (codec.ids(bits, points, len(ids)) == ids).all()


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=0, max_size=900))
def test_avi_round_trip(data):
    payload = data.ljust(max(1, -(-len(data) // 192)) * 192, b" ")
    stored = media.encode_avi(payload)
    video = media.decode_avi(stored)
    assert video.frames.tobytes() == payload and video.fps == media.FPS
    at, size = media.frame_index(stored)[0][0]
    assert (media.decode_frame(stored[at : at + size]) == video.frames[0]).all()


def test_avi_rejects_damage_and_finds_shots():
    stored = media.encode_avi(bytes([10] * 192 * 20 + [200] * 192 * 20))
    assert media.shot_starts(media.decode_avi(stored).frames).tolist() == [0, 20]
    with pytest.raises(ValueError):
        media.decode_avi(stored[:-900])
    with pytest.raises(ValueError):
        media.decode_avi(b"RIFF" + stored[4:8] + b"WAVE" + stored[12:])


def test_warc_round_trip_and_errors():
    pages = [f"<p>{k} {'lorem ipsum ' * (k % 40)}</p>" for k in range(300)]
    records = [warc.page_record(k, f"http://x/{k}\r\ny", p, None if k % 3 else 0, "2024-01-01T00:00:00Z") for k, p in enumerate(pages)]
    out = io.BytesIO()
    assert warc.write_archive(out, iter(records), 1 << 30) == 300
    data = out.getvalue()
    assert data[:4] == (0x184D2A5D).to_bytes(4, "little")
    back = list(warc.read_archive(io.BytesIO(data), 1000))
    assert len(back) == 300 and not any(r.error for r in back)
    assert warc.http_parts(back[1].block)[1] == pages[1].encode() and back[3].headers["warc-type"] == "revisit" and back[0].headers["warc-type"] == "response"
    cut = list(warc.read_archive(io.BytesIO(data[:-5])))
    assert len(cut) == 300 and cut[-1].error
    assert warc.parse_record(b"WARC/1.1\r\nWARC-Type: response\r\n\r\n").error
    assert warc.parse_record(records[0].replace(b"Content-Length: ", b"Content-Length: 9", 1)).error


def test_first_met_counts_pairs_once():
    a = [np.array([1, 4]), np.array([2, 4]), np.array([1, 2, 4])]
    assert vectors.first_met(a, a, 4).tolist() == [[False, True, False], [True, False, False], [False, False, False]]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB c\n\t\x0b\x1cé"), max_size=40), min_size=1, max_size=6))
def test_shingle_sets(texts):
    for t in texts:
        assert len(minhash.shingle_set(t, 4)) == len(reference.shingles(t, 4))


def test_forward_backward_is_enumeration():
    rng = np.random.default_rng(3)
    lines, moves = np.array([1, 4, 2]), rng.normal(size=(2, 2))
    e = rng.normal(size=7)
    p = quality.forward_backward(e, lines, moves)[2]
    at = 0
    for n in lines:
        total, good = 0.0, np.zeros(n)
        for code in range(1 << n):
            y = [code >> k & 1 for k in range(n)]
            w = np.exp(sum(e[at + k] * y[k] for k in range(n)) + sum(moves[a, b] for a, b in zip(y, y[1:], strict=False)))
            total += w
            good += w * np.array(y)
        assert np.allclose(p[at : at + n], good / total)
        at += n


def test_quality_separates_and_handles_odd_texts():
    rng = np.random.default_rng(0)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    good = [" ".join(word() for _ in range(30)).capitalize() + ".\n" + word() for _ in range(60)]
    bad = [" ".join(word().upper() + "!!" for _ in range(30)) for _ in range(60)]
    field = quality.fit(good + bad, np.array([1] * 60 + [0] * 60))
    s = quality.scores(field, [*good, *bad, None, "", "\n\n", "x" * 100_000])
    assert s[:60].min() > 0.5 > s[60:120].max() and ((s >= 0) & (s <= 1)).all()
    assert quality.fit([], np.zeros(0, int)).constant == 0.5


def test_quality_slope_is_that_of_the_likelihood():
    rng = np.random.default_rng(5)
    texts, good = ["Ab c.\n\nX!! X!!\nmore", "one line", "a\nb\nc"], np.array([1, 0, 1])
    total, square, n, _ = quality.summed(texts)
    w = rng.normal(size=len(total) + 4) / 10
    made = lambda w: quality.Field(total / n, np.ones(len(total)), w[:-4], w[-4:].reshape(2, 2))
    value, g = quality.slope(made(w), texts, good)
    apart = [quality.slope(made(w), [t], good[k : k + 1]) for k, t in enumerate(texts)]
    assert np.isclose(value, sum(v for v, _ in apart)) and np.allclose(g, sum(h for _, h in apart))
    for k in (0, 1, 5, 30, 60, -4, -3, -2, -1):
        step = np.zeros_like(w)
        step[k] = 1e-5
        assert np.isclose((quality.slope(made(w + step), texts, good)[0] - quality.slope(made(w - step), texts, good)[0]) / 2e-5, g[k], atol=1e-5)


def test_line_features_do_not_depend_on_stretches():
    made = quality.Lines(["Ab c.\n\nX!! X!!\nX!! X!!\n" * 40, "one", "é\n" * 30, "", None])
    whole = next(made.features())[2]
    made.stretches = lambda: type(made).stretches(made, 300)
    parts = list(made.features())
    assert len(parts) > 5 and (np.concatenate([x for _, _, x in parts]) == whole).all()


def test_grams_of_a_text_do_not_depend_on_its_batch_or_stretches():
    texts = ["Hello wörld", "", "123", "a" * 300, "Ünd so weiter, ab und zu " * 30]
    text, bins, n, has = language.grams(texts)
    for k, t in enumerate(texts):
        for most in (1 << 20, 7):
            _, alone, times, own = language.grams([t], most)
            assert alone.tolist() == bins[text == k].tolist() and times.tolist() == n[text == k].tolist() and own[0] == has[k]
    assert has.tolist() == [True, False, False, True, True] and n[text == 1].sum() == 2 * language.ORDERS


def test_crc_of_ids():
    enc = Encoder(tokenizer_path("byte_bpe_50k.json"), "byte")
    assert zlib.crc32(enc.encode(["Hello world"])[0]) == zlib.crc32(np.array(Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json")).encode("Hello world", add_special_tokens=False).ids, "<u4").tobytes())
