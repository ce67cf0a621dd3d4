"""Quality of documents by a linear-chain conditional random field over their lines.

Each line gets features of its own and of its neighbours. The field labels lines bad or good; its
forward-backward marginals, weighted by the lines' lengths, make the document's score. Chains of
two states are handled by log odds, and all documents of a batch move one line at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.storage import materialize

CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b".,;:'\"()-", b"!?", b"*#$%&@^~=+<>/\\_`{}[]", b"|", bytes(range(128, 256))]
OWN = 2 + 2 * len(CLASSES) + 6


def _tables() -> tuple[np.ndarray, np.ndarray]:
    kind = np.full(256, len(CLASSES), np.uint8)
    for k, chars in enumerate(CLASSES):
        kind[list(chars)] = k
    noise = np.random.default_rng(7).integers(1, 1 << 62, 256, np.uint64)
    noise[[9, 10, 13, 32]] = 0
    return kind, noise


KIND, NOISE = _tables()


class Lines:
    """The lines of some texts, cut at line feeds; their features are made a stretch of lines at a time."""

    def __init__(self, texts: list[str | None]):
        raw = [(t or "").encode() + b"\n" for t in texts]
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        self.ends = np.flatnonzero(self.data == 10)
        self.begins = np.concatenate([[0], self.ends[:-1] + 1])
        self.lines = np.diff(np.searchsorted(self.ends, np.cumsum([len(r) for r in raw])), prepend=0)
        self.doc = np.repeat(np.arange(len(raw)), self.lines)
        self.size = self.ends - self.begins
        key = np.empty(len(self.ends), np.uint64)
        for lo, hi in self.stretches():
            at = self.begins[lo]
            key[lo:hi] = np.add.reduceat(NOISE[self.data[at : self.ends[hi - 1] + 1]], self.begins[lo:hi] - at)
        _, at, times = np.unique(key ^ (self.doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
        self.times = times[at]

    def stretches(self, most: int = 1 << 22) -> Iterator[tuple[int, int]]:
        """Ranges of lines of a bounded number of bytes, a longer line alone; a line counts 64 bytes at least."""
        cost = np.cumsum(np.maximum(self.size, 64))
        lo = 0
        while lo < len(cost):
            hi = max(lo + 1, int(np.searchsorted(cost, (cost[lo - 1] if lo else 0) + most, "right")))
            yield lo, hi
            lo = hi

    def own(self, lo: int, hi: int) -> np.ndarray:
        """Features of lines lo to hi without their neighbours."""
        shift = self.begins[lo]
        data = self.data[shift : self.ends[hi - 1] + 1]
        begins, ends, size = self.begins[lo:hi] - shift, self.ends[lo:hi] - shift, self.size[lo:hi]
        whole = np.maximum(size, 1)
        kind = KIND[data]
        own = np.zeros((hi - lo, OWN), np.float32)
        own[:, 0] = 1
        own[:, 1] = np.log1p(size)
        for k in range(len(CLASSES)):
            share = np.add.reduceat(kind == k, begins, dtype=np.int32) / whole
            own[:, 2 + k], own[:, 2 + len(CLASSES) + k] = share, np.sqrt(share)
        gap = (kind == 3) | (data == 10)
        starts = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
        n = 2 + 2 * len(CLASSES)
        if len(starts):
            word = np.add.reduceat(NOISE[data], starts)  # white space adds nothing
            line = np.searchsorted(ends, starts)
            words = np.bincount(line, minlength=hi - lo)
            again = np.concatenate([[False], (word[1:] == word[:-1]) & (line[1:] == line[:-1])])
            own[:, n] = np.bincount(line, again, hi - lo) / np.maximum(words, 1)
            own[:, n + 1] = size / np.maximum(words, 1) / 10
            own[:, n + 2] = np.log1p(words)
        own[:, n + 3] = np.log(self.times[lo:hi]) * (size > 0)
        own[:, n + 4] = np.isin(kind[begins], (1, 8)) & (size > 0)
        own[:, n + 5] = (data[np.maximum(ends - 1, 0)] == ord(".")) & (size > 0)
        return own

    def features(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """Ranges of lines with the features of each and of the lines before and after it in its text."""
        for lo, hi in self.stretches():
            first, last = max(0, lo - 1), min(len(self.doc), hi + 1)
            own, doc = self.own(first, last), self.doc[first:last]
            same = (doc[1:] == doc[:-1])[:, None]
            zero = np.zeros((1, OWN), np.float32)
            before, after = np.concatenate([zero, own[:-1] * same]), np.concatenate([own[1:] * same, zero])
            yield lo, hi, np.concatenate([own, before, after], 1)[lo - first : hi - first]


@dataclass
class Field:
    """weights of features for a good line; moves[i, j] for label i before label j."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    moves: np.ndarray
    constant: float | None = None

    def emissions(self, lines: Lines) -> np.ndarray:
        out = np.empty(len(lines.doc))
        for lo, hi, x in lines.features():
            out[lo:hi] = ((x - self.mean) / self.spread) @ self.weights
        return out


def _chains(lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of texts by falling number of lines, and where each begins."""
    order = np.argsort(-lines, kind="stable")
    return order, (np.cumsum(lines) - lines)[order]


def forward_backward(e: np.ndarray, lines: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log odds of good from the lines up to each, from those after it, and the marginal."""
    order, at = _chains(lines)
    ahead, back = np.zeros(len(e)), np.zeros(len(e))
    long = lines[order]
    m = None
    for t in range(int(long[0]) if len(long) else 0):
        live = int(np.searchsorted(-long, -t, "left"))  # texts of more than t lines
        k = at[:live] + t
        m = e[k] if t == 0 else e[k] + np.logaddexp(m[:live] + moves[1, 1], moves[0, 1]) - np.logaddexp(m[:live] + moves[1, 0], moves[0, 0])
        ahead[k] = m
    for t in range(int(long[0]) - 2 if len(long) else -1, -1, -1):
        live = int(np.searchsorted(-long, -(t + 1), "left"))
        k = at[:live] + t
        b = back[k + 1] + e[k + 1]
        back[k] = np.logaddexp(b + moves[1, 1], moves[1, 0]) - np.logaddexp(b + moves[0, 1], moves[0, 0])
    return ahead, back, 1 / (1 + np.exp(-np.clip(ahead + back, -60, 60)))


def summed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, int, float]:
    """Sums of features and of their squares over all lines, the number of lines, and of what texts weigh by line."""
    lines = Lines(texts)
    total, square = np.zeros(3 * OWN), np.zeros(3 * OWN)
    for _, _, x in lines.features():
        total += x.sum(0, dtype=np.float64)
        square += (x.astype(np.float64) ** 2).sum(0)
    return total, square, len(lines.doc), float(np.sqrt(lines.lines).sum())


def slope(field: Field, texts: list[str | None], good: np.ndarray) -> tuple[float, np.ndarray]:
    """Log likelihood of line labels, each line labelled as its text is, and its gradient by weights and moves.

    A text weighs one over the root of its number of lines.
    """
    made = Lines(texts)
    e, lines, moves = field.emissions(made), made.lines, field.moves
    y = np.repeat(good, lines).astype(np.float64)
    weight = np.repeat(1 / np.sqrt(lines), lines)
    ahead, back, p = forward_backward(e, lines, moves)
    inner = np.ones(len(y), bool)
    last = np.cumsum(lines) - 1
    inner[last] = False  # lines with one after them
    k = np.flatnonzero(inner)
    label = y[k].astype(int)
    value = weight @ (y * e) + weight[k] @ (moves[label, label] - np.logaddexp(ahead[k] + moves[1, 0], moves[0, 0])) - weight[last] @ np.logaddexp(0, ahead[last])
    out = np.zeros(3 * OWN + 4)
    for lo, hi, x in made.features():
        out[:-4] += (weight[lo:hi] * (y[lo:hi] - p[lo:hi])) @ ((x - field.mean) / field.spread)
    b = back[k + 1] + e[k + 1]
    joint = np.stack([moves[i, j] + i * ahead[k] + j * b for i in (0, 1) for j in (0, 1)])
    joint = np.exp(joint - joint.max(0)) if len(k) else joint
    joint /= joint.sum(0)
    seen = np.stack([(label == i) & (label == j) for i in (0, 1) for j in (0, 1)])
    out[-4:] = (seen - joint) @ weight[k]
    return float(value), out


def ascend(value_and_slope, n: int, steps: int = 24, memory: int = 8) -> np.ndarray:
    """A maximum of a concave function, from zero, by limited-memory quasi-Newton steps."""
    w = np.zeros(n)
    value, g = value_and_slope(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d, scale = g.copy(), []
        for s, y in reversed(past):
            scale.append((s @ d) / (s @ y))
            d -= scale[-1] * y
        d *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / max(1e-12, np.linalg.norm(g))
        for (s, y), a in zip(past, reversed(scale), strict=True):
            d += (a - (y @ d) / (s @ y)) * s
        step = 1.0
        while True:
            there, h = value_and_slope(w + step * d)
            if there >= value + 1e-4 * step * (g @ d):
                break
            step /= 4
            if step < 1e-4:
                return w
        if (s := step * d) @ (y := g - h) > 1e-12:
            past = [*past, (s, y)][-memory:]
        gained = there - value
        w, value, g = w + s, there, h
        if gained < 1e-5 * max(1e-3, abs(value)):
            break
    return w


def fitted(total: np.ndarray, square: np.ndarray, n: int, whole: float, slope_of, ridge: float = 0.02, steps: int = 24) -> Field:
    """The field that maximizes the likelihood less a ridge; slope_of gives a field's likelihood and gradient over all texts."""
    mean = total / n
    spread = np.sqrt(np.maximum(square / n - mean**2, 0))
    mean[0], spread[0] = 0, 1
    spread[spread < 1e-6] = 1
    made = lambda w: Field(mean, spread, w[:-4], w[-4:].reshape(2, 2))
    pull = np.full(len(mean) + 4, ridge / 10)
    pull[-4:] += ridge

    def at(w):
        value, g = slope_of(made(w))
        return value / whole - (pull * w**2).sum() / 2, g / whole - pull * w

    return made(ascend(at, len(pull), steps))


def fit(texts: list[str | None], good: np.ndarray) -> Field:
    """A field from texts in memory."""
    if len(good) == 0 or min(good) == max(good):
        return Field(np.zeros(0), np.zeros(0), np.zeros(0), np.zeros((2, 2)), float(good[0]) if len(good) else 0.5)
    return fitted(*summed(texts), lambda field: slope(field, texts, np.asarray(good)))


def scores(field: Field, texts: list[str | None]) -> np.ndarray:
    """Length-weighted marginals of good lines; a text without bytes counts as one line."""
    if field.constant is not None:
        return np.full(len(texts), field.constant)
    made = Lines(texts)
    p = forward_backward(field.emissions(made), made.lines, field.moves)[2]
    begin = np.cumsum(made.lines) - made.lines
    weight = made.size + 1e-3
    return np.clip(np.add.reduceat(p * weight, begin) / np.add.reduceat(weight, begin), 0, 1)


def slices(texts: list[str | None], most: int = 2 << 20) -> Iterator[list[str | None]]:
    """Stretches of a bounded number of characters, a longer text alone."""
    part, size = [], 0
    for t in texts:
        n = len(t or "")
        if part and size + n > most:
            yield part
            part, size = [], 0
        part.append(t)
        size += n
    if part:
        yield part


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds == fold


def train(docs: DataFrame, labels: DataFrame, fit_docs: int = 3_000) -> Field:
    """Fit on labelled rows outside the held-out fold, ``fit_docs`` of them at most, whole texts of any length.

    Rows are drawn by a hash of doc_id. Of several labels of a document the largest counts, of
    several rows of a doc_id the smallest text; a null text is empty. Lines have no labels of their
    own: each bears its document's, so moves between labels are only learned from the lack of them.
    Without labels, or with one kind only, the field is a constant. Likelihood and gradient are
    summed where the texts lie; the driver gets a few hundred numbers a step.
    """
    spark = docs.sparkSession
    drawn = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").cast("int").alias("good"))
    drawn = drawn.where(~held_out(F.col("doc_id"), 5, 0)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_docs)
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(drawn), "doc_id")  # fit_docs rows
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("good").alias("good"))
    rows = materialize(rows.select("text", "good").repartition(-(-fit_docs // 200)), "fit-texts")
    good = {r.good: r.n for r in rows.groupBy("good").agg(F.count("*").alias("n")).collect()}
    if len(good) < 2:
        return fit([], np.array(list(good)))

    def over_rows(f) -> np.ndarray:
        """The sum of f(texts, labels) over all rows; f is a vector."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = None
            for b in batches:
                at = 0
                for part in slices(b["text"].tolist()):
                    got = f(part, b["good"].to_numpy()[at : at + len(part)])
                    total, at = got if total is None else total + got, at + len(part)
            if total is not None:
                yield pd.DataFrame({"sum": [total.tobytes()]})

        return np.sum([np.frombuffer(r[0]) for r in rows.mapInPandas(run, "sum binary").collect()], 0)

    def sums(texts, _) -> np.ndarray:
        total, square, n, whole = summed(texts)
        return np.concatenate([total, square, [n, whole]])

    def slope_of(field: Field) -> tuple[float, np.ndarray]:
        def run(texts, good) -> np.ndarray:
            value, g = slope(field, texts, good)
            return np.concatenate([g, [value]])

        got = over_rows(run)
        return float(got[-1]), got[:-1]

    got = over_rows(sums)
    return fitted(got[: 3 * OWN], got[3 * OWN : 6 * OWN], got[-2], got[-1], slope_of)


def score_column(docs: DataFrame, field: Field, text_col: str = "text") -> Column:
    """Score 0 to 1 of each text; null counts as empty."""
    sent = docs.sparkSession.sparkContext.broadcast(field)  # a few hundred numbers

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            parts = [scores(sent.value, part) for part in slices(b.tolist())]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return score(F.col(text_col).cast("string"))
