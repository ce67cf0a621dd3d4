"""Language of texts by multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.quality import held_out, slices

BINS = 1 << 15
ORDERS = 3
_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Which code points are letters, up to the last one that is."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.array([chr(c).isalpha() for c in range(0x32400)])
    return _LETTER


def _bins(code: np.ndarray, starts: int) -> tuple[np.ndarray, np.ndarray]:
    """Bins of the n-grams that begin at the first ``starts`` code points, and which of these are letters."""
    table = _letters()
    letter = table[np.minimum(code, len(table) - 1)]
    code = np.where(letter, code, 32).astype(np.uint32)
    end = np.concatenate([code, np.full(ORDERS, 32, np.uint32)])
    h = np.zeros(starts, np.uint32)
    out = np.empty((starts, ORDERS), np.uint16)
    for k in range(ORDERS):
        h = (h ^ end[k : k + starts]) * np.uint32(0x9E3779B1) + np.uint32(k + 1)
        out[:, k] = (h ^ (h >> np.uint32(15))) & np.uint32(BINS - 1)
    return out, letter[:starts]


def grams(texts: list[str | None], most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse counts of n-grams: text, bin and count, sorted by text; and whether each text has a letter.

    Texts are lower-cased and what isn't a letter counts as a space; a space stands before and
    behind. Texts are read in stretches of ``most`` code points, so that memory beside the text is
    bounded; an n-gram belongs to the stretch in which it begins.
    """
    has = np.zeros(len(texts), bool)
    text, bins, count = [], [], []
    for k, t in enumerate(texts):
        code = np.frombuffer((" " + (t or "").lower() + " ").encode("utf-32-le", "surrogatepass"), "<u4")
        total = None
        for at in range(0, len(code), most):
            starts = min(most, len(code) - at)
            got, letter = _bins(code[at : at + starts + ORDERS - 1], starts)
            has[k] |= letter.any()
            if len(code) <= most:
                used, n = np.unique(got, return_counts=True)
                break
            own = np.bincount(got.ravel(), minlength=BINS)
            total = own if total is None else total + own
        if total is not None:
            used = np.flatnonzero(total)
            n = total[used]
        text.append(np.full(len(used), k))
        bins.append(used.astype(np.int64))
        count.append(n)
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return join(text), join(bins), join(count), has


def train(docs: DataFrame, fit_docs: int = 20_000) -> tuple[list[str], np.ndarray]:
    """Languages and log probabilities (bins x languages) from rows with a language outside the held-out fold.

    About ``fit_docs`` rows are drawn by a hash of doc_id. Languages get even parts of them; one with
    fewer rows is taken whole. Null texts and languages are left out; repeated rows count each.
    Without such rows there are no languages. The model has ``BINS`` numbers for each language, and
    the driver gets as many counts; distinct values of lang are taken to be hundreds at most.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("lang is not null and text is not null and doc_id is not null")
    rows = rows.where(~held_out(F.col("doc_id"), 3, 1))
    have = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row for each language
    left, shares = fit_docs, []
    for k, (lang, n) in enumerate(sorted(have.items(), key=lambda x: (x[1], x[0]))):  # rare ones first: what they leave goes to the others
        take = min(n, left // (len(have) - k))
        left -= take
        shares.append((lang, (1 << 20) * take // n))
    asked = docs.sparkSession.createDataFrame(shares, "lang string, below long")
    rows = rows.join(F.broadcast(asked), "lang").where(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 20)) < F.col("below"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, own in b.groupby("lang"):
                for part in slices(own["text"].tolist()):
                    _, bins, n, _ = grams(part)
                    total[lang] = total.get(lang, 0) + np.bincount(bins, n, BINS).astype(np.int64)
        for lang, c in total.items():
            used = np.flatnonzero(c)
            yield pd.DataFrame({"lang": lang, "bin": used, "n": c[used]})

    counted = rows.select("lang", "text").repartition(-(-fit_docs // 1500)).mapInPandas(count, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    got = counted.toArrow().to_pandas()  # BINS rows for each language at most
    langs = sorted(got["lang"].unique())
    c = np.full((BINS, len(langs)), 0.5)
    c[got["bin"], np.searchsorted(langs, got["lang"])] += got["n"]
    return langs, np.log(c / c.sum(0)).astype(np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """docs with lang_pred and score, the posterior at even priors over a text's n-grams.

    ``und`` with score 0 for null texts, texts without a letter, and a model without languages. Of
    equally likely languages the first by code points is told. Equal texts get equal results, to
    rounding. A column named lid is replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bins x languages

    def batch(texts: list[str | None]) -> pd.DataFrame:
        langs, table = sent.value
        if not langs:
            return pd.DataFrame({"lang_pred": ["und"] * len(texts), "score": 0.0})
        text, bins, n, has = grams(texts)
        total = np.zeros((len(texts), len(langs)))
        step = max(1024, (1 << 22) // len(langs))
        for at in range(0, len(bins), step):  # sparse counts by the rows of the table that they name
            rows = text[at : at + step]
            first = np.flatnonzero(np.diff(rows, prepend=-1))
            total[rows[first]] += np.add.reduceat(table[bins[at : at + step]] * n[at : at + step, None], first, axis=0, dtype=np.float64)
        total -= total.max(1, keepdims=True)
        p = np.exp(total)
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        return pd.DataFrame({"lang_pred": np.where(has, np.array(langs, object)[best], "und"), "score": np.where(has, p.max(1), 0.0)})

    @F.pandas_udf("lang_pred string, score double")
    def told(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parts = [batch(part) for part in slices(b.tolist(), 1 << 20)]
            yield pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"lang_pred": np.zeros(0, object), "score": np.zeros(0)})

    return docs.withColumn("lid", told(F.col("text").cast("string")))
