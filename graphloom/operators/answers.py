"""Relation extraction: prompts, injected clients, and parsing of answers."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom import schema
from graphloom.functions.text import llm_json


def parse_answers(answers: DataFrame, text_col: str = "answer") -> DataFrame:
    """event_id, parsed, event_label, triples, discovered_types; what can't be read is an unknown event without triples."""
    got = F.from_json(llm_json(F.col(text_col)), schema.RESPONSE, {"mode": "PERMISSIVE"})
    made = answers.withColumn("got", got).withColumn("parsed", F.coalesce(F.col("got.event_label").isNotNull() | F.col("got.triples").isNotNull(), F.lit(False)))
    none = lambda c: F.coalesce(F.col(f"got.{c}"), F.array())
    return made.select("event_id", "parsed", F.coalesce("got.event_label", F.lit("Unknown Event")).alias("event_label"), none("triples").alias("triples"), none("discovered_types").alias("discovered_types"))


def triples_of(answers: DataFrame) -> DataFrame:
    """schema.TRIPLE without canonical names: event_id, ord, source, relation, target, confidence."""
    rows = answers.select("event_id", F.posexplode("triples").alias("ord", "t"))
    text = lambda c: F.coalesce(f"t.{c}", F.lit("")).alias(c)
    return rows.select("event_id", F.col("ord").cast("long").alias("ord"), text("source"), text("relation"), text("target"), F.coalesce("t.confidence", F.lit(0.5)).alias("confidence"))


def rule_answer(context: str) -> str:
    """The offline client: names that follow each other in a sentence are related by what stands between."""
    import json

    triples = []
    for sentence in re.split(r"[.!?\n]", context):
        names = list(re.finditer(r"\b[A-Z][a-z]+\b", sentence))
        for a, b in zip(names, names[1:], strict=False):
            between = sentence[a.end() : b.start()].strip(" ,;:")
            if between and a[0] != b[0]:
                triples.append({"source": a[0], "relation": " ".join(between.split()[:5]), "target": b[0], "confidence": 0.5})
    return json.dumps({"event_label": context.split("\n")[0][:80] or "Unknown Event", "triples": triples, "discovered_types": []})


def ask(client: Callable[[str], str], prompt: str, attempts: int = 3, wait: Callable[[float], None] = time.sleep) -> str | None:
    """An answer, or None after some attempts; a rate limit waits as long as it names."""
    for k in range(attempts):
        try:
            return client(prompt)
        except Exception as e:
            said = re.search(r"try again in ([\d.]+)s", str(e))
            limited = "429" in str(e) or "rate limit" in str(e).lower()
            if k + 1 < attempts:
                wait((float(said[1]) if said else 5.0 * 2**k) if limited else 1.0)
    return None


def extract(events: DataFrame, client: Callable[[str], str] = rule_answer, workers: int = 5, chars: int = 4000) -> DataFrame:
    """event_id, answer for each event; calls of a batch run side by side, and answers keep their event."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(workers) as pool:
            for b in batches:
                yield pd.DataFrame({"event_id": b["event_id"], "answer": list(pool.map(lambda c: ask(client, c[:chars]), b["context"]))})

    return events.select("event_id", "context").mapInPandas(run, "event_id string, answer string")
