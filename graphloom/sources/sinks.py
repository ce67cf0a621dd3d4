"""Sinks: JSON lines, graph tables as CSV, an interactive page, JSON reports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions import text as T


def write_jsonl(articles: DataFrame, folder: str, topic: str, stamp: str) -> str:
    """Write below a folder named by the topic and a time stamp; returns its path."""
    name = topic.translate(str.maketrans(" /", "__"))[:50]
    path = f"{folder.rstrip('/')}/{name}_{stamp}"
    articles.write.mode("overwrite").json(path)
    return path


def nodes_table(nodes: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return nodes.select("id", text("name"), text("type"), F.coalesce("mention_count", F.lit(0)).cast("long").alias("mention_count"), text("cluster_id"), text("temporal_window"))


def edges_table(edges: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return edges.select("source", "target", text("relation"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), text("event_id"))


def write_csv(table: DataFrame, path: str, one_file: bool = False) -> None:
    """Header and rows; one_file gathers all rows in one task and is meant for small exports."""
    (table.coalesce(1) if one_file else table).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def styled_nodes(nodes: DataFrame) -> DataFrame:
    kind = F.col("type")
    size = F.when(kind == "Event", 20).otherwise(10 + 2 * F.coalesce("mention_count", F.lit(0))).cast("long")
    return nodes.select("id", F.substring(F.coalesce("name", "id"), 1, 50).alias("label"), T.type_colour(kind).alias("colour"), size.alias("size"))


def styled_edges(edges: DataFrame) -> DataFrame:
    part = F.col("relation") == "PARTICIPATES_IN"
    return edges.select("source", "target", F.substring("relation", 1, 20).alias("label"), F.when(part, "#AAAAAA").otherwise("#666666").alias("colour"), F.coalesce(part, F.lit(False)).alias("dashed"))


PAGE = """<!doctype html><meta charset="utf-8"><title>Graph</title><body><canvas id="c" width="1200" height="900"></canvas><script>
const nodes = NODES, edges = EDGES, at = new Map(nodes.map((n, k) => [n.id, {...n, x: 600 + 300 * Math.cos(k), y: 450 + 300 * Math.sin(k)}])), g = document.getElementById("c").getContext("2d");
function step() {
  const all = [...at.values()];
  for (const a of all) for (const b of all) if (a !== b) { const dx = a.x - b.x, dy = a.y - b.y, d = dx * dx + dy * dy + 9; a.x += 50 * dx / d; a.y += 50 * dy / d; }
  for (const e of edges) { const a = at.get(e.source), b = at.get(e.target); if (a && b) { const dx = b.x - a.x, dy = b.y - a.y; a.x += dx * 0.01; a.y += dy * 0.01; b.x -= dx * 0.01; b.y -= dy * 0.01; } }
  g.clearRect(0, 0, 1200, 900);
  for (const e of edges) { const a = at.get(e.source), b = at.get(e.target); if (a && b) { g.strokeStyle = e.colour; g.setLineDash(e.dashed ? [4, 4] : []); g.beginPath(); g.moveTo(a.x, a.y); g.lineTo(b.x, b.y); g.stroke(); } }
  for (const n of all) { g.fillStyle = n.colour; g.beginPath(); g.arc(n.x, n.y, n.size / 3, 0, 7); g.fill(); g.fillText(n.label, n.x + 8, n.y); }
}
let k = 0; const t = setInterval(() => { step(); if (++k > 150) clearInterval(t); }, 30);
</script>"""


def html_page(nodes: DataFrame, edges: DataFrame, most_nodes: int = 2_000, most_edges: int = 10_000) -> str:
    """A page for viewing. It shows the nodes of the highest mention counts, as a browser can hold."""
    shown = nodes.orderBy(F.desc_nulls_last("mention_count"), "id").limit(most_nodes)
    ids = F.broadcast(shown.select("id"))  # most_nodes rows
    inside = edges.join(ids.withColumnRenamed("id", "source"), "source", "left_semi").join(ids.withColumnRenamed("id", "target"), "target", "left_semi").limit(most_edges)
    dump = lambda df: json.dumps([r.asDict() for r in df.collect()]).replace("</", "<\\/")
    return PAGE.replace("NODES", dump(styled_nodes(shown)), 1).replace("EDGES", dump(styled_edges(inside)), 1)


def save_report(report: dict, path: str) -> None:
    """A JSON report; keys become text, tuples lists."""
    with open(path, "w") as f:
        json.dump({str(k): v for k, v in report.items()}, f, indent=2, default=str)
