"""Units of the engine by hand and by plain versions."""

from __future__ import annotations

import datetime as dt
import json
import random
from collections import deque

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from graphloom.functions import fuzzy
from graphloom.functions import text as T
from graphloom.functions.components import connected_components
from graphloom.operators import answers, clustering, entities, events, graph, similarity, taxonomy
from graphloom.plans import models
from graphloom.plans.pipeline import Run
from graphloom.sources import articles as A
from graphloom.sources import sinks, taxonomy as seeds, web
from graphloom.streaming import incremental


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first().x


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", max_size=12), st.text("abc ", max_size=12))
def test_indel_ratio(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    want = 200 * table[-1][-1] / (len(a) + len(b)) if a + b else 100
    assert fuzzy.indel_ratio(a, b) == want == fuzzy.indel_ratio(b, a) and 0 <= want <= 100


def test_fuzzy_join_finds_all_pairs(spark):
    rng = random.Random(1)
    names = sorted({" ".join("".join(rng.choice("abcd") for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(1, 3))) for _ in range(150)})
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {(r.left_key, r.alias) for r in fuzzy.fuzzy_join(df, df.withColumnRenamed("name", "alias"), "name", "alias", 85, 1000).collect()}
    key = lambda n: " ".join(sorted(n.split()))
    assert got == {(a, b) for a in names for b in names if fuzzy.indel_ratio(key(a), key(b)) > 85}


@pytest.mark.parametrize("least", [60.0, 85.0])
def test_fuzzy_join_by_subsequences_finds_all_pairs(spark, least):
    rng = random.Random(2)
    made = lambda n: "".join(rng.choice(["an", "er", "ß", "t", "oo", "𝛼"]) for _ in range(n))
    names = sorted({made(rng.randint(1, 18)) for _ in range(140)} | {made(4) + " " + made(3) for _ in range(20)} | {""})
    names = sorted({*names, *(n[: len(n) // 2] + n[len(n) // 2 + 1 :] for n in names[::3])})
    left, right = names[::2] + names[1::4], names[1::2] + names[::4]  # some are on both sides
    one, two = (spark.createDataFrame([(n,) for n in x], f"{c} string") for x, c in ((left, "name"), (right, "alias")))
    got = {(r.left_key, r.alias): r.ratio for r in fuzzy.fuzzy_join(one, two, "name", "alias", least, 1000, block=16).collect()}
    key = lambda n: " ".join(sorted(n.split()))
    ratios = {(a, b): fuzzy.indel_ratio(key(a), key(b)) for a in set(left) for b in set(right) if a and b}
    assert got == {k: r for k, r in ratios.items() if r > least}
    assert min(map(len, names)) < fuzzy.reach(least) < max(map(len, names))


def test_fuzzy_join_compares_only_pairs_that_pass(spark):
    rng = random.Random(3)
    names = sorted({"".join(rng.choice("abcdefgh") for _ in range(rng.randint(5, 14))) for _ in range(600)})
    got = {(r.x, r.y) for r in fuzzy.candidates(spark.createDataFrame([(n, 3) for n in names], "text string, side int"), 85.0).collect()}
    assert {frozenset(p) for p in got} == {frozenset((a, b)) for a in names for b in names if a < b and fuzzy.indel_ratio(a, b) > 85} and got


def test_text_functions(spark):
    n = lambda s: one(spark, T.normalize_entity(F.col("s")), s=s)
    assert (n(" Dr. Smith. "), n("Prime Minister Modi"), n("Ministerial"), n("USA"), n("CEOs!")) == ("smith", "modi", "ial", "usa", "s")
    assert one(spark, T.normalize_entity(F.col("s"), True), s="Ministerial") == "ministerial"
    assert one(spark, T.preprocess_relation(F.col("s")), s=" Levied the  controls ON a port ") == "levied controls port"
    assert one(spark, T.relation_name(F.col("s")), s="signed deal") == "SIGNED_DEAL"
    assert one(spark, T.llm_json(F.col("s")), s='x ```json\n{"a": 1}\n``` y') == '{"a": 1}' and one(spark, T.llm_json(F.col("s")), s='```\n{}\n```') == "{}" and one(spark, T.llm_json(F.col("s")), s=" {} ") == "{}"
    assert one(spark, T.retry_after(F.col("s")), s="please try again in 7.5s") == 7.5 and one(spark, T.retry_after(F.col("s")), s="no") is None
    assert one(spark, T.file_slug(F.col("s")), s="a b/c" + "d" * 60) == ("a_b_c" + "d" * 60)[:50]
    assert one(spark, T.json_list(F.col("s")), s='["a"]') == ["a"] and one(spark, T.json_list(F.col("s")), s="x") == []
    assert one(spark, T.type_colour(F.col("s")), s="Event") == "#FF6B35" and one(spark, T.type_colour(F.col("s")), s=None) == "#999999"
    assert one(spark, T.stripped_article_text(F.col("t"), F.col("c")), t=" a ", c=None) == "a. "
    assert one(spark, T.compose_content(F.col("t"), F.col("c")), t=" a ", c="a") == "a"


def test_dates(spark):
    d = lambda s: one(spark, T.parse_date(F.col("s")), s=s)
    want = dt.datetime(2024, 1, 2, 10, 30)
    for s in ("2024-01-02T10:30:00Z", "2024-01-02T10:30:00+05:30", " 2024-01-02 10:30:00 ", "Tue, 02 Jan 2024 10:30:00 +0000", "Tue, 2 Jan 2024 10:30:00 GMT"):
        assert d(s) == want, s
    assert d("2024-01-02") == d("2 Jan 2024") == dt.datetime(2024, 1, 2) and d("2024") is None and d("soon") is None and d("2024-13-40") is None
    assert one(spark, T.iso_week(F.col("s").cast("timestamp_ntz")), s="2024-12-30") == "2025-W01"


def test_scan_and_parse(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "a.jsonl").write_text('{"title": "A", "url": "u1", "published": "2024-01-02"}\n\n{bad\n{"title": "B", "url": "u2", "published_at": 86400, "content": "c"}\n{"url": "u1", "published_at": ""}\n')
    (tmp_path / "in" / "b.json").write_text('[{"title": "C", "url": "u3", "published_at": "5"}, {"title": "D", "url": ""}]')
    (tmp_path / "in" / "c.json").write_text('{"title": "E", "url": "u5", "published_at": "", "published": "Tue, 02 Jan 2024 10:30:00 GMT"}')
    (tmp_path / "in" / "d.txt").write_text("x")
    raw, bad = A.scan_json(spark, str(tmp_path))
    assert raw.count() == 6 and bad.count() == 1
    arts = A.parse_articles(raw, "2000-01-01 00:00:00")
    got = {r.title: (r.published_at, r.published_at_inferred) for r in arts.collect()}
    assert got["A"] == (dt.datetime(2024, 1, 2), False) and got["B"] == (dt.datetime(1970, 1, 2), False) and got["C"] == (dt.datetime(2000, 1, 1), True) and got["E"] == (dt.datetime(2024, 1, 2, 10, 30), False)
    stored = spark.createDataFrame([("u3",)], "url string")
    new = A.new_by_url(arts, stored, ["title", "content"])
    assert sorted(r.url for r in new.collect()) == ["u1", "u2", "u5"]
    assert A.ingest_counts(arts, new).first().asDict() == {"inserted": 3, "skipped": 3, "total": 6}
    assert A.new_by_url(arts, new, ["title"]).where("url <> 'u3'").count() == 0
    none, bad = A.scan_json(spark, str(tmp_path / "missing"))
    assert none.count() == bad.count() == 0 and A.parse_articles(none, "2000-01-01").count() == 0


def test_web(spark):
    plan = web.query_plan(spark, "t", "2026-02-28", "2026-06-01")
    assert plan.count() == 32 * 15 and sum(map(len, web.MEDIA.values())) == 57
    ok = lambda u, **k: one(spark, web.approved_domain(F.col("u"), **k), u=u)
    assert ok("https://www.BBC.com/x") and ok("https://notaxios.com/") and not ok("https://notaxios.com/", strict=True) and ok("https://m.axios.com", strict=True) and not ok("nothing")
    items = spark.createDataFrame([("T", "d" * 40, None, "u"), ("T", "short", None, "u"), ("", "d" * 40, None, "u")], "title string, description string, full_text string, url string")
    assert web.items_to_articles(items).count() == 1
    pub = spark.sql("""select parse_json(x) as p from values ('{"title": "T"}'), ('{"name": "N"}'), ('"S"'), ('{}'), (null) t(x)""")
    assert [r.x for r in pub.select(web.publisher_name(F.col("p")).alias("x")).collect()] == ["T", "N", "S", "Unknown", "Unknown"]

    def client(query, start, end):
        if "cnn" in query:
            raise OSError("down")
        return [{"url": f"{start}{query[:3]}", "title": "x"}]

    assert web.fetch(plan.limit(15), client).count() == 14
    many = spark.createDataFrame([("a", k) for k in range(9)] + [("b", 1)], "interval string, n int")
    assert web.limit_each(many, "interval", 3, ["n"]).count() == 4


def test_status(spark):
    rows = spark.createDataFrame([("1", "embedded"), ("2", "clustered")], "id string, status string")
    ids = spark.createDataFrame([("1",), ("2",)], "id string")
    assert {r.id: r.status for r in A.update_status(rows, ids, "deduplicated").collect()} == {"1": "deduplicated", "2": "clustered"}
    assert A.with_status(rows, "embedded").count() == 1 and A.first_nonempty(rows, ("ingested", "clustered", "embedded")).first().id == "2"


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)] + [(None, 1), (7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "src long, dst long")).collect()}
    root = {k: k for a, b in links if a is not None and a != b for k in (a, b)}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a is not None and a != b and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    assert got == root
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_nearest_is_exact(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8))
    df = spark.createDataFrame([(k, [float(c) for c in v]) for k, v in enumerate(x)], "id long, vector array<double>")
    u = x / np.linalg.norm(x, axis=1)[:, None]
    want = {(k, int(j)) for k, row in enumerate(u @ u.T) for j in np.argsort(-row, kind="stable")[:4]}
    assert {(r.id1, r.id2) for r in similarity.nearest(df, df, 4, block=64).collect()} == want
    assert similarity.nearest(df.limit(0), df, 3).count() == similarity.nearest(df, df.limit(0), 3).count() == 0


def test_nearest_of_copies_ties_and_missing_vectors(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([np.repeat(rng.normal(size=(3, 8)), 40, 0), rng.normal(size=(50, 8)), np.eye(8)[rng.integers(0, 8, 60)]])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    cos = np.round(u @ u.T, 12)
    want = {(i, int(j)) for i in range(len(u)) for j in sorted(range(len(u)), key=lambda j: (-cos[i, j], j))[:4]}
    i, j, c = similarity.top_pairs(u, u, 4, tile=32, chunk=16)
    assert {*zip(i.tolist(), j.tolist(), strict=True)} == want and np.allclose(c, cos[i, j])
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(900, None), (901, [float("nan")] * 8), (902, [None] * 8)]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    assert {(r.id1, r.id2) for r in similarity.nearest(df, df, 4, block=64).collect()} == want
    high = {(r.id1, r.id2) for r in similarity.nearest(df, df, 4, least=0.5).collect()}
    assert high == {(i, j) for i, j in want if cos[i, j] >= 0.5}


def test_duplicate_modes(spark):
    pairs = spark.createDataFrame([(1, 2, 0.99, 1), (2, 1, 0.99, 1), (2, 3, 0.98, 2), (3, 2, 0.98, 1)], "id1 long, id2 long, similarity double, rank int")
    rows = spark.createDataFrame([(k,) for k in range(1, 5)], "id long")
    ids = lambda df: sorted(r.id for r in df.collect())
    assert ids(similarity.survivors(rows, pairs)) == [1, 4] and ids(similarity.survivors(rows, pairs, "reference")) == [4]
    assert {r.id: r.duplicate_group_id for r in similarity.duplicate_groups(pairs).collect()} == {1: "dup_1", 2: "dup_2", 3: "dup_2"}


def test_hdbscan_and_leaders():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.05, (20, 2)) for c in ((0, 0), (3, 0), (0, 3))] + [np.array([[9.0, 9.0]])])
    labels = clustering.hdbscan(x, 3)
    assert len(set(labels[:60])) == 3 and -1 not in labels[:60] and all(len(set(labels[k : k + 20])) == 1 for k in (0, 20, 40))
    assert (clustering.hdbscan(np.zeros((6, 2)), 2) == -1).all() and len(clustering.hdbscan(np.zeros((0, 2)), 2)) == 0
    assert clustering.leaders(np.array([[1.0, 0], [0.99, 0.1], [0, 1.0]]), 0.78, 2).tolist() == [0, 0, -1]
    assert clustering.leaders(np.eye(3), 0.78, 2).tolist() == [0, 0, 0]


def test_spanning_tree_of_neighbour_lists():
    rng = np.random.default_rng(2)
    x = similarity.unit(rng.normal(size=(12, 8))[rng.integers(0, 12, 400)] + 0.3 * rng.normal(size=(400, 8)))
    for k in (2, 5, 16):
        i, j, _ = similarity.top_pairs(x, x, k)
        assert np.array_equal(clustering.sparse_spanning_tree(x, i, j, chunk=16, tile=64), clustering.spanning_tree(x, 1))


def test_weekly_clusters_with_copies_and_zeros_equal_the_plain_way(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([np.repeat(rng.normal(size=(4, 6)), 25, 0), rng.normal(size=(60, 6)), np.zeros((2, 6))]).astype(np.float32)
    df = spark.createDataFrame([(k, "w", 7 * k % 199, v.tolist()) for k, v in enumerate(x)], "id long, temporal_window string, ord long, vector array<float>")
    order = sorted(range(len(x)), key=lambda k: (7 * k % 199, k))
    labels = clustering.hdbscan(clustering.unit(x[order].astype(np.float64)), 2)
    assert {(r.id, r.label) for r in clustering.cluster_windows(df).collect()} == {(k, n) for k, n in zip(order, labels.tolist(), strict=True) if n >= 0}


def test_events(spark):
    members = spark.createDataFrame([("2024-W03", 1, k, k) for k in range(5)], "temporal_window string, cluster_id int, id long, ord long")
    arts = spark.createDataFrame([(k, f"t{k}", "c" * 400) for k in range(5)], "id long, title string, content string")
    e = events.build_events(members, arts).first()
    assert e.cluster_id == 1 and e.temporal_window == "2024-W03" and e.representative_article_ids == ["0", "1", "2"] and e.context.count("Title: ") == 5 and "c" * 301 not in e.context
    assert events.build_events(members.limit(0), arts).count() == 0


def test_resolution(spark):
    state = spark.createDataFrame([("USA", ["America"]), ("Modi", [])], "canonical_name string, aliases array<string>")
    mentions = spark.createDataFrame([("USA", 1), ("America", 2), ("Modi", 3), ("modi", 4), ("Sunderland City", 5), ("City Sunderland", 6), ("Zebra", 7)], "text string, ord long")
    got = {r.mention_key: (r.canonical_name, r.is_new) for r in entities.resolve(mentions, state).collect()}
    assert got["USA"] == ("USA", False) and got["America"] == ("USA", False) and got["Modi"] == ("Modi", False) and got["modi"] == ("Modi", False)
    assert got["Sunderland City"] == ("Sunderland City", True) and got["City Sunderland"] == ("Sunderland City", False) and got["Zebra"] == ("Zebra", True)


def test_resolution_heeds_known_types(spark):
    state = spark.createDataFrame([("Jordan River", [], "Location"), ("Jordan Rivers", [], "Person")], "canonical_name string, aliases array<string>, entity_type string")
    told = [("Jordan Riverr", "Person", 1), ("River Jordan", "Location", 2), ("Rivers Jordan", "Event", 3), ("jordan  river", None, 4), ("Amber Hill", "Person", 5), ("Hill Amber", "Location", 6), ("hill amber", "Unknown", 7)]
    mentions = spark.createDataFrame(told, "text string, entity_type string, ord long")
    got = {r.mention_key: r for r in entities.resolve(mentions, state, least=0.6).collect()}
    assert got["Jordan Riverr"].canonical_name in ("Jordan Rivers", "Jordan Riverr") and got["River Jordan"].canonical_name == "Jordan River"
    assert got["Rivers Jordan"].is_new and got["jordan  river"].canonical_name == "Jordan River"
    assert got["Amber Hill"].is_new and got["Hill Amber"].is_new and not got["hill amber"].is_new
    assert entities.resolve(mentions.limit(0), state).count() == 0 and entities.resolve(mentions, state.limit(0)).count() == 7


def test_taxonomies(spark):
    types = spark.createDataFrame([(1, "AI Company")], "type_id long, type_name string")
    given_ = spark.createDataFrame([("OpenAI", "announced", "AI Company"), ("Anthropic", "...", "Intelligence Firm"), ("X", "", None)], "entity_name string, context string, suggested_type string")
    assert {r.entity_name: (r.type_name, r.is_new) for r in taxonomy.induce_types(given_, types).collect()} == {"OpenAI": ("AI Company", False), "Anthropic": ("Intelligence Firm", True), "X": ("Unknown", False)}
    empty = spark.createDataFrame([], "type_name string, mention_count long")
    assert taxonomy.active_labels(empty).count() == 4
    rel = spark.createDataFrame([("signed trade deal with", 1), ("signed the trade deal", 2), ("bombed", 3)], "relation string, ord long")
    got = {r.relation: r.relation_canonical for r in taxonomy.merge_relations(rel).collect()}
    assert got == {"signed trade deal": "SIGNED_TRADE_DEAL", "bombed": "BOMBED"}
    assert seeds.seed_types(spark, "/nowhere.yaml").count() == 0


def test_answers(spark):
    reply = {"event_label": "E", "triples": [{"source": "A", "relation": "r", "target": "B"}], "discovered_types": []}
    rows = spark.createDataFrame([("1", f"```json\n{json.dumps(reply)}\n```"), ("2", "nonsense"), ("3", None)], "event_id string, answer string")
    told = answers.parse_answers(rows)
    assert {r.event_id: (r.event_label, r.parsed) for r in told.collect()} == {"1": ("E", True), "2": ("Unknown Event", False), "3": ("Unknown Event", False)}
    assert answers.triples_of(told).first().confidence == 0.5
    waits, calls = [], iter([RuntimeError("429 try again in 2.5s"), RuntimeError("bad"), "ok"])

    def client(prompt):
        x = next(calls)
        if isinstance(x, Exception):
            raise x
        return x

    assert answers.ask(client, "p", wait=waits.append) == "ok" and waits == [2.5, 1.0]
    assert answers.ask(lambda p: 1 / 0, "p", wait=waits.append) is None


def brandes(nodes, links):
    after = {n: sorted({b for a, b in links if a == n and a != b}) for n in nodes}
    score = dict.fromkeys(nodes, 0.0)
    for s in nodes:
        for t in nodes:
            paths = {s: [[s]]}
            depth, queue = {s: 0}, deque([s])
            while queue:
                v = queue.popleft()
                for w in after[v]:
                    if w not in depth:
                        depth[w] = depth[v] + 1
                        queue.append(w)
                        paths[w] = []
                    if depth[w] == depth[v] + 1:
                        paths[w] += [[*p, w] for p in paths[v]]
            for v in nodes:
                if s != t and v not in (s, t) and paths.get(t):
                    score[v] += sum(v in p for p in paths[t]) / len(paths[t])
    n = len(nodes)
    return {k: v / ((n - 1) * (n - 2)) for k, v in score.items()}


def test_graph(spark):
    rng = random.Random(2)
    links = [(f"n{rng.randint(0, 9)}", f"n{rng.randint(0, 9)}") for _ in range(30)]
    nodes = [f"n{k}" for k in range(10)]
    e = spark.createDataFrame(links, "source string, target string")
    v = spark.createDataFrame([(n,) for n in nodes], "id string")
    want = brandes(nodes, set(links))
    got = {r.id: r.centrality for r in graph.betweenness(v, e).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    alone = spark.createDataFrame([("x",)], "id string")
    assert graph.degree_centrality(alone, e.limit(0)).first().centrality == 1.0
    t = spark.createDataFrame([("ev", 1, 0.5, "A", "A", "r", None), ("ev", 2, 0.9, "A", "", "r", "R")], "event_id string, ord long, confidence double, source string, target string, relation string, relation_canonical string")
    made = graph.triple_edges(t)
    assert made.count() == 3 and graph.collapse_edges(made, ["ord", "sub"]).first().confidence == 0.9


def test_betweenness_reads_its_edges_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(len(b))
            yield b

    rows = spark.createDataFrame([(f"n{k}", f"n{k + 1}") for k in range(20)], "source string, target string")
    edges = rows.mapInPandas(counted, rows.schema)
    nodes = spark.createDataFrame([(f"n{k}",) for k in range(21)], "id string")
    assert graph.betweenness(nodes, edges).count() == 21 and read.value == 20


def test_models(spark):
    arts = spark.createDataFrame([("1", "t", "c one"), ("2", "t", None)], "id string, title string, content string")

    class Model:
        def embed(self, texts):
            return np.array([[3.0, 4.0]] * len(texts))

        def tag(self, text, labels):
            if not text:
                raise ValueError
            return [("one", "ORG", 0.9, 2, 5)]

    assert np.allclose(models.embed_articles(arts, Model).first().vector, [0.6, 0.8])
    assert [tuple(r)[:2] for r in models.tag_articles(arts, Model, ["ORG"], True).collect()] == [("one", "Organization")]


def test_stream_ingestion(spark, tmp_path):
    folder, table = tmp_path / "in", f"file://{tmp_path}/table"
    folder.mkdir()
    for k in range(2):
        (folder / f"{k}.json").write_text("\n".join(json.dumps({"url": f"u{j}", "n": k}) for j in range(k, k + 3)))
        stream = spark.readStream.schema("url string, n int").json(str(folder))
        incremental.ingest_stream(stream, table, f"file://{tmp_path}/state", lambda b, s: A.new_by_url(b, s, ["n"])).awaitTermination()
    assert sorted(r.url for r in spark.read.parquet(table).collect()) == ["u0", "u1", "u2", "u3"]


def test_pipeline_end_to_end(spark, tmp_path):
    words = ["Paris", "Berlin", "Madrid", "Rome"]
    lines = [{"title": f"{words[k % 4]} signs deal", "content": f"{words[k % 4]} signed trade deal with {words[(k + 1) % 4]}. Prices rise again in week {k // 8}.", "url": f"u{k}", "published_at": f"2024-01-{1 + k % 20:02d}"} for k in range(24)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text("\n".join(map(json.dumps, lines)))
    run = Run(spark, str(tmp_path / "in"), str(tmp_path / "out"), "2024-01-01 00:00:00")
    t = run.run()
    run.export(t)
    assert t["articles"].count() == 24 and t["events"].count() > 0 and t["edges"].count() > 0
    assert {r.type for r in t["nodes"].select("type").distinct().collect()} >= {"Event"}
    report = json.loads((tmp_path / "out" / "metrics.json").read_text())
    assert report["graph_stats"]["node_count"] == t["nodes"].count() and "<script>" in (tmp_path / "out" / "graph.html").read_text()
    again = Run(spark, str(tmp_path / "in"), str(tmp_path / "out"), "2024-01-01 00:00:00", from_stage="triples", skip_llm=True).run()
    assert again["triples"].count() == 0 and again["nodes"].where("type = 'Event'").count() == t["events"].count()
    assert sinks.nodes_table(t["nodes"]).where("name is null").count() == 0


def test_two_runs_equal_one_over_both_batches(spark, tmp_path):
    words = ["Paris", "Berlin", "Madrid", "Rome", "Oslo", "Vienna"]
    line = lambda k: json.dumps({"title": f"{words[k % 6]} signs", "content": f"{words[k % 6]} signed trade deal with {words[(k + k // 6) % 6]}.", "url": f"u{k}", "published_at": f"2024-01-{1 + k % 20:02d}"})
    for name, rows in (("one", range(12)), ("two", range(8, 30)), ("all", range(30))):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.jsonl").write_text("\n".join(map(line, rows)))
    made = lambda name, now, previous="": Run(spark, str(tmp_path / name), str(tmp_path / f"{name}-out"), now, previous=previous).gather()
    one, whole = made("one", "2024-02-01 00:00:00"), made("all", "2024-02-01 00:00:00")
    two = made("two", "2024-02-02 00:00:00", str(tmp_path / "one-out"))
    for name in ("articles", "mentions", "vectors"):
        assert two[name].exceptAll(whole[name].select(two[name].columns)).count() == 0 and two[name].count() == whole[name].count(), name
    told = lambda t: {r.canonical_name: (r.canonical_id, r.entity_type, r.aliases, r.mention_count) for r in t["entities"].collect()}
    assert told(two) == told(whole) and len(told(one)) == 6
    seen = {r.canonical_name: (r.first_seen.day, r.last_seen.day) for r in two["entities"].collect()}
    assert set(seen.values()) == {(1, 2)}
    with pytest.raises(ValueError):
        made("one", "2024-02-01 00:00:00", str(tmp_path / "one-out"))


def test_merge_entities(spark):
    state = spark.sql("select 'id1' as canonical_id, 'USA' as canonical_name, 'Unknown' as entity_type, array('America') as aliases, 2L as mention_count, timestamp '2020-01-01' as first_seen, timestamp '2020-01-01' as last_seen")
    mentions = spark.createDataFrame([("USA", "Country", 1), ("the US", "Unknown", 2), ("Modi", "Person", 3)], "text string, entity_type string, ord long")
    resolved = spark.createDataFrame([("USA", "USA"), ("the US", "USA"), ("Modi", "Modi")], "mention_key string, canonical_name string")
    got = {r.canonical_name: r for r in entities.merge_entities(state, mentions, resolved, "2024-01-01").collect()}
    assert (got["USA"].entity_type, got["USA"].aliases, got["USA"].mention_count, got["USA"].first_seen.year, got["USA"].last_seen.year) == ("Country", ["America", "the US"], 4, 2020, 2024)
    assert got["Modi"].mention_count == 1 and got["Modi"].aliases == [] and got["Modi"].entity_type == "Person"


def test_rare_names_are_matched_and_resolved(spark, small):
    from graphloom.plans import bindings, queries

    texts = {r.text for r in bindings.mentions(spark, small).select("text").distinct().collect()}
    assert {r.left_key for r in queries.token_sort_ratio_topk(spark, small).collect()} == {t.lower() for t in texts}
    assert {r.mention_key for r in queries.entity_resolution(spark, small).collect()} == texts


def test_equal_mentions_are_one_row_before_they_are_stripped(spark):
    rows = [(" Ann ", 5, "Person"), ("Ann", 7, "Place"), ("Ann", 3, "Unknown"), ("Bob", 9, None), ("Bob", 8, "Place"), ("  ", 1, "Place"), (None, 2, "Place")]
    mentions = spark.createDataFrame(rows * 40, "text string, ord long, entity_type string")
    state = spark.createDataFrame([("Zoe", None, "Person")], "canonical_name string, aliases array<string>, entity_type string")
    got = {r.mention_key: (r.canonical_name, r.is_new, r.score) for r in entities.resolve(mentions, state).collect()}
    assert got == {"Ann": ("Ann", True, 1.0), "Bob": ("Bob", True, 1.0)}


def test_short_texts_are_dealt_to_a_number_of_tasks(spark):
    from graphloom.functions.vectors import hashed_embedding

    texts = spark.createDataFrame([(k, f"name {k % 37} x") for k in range(400)], "id long, text string")
    few, many = hashed_embedding(texts, "id", "text"), hashed_embedding(texts, "id", "text", short=True)
    assert few.exceptAll(many).count() == many.exceptAll(few).count() == 0
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "REPARTITION_BY_NUM" not in few._jdf.queryExecution().executedPlan().toString()
