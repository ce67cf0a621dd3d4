"""Every operator of the engine as a query over the supplied tables, with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions import fuzzy, vectors
from graphloom.functions import text as T
from graphloom.operators import answers, clustering, entities, events, graph, similarity, taxonomy
from graphloom.plans import bindings as B
from graphloom.plans.models import embed_articles
from graphloom.sources import articles as A
from graphloom.sources import sinks, web
from graphloom.storage import materialize, scratch_path
from graphloom.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
ART, MEN, TRI, TYP, ENT = (f"({B.SQL[k]})" for k in ("articles", "mentions", "triples", "types", "entities"))


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


# Ingestion and scalars.


@query(f"""select id, url, source from (select *, row_number() over (partition by url order by id) as k from {ART} where status <> 'clustered') where k = 1 and url not in (select url from {ART} where status = 'clustered')""")
def ingest_new_by_url(spark, sf):
    a = B.articles(spark, sf)
    return A.new_by_url(a.where("status <> 'clustered'"), a.where("status = 'clustered'"), ["id"]).select("id", "url", "source")


@query(f"""with b as (select * from {ART} where status <> 'clustered'), s as (select url from {ART} where status = 'clustered') select (select count(distinct url) from b where url not in (select url from s)) as inserted, (select count(*) from b) - (select count(distinct url) from b where url not in (select url from s)) as skipped, (select count(*) from b) as total""")
def ingest_counts(spark, sf):
    a = B.articles(spark, sf)
    batch = a.where("status <> 'clustered'")
    return A.ingest_counts(batch, A.new_by_url(batch, a.where("status = 'clustered'"), ["id"]))


@query(f"select id, status from {ART} where status = 'embedded'")
def first_nonempty_status(spark, sf):
    return A.first_nonempty(B.articles(spark, sf), ("llm_done", "embedded", "ingested")).select("id", "status")


@query(f"select id, case when status = 'ingested' and id % 2 = 0 then 'embedded' else status end as status from {ART}")
def update_status(spark, sf):
    a = B.articles(spark, sf)
    return A.update_status(a, a.where("id % 2 = 0"), "embedded").select("id", "status")


@query("select d::date as start_date, least(d + interval 2 day, timestamp '2026-06-01')::date as end_date from range(timestamp '2026-02-28', timestamp '2026-06-02', interval 3 day) t(d)")
def date_intervals(spark, sf):
    return web.date_intervals(spark, "2026-02-28", "2026-06-01", 3)


@query()
def search_plan(spark, sf):
    return web.query_plan(spark, "energy", "2026-02-28", "2026-06-01").select("start_date", "end_date", "category", "query")


@query("select page_id, regexp_replace(lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)), '^www\\.', '') as host, contains(regexp_replace(lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)), '^www\\.', ''), '1.') or contains(regexp_replace(lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)), '^www\\.', ''), '7.') as approved from pages")
def domain_filter(spark, sf):
    pages = B.table(spark, sf, "pages")
    return pages.select("page_id", T.host(F.col("url")).alias("host"), web.approved_domain(F.col("url"), ["1.", "7."]).alias("approved"))


NORM = "lower(regexp_replace(trim(regexp_replace(trim(x), '^(President|Dr\\.|Mr\\.|Mrs\\.|Ms\\.|CEO|Chairman|Secretary|Minister|Prime Minister)', '', 'i')), '[.,;:!?]$', ''))"


@query(f"select id, {NORM} as name from (select id, case when id % 3 = 0 then ' Dr. ' || title when id % 3 = 1 then 'CEOs ' || title || ' ' else title end as x from {ART} where regexp_full_match(title, '[ -~]*'))")
def entity_normalize(spark, sf):
    a = B.articles(spark, sf).where(F.col("title").rlike("^[ -~]*$"))
    x = F.expr("case when id % 3 = 0 then concat(' Dr. ', title) when id % 3 = 1 then concat('CEOs ', title, ' ') else title end")
    return a.select("id", T.normalize_entity(x).alias("name"))


PHRASE = "trim(regexp_replace(regexp_replace(trim(lower({x})), '\\b(the|a|an|to|of|for|with|by|on|in|at)\\b', '', 'g'), '\\s+', ' ', 'g'))"


@query(f"select id, {PHRASE.format(x='title')} as phrase from {ART} where regexp_full_match(title, '[ -~]*')")
def relation_preprocess(spark, sf):
    return B.articles(spark, sf).where(F.col("title").rlike("^[ -~]*$")).select("id", T.preprocess_relation(F.col("title")).alias("phrase"))


@query("select distinct o_orderpriority as phrase, upper(replace(o_orderpriority, ' ', '_')) as name from orders")
def relation_canonical_name(spark, sf):
    return B.table(spark, sf, "orders").select("o_orderpriority").distinct().select(F.col("o_orderpriority").alias("phrase"), T.relation_name(F.col("o_orderpriority")).alias("name"))


@query("select strftime(ts, '%G-W%V') as week, event_type, count(*) as n from events group by all")
def iso_week_window(spark, sf):
    return B.table(spark, sf, "events").groupBy(T.iso_week(F.col("ts")).alias("week"), "event_type").agg(F.count("*").alias("n"))


@query("select page_id, array_to_string(list_filter([trim(coalesce(t, '')), case when trim(coalesce(url, '')) <> trim(coalesce(t, '')) then trim(coalesce(url, '')) else '' end], lambda x: x <> ''), chr(10) || chr(10)) as content from (select page_id, url, trim(regexp_extract(html, '<title[^>]*>([^<]*)</title>', 1, 'is')) as t from pages)")
def content_compose(spark, sf):
    p = B.table(spark, sf, "pages")
    return p.select("page_id", T.compose_content(T.html_title(F.col("html")), F.col("url"), F.col("url")).alias("content"))


@query("select page_id, url, trim(regexp_extract(html, '<title[^>]*>([^<]*)</title>', 1, 'is')) as title from pages")
def html_title_extract(spark, sf):
    return B.table(spark, sf, "pages").select("page_id", "url", T.html_title(F.col("html")).alias("title"))


@query("select page_id, length(trim(regexp_replace(regexp_replace(regexp_replace(html, '<(script|style)[^>]*>.*?</(script|style)>', ' ', 'gis'), '<[^>]*>', ' ', 'gs'), '\\s+', ' ', 'g'))) as chars from pages")
def html_text_extract(spark, sf):
    return B.table(spark, sf, "pages").select("page_id", F.length(T.html_text(F.col("html"))).cast("long").alias("chars"))


@query("select event_id, ts::timestamp(0) as parsed from (select event_id, date_trunc('second', ts) as ts from events)")
def rss_date_parse(spark, sf):
    e = B.table(spark, sf, "events").select("event_id", F.date_trunc("second", F.col("ts").cast("timestamp")).alias("t"))
    # Three of the accepted forms, in turn.
    made = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("Mon, "), F.date_format("t", "dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))).when(F.col("event_id") % 3 == 1, F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.date_format("t", "yyyy-MM-dd HH:mm:ss"))
    return e.select("event_id", T.parse_date(made).alias("parsed"))


@query("select event_id, try_cast(regexp_extract(props, '\"k\": *(-?[0-9]+)', 1) as bigint) as n, case when event_id % 2 = 0 then event_type else 'Unknown Event' end as label from events")
def llm_json_parse(spark, sf):
    label = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(', "event_label": "'), "event_type", F.lit('"'))).otherwise(F.lit(""))
    said = F.concat(F.regexp_replace("props", r"\}\s*$", ""), label, F.lit("}"))
    e = B.table(spark, sf, "events").select("event_id", F.concat(F.lit("Sure:\n```json\n"), said, F.lit("\n```\ndone")).alias("answer"))
    got = F.from_json(T.llm_json(F.col("answer")), "k long, event_label string")
    return e.select("event_id", got["k"].alias("n"), F.coalesce(got["event_label"], F.lit("Unknown Event")).alias("label"))


@query("select conv_id, turn, case when turn % 3 < 2 then turn + 0.5 end::double as seconds from conversations")
def retry_after_parse(spark, sf):
    wait = F.concat(F.lit(" Rate limit reached, try again in "), F.col("turn").cast("string"), F.lit(".5s."))
    said = F.concat(F.coalesce("text", F.lit("")), F.when(F.col("turn") % 3 < 2, wait).otherwise(F.lit(" Done.")))
    return B.table(spark, sf, "conversations").select("conv_id", "turn", T.retry_after(said).alias("seconds"))


# Duplicates and neighbours.


@query("select md5(text) as digest, count(*) as n, min(doc_id) as first_id from documents where text is not null group by 1 having count(*) > 1")
def exact_duplicates(spark, sf):
    d = B.table(spark, sf, "documents").where("text is not null")
    return d.groupBy(F.md5(F.col("text").cast("binary")).alias("digest")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


def _vectors(spark, sf):
    return B.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")


COS = "list_dot_product(a.embedding::double[], b.embedding::double[]) / sqrt(list_dot_product(a.embedding::double[], a.embedding::double[]) * list_dot_product(b.embedding::double[], b.embedding::double[]))"


@query(f"select id1, id2, round(cos, 4) as cos, rank from (select id1, id2, cos, row_number() over (partition by id1 order by round(cos, 12) desc, id2)::int as rank from (select a.vec_id as id1, b.vec_id as id2, {COS} as cos from embeddings a cross join embeddings b)) where rank <= 10 and id1 <> id2")
def knn_top10(spark, sf):
    v = _vectors(spark, sf)
    return similarity.nearest(v, v, 10).where("id1 <> id2").select("id1", "id2", F.round("cos", 4).alias("cos"), "rank")


@query(f"select id1, id2, round(cos, 4) as cos, rank from (select id1, id2, cos, row_number() over (partition by id1 order by round(cos, 12) desc, id2)::int as rank from (select a.vec_id as id1, b.vec_id as id2, {COS} as cos from embeddings a join embeddings b on a.label = b.label)) where rank <= 5")
def knn_by_type(spark, sf):
    v = _vectors(spark, sf)
    return similarity.nearest(v, v, 5, key="label").select("id1", "id2", F.round("cos", 4).alias("cos"), "rank")


PAIRS = f"select * from (select id1, id2, cos, row_number() over (partition by id1 order by round(cos, 12) desc, id2) as rank from (select a.vec_id as id1, b.vec_id as id2, {COS} as cos from embeddings a cross join embeddings b)) where rank <= 10 and id1 <> id2 and cos >= 0.4"


def _pairs(spark, sf):
    v = _vectors(spark, sf)
    return similarity.nearest(v, v, 10, least=0.4).where("id1 <> id2").select("id1", "id2", "cos", "rank")


@query(f"select id1, id2, round(cos, 4) as similarity from ({PAIRS})")
def near_duplicate_pairs(spark, sf):
    return _pairs(spark, sf).select("id1", "id2", F.round("cos", 4).alias("similarity"))


@query(f"select id, arg_max('dup_' || case when id1::varchar < id2::varchar then id1::varchar else id2::varchar end, id1 * 100 + rank) as duplicate_group_id from (select id1 as id, * from ({PAIRS}) union all select id2 as id, * from ({PAIRS})) group by id")
def dup_group_last_wins(spark, sf):
    return similarity.duplicate_groups(_pairs(spark, sf))


@query(f"select vec_id as id from embeddings where vec_id not in (select id1 from ({PAIRS}))")
def dup_survivors_reference(spark, sf):
    return similarity.survivors(_vectors(spark, sf), _pairs(spark, sf), "reference").select("id")


@query(f"select vec_id as id from embeddings where vec_id not in (select id1 from ({PAIRS}) where id2 < id1)")
def dup_survivors_first(spark, sf):
    return similarity.survivors(_vectors(spark, sf), _pairs(spark, sf)).select("id")


@query(f"with recursive e as materialized (select id1 as a, id2 as b from ({PAIRS}) union select id2, id1 from ({PAIRS})), r as (select a as node, a as root from e union select e.b, r.root from r join e on r.node = e.a) select node, min(root) as component from r group by node")
def dup_components(spark, sf):
    return similarity.duplicate_components(_pairs(spark, sf))


TOK = "(select doc_id, unnest(regexp_extract_all(lower(left(text, 2000)), '[a-z]+')) as w from documents)"
HASHED = f"select doc_id as id, ('0x' || substr(md5(w), 1, 8))::bigint % 64 as bucket, sum(case when substr(md5(w), 9, 1) < '8' then 1 else -1 end)::double as value from {TOK} group by all having sum(case when substr(md5(w), 9, 1) < '8' then 1 else -1 end) <> 0"


@query(HASHED)
def hashed_embedding_cells(spark, sf):
    return vectors.hashed_counts(B.table(spark, sf, "documents"), "doc_id", "text")


@query(f"select label, k, n, round(x / sqrt(sum(x * x) over (partition by label)), 6) as x from (select label, k, avg(x) as x, count(*) as n from (select label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) - 1 as k from embeddings) group by all)")
def centroid_by_label(spark, sf):
    c = clustering.centroids(_vectors(spark, sf), "label", "id", "vector")
    return c.select("label", F.posexplode("centroid").alias("k", "x"), "n").select("label", F.col("k").cast("long").alias("k"), "n", F.round("x", 6).alias("x"))


# Windows and events.


@query(f"select temporal_window, count(*) as article_count, count(distinct source) as source_count, array_to_string(list(id order by id)[1:3], ',') as representatives from {ART} group by 1")
def events_by_iso_week(spark, sf):
    e = events.events_by_week(B.articles(spark, sf))
    return e.select("temporal_window", "article_count", "source_count", F.array_join(F.col("representatives").cast("array<string>"), ",").alias("representatives"))


LABELLED = f"(select temporal_window, id, id as ord, (id % 5 - 1)::int as label, title, content from {ART})"


def _labelled(spark, sf):
    return B.articles(spark, sf).select("temporal_window", "id", F.col("id").alias("ord"), (F.col("id") % 5 - 1).cast("int").alias("label"))


NUMBERED = f"select temporal_window, label, (row_number() over (partition by temporal_window order by n desc, o, label) - 1)::int as cluster_id, n as size from (select temporal_window, label, count(*) as n, min(ord) as o from {LABELLED} where label >= 0 group by all)"


@query(NUMBERED)
def cluster_renumber(spark, sf):
    return clustering.renumber(_labelled(spark, sf))


def _members(spark, sf):
    rows = _labelled(spark, sf)
    return rows.join(clustering.renumber(rows), ["temporal_window", "label"]).select("temporal_window", "cluster_id", "id", "ord")


MEMBERS = f"(select l.*, r.cluster_id from {LABELLED} l join ({NUMBERED}) r using (temporal_window, label))"


@query(f"select temporal_window, cluster_id, md5(string_agg('Title: ' || title || chr(10) || 'Excerpt: ' || left(content, 300) || '...', chr(10) || chr(10) order by ord)) as context_md5 from {MEMBERS} group by all")
def event_context(spark, sf):
    e = events.build_events(_members(spark, sf), B.articles(spark, sf))
    return e.select("temporal_window", "cluster_id", F.md5(F.col("context").cast("binary")).alias("context_md5"))


@query(f"select temporal_window, cluster_id, count(*) as articles, array_to_string(list(id order by ord)[1:3], ',') as representatives from {MEMBERS} group by all")
def event_representatives(spark, sf):
    e = events.build_events(_members(spark, sf), B.articles(spark, sf))
    return e.select("temporal_window", "cluster_id", F.size("article_ids").cast("long").alias("articles"), F.array_join("representative_article_ids", ",").alias("representatives"))


@query(f"select a.id, m.cluster_id, m.temporal_window, case when m.id is not null then 'clustered' else a.status end as status from {ART} a left join {MEMBERS} m using (id)")
def cluster_assignment(spark, sf):
    a = B.articles(spark, sf)
    return events.assign_clusters(a, events.build_events(_members(spark, sf), a)).select("id", "cluster_id", "temporal_window", "status")


def _weekly_vectors(spark, sf):
    a = B.articles(spark, sf)
    return a.select("id", "temporal_window", F.col("id").alias("ord")).join(embed_articles(a), "id")


@query()
def hdbscan_by_week(spark, sf):
    return clustering.cluster_windows(_weekly_vectors(spark, sf))


@query()
def greedy_leader_cluster(spark, sf):
    return clustering.cluster_windows(_weekly_vectors(spark, sf), method="leaders")


# Mentions and entities.


@query(f"select article_id, text, count(*) as n from {MEN} group by all")
def rule_ner_mentions(spark, sf):
    return B.mention_texts(spark, sf).groupBy("article_id", "text").agg(F.count("*").alias("n"))


@query("select article_id, count(*) as n, count(*) as same, sum(length(text))::bigint as chars from (select doc_id as article_id, unnest(regexp_extract_all(text, '[A-Z][a-z]+')) as text from documents where text is not null) group by 1")
def mention_spans(spark, sf):
    m = B.mentions(spark, sf).join(B.articles(spark, sf).select(F.col("id").alias("article_id"), "content"), "article_id")
    same = F.col("content").substr(F.col("span_start") + 1, F.col("span_end") - F.col("span_start")) == F.col("text")
    return m.groupBy("article_id").agg(F.count("*").alias("n"), F.count_if(same).alias("same"), F.sum(F.col("span_end") - F.col("span_start")).cast("long").alias("chars"))


@query(f"select text, count(*) as mention_count, count(distinct article_id) as article_count from {MEN} group by text")
def mention_counts(spark, sf):
    return entities.mention_counts(B.mention_texts(spark, sf))


LABELS = [*T.TAGGER_TYPES, "none of them"]


@query(f"select mapped, count(*) as n from (select case event_id % {len(LABELS)} {' '.join(f"when {k} then '{T.TAGGER_TYPES.get(x, 'Unknown')}'" for k, x in enumerate(LABELS))} end as mapped from events) group by 1")
def spacy_label_map(spark, sf):
    label = F.element_at(F.array(*[F.lit(x) for x in LABELS]), (F.col("event_id") % len(LABELS) + 1).cast("int"))
    return B.table(spark, sf, "events").select(T.tagger_type(label).alias("mapped")).groupBy("mapped").agg(F.count("*").alias("n"))


@query()
def token_sort_ratio_topk(spark, sf):
    names = materialize(B.mention_texts(spark, sf).select(F.lower("text").alias("name")).distinct(), "names")
    return fuzzy.fuzzy_join(names, names.withColumnRenamed("name", "alias"), "name", "alias").select("left_key", "alias", "ratio", "rank")


FUZZY = "(select vec_id as mention, (vec_id * 7 + j) % 50 as canonical_id, 0.85 + ((vec_id + j) % 16) / 100.0::double as ratio from embeddings, (values (0), (1), (2)) t(j))"
SEMANTIC = "(select vec_id as mention, (vec_id * 7 + 2 * (j - 1)) % 50 as canonical_id, ((vec_id % 11) + 10 - j) / 20.0::double as similarity, j as rank from embeddings, (values (1), (2), (3), (4), (5)) t(j))"


@query(f"select mention, canonical_id, round(score, 6) as score from (select *, row_number() over (partition by mention order by stage, score desc, canonical_id) as k from (select f.mention, f.canonical_id, 0.4::double * f.ratio + 0.6::double * coalesce(s.similarity, 0) as score, 1 as stage from {FUZZY} f left join {SEMANTIC} s on f.mention = s.mention and f.canonical_id = s.canonical_id union all select mention, canonical_id, similarity, 2 from {SEMANTIC} where rank <= 3) where score > 0.8800001) where k = 1")
def fuse_scores(spark, sf):
    v = B.table(spark, sf, "embeddings").select("vec_id")
    f = v.withColumn("j", F.explode(F.array(*map(F.lit, range(3))))).select(F.col("vec_id").alias("mention"), ((F.col("vec_id") * 7 + F.col("j")) % 50).alias("canonical_id"), (0.85 + ((F.col("vec_id") + F.col("j")) % 16) / 100.0).alias("ratio"))
    s = v.withColumn("rank", F.explode(F.array(*map(F.lit, range(1, 6))))).select(F.col("vec_id").alias("mention"), ((F.col("vec_id") * 7 + 2 * (F.col("rank") - 1)) % 50).alias("canonical_id"), ((F.col("vec_id") % 11 + 10 - F.col("rank")) / 20.0).alias("similarity"), "rank")
    return entities.fuse_scores(f, s, least=0.8800001).withColumn("score", F.round("score", 6))


@query(f"select coalesce(s.name, m.name) as canonical_name, coalesce(s.n, 0) + coalesce(m.n, 0) as mention_count from (select text as name, count(*) as n from {MEN} where article_id % 2 = 0 group by 1) s full outer join (select text as name, count(*) as n from {MEN} where article_id % 2 = 1 group by 1) m using (name)")
def resolve_exact_upsert(spark, sf):
    m = B.mention_texts(spark, sf)
    state = m.where("article_id % 2 = 0").groupBy(F.col("text").alias("canonical_name")).agg(F.count("*").alias("mention_count"))
    return entities.upsert_exact(state, m.where("article_id % 2 = 1"))


@query(f"select left(text, 3) as canonical_name, coalesce(array_to_string(list_sort(list(distinct text) filter (where text <> left(text, 3))), ','), '') as aliases from {MEN} group by 1")
def alias_accumulate(spark, sf):
    m = B.mention_texts(spark, sf).select(F.substring("text", 1, 3).alias("canonical_name"), "text")
    return entities.accumulate_aliases(m).select("canonical_name", F.array_join("aliases", ",").alias("aliases"))


@query()
def entity_resolution(spark, sf):
    m = B.mention_texts(spark, sf).withColumn("ord", F.col("article_id"))
    state = B.entities(spark, sf).select(F.initcap("canonical_name").alias("canonical_name"), "aliases")
    return entities.resolve(m, state)


# Taxonomies.


@query(f"select query_id, type_id from (select a.vec_id as query_id, b.vec_id as type_id, row_number() over (partition by a.vec_id order by round({COS}, 9) desc, b.vec_id) as k from embeddings a cross join (select * from embeddings where vec_id in (select min(vec_id) from embeddings group by label)) b where {COS} > 0.1) where k = 1")
def nearest_type(spark, sf):
    v = _vectors(spark, sf)
    first = B.table(spark, sf, "embeddings").groupBy("label").agg(F.min("vec_id").alias("type_id")).select("type_id")  # a type for each label
    return similarity.nearest_type(v, v.withColumnRenamed("id", "type_id").join(first, "type_id").select("type_id", "vector"), 0.1).select("query_id", "type_id")


@query(f"select type_name from {TYP} order by mention_count desc, type_name limit 10")
def active_labels_topk(spark, sf):
    return taxonomy.active_labels(B.types(spark, sf), 10)


@query(f"select type_name, mention_count from {TYP} order by mention_count desc, type_name limit 20")
def top_types(spark, sf):
    return taxonomy.top_types(B.types(spark, sf))


@query(f"select (select count(*) from {TYP}) as type_count, (select count(*) from {TYP} where not is_confirmed) as unconfirmed, (select string_agg(type_name, ',' order by type_name) from (select type_name from {TYP} where is_auto_discovered order by 1 limit 10)) as discovered, (select string_agg(type_name, ',' order by type_name) from (select type_name from {TYP} order by mention_count desc, type_name limit 20)) as top_types")
def ontology_report(spark, sf):
    r = taxonomy.ontology_report(B.types(spark, sf))
    return r.select("type_count", "unconfirmed", F.array_join("discovered", ",").alias("discovered"), F.array_join("top_types", ",").alias("top_types"))


@query(f"select type_id, type_name, case when parent_type_id = 1 then 0 else parent_type_id end as parent_type_id, mention_count + case when type_id = 0 then (select mention_count from {TYP} where type_id = 1) else 0 end as mention_count from {TYP} where type_id <> 1")
def merge_types(spark, sf):
    t = B.types(spark, sf)
    return taxonomy.merge_types(t, t.select("type_id"), 0, 1)[0]


@query("select r_name as type_name, null::varchar as parent_name, false as is_auto_discovered from region union all select n_name, r_name, false from nation join region on n_regionkey = r_regionkey")
def seed_types(spark, sf):
    n, r = B.table(spark, sf, "nation"), B.table(spark, sf, "region")
    cols = [F.lit(False).alias("is_auto_discovered"), F.lit(True).alias("is_confirmed")]
    have = r.select(F.col("r_name").alias("type_name"), F.lit(None).cast("string").alias("parent_name"), *cols)
    seeds = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("type_name"), F.col("r_name").alias("parent_name"), *cols)
    return taxonomy.add_seed_types(have, seeds).drop("is_confirmed")


@query()
def type_induction(spark, sf):
    t = B.types(spark, sf).select("type_id", F.initcap("type_name").alias("type_name"))
    given = B.articles(spark, sf).select(F.col("id").cast("string").alias("entity_name"), F.col("title").alias("context"), F.when(F.col("id") % 2 == 0, F.substring_index("title", " ", 1)).alias("suggested_type"))
    return taxonomy.induce_types(given, t)


RELS = "(select p_partkey as relation_id, p_name as relation_canonical, case when p_partkey % 4 = 0 then null else (p_partkey % 4)::int end as cluster_id, (p_partkey * 13 % 101)::bigint as usage_count from part)"


def _relations(spark, sf):
    return B.table(spark, sf, "part").select(F.col("p_partkey").alias("relation_id"), F.col("p_name").alias("relation_canonical"), F.when(F.col("p_partkey") % 4 != 0, (F.col("p_partkey") % 4).cast("int")).alias("cluster_id"), (F.col("p_partkey") * 13 % 101).cast("long").alias("usage_count"))


@query(f"select coalesce(cluster_id, -1) as cluster_id, arg_min(relation_canonical, relation_id) as canonical, count(*) as members, sum(usage_count)::bigint as usage_count from {RELS} group by 1")
def relation_taxonomy(spark, sf):
    return taxonomy.relation_taxonomy(_relations(spark, sf))


@query(f"select cluster_id, relation_canonical as canonical from (select *, row_number() over (partition by cluster_id order by usage_count desc, relation_id) as k from {RELS} where cluster_id is not null) where k = 1")
def relation_canonical_by_usage(spark, sf):
    return taxonomy.most_used(_relations(spark, sf).where("cluster_id is not null"))


@query(f"select upper(replace({PHRASE.format(x='o_orderpriority')}, ' ', '_')) as relation_canonical, count(*) as usage_count from orders group by 1")
def relation_usage(spark, sf):
    return taxonomy.relation_usage(B.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("relation")))


@query()
def relation_knn_merge(spark, sf):
    return taxonomy.merge_relations(B.table(spark, sf, "part").select(F.col("p_name").alias("relation"), F.col("p_partkey").alias("ord")))


@query()
def relation_clusters(spark, sf):
    r = _relations(spark, sf).groupBy("relation_canonical").agg(F.min("relation_id").alias("relation_id"), F.sum("usage_count").alias("usage_count"))  # the distinct phrases
    return taxonomy.cluster_relations(r.join(vectors.hashed_embedding(r, "relation_id", "relation_canonical").withColumnRenamed("id", "relation_id"), "relation_id"))


# Answers and the graph.


@query(f"select count(*) as events, count(*) as parsed from {ART}")
def relation_extraction(spark, sf):
    e = B.articles(spark, sf).select(F.col("id").cast("string").alias("event_id"), F.col("content").alias("context"))
    return answers.parse_answers(answers.extract(e)).agg(F.count("*").alias("events"), F.count_if("parsed").alias("parsed"))


EDGES = f"(select event_id, ord, confidence, source, event_id as target, 'PARTICIPATES_IN' as relation, null::varchar as original_relation, 0 as sub from {TRI} union all select event_id, ord, confidence, target, event_id, 'PARTICIPATES_IN', null, 1 from {TRI} union all select event_id, ord, confidence, source, target, relation, relation, 2 from {TRI})"
# Keys of the supplied lines repeat, so the order goes on to the attributes.
LAST = f"(select source, target, relation, confidence, event_id from (select *, row_number() over (partition by source, target order by ord desc, sub desc, confidence desc, event_id desc, relation desc) as k from {EDGES}) where k = 1)"


def _edges(spark, sf):
    edges = graph.collapse_edges(graph.triple_edges(B.triples(spark, sf)), ["ord", "sub", "confidence", "event_id", "relation"])
    return materialize(edges, "edges")  # few beside the triples, and read several times


def _events(edges):
    """The event ids of all triples: each takes part in its event, and of the edges of a pair one is kept."""
    return edges.where(F.col("relation") == graph.PART).select(F.col("target").alias("event_id")).distinct()


def _nodes(spark, sf, edges=None):
    e = _edges(spark, sf) if edges is None else edges
    ents = B.entities(spark, sf).withColumn("canonical_id", F.col("canonical_name"))
    evs = _events(e).select("event_id", F.concat(F.lit("Event "), "event_id").alias("label"), F.lit(0).alias("cluster_id"), F.col("event_id").alias("temporal_window"), F.array().cast("array<string>").alias("article_ids"))
    return graph.build_nodes(e, ents, evs)


NODES = f"(select id, coalesce(n.canonical_name, 'Event ' || id) as name, case when n.canonical_name is not null then 'Nation' else 'Event' end as type, n.mention_count, case when n.canonical_name is null then id end as temporal_window from (select source as id from {LAST} union select target from {LAST} union select canonical_name from {ENT}) x left join {ENT} n on n.canonical_name = x.id)"


@query(f"select source, target, relation, original_relation, event_id, count(*) as n from {EDGES} group by all")
def triple_to_edges(spark, sf):
    return graph.triple_edges(B.triples(spark, sf)).groupBy("source", "target", "relation", "original_relation", "event_id").agg(F.count("*").alias("n"))


@query(f"select * from {LAST}")
def edge_collapse_last_wins(spark, sf):
    return _edges(spark, sf).drop("original_relation")


NAMES = f"(select lower(name) as name_key, arg_max(canonical_id, ord * 10 + pos) as canonical_id from (select canonical_id, ord, canonical_name as name, 0 as pos from {ENT} union all select canonical_id, ord, aliases[1], 1 from {ENT} union all select canonical_id, ord, aliases[2], 2 from {ENT}) group by 1)"


@query(f"select event_id, ord, coalesce(a.canonical_id, source) as source, coalesce(b.canonical_id, target) as target from {TRI} t left join {NAMES} a on a.name_key = lower(source) left join {NAMES} b on b.name_key = lower(target)")
def name_to_canonical_join(spark, sf):
    return graph.resolve_names(B.triples(spark, sf), graph.name_map(B.entities(spark, sf))).select("event_id", "ord", "source", "target")


@query(f"select coalesce(e.id, n.id) as id, coalesce(n.name, coalesce(e.id, n.id)) as name, coalesce(n.mention_count, 0) as mention_count from (select source as id from {LAST} union select target from {LAST}) e full outer join (select canonical_name as id, canonical_name as name, mention_count from {ENT}) n using (id)")
def node_enrich_full_outer(spark, sf):
    ends = _edges(spark, sf).select(F.explode(F.array("source", "target")).alias("id")).distinct()
    return graph.enrich_nodes(ends, B.entities(spark, sf).select(F.col("canonical_name").alias("id"), F.col("canonical_name").alias("name"), "mention_count"))


@query(f"select id, name, type, mention_count, temporal_window from {NODES}")
def graph_nodes(spark, sf):
    return _nodes(spark, sf).select("id", "name", "type", "mention_count", "temporal_window")


@query(f"select (select count(*) from {NODES}) as node_count, 1::bigint as entity_types, (select count(*) from {LAST}) as edge_count, (select count(distinct relation) from {LAST}) as relation_types, (select count(distinct relation) from {LAST} where relation <> 'PARTICIPATES_IN') as relations_discovered")
def graph_stats(spark, sf):
    e = _edges(spark, sf)
    return graph.graph_stats(_nodes(spark, sf, e), e)


@query(f"select id, round(coalesce(d, 0) / ((select count(*) from {NODES}) - 1)::double, 9) as centrality from {NODES} left join (select id, count(*) as d from (select source as id from {LAST} union all select target from {LAST}) group by 1) using (id)")
def degree_centrality(spark, sf):
    e = _edges(spark, sf)
    return graph.degree_centrality(_nodes(spark, sf, e), e).withColumn("centrality", F.round("centrality", 9))


@query()
def betweenness_centrality(spark, sf):
    e = _edges(spark, sf).where(F.col("relation") != graph.PART)
    return graph.betweenness(e.select(F.explode(F.array("source", "target")).alias("id")).distinct(), e).withColumn("centrality", F.round("centrality", 9))


@query(f"select id, name, degree from (select n.id, n.name, coalesce(d, 0) as degree from {NODES} n left join (select id, count(*) as d from (select source as id from {LAST} union all select target from {LAST}) group by 1) using (id) where type <> 'Event') order by degree desc, id limit 20")
def top_entities_by_connections(spark, sf):
    e = _edges(spark, sf)
    return graph.top_by_connections(_nodes(spark, sf, e), e)


@query(f"select id, name, coalesce(mention_count, 0) as mention_count from {NODES} where type <> 'Event' order by 3 desc, 1 limit 20")
def top_entities_by_mentions(spark, sf):
    return graph.top_by_mentions(_nodes(spark, sf))


@query(f"select temporal_window, count(*) as events from {NODES} where type = 'Event' group by 1")
def event_frequency(spark, sf):
    return graph.events_by_window(_nodes(spark, sf))


@query(f"with b as (select source as a, target as b from {LAST} union select target, source from {LAST}), h1 as (select distinct b as id, 1 as hop from b where a = 'NATION_01'), h2 as (select distinct b.b as id, 2 as hop from h1 join b on h1.id = b.a) select id, min(hop) as hop from (select 'NATION_01' as id, 0 as hop union all select * from h1 union all select * from h2) group by 1")
def two_hop_neighbourhood(spark, sf):
    return graph.neighbourhood(_edges(spark, sf), spark.createDataFrame([("NATION_01",)], "id string"))


@query(f"select distinct id from (select unnest([source, target]) as id from {LAST} where relation <> 'PARTICIPATES_IN' and confidence >= 0.05)")
def property_filter_endpoints(spark, sf):
    return graph.endpoints_where(_edges(spark, sf), "relation <> 'PARTICIPATES_IN' and confidence >= 0.05")


@query(f"with p as (select distinct event_id, unnest([source, target]) as id from {TRI}) select a.id as left_id, b.id as right_id, count(*) as events from p a join p b on a.event_id = b.event_id and a.id < b.id group by all")
def entity_cooccurrence(spark, sf):
    return graph.cooccurrence(B.triples(spark, sf).select("event_id", F.explode(F.array("source", "target")).alias("id")))


# Export and streams.


@query(f"select id, coalesce(name, '') as name, coalesce(type, '') as type, coalesce(mention_count, 0)::varchar as mention_count, coalesce(temporal_window, '') as temporal_window from {NODES}")
def nodes_csv(spark, sf):
    path = scratch_path(spark, "nodes-csv")
    sinks.write_csv(sinks.nodes_table(_nodes(spark, sf)), path)
    back = spark.read.option("header", True).option("nullValue", "\0").option("emptyValue", "").csv(path)
    return back.select("id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("name", "type", "mention_count", "temporal_window")])


@query(f"select source, target, relation, round(confidence, 6) as confidence, event_id from {LAST}")
def relationships_csv(spark, sf):
    path = scratch_path(spark, "edges-csv")
    sinks.write_csv(sinks.edges_table(_edges(spark, sf)), path)
    return spark.read.option("header", True).schema("source string, target string, relation string, confidence double, event_id string").csv(path).withColumn("confidence", F.round("confidence", 6))


@query(f"select id, left(name, 50) as label, case when type = 'Event' then '#FF6B35' else '#' || left(md5(type), 6) end as colour, case when type = 'Event' then 20 else 10 + 2 * coalesce(mention_count, 0) end as size from {NODES}")
def graph_style(spark, sf):
    return sinks.styled_nodes(_nodes(spark, sf))


@query(f"select source, target, left(relation, 20) as label, case when relation = 'PARTICIPATES_IN' then '#AAAAAA' else '#666666' end as colour, relation = 'PARTICIPATES_IN' as dashed from {LAST}")
def edge_style(spark, sf):
    return sinks.styled_edges(_edges(spark, sf))


@query(f"select id, url from {ART}")
def articles_jsonl(spark, sf):
    path = sinks.write_jsonl(B.articles(spark, sf).select("id", "url"), scratch_path(spark, "jsonl"), "two words/and more", "20240101T000000")
    return spark.read.schema("id long, url string").json(path)


@query("select date_trunc('week', ts) as week_start, event_type, count(*) as n from events group by all")
def stream_weekly_counts(spark, sf):
    s = incremental.weekly_counts(incremental.table_stream(spark, sf, "events"), "ts", ["event_type"])
    return incremental.run_available(spark, s, "complete")


@query("select distinct user_id, event_type from events")
def stream_dedup_by_url(spark, sf):
    s = incremental.table_stream(spark, sf, "events").select("user_id", "event_type").dropDuplicates(["user_id", "event_type"])
    return incremental.run_available(spark, s, "append")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
