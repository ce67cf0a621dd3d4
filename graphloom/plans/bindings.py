"""The engine's logical inputs, bound to the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions.text import iso_week, normalize_entity
from graphloom.operators.entities import mention_texts as texts_of_mentions
from graphloom.operators.entities import rule_mentions

#: The same bindings in SQL.
SQL = {
    "articles": "select doc_id as id, left(split_part(text, chr(10), 1), 80) as title, text as content, source, timestamp '2024-01-01' + to_days((doc_id % 28)::int) as published_at, 'https://' || source || '.example.com/' || (doc_id % 700)::varchar as url, case when doc_id % 7 = 0 then 'ingested' when doc_id % 7 < 4 then 'embedded' else 'clustered' end as status, strftime(timestamp '2024-01-01' + to_days((doc_id % 28)::int), '%G-W%V') as temporal_window from documents where text is not null",
    "mentions": "select doc_id as article_id, unnest(regexp_extract_all(text, '[A-Z][a-z]+')) as text from documents where text is not null",
    "triples": "select strftime(l_shipdate, '%G-W%V') as event_id, l_orderkey * 10 + l_linenumber as ord, sn.n_name as source, lower(o_orderpriority) as relation, cn.n_name as target, l_discount::double as confidence from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey join nation sn on s_nationkey = sn.n_nationkey join nation cn on c_nationkey = cn.n_nationkey where sn.n_name <> cn.n_name",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("text is not null")
    made = docs.select(
        F.col("doc_id").alias("id"), F.substring(F.split_part("text", F.lit("\n"), F.lit(1)), 1, 80).alias("title"), F.col("text").alias("content"), "source",
        F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(cast(doc_id % 28 as int))").alias("published_at"),
        F.concat(F.lit("https://"), "source", F.lit(".example.com/"), (F.col("doc_id") % 700).cast("string")).alias("url"),
        F.expr("case when doc_id % 7 = 0 then 'ingested' when doc_id % 7 < 4 then 'embedded' else 'clustered' end").alias("status"),
    )
    return made.withColumn("temporal_window", iso_week(F.col("published_at")))


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_mentions(articles(spark, sf_dir))


def mention_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts_of_mentions(articles(spark, sf_dir))


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    nation = t("nation").select("n_nationkey", "n_name")
    # Orders find their customer and lines their supplier before they meet, so that narrow rows are dealt.
    placed = t("orders").select("o_orderkey", "o_custkey", "o_orderpriority").join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey", "c_custkey")
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_discount").join(t("supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")).drop("l_suppkey", "s_suppkey")
    rows = lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(nation.withColumnsRenamed({"n_nationkey": "sk", "n_name": "source"}), F.col("s_nationkey") == F.col("sk")).join(nation.withColumnsRenamed({"n_nationkey": "ck", "n_name": "target"}), F.col("c_nationkey") == F.col("ck"))
    return rows.where("source <> target").select(
        iso_week(F.col("l_shipdate")).alias("event_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("ord"), "source",
        F.lower("o_orderpriority").alias("relation"), F.lit(None).cast("string").alias("relation_canonical"), "target", F.col("l_discount").cast("double").alias("confidence"),
    )


def types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A taxonomy: regions above nations; counts are customers."""
    n = table(spark, sf_dir, "nation")
    counts = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("mention_count"))
    low = n.join(counts, "n_nationkey", "left").select(
        (F.col("n_nationkey") + 100).cast("long").alias("type_id"), F.col("n_name").alias("type_name"), F.col("n_regionkey").cast("long").alias("parent_type_id"),
        F.coalesce("mention_count", F.lit(0)).alias("mention_count"), (F.col("n_nationkey") % 2 == 0).alias("is_auto_discovered"), (F.col("n_nationkey") % 3 == 0).alias("is_confirmed"),
    )
    high = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long"), "r_name", F.lit(None).cast("long"), F.lit(0).cast("long"), F.lit(False), F.lit(True))
    return low.union(high)


SQL["types"] = "select n_nationkey + 100 as type_id, n_name as type_name, n_regionkey::bigint as parent_type_id, coalesce(k, 0) as mention_count, n_nationkey % 2 = 0 as is_auto_discovered, n_nationkey % 3 = 0 as is_confirmed from nation left join (select c_nationkey, count(*) as k from customer group by 1) on c_nationkey = n_nationkey union all select r_regionkey, r_name, null, 0, false, true from region"


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as entities, under lower-case ids, with a reversed and a shared alias."""
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("e"), F.col("n_nationkey").cast("string")).alias("canonical_id"), F.col("n_name").alias("canonical_name"), F.lit("Nation").alias("entity_type"),
        F.array(F.reverse("n_name"), F.concat(F.lit("Region "), F.col("n_regionkey").cast("string"))).alias("aliases"), F.col("n_nationkey").cast("long").alias("ord"),
        (F.col("n_nationkey") * 3 % 11).cast("long").alias("mention_count"),
    )


SQL["entities"] = "select 'e' || n_nationkey::varchar as canonical_id, n_name as canonical_name, [reverse(n_name), 'Region ' || n_regionkey::varchar] as aliases, n_nationkey::bigint as ord, (n_nationkey * 3 % 11)::bigint as mention_count from nation"
