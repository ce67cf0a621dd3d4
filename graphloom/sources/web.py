"""Search-based acquisition: intervals, query plan, domain filters, composition. Fetching is injected."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphloom.functions import text as T

# Approved media domains by category.
MEDIA = {
    "global_news": [
        "bbc.co.uk", "bbc.com", "cnn.com", "nbcnews.com", "abcnews.go.com", "cbsnews.com", "nytimes.com", "washingtonpost.com", "usatoday.com", "latimes.com",
        "aljazeera.com", "france24.com", "dw.com", "euronews.com", "trtworld.com", "apnews.com", "reuters.com",
    ],
    "finance_business": [
        "bloomberg.com", "economictimes.indiatimes.com", "business-standard.com", "thehindubusinessline.com", "investopedia.com", "spglobal.com",
        "financialtimes.com", "wsj.com", "marketwatch.com", "cnbc.com", "fortune.com", "forbes.com", "moneycontrol.com", "businessinsider.com",
    ],
    "energy_commodities": [
        "oilprice.com", "world-nuclear-news.org", "energyintel.com", "commodities-insights.spglobal.com", "tradewindsnews.com", "shippingwatch.com",
        "gcaptain.com", "metalbulletin.com", "mining.com", "fastmarkets.com",
    ],
    "india": [
        "thehindu.com", "hindustantimes.com", "indiatoday.in", "ndtv.com", "timesofindia.indiatimes.com", "indianexpress.com",
    ],
    "china": [
        "chinadaily.com.cn", "scmp.com", "globaltimes.cn",
    ],
    "defense_security": [
        "defensenews.com", "janes.com", "aviationweek.com", "flightglobal.com", "foreignpolicy.com", "politico.com", "axios.com",
    ],
}
DOMAINS_A_QUERY = 5


def date_intervals(spark: SparkSession, start: str, end: str, days: int) -> DataFrame:
    """start_date, end_date of windows of ``days``, the last one clipped."""
    return spark.sql(
        "select d as start_date, least(date_add(d, :n - 1), date(:end)) as end_date from (select explode(sequence(date(:start), date(:end), make_interval(0, 0, 0, :n))) as d)",
        {"start": start, "end": end, "n": days},
    )


def query_plan(spark: SparkSession, topic: str, start: str, end: str, days: int = 3, categories: list[str] | None = None) -> DataFrame:
    """One row per interval and search: category, query."""
    rows = []
    for category, domains in MEDIA.items():
        if categories is None or category in categories:
            for k in range(0, len(domains), DOMAINS_A_QUERY):
                rows.append((category, f"{topic} " + " OR ".join(f"site:{d}" for d in domains[k : k + DOMAINS_A_QUERY])))
    searches = spark.createDataFrame([*rows, ("_broad", topic)], "category string, query string")
    return date_intervals(spark, start, end, days).join(F.broadcast(searches))  # as many rows as domain batches


def approved_domain(url: Column, domains: list[str] | None = None, strict: bool = False) -> Column:
    """True if the host holds an approved domain; strict: is one or lies below one."""
    found = T.host(url)
    known = F.array(*[F.lit(d) for d in domains or sum(MEDIA.values(), [])])
    return F.exists(known, lambda d: (found == d) | F.endswith(found, F.concat(F.lit("."), d)) if strict else F.contains(found, d))


def approved_result(url: Column, publisher_href: Column, publisher_title: Column, domains: list[str] | None = None) -> Column:
    known = F.array(*[F.lit(d) for d in domains or sum(MEDIA.values(), [])])
    named = F.lower(F.concat_ws("\n", publisher_href, publisher_title))
    return approved_domain(url, domains) | F.exists(known, lambda d: F.contains(named, d))


def publisher_name(publisher: Column) -> Column:
    """Name of a VARIANT publisher: an object's title or name, or a text."""
    field = lambda p: F.nullif(F.trim(F.try_variant_get(publisher, p, "string")), F.lit(""))
    plain = F.when(F.schema_of_variant(publisher) == "STRING", field("$"))
    return F.coalesce(field("$.title"), field("$.name"), plain, F.lit("Unknown"))


def new_candidates(items: DataFrame, seen: DataFrame, order: list[str]) -> DataFrame:
    """Items with an unseen url, the first of each url in the batch."""
    rank = F.row_number().over(Window.partitionBy("url").orderBy(*order))
    return items.where("url <> ''").withColumn("url_rank", rank).where("url_rank = 1").drop("url_rank").join(seen.select("url").distinct(), "url", "left_anti").select(*items.columns)


def items_to_articles(items: DataFrame, least_chars: int = 40) -> DataFrame:
    """Items (title, description, full_text, url, ...) with a composed content of enough characters."""
    made = items.withColumn("content", T.compose_content(F.col("title"), F.col("description"), F.col("full_text")))
    return made.where((F.length(F.trim("content")) >= least_chars) & (F.trim("url") != "") & (F.trim("title") != ""))


def limit_each(articles: DataFrame, key: str, most: int, order: list[str]) -> DataFrame:
    """At most ``most`` rows of each key (an interval), in a stated order."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return articles.withColumn("key_rank", rank).where(F.col("key_rank") <= most).drop("key_rank")


def fetch(plan: DataFrame, client: Callable[[str, str, str], list[dict]]) -> DataFrame:
    """Run an injected search client over a query plan; a failing search gives no rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.itertuples():
                try:
                    found = client(r.query, str(r.start_date), str(r.end_date))
                except Exception:  # a search that fails is left out, as others go on
                    found = []
                rows += [(r.category, str(r.start_date), x.get("url", ""), x.get("title", ""), x.get("description", ""), x.get("published", "")) for x in found]
            yield pd.DataFrame(rows, columns=["category", "interval", "url", "title", "description", "published"])

    return plan.mapInPandas(run, "category string, interval string, url string, title string, description string, published string")
