"""Text, date and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Titles removed before names, words removed from relations, labels of a tagger.
TITLES = ("President", r"Dr\.", r"Mr\.", r"Mrs\.", r"Ms\.", "CEO", "Chairman", "Secretary", "Minister", "Prime Minister")
RELATION_STOPWORDS = ("the", "a", "an", "to", "of", "for", "with", "by", "on", "in", "at")
TAGGER_TYPES = {
    "PERSON": "Person", "ORG": "Organization", "GPE": "Location", "LOC": "Location", "EVENT": "Event",
    "PRODUCT": "Product", "WORK_OF_ART": "Product", "LAW": "Policy", "NORP": "Organization",
}


def strip(c: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def article_text(title: Column, content: Column, chars: int = 2000) -> Column:
    """What of an article is embedded: title and the head of its content."""
    return F.concat(title, F.lit(". "), F.substring(content, 1, chars))


def stripped_article_text(title: Column, content: Column, chars: int = 2000) -> Column:
    return F.concat(strip(F.coalesce(title, F.lit(""))), F.lit(". "), F.substring(strip(F.coalesce(content, F.lit(""))), 1, chars))


def compose_content(*parts: Column) -> Column:
    """Distinct non-empty parts in order, a blank line between."""
    kept = F.filter(F.transform(F.array(*parts), lambda p: strip(F.coalesce(p, F.lit("")))), lambda p: p != "")
    return F.array_join(F.array_distinct(kept), "\n\n")


def normalize_entity(name: Column, strict: bool = False) -> Column:
    """Lower-case name without one leading title and one closing mark.

    Titles match without a word's end, unless strict.
    """
    end = r"(?![A-Za-z])" if strict else ""
    plain = strip(F.regexp_replace(strip(name), f"(?i)^({'|'.join(TITLES)}){end}", ""))
    return F.lower(F.regexp_replace(plain, r"[.,;:!?]$", ""))


def preprocess_relation(phrase: Column) -> Column:
    words = F.regexp_replace(F.trim(F.lower(phrase)), rf"\b({'|'.join(RELATION_STOPWORDS)})\b", "")
    return F.trim(F.regexp_replace(words, r"\s+", " "))


def relation_name(phrase: Column) -> Column:
    return F.upper(F.replace(phrase, F.lit(" "), F.lit("_")))


def iso_week(ts: Column) -> Column:
    """ISO week as YYYY-Www, by the value's own wall clock."""
    # Plain text functions: format_string parses its pattern for each row.
    made = F.concat(F.extract(F.lit("YEAROFWEEK"), ts).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(ts).cast("string"), 2, "0"))
    return F.coalesce(made, F.lit("null-Wnull"))


def tagger_type(label: Column) -> Column:
    pairs = [F.lit(x) for kv in TAGGER_TYPES.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), label), F.lit("Unknown"))


def parse_date(value: Column) -> Column:
    """Timestamp without zone of a date text by the accepted forms, null if none fits.

    ISO dates with or without time, zone or Z; "Mon, 02 Jan 2024 10:00:00 +0000" and the same with
    a zone's name; "2024-01-02 10:00:00"; "2 Jan 2024"; a number of seconds since 1970 is parse_epoch.
    A value's own wall clock counts; its zone is dropped.
    """
    v = F.trim(value)
    iso = F.when(v.rlike(r"^\d{4}-\d{2}-\d{2}([T ]|$)"), v.try_cast("timestamp_ntz"))
    rss = F.regexp_extract(v, r"^(?:[A-Za-z]{3}, )?(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2}) (?:[+-]\d{4}|[A-Za-z]{3,4})$", 1)
    day = F.regexp_extract(v, r"^(\d{1,2} [A-Za-z]{3} \d{4})$", 1)
    ntz = lambda text, form: F.try_to_timestamp(F.when(text != "", text), F.lit(form)).cast("timestamp_ntz")
    return F.coalesce(iso, ntz(rss, "d MMM yyyy HH:mm:ss"), ntz(day, "d MMM yyyy"))


def parse_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def published_at(value: Column, now: Column) -> tuple[Column, Column]:
    """Date of a VARIANT field (number: epoch seconds; text: parse_date; else now), and whether it is inferred."""
    kind = F.schema_of_variant(value)
    number = F.when(kind.rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT|INT)"), parse_epoch(F.try_variant_get(value, "$", "double")))
    found = F.coalesce(number, F.when(kind == "STRING", parse_date(F.try_variant_get(value, "$", "string"))))
    return F.coalesce(found, now), found.isNull()


def llm_json(text: Column) -> Column:
    """The JSON within an answer: a fence labelled json, else any fence, else all of it."""
    fenced = F.regexp_extract(text, r"(?s)```json(.*?)```", 1)
    plain = F.regexp_extract(text, r"(?s)```(.*?)```", 1)
    return strip(F.when(fenced != "", fenced).when(plain != "", plain).otherwise(text))


def retry_after(message: Column) -> Column:
    """Seconds named by a rate-limit message, else null."""
    return F.nullif(F.regexp_extract(message, r"try again in ([\d.]+)s", 1), F.lit("")).try_cast("double")


def json_list(text: Column) -> Column:
    return F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))


def file_slug(topic: Column) -> Column:
    return F.substring(F.translate(topic, " /", "__"), 1, 50)


def type_colour(kind: Column) -> Column:
    return F.when(kind == "Event", "#FF6B35").when(kind.isNull(), "#999999").otherwise(F.concat(F.lit("#"), F.substring(F.md5(kind.cast("binary")), 1, 6)))


def host(url: Column) -> Column:
    """Lower-case host of a URL without a leading www."""
    return F.regexp_replace(F.lower(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit(""))), r"^www\.", "")


def html_title(html: Column) -> Column:
    return F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>([^<]*)</title>", 1))


def html_text(html: Column) -> Column:
    """Visible text by removing scripts, styles and tags."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"(?s)<[^>]*>", " "), r"\s+", " "))
