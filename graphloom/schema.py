"""Explicit schemas of the engine's tables."""

ARTICLE = "id string, title string, content string, source string, published_at timestamp_ntz, url string, status string"
MENTION = "text string, entity_type string, confidence double, article_id string, span_start int, span_end int"
ENTITY = "canonical_id string, canonical_name string, entity_type string, aliases array<string>, mention_count long, first_seen timestamp, last_seen timestamp, embedding_vector array<float>"
EVENT = "event_id string, cluster_id int, temporal_window string, article_ids array<string>, representative_article_ids array<string>, context string"
TRIPLE = "event_id string, ord long, source string, relation string, relation_canonical string, target string, confidence double"
RESPONSE = "event_label string, triples array<struct<source string, relation string, target string, confidence double>>, discovered_types array<struct<entity_name string, suggested_type string, reasoning string>>"
NODE = "id string, name string, type string, mention_count long, cluster_id int, temporal_window string, aliases array<string>, article_count long"
EDGE = "source string, target string, relation string, confidence double, event_id string, original_relation string"
