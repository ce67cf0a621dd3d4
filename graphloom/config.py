"""Settings, passed explicitly; every threshold of the operators has its default here."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Settings:
    duplicate_similarity: float = 0.95  # l2sq similarity, a cosine of 0.975
    duplicate_neighbours: int = 10
    entity_similarity: float = 0.88
    fuzzy_ratio: float = 85.0
    fuzzy_candidates: int = 5
    fuzzy_weight: float = 0.4
    relation_similarity: float = 0.85
    type_similarity: float = 0.82
    event_similarity: float = 0.78
    min_cluster_size: int = 2
    representatives: int = 3
    content_chars: int = 2000
    excerpt_chars: int = 300
    prompt_chars: int = 4000
    ner_batch: int = 32
    embedding_batch: int = 64
    embedding_dim: int = 64
    llm_batch: int = 10
    llm_workers: int = 5
    active_labels: int = 50
    top_k: int = 20
    type_induction: bool = True
    relation_clustering: bool = True
    interval_days: int = 3
    max_per_interval: int = 50
    # What labels a tagger is given where no type is known yet.
    generic_labels: tuple[str, ...] = field(default=("Person", "Organization", "Location", "Event"))


STATUSES = ("ingested", "embedded", "deduplicated", "clustered", "llm_done", "graph_built")
