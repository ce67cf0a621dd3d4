"""Seed taxonomy from YAML."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

COLUMNS = "type_name string, parent_name string, is_auto_discovered boolean, is_confirmed boolean, ord int"


def seed_types(spark: SparkSession, path: str) -> DataFrame:
    """Confirmed types of a YAML file with ``entity_types: [{name, parent}]``; none if it is missing."""
    rows = []
    if os.path.exists(path):
        import yaml

        with open(path) as f:
            found = (yaml.safe_load(f) or {}).get("entity_types") or []
        rows = [(str(x["name"]).strip(), x.get("parent"), False, True, k) for k, x in enumerate(found)]
    return spark.createDataFrame(rows, COLUMNS)
