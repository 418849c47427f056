"""Corpus specifications in YAML: entities, their documents and the slots that give mentions."""

from __future__ import annotations

import os
from typing import Any
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def slot_values(slots: Any, name: str = "") -> list[tuple[str, str]]:
    """``(slot, value)`` pairs of nested lists and mappings."""
    if isinstance(slots, dict):
        return [pair for k, v in slots.items() for pair in slot_values(v, str(k))]
    if isinstance(slots, (list, tuple)):
        return [pair for v in slots for pair in slot_values(v, name)]
    return [] if slots is None else [(name, str(slots))]


def spec_rows(spec: dict[str, Any]) -> list[tuple[str, str, str, list[str]]]:
    """``(path, url, target, mentions)`` of each file of each entity; folders are walked in order."""
    root, base = spec.get("root_path", ""), spec.get("abs_url_base", "")
    rows = []
    for entity in spec["entities"]:
        mentions = sorted({v for _, v in slot_values(entity.get("slots"))})
        paths = entity["doc_path"] if isinstance(entity["doc_path"], list) else [entity["doc_path"]]
        for entry in paths:
            sub, url = (entry["doc_path"], entry.get("abs_url")) if isinstance(entry, dict) else (entry, None)
            full = os.path.join(root, sub)
            files = [full] if os.path.isfile(full) else sorted(os.path.join(d, f) for d, _, names in os.walk(full) for f in names)
            for f in files:
                relative = os.path.relpath(f, root)
                if url and os.path.isfile(full):
                    address = url
                elif url:
                    address = f"{url}#{quote(os.path.relpath(f, full))}"
                else:
                    address = (base or "http://") + relative
                rows.append((f, address, entity["target_id"], mentions))
    return rows


def read_spec(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Documents (``path, abs_url, raw``) and ratings of a specification; a document named by many entities comes once."""
    import yaml

    with open(path) as f:
        spec = yaml.safe_load(f)
    listed = spark.createDataFrame(spec_rows(spec), "path string, abs_url string, target_id string, mentions array<string>")
    merged = listed.groupBy("path", "target_id").agg(F.first("abs_url").alias("abs_url"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("mentions")))).alias("mentions"))
    documents = merged.groupBy("path").agg(F.min("abs_url").alias("abs_url"))
    files = spark.read.format("binaryFile").load(sorted({r[0] for r in spec_rows(spec)})).select(F.regexp_replace("path", "^file:/*", "/").alias("path"), F.col("content").alias("raw"))
    annotator = spec.get("annotator_id", "")
    ratings = merged.select("path", F.lit(annotator).alias("annotator_id"), "target_id", "mentions")
    return documents.join(files, "path").withColumn("source", F.lit(spec.get("source"))), ratings
