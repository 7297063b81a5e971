"""From raw documents to packed sequences: five stages, each written and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brimline.llm.common import settled, table
from brimline.llm.stages import (
    drop_near_copies,
    drop_poor_documents,
    hide_secrets,
    mix_sources,
    pack_documents,
)

STAGES = [
    ("quality_rules", drop_poor_documents),
    ("near_dedup", drop_near_copies),
    ("secret_scan", hide_secrets),
    ("source_mix", mix_sources),
    ("packing", pack_documents),
]

#: SQL has no byte-pair encoding, so packing cannot be written in it; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last returns its columns."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
