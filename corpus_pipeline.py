"""Corpus pipeline: five stages from raw documents to token digests.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and
reread as the next one's docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from geoweather.llm import bpe, langid, mixing, neardup, pii
from geoweather.llm.common import stage, table

STAGES = [
    ("language id", langid.stage_language),
    ("near duplicates", neardup.stage_near_duplicates),
    ("pii", pii.stage_pii),
    ("mix sources", mixing.stage_mix),
    ("byte bpe", bpe.stage_encode),
]

# SQL cannot express the random field, MinHash components or the merges; tests compare the operators, not yet all of run(), with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents."""
    docs = table(spark, sf_dir, "documents")
    for name, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
