"""The corpus pipeline: stages over documents, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from runlens.llm.bpe import encode_and_decode
from runlens.llm.common import stored, table
from runlens.llm.decontaminate import drop_leaks
from runlens.llm.importance import keep_good
from runlens.llm.longest_factor import keep_first_copies
from runlens.llm.near_dup import keep_one

STAGES = [
    ("quality", keep_good),
    ("near_dup", keep_one),
    ("repeats", keep_first_copies),
    ("leaks", drop_leaks),
    ("bpe", encode_and_decode),
]

# Hashed n-gram weights and byte-pair encoding have no SQL twin; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
