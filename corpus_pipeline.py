"""Corpus cleaning: ``STAGES`` applied to ``documents`` one after the other.

Each stage is a function (spark, docs, sf_dir) -> DataFrame. What it returns is
written as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from stratocast.llm import stages
from stratocast.llm.common import shared_folder, table

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("minhash_near_dedup", stages.drop_near_duplicates),
    ("suffix_array_dedup", stages.cut_repeats),
    ("benchmark_decontamination", stages.drop_contaminated),
    ("byte_bpe", stages.tokenise),
]

#: The stages are trained, iterative or byte-wise; plain SQL has no form of them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    folder = os.path.join(shared_folder(spark), f"pipeline-{uuid.uuid4().hex}")
    for number, (name, stage) in enumerate(STAGES):
        path = os.path.join(folder, f"{number}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
