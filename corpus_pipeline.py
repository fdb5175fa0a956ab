"""The training-data pipeline: language ID, near-duplicate removal, substring dedup, benchmark
decontamination, source mixing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of ``documents``; the texts of
the third stage are shortened and their ``n_chars`` follows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vaultshift.llm import stages
from vaultshift.llm.common import Scratch

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", stages.language_id),
    ("ngram_jaccard_join", stages.near_duplicates),
    ("substring_dedup", stages.substring_dedup_stage),
    ("benchmark_decontamination", stages.decontaminate),
    ("source_mixing", stages.mix_sources),
]

#: Language ID and the searches are not expressible in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"{k}_{name}")
        if k:
            scratch.drop(f"{k - 1}_{STAGES[k - 1][0]}")
    return docs
