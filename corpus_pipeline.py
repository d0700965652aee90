"""The corpus pipeline: quality, near-dedup, decontamination, PII, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's ``docs``; all but the last return the columns of ``documents``.
Counted as part of the ``contrail.llm`` subpackage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import decontaminate, packing, pii, quality, simhash
from contrail.llm.common import cut, table
from contrail.llm.queries import QUALITY_THRESHOLD, vocabulary_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble rejects (score below the threshold) go."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored, score = quality.scored(docs, model)
    return scored.where(F.col(score) >= QUALITY_THRESHOLD).select(*docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays: the one with the smallest id."""
    return simhash.one_of_each(docs, shingle=3, max_distance=2)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; long benchmark passages are cut out of the others."""
    return decontaminate.remove_contamination(docs, table(spark, sf_dir, "benchmark"), window=13, coverage=20)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced in the texts."""
    return pii.sanitised(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into training sequences (one row per piece, with its token ids)."""
    return packing.pack(docs, vocabulary_path(), sequence=1024, added_tokens=True, with_ids=True)


STAGES = [("quality", quality_stage), ("near_dedup", dedup_stage), ("decontamination", decontamination_stage),
          ("pii", pii_stage), ("packing", packing_stage)]

#: Model scores, hashes and token ids cannot be expressed in SQL: a brute-force test stands in.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
