"""A training corpus from ``documents``: quality classifier, near duplicates,
benchmark decontamination, secret redaction, mix of sources.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns the columns of documents; the last one returns the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sackcast.llm import decontaminate, jaccard_join, mixing, quality, secret_scan
from sackcast.llm.shared import cut

#: Near duplicates: words of a shingle, and least Jaccard similarity in per cent.
WORDS, SIMILARITY = 5, 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier keeps (grade 2 likely enough), their columns unchanged
    whatever they are called. A null or empty text is rated as one without words; repeated rows are
    rated alike; where nothing is labelled all stay; an empty table gives none."""
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.kept_quality(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id; rows without a doc_id stay."""
    groups = jaccard_join.jaccard_components(docs, WORDS, SIMILARITY)
    heads = groups.where("doc_id = component_id").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(heads, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.where("doc_id is null")).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item. Rows without a doc_id are not looked at and stay,
    as do null and empty texts; rows that share a doc_id go together; an empty table gives none."""
    found = decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked; null texts stay null, repeated rows are masked alike, an
    empty table gives none."""
    return secret_scan.redact_secrets(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source): how many words of each document the mix takes."""
    return mixing.mix_sources(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("mixing", mixing_stage),
]

#: The classifier's fit and the draws of the mix have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs)
    return docs
