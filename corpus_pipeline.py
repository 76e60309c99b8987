"""A training corpus from ``documents``: quality, language, near-duplicates, personal data, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet in the shared checkpoint folder and read again as the next stage's docs,
so a lost executor costs no more than the stage it worked on.  All stages but the
last return the columns of ``documents``; the last returns the packed pieces.

No stage can be expressed in SQL as a whole (compression, kernel learning,
min-hashing, tokenisers), so ``ORACLE_SQL`` is None and tests hold the result
against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from metroflux.llm import op1_language, op3_packing, op4_minhash, op5_quality, op8_pii
from metroflux.llm.common import STAGED, drop_staged, read_table, stage

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the compression bands."""
    return op5_quality.keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the kernel classifier tells; it learns on the rows left by the stage before."""
    return op1_language.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, linked from a similarity of 0.8: that of the smallest id."""
    return op4_minhash.keep_first(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates; n_chars follows."""
    return op8_pii.replace(docs, length_col="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their sequence and place."""
    return op3_packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("PII", pii),
    ("best-fit packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage wrote for itself and its predecessor goes when its own result is written."""
    docs, before = read_table(spark, sf_dir, "documents"), len(STAGED)
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), "pipeline-" + name.lower().replace(" ", "-"))
        drop_staged(spark, since=before, keep=1)
    return docs


def queries():
    return {"pipeline": run}


def oracle_sql():
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
