"""The corpus pipeline: documents through five stages of the llm package.

Each stage gets what its predecessor kept. All but the last return the columns
of documents; the last returns them with ``copy_no``. NULL and empty texts leave
at the first stage (no language); an empty table stays empty. Repeated rows are
copies of each other: one of them stays. Of near duplicates the smallest doc_id
stays (a NULL id before all others; of equal ids the smallest set fingerprint), so
ties give the same rows on every run. Long texts are read whole. Further columns
are kept as they are, whatever their names; only ``text``, ``n_chars`` and an
input column named ``copy_no`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationday.llm import decontaminate, language, ngram_join, pii
from stationday.llm.common import BATCH_SETTING, bounded_batches, on_workers, saved, table
from stationday.llm.mixing import mixed_documents


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised, by a model of the same rows that
    the query learns from."""
    on_workers(spark)
    bounded_batches(spark)
    return language.accepted(docs, language.train(docs, language.training_rows(F.col("doc_id"))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8)."""
    on_workers(spark)
    bounded_batches(spark)
    return ngram_join.one_per_group(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    bounded_batches(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data replaced by its kind."""
    return pii.redact(docs, pii.train(pii.detect(docs)))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is taken, numbered by copy_no."""
    return mixed_documents(docs)


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", private_data),
    ("mixing", mixing),
]

#: Trained models, SimHash and random rounding: no SQL for the whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again."""
    docs, own = table(spark, sf_dir, "documents"), spark.conf.get(BATCH_SETTING, None)
    try:
        for name, stage in STAGES:
            docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    finally:
        if own is None:
            spark.conf.unset(BATCH_SETTING)
    return docs
