"""The corpus pipeline: language ID, exact dedup, near dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``.  All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import exact_dedup, langid, minmax_dedup, mixing, packing
from daybook.llm.common import documents, fold
from daybook.session import ensure_checkpoint_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest-centroid classifier doesn't reject."""
    model = langid.fit(docs, train=fold(F.col("doc_id"), 5) != 0)
    return langid.identify(docs, model).where("NOT lang_rejected").select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at 80 % of five-word shingles."""
    return minmax_dedup.drop_near(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often and as far as the mix takes them."""
    return mixing.take(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences with their token ids."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("mixing", mix),
    ("packing", pack),
]

#: Language ID and packing are not expressible in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        out = f"{at}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
