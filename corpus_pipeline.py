"""The corpus pipeline: each stage works on the rows its predecessor kept.

Quality classifier, language identification, near-duplicate removal, personal data, packing. Every
stage but the last returns the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakeops.llm.common import table
from lakeops.llm.langid import keep_identified
from lakeops.llm.packing import pack
from lakeops.llm.pii import sanitise
from lakeops.llm.quality_gam import keep_good
from lakeops.llm.simhash import keep_one_of_each
from lakeops.session import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return keep_identified(docs)


def distinct_enough(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one_of_each(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, and terms that give it away, generalised or removed."""
    return sanitise(docs, scope="document")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("language", known_language),
    ("near_duplicates", distinct_enough),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

# Trained models, fingerprints and token ids are not SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
