"""From raw documents to tokens: toxic documents go, one document of each group of near copies stays, documents
with benchmark passages go, personal data is masked, and what is left is encoded.

Each stage takes (spark, documents, folder of the tables) and returns the rows it keeps, in the
columns of documents; the last returns tokens. None of them can be said in SQL (a trained scorer,
connected components, trained span weights, an encoder), so there is no SQL for the whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from goldseam.llm import bpe, decontamination, jaccard, pii, toxicity
from goldseam.llm.bound import VOCABULARY
from goldseam.llm.common import stored, table
from goldseam.llm.registry import importable


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return toxicity.reject(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return jaccard.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"), short_items=True)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return bpe.tokens(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("personal_data", mask_personal_data),
    ("tokens", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, each stage before it written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
