"""A corpus pipeline: each stage reads what its predecessor kept.

Stages take (spark, docs, sf_dir) and return a DataFrame; ``run`` writes each one as
Parquet to the shared folder and reads it back for the next. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from glean.llm import jaccard_join, mil_quality, mixing, packing, secret_linking  # noqa: E402
from glean.llm.common import save, table  # noqa: E402

#: The tokenizer of the packing stage.
TOKENIZER = "word_bpe_49k.json"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the attention classifier accepts (score of at least its cutoff)."""
    return mil_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id."""
    return jaccard_join.keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets and linked credentials masked; n_chars stays what it was."""
    return secret_linking.mask(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    import public_tokenizers

    return packing.packed(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("secret scans", without_secrets),
    ("mixing", mixed),
    ("packing", packed),
]

#: Tokenizer ids and a trained model can't be expressed in SQL; tests/llm/test_pipeline.py compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
