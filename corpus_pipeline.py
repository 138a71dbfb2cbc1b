"""A corpus pipeline of the training-data operators; each stage reads what the one before kept.

All stages but the last return the columns of the documents they got. Null and empty texts fail the
quality rules; repeated rows are deduplicated; an empty table goes through as one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridmill.llm import exact, mixing, near, pieces, quality
from gridmill.llm.common import documents, stage


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that fail no rule of the full policy."""
    return quality.accepted(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest doc_id."""
    return exact.unique_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each component of texts that share 80 % of their five-word shingles: the
    one with the smallest doc_id."""
    return near.unique_documents(docs)


def source_mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix draws them: none, one or two rows each."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """``doc_id, source, lang`` and ``ids``, ``begins``, ``ends``: pieces and the bytes they cover."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = pieces.encode_pieces(docs, model, keep=("doc_id", "source", "lang"))
    return rows.drop("decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("encode", encode),
]

# The last stage is a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again."""
    docs = documents(spark, sf_dir)
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
