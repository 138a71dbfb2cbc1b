"""Staging and small column helpers of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmill.scratch import scratch

# One word: a run without the six white-space characters of ASCII.
WORD = r"[^\x20\x09-\x0D]+"


def stage(frame: DataFrame, what: str) -> DataFrame:
    """The rows as a written table: cuts the lineage and outlives lost executors."""
    folder = scratch(frame.sparkSession, what)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def whole(text: Column | str) -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: Column | str) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)
