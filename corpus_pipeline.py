"""A corpus from raw documents to packed sequences, stage by stage.

In every stage a null text is an empty one, a null doc_id, lang or source is allowed, rows
that repeat are judged alike and stay or go together, no rows give no rows, and columns
beyond those of documents are handed on unchanged whatever their names, up to packing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from awareness_mart.llm.common import read, scratch_folder, without
from awareness_mart.llm.decontaminate import contained_items
from awareness_mart.llm.near_dups import near_duplicates
from awareness_mart.llm.packing import packed
from awareness_mart.llm.quality import judged
from awareness_mart.llm.secret_scan import redacted


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    Null and empty texts have no words and go. A row without source is judged by itself.
    """
    return without(docs, judged(docs, by_rule=True).where("not kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest doc_id.

    Texts without words and rows without doc_id are linked with nothing and stay; rows that
    share a doc_id are one document.
    """
    copies = near_duplicates(docs).where("not kept").select("doc_id")
    return docs.join(copies.distinct(), "doc_id", "left_anti").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go; texts without words contain none."""
    return without(docs, contained_items(docs, read(spark, sf_dir, "benchmark")))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; n_chars follows. A null text stays null, as its n_chars."""
    return redacted(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens; an empty text is its end token alone."""
    return packed(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("secrets", secrets),
    ("packing", packing),
]

# Tokenizers, likelihoods and a stage that trains a model are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what each returns is written and read again by the next."""
    folder = f"{scratch_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
