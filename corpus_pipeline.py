"""From raw documents to packed training sequences.

Each stage takes all that its predecessor kept, is written as Parquet in the shared folder and read again by the next. In every
stage a missing text counts as empty, texts are read whole however long they are, columns of any other name are handed on unread,
and an empty table gives an empty result. What repeated rows and missing values of doc_id, lang and source give, is told per stage.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from delaylake.llm.common import configure, written  # noqa: E402
from delaylake.llm.exact_dedup import without_duplicates  # noqa: E402
from delaylake.llm.mixing import mixed_documents  # noqa: E402
from delaylake.llm.near_copies import without_near_copies  # noqa: E402
from delaylake.llm.packing import default_tokenizer, pack_documents  # noqa: E402
from delaylake.llm.quality_rules import clean_documents  # noqa: E402
from delaylake.session import releasing  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the outlier rule rejects go; rows alike in doc_id and text stay once.

    A missing language or source is a group of its own. Missing and empty texts have no words, so they go.
    """
    configure(spark)
    return clean_documents(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays, one of them where doc_ids are equal too; a missing doc_id is the smallest."""
    configure(spark)
    return without_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by at least four fifths of their five-word shingles the row with the least doc_id stays.

    Of repeated rows one stays; a row without doc_id stays only where its whole group has none.
    """
    configure(spark)
    return without_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources take them; the last one of a source may come cut to its first words.

    A missing source is a source of its own, last in order. Rows alike in doc_id and text count as one document with their
    shares together; documents without words are never taken.
    """
    configure(spark)
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids (unsigned 32 bits, little-endian) and their places in sequences of at most 1024 ids."""
    configure(spark)
    return pack_documents(docs, default_tokenizer(), with_ids=True)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("source_mixing", mixing),
    ("packing", packing),
]

#: Estimates by concentration steps, fingerprints and best fit have no plain SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; what a stage writes on its way goes when its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with releasing(spark, f"pipeline_{name}"):
            docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
