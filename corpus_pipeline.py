"""Corpus cleaning: from raw documents to token pieces, one operator a stage.

Every stage takes ``(spark, docs, sf_dir)`` with ``docs`` in the columns of the
documents table, works on all rows that the one before kept, and returns a
DataFrame that is written as Parquet and read again for the next.
"""

from pyspark.sql import DataFrame, SparkSession

from admesh.llm import decontaminate, hyperminhash, pieces, pii, quality
from admesh.llm.tables import SCHEMAS, table
from admesh.storage import RunFolder


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects as junk or toxic."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group of near duplicates."""
    return hyperminhash.keep_one(docs, RunFolder(spark))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"), RunFolder(spark))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With personal data replaced by its kind."""
    return pii.redact(docs, RunFolder(spark))


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The best segmentation into pieces of every document, and the next best ones as edits.

    The pieces are decoded, too: each row carries the decoded text's digest, and
    a text that does not come back is an error.
    """
    return pieces.encode_documents(docs, verify=True)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("pii", redacted),
    ("sentencepiece", as_pieces),
]

# Training, sketches and the piece lattice have no SQL form; tests/llm/test_pipeline.py checks the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; returns the last one's rows."""
    folder = RunFolder(spark)
    docs = spark.read.schema(SCHEMAS["documents"]).parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = folder.write(stage(spark, docs, sf_dir), name)
    return docs
