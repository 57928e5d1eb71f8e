"""The corpus pipeline: from raw documents to a mixed, tokenised corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's docs; all but the last return the
columns of documents.  n_chars follows the text where a stage changes it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.llm import langid, line_dedup, mixing, pieces, simhash
from souk.llm.common import table
from souk.session import ensure_checkpoint_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told (no letter, or no trigram of a language that was learned) go."""
    return langid.keep_identified(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in at least ten documents go."""
    out = line_dedup.drop_lines(docs, min_docs=10)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the numbers that bring every source to its target."""
    return mixing.mixed_documents(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_pieces, scores, round_trip of every document of the mix."""
    return pieces.encode(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("simhash_dedup", simhash_dedup),
    ("source_mixing", source_mixing),
    ("sentencepiece", sentencepiece),
]

# SimHash and n-best segmentation cannot be expressed in SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; what is between them lies in the cluster's shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
