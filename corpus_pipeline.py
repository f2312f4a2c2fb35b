"""The training-data pipeline over ``documents``: five stages, each one operator.

quality rules -> SimHash near-duplicates -> benchmark decontamination -> private data ->
byte-level BPE. Every stage takes what the one before kept; all but the last return the
columns of ``documents`` (``n_chars`` is counted anew where a text has changed).
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtick.llm import bpe, decontaminate, quality, simhash, surrogates
from moodtick.llm.common import read
from moodtick.llm.queries import PII_KEY
from moodtick.session import shared_path


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the risk-controlled cutoffs accept."""
    return quality.accepted(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts whose fingerprints are linked."""
    return simhash.deduplicated(docs, shingle=4, max_bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark windows; documents that are mostly benchmark go."""
    return _counted(decontaminate.decontaminated(docs, read(spark, sf_dir, "benchmark"), max_coverage=0.5))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates for private data."""
    return _counted(surrogates.replaced(docs, PII_KEY))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (array of int), and the digests of ids and of the decoded bytes."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encoded(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN).select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII surrogates", private_data),
    ("byte-level BPE", tokens),
]

#: Suffix automata on words could be SQL, surrogates and BPE merges cannot.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again."""
    docs, folder = read(spark, sf_dir, "documents"), shared_path(spark, f"corpus-pipeline-{uuid.uuid4().hex}")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k + 1 == len(STAGES):
            return out
        path = f"{folder}/{k}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
