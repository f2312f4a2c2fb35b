"""A versioned lexicon table that running streams pick up.

``<root>/v=<n>`` is one whole version, published by a rename to a name that must not exist
yet, so a reader sees finished versions only. A scoring stream looks for the newest version
at the start of every micro-batch, and writes its number beside every score.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LEXICON
from ..sinks.commit_log import publish_new


class LexiconTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def versions(self) -> list[int]:
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[2:]) for n in names if n.startswith("v="))

    def publish(self, entries: DataFrame) -> int:
        """A new version from (token, valence) rows: tokens in lower case, each once (the
        mean of several valences); entries without a valence are left out. Tokens that no
        text can hold stay in the table (see ``unmatched``)."""
        version = max(self.versions(), default=-1) + 1
        staged = f"{self.root}/_staged/{uuid.uuid4().hex}"
        own = entries.select(F.lower(F.trim("token")).alias("token"), F.col("valence").cast("double").alias("valence"))
        own.dropna().groupBy("token").agg(F.avg("valence").alias("valence")).write.parquet(staged)
        publish_new(self.spark, staged, f"{self.root}/v={version}")
        return version

    def read(self, version: int) -> DataFrame:
        return self.spark.read.schema(LEXICON).parquet(f"{self.root}/v={version}")

    def unmatched(self, version: int) -> DataFrame:
        """The entries that no token can match (tokens are runs of a-z)."""
        return self.read(version).where(~F.col("token").rlike("^[a-z]+$"))
