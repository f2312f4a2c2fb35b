"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import os
import re
import uuid
from collections.abc import Callable
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# Words are runs of anything but these six characters (the ASCII white space).
SPACE = " \t\n\x0b\x0c\r"
#: Bytes of an Arrow batch between Spark and a worker. Spark's own bound is 10,000 rows, 35 MB
#: of documents of 3.5 kB: that much, doubled as it grows, for each core and each way.
BATCH = 2 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder (survives lost executors)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` as a path that workers open as files.

    Files that are memory-mapped need a folder mounted on every machine (NFS,
    Lustre, a FUSE mount); a folder that only Hadoop clients reach is refused."""
    url = urlparse(checkpoint_dir(spark))
    if url.scheme not in ("", "file"):
        raise ValueError(f"{kind}: spark.checkpoint.dir must be mounted on all machines, not {url.scheme}://")
    path = os.path.join(unquote(url.path), f"{kind}-{uuid.uuid4().hex}")
    os.makedirs(path)
    return path


def write_atomically(path: str, *chunks) -> None:
    """Write a file under a name of its own, then rename it: a retried or
    duplicate task replaces the file by an equal one."""
    part = f"{path}.{uuid.uuid4().hex}.part"
    with open(part, "wb") as f:
        for c in chunks:
            f.write(c)
    os.replace(part, path)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches are cut at BATCH bytes too, however many rows
    that is (one row at least); a bound that the session has set is kept. Spark reads the
    bound when the query runs, so it stays set."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(name, None) is None:
        conf.set(name, str(BATCH))
    return df


#: What this worker remembers: the key of the operator it last worked for, and a value.
_HELD: list = [None, None]


def forget() -> None:
    """Workers outlive their stage; what they remember for an operator must not."""
    if _HELD[0] is not None:
        _HELD[:] = [None, None]
        gc.collect()  # remembered results may refer to their maker and back


def held(key, make: Callable):
    """``make()``, remembered by this worker from task to task until it works for another
    operator (another key, or ``forget``)."""
    if _HELD[0] != key:
        forget()
        _HELD[:] = [key, make()]
    return _HELD[1]


def clean_name(df: DataFrame, name: str) -> str:
    """``name``, or the name with underscores that ``df`` has no column of (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def bucket(doc_id: Column | str, n: int) -> Column:
    """crc32(doc_id as text) mod n; a null doc_id has the text ''."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def regex_any(strings) -> str:
    """An alternation of literal strings, longest first."""
    return "|".join(re.escape(s) for s in sorted(strings, key=lambda s: (-len(s), s)))
