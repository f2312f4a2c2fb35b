"""Keyed Parquet table with idempotent, copy-on-write partition merges.

Layout below ``root``::

    data/b<version>-<id>/window_part=<p>/part-*.parquet   rows of partition p as of a version
    _log/<version>.json             what a commit added and removed (``commit_log``)
    _rejects/b<version>-<id>/       rows that break the table's constraints (on_violation="reject")

A partition is a day (``granularity="day"``, e.g. ``2024-01-01``) or an hour
(``"hour"``, e.g. ``2024-01-01T10``). A stream in append mode emits each window
once, when it closes, so a micro-batch touches the newest partition; with hour
partitions a batch rewrites at most one hour of windows instead of a whole day.

A merge reads only the current files of the partitions the batch touches, replaces
the batch's keys there (``merge_frames``), writes those partitions to a folder of its
own with a normal distributed write, and then publishes a log entry. Readers always
see a complete snapshot; a folder being read is never overwritten. The entry holds
each folder's rows, smallest and largest ``window_start`` and nulls per column, so a
range read and the newest N rows open only the folders that can hold them.

Batch ids belong to a writer (a stream with its checkpoint): the log keeps the last id
of each, so a replayed batch is a no-op, while a new checkpoint, a second stream or a
backfill (no id) always merges. Any number of writers may merge at once: the one whose
version exists already looks at what came between, merges again where it touched the
same partitions, and publishes under the next version.

File-system access goes through Hadoop's FileSystem API; ``root`` must be on a
shared store with an atomic rename (HDFS, NFS). Readers may run at any time.
``vacuum`` deletes partition folders and log entries that none of the newest
snapshots needs; ``expire`` drops partitions by age.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import METRICS, METRICS_KEY, TICKER_MAX_LEN
from .commit_log import CommitLog, Conflict, State
from .merge import dedup_batch, merge_frames

PARTITION_COL = "window_part"
GRANULARITY = {"day": "yyyy-MM-dd", "hour": "yyyy-MM-dd'T'HH"}
ATTEMPTS = 20  # merges against newer snapshots before a batch fails


def _iso(t: dt.datetime) -> str:
    return t.isoformat(timespec="microseconds")


class KeyedParquetTable:
    def __init__(self, spark: SparkSession, root: str, schema=METRICS, key=METRICS_KEY, granularity: str = "day"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.key = tuple(key)
        fmt = GRANULARITY[granularity]
        self.partition_of = lambda: F.date_format(F.col("window_start"), fmt)
        self.log = CommitLog(spark, self.root)

    def current(self) -> dict | None:
        """version, writers, partitions (value -> folder) of the newest snapshot; None for a new table."""
        s = self.log.state()
        if s.version < 0:
            return None
        return {"version": s.version, "writers": s.writers, "partitions": self._partitions(s), "rejects": s.rejects}

    @staticmethod
    def _partitions(state: State) -> dict[str, str]:
        return {info["part"]: path for path, info in state.files.items()}

    # ---------------------------------------------------------------- read
    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def _open(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self._empty()
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/{p}" for p in sorted(paths)])

    def read(self, dates: list[str] | None = None, version: int | None = None) -> DataFrame:
        """The current snapshot, or that of a version still kept (optionally only some
        partitions, by partition value)."""
        parts, wanted = self._partitions(self.log.state(version)), None if dates is None else set(dates)
        return self._open([path for d, path in parts.items() if wanted is None or d in wanted])

    def read_range(self, start: dt.datetime | None = None, end: dt.datetime | None = None) -> DataFrame:
        """Rows with start <= window_start < end, from the folders whose bounds meet the range."""
        a, z = start and _iso(start), end and _iso(end)
        files = self.log.state().files
        df = self._open([p for p, s in files.items() if (a is None or s["max"] >= a) and (z is None or s["min"] < z)])
        if start is not None:
            df = df.where(F.col("window_start") >= F.lit(start).cast("timestamp_ntz"))
        return df if end is None else df.where(F.col("window_start") < F.lit(end).cast("timestamp_ntz"))

    def newest(self, n: int) -> DataFrame:
        """The ``n`` rows with the largest window_start (ties by ticker): folders are taken
        from the newest on until ``n`` rows lie above all that is left."""
        left = sorted(self.log.state().files.items(), key=lambda f: f[1]["max"], reverse=True)
        taken: list[tuple[str, dict]] = []
        while left and (not taken or sum(s["rows"] for _, s in taken if s["min"] > left[0][1]["max"]) < n):
            taken.append(left.pop(0))
        order = [F.col("window_start").desc(), F.col(self.key[0]).asc()]
        return self._open([p for p, _ in taken]).orderBy(*order).limit(n)

    # ---------------------------------------------------------------- write
    def merge(self, batch: DataFrame, batch_id: int | None = None, writer: str = "default", on_violation: str = "raise") -> bool:
        """Upsert ``batch``. Returns False when ``writer`` has merged this ``batch_id``
        already (replay) or the batch is empty; without an id it always merges. Raises
        on any failure so that a streaming query retries the batch instead of
        committing it. Rows that break the table's constraints raise, or go to the
        reject table of this commit (``on_violation="reject"``, see ``rejects``)."""
        state = self.log.state()
        if batch_id is not None and state.writers.get(writer, -1) >= batch_id:
            return False
        b = dedup_batch(batch.select(*[f.name for f in self.schema.fields]), self.key).withColumn(
            PARTITION_COL, self.partition_of()
        )
        # used twice (partitions, then the write): keep the deduplicated batch instead of recomputing it
        b = b.withColumn("reason", self._violation()).persist()
        try:
            return self._merge(b, batch_id, state, writer, on_violation)
        finally:
            b.unpersist()

    def _violation(self):
        """Why a row may not be in the table: key parts and window end NOT NULL, ticker
        at most TICKER_MAX_LEN characters; NULL for a good row."""
        ticker, start = self.key[0], self.key[1]
        return (
            F.when(F.col(ticker).isNull() | F.col(start).isNull(), "null key")
            .when(F.col("window_end").isNull(), "null window_end")
            .when(F.length(ticker) > TICKER_MAX_LEN, "long ticker")
        )

    def _merge(self, b: DataFrame, batch_id: int | None, state: State, writer: str, on_violation: str) -> bool:
        # The partitions a batch touches (a metadata list bounded by the batch's
        # time span), with the table's constraints checked in the same pass.
        stats = b.groupBy(PARTITION_COL, "reason").agg(F.count(F.lit(1)).alias("n")).collect()
        bad = [r for r in stats if r["reason"] is not None]
        if bad and on_violation != "reject":
            raise ValueError(f"batch {batch_id} violates the table's key constraints: {bad[:3]}")
        touched = {r[PARTITION_COL] for r in stats if r["reason"] is None}
        if not stats:
            return False
        name = f"b{state.version + 1:012d}-{uuid.uuid4().hex[:8]}"
        if bad:
            b.where("reason IS NOT NULL").drop(PARTITION_COL).write.parquet(f"{self.root}/_rejects/{name}")
        good, added, based_on = b.where("reason IS NULL").drop("reason"), None, {}
        for _ in range(ATTEMPTS):
            base = {d: p for d, p in self._partitions(state).items() if d in touched}
            if added is None or base != based_on:  # nothing written yet, or another writer changed these partitions
                added = self._rewrite(good, list(base.values()), f"data/b{state.version + 1:012d}-{uuid.uuid4().hex[:8]}") if touched else {}
                based_on = base
            try:
                self.log.commit(state, added, list(base.values()), writer, batch_id, (name,) if bad else ())
                return True
            except Conflict:
                state = self.log.state()
                if batch_id is not None and state.writers.get(writer, -1) >= batch_id:
                    return False
        raise RuntimeError(f"batch {batch_id}: {ATTEMPTS} other commits came first")

    def _rewrite(self, batch: DataFrame, current: list[str], stage: str) -> dict[str, dict]:
        """Write the touched partitions with the batch merged in; their statistics by folder."""
        old = self._open(current).withColumn(PARTITION_COL, self.partition_of())
        merged = merge_frames(old, batch, list(self.key) + [PARTITION_COL], deduped=True)
        (
            # (partition, ticker) spreads a partition over tasks; one such group is bounded by its window count
            merged.repartition(PARTITION_COL, self.key[0])
            .write.partitionBy(PARTITION_COL)
            .parquet(f"{self.root}/{stage}")
        )
        names = [f.name for f in self.schema.fields]
        written = self.spark.read.schema(f"{self._ddl()}, {PARTITION_COL} string").parquet(f"{self.root}/{stage}")
        nulls = F.struct(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
        zones = written.groupBy(PARTITION_COL).agg(
            F.count(F.lit(1)).alias("rows"), F.min("window_start").alias("lo"), F.max("window_start").alias("hi"), nulls.alias("nulls"))
        return {
            f"{stage}/{PARTITION_COL}={r[PARTITION_COL]}": {
                "part": r[PARTITION_COL], "rows": r["rows"], "min": _iso(r["lo"]), "max": _iso(r["hi"]),
                "nulls": {c: k for c, k in r["nulls"].asDict().items() if k},
            }
            for r in zones.collect()
        }

    def _ddl(self) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)

    def rejects(self) -> DataFrame:
        """Rows of committed batches that broke a constraint, with the reason."""
        names = self.log.state().rejects
        if not names:
            return self._empty().withColumn("reason", F.lit(None).cast("string"))
        return self.spark.read.parquet(*[f"{self.root}/_rejects/{n}" for n in names])

    # ---------------------------------------------------------------- housekeeping
    def expire(self, before: dt.datetime) -> list[str]:
        """Drop the partitions whose windows all start before ``before``; their values."""
        for _ in range(ATTEMPTS):
            state = self.log.state()
            old = {p: s["part"] for p, s in state.files.items() if s["max"] < _iso(before)}
            if not old:
                return []
            try:
                self.log.commit(state, {}, list(old), writer="expire")
                return sorted(old.values())
            except Conflict:
                continue
        raise RuntimeError(f"expire: {ATTEMPTS} other commits came first")

    def vacuum(self, retain: int = 2, orphan_age: float = 86400.0) -> list[str]:
        """Delete what the newest ``retain`` snapshots do not need: superseded partition
        folders, emptied batch folders and older log entries; of folders that no commit
        ever named (a writer failed, or is at work) those older than ``orphan_age``
        seconds. A reader of a retained snapshot is unaffected. Returns the deleted paths."""
        entries = self.log.entries()
        newest = self.log.state()
        if newest.version < retain:
            return []
        oldest = self.log.state(newest.version - retain + 1)
        keep = set(oldest.files) | {p for e in entries if e["version"] > oldest.version for p in e["add"]}
        superseded = {p for e in entries for p in e["remove"]} - keep
        fs, deleted = self.log.fs, []
        for p in sorted(superseded):
            if fs.delete(self.log.path(f"{self.root}/{p}"), True):
                deleted.append(p)
        data, live = self.log.path(f"{self.root}/data"), {p.split("/")[1] for p in keep}
        named = {p.split("/")[1] for p in superseded}
        if fs.exists(data):
            for batch in fs.listStatus(data):
                name = batch.getPath().getName()
                age = time.time() - batch.getModificationTime() / 1000
                if name not in live and (name in named or age > orphan_age):
                    fs.delete(batch.getPath(), True)
                    deleted.append(f"data/{name}")
        return deleted + self.log.forget(retain)

    def foreach_batch(self, vacuum_every: int | None = None, retain: int = 2, writer: str = "stream", on_violation: str = "raise"):
        """A ``foreachBatch`` callback that merges each micro-batch (and, if
        ``vacuum_every`` is set, vacuums after every that many batch ids).
        ``streaming.pipeline.start`` passes the checkpoint as the writer, so that
        batch ids of different checkpoints are kept apart."""

        def _fn(df: DataFrame, epoch_id: int, writer: str = writer) -> None:
            self.merge(df, epoch_id, writer, on_violation)
            if vacuum_every and epoch_id % vacuum_every == 0:
                self.vacuum(retain)

        _fn.takes_writer = True
        return _fn
