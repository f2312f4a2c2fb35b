"""Session construction and shared-folder helpers."""

from __future__ import annotations

import contextlib
import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of the engine needs, whatever the cluster size.
REQUIRED_CONF = {
    # event time and stored timestamps are UTC, independent of the driver's TZ
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Broadcast only what has been measured: no broadcast from static size
    # estimates; AQE turns a shuffle join into a broadcast join once the
    # finished shuffle stage has shown that side to be below the bound.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
}

# Defaults a launcher may override (``build_session(extra=...)``).
DEFAULT_CONF = {
    # texts can be 20k words; keep Arrow batches to the Python scorer small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def build_session(
    master: str | None = None,
    app_name: str = "moodtick",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine's required settings.

    On a cluster ``master`` stays None and the launcher decides; tests pass
    ``local[*]``. The UI is off: nothing here serves pages.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **REQUIRED_CONF}.items():
        b = b.config(k, v)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_required(spark)
    return spark


def apply_required(spark: SparkSession) -> None:
    """Apply the runtime-settable part of REQUIRED_CONF to an existing session."""
    for k, v in REQUIRED_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a running session: keep what it has
            pass


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    It is a static setting, read from the session's configuration. Only when the
    session has none (tests, local runs) a fresh local folder is registered on
    the SparkContext; a cluster must configure a shared one.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
    if not d:
        d = tempfile.mkdtemp(prefix="moodtick-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder (for stream checkpoints, stage tables)."""
    base = checkpoint_dir(spark)
    return os.path.join(base, *parts) if "://" not in base else "/".join([base.rstrip("/"), *parts])


@contextlib.contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]):
    """Set runtime SQL settings for the duration of a block, then restore them."""
    prev = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in prev.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def stream_width(spark: SparkSession) -> dict[str, str]:
    """State width for the replay streams: one state partition per core of the
    cluster (a stateful stream keeps the width of its first start)."""
    return {"spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism)}
