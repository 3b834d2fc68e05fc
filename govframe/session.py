"""Session construction and the shared scratch folder.

Every operator in the package takes a ``SparkSession`` that the caller
already owns; ``build_session`` is only a convenience for scripts, tests
and the benchmark.  Settings that matter at scale:

* AQE on, with partition coalescing and skew-join splitting, so the
  physical join strategy and the reducer count follow the measured
  shuffle sizes instead of a guess made at plan time.
* ``autoBroadcastJoinThreshold`` left at a bounded value: Spark only
  broadcasts a side whose measured size is under it, and falls back to a
  shuffled join beyond it.  The package adds explicit ``broadcast()``
  hints only where the row count is bounded by construction (one-row
  aggregates, per-partition counts, literal lists).
* Session time zone pinned to UTC; all timestamps in the data model are
  ``timestamp_ntz`` anyway, so nothing depends on the zone.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    app_name: str = "govframe",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings above; ``master`` and ``shuffle_partitions`` stay as the environment has them unless given."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("GOVFRAME_DRIVER_MEMORY", "16g"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` (or already set on the
    context) is used as is.  When neither is set, a run in one process
    (``local`` master) gets a fresh folder; on a cluster, whose machines
    share no local folder, that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        configured = tempfile.mkdtemp(prefix="govframe-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path inside the shared checkpoint folder.

    Used for snapshot and versioned-table writes so that every executor
    (and a re-run task on another host) sees the same files.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    leaf = "/".join(p.strip("/") for p in parts if p)
    return f"{base}/govframe/{leaf}/{uuid.uuid4().hex}" if leaf else f"{base}/govframe/{uuid.uuid4().hex}"
