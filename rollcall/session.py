"""Session settings and the shared scratch location.

Library operators never create a session: the caller owns it. This module is
for scripts and tests (bench, pytest), and for finding the shared folder where
jobs may materialise intermediate tables.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for these plans at any scale.
RECOMMENDED_CONF = {
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, switch a join to broadcast from measured sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int | None = None,
    app: str = "rollcall",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """A local session for tests and the benchmark (UI off)."""
    parts = shuffle_partitions or (os.cpu_count() or 8)
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.driver.memory", os.environ.get("ROLLCALL_DRIVER_MEMORY", "8g"))
    )
    for k, v in {**RECOMMENDED_CONF, **(extra_conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


#: Folders named by scratch_path and not yet dropped.
_SCRATCH: list[str] = []


def _classic_context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no context
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and is read, never replaced.
    Only when it is unset and the master is local (tests) is a fresh local
    folder chosen; elsewhere a missing setting raises.
    """
    sc = _classic_context(spark)
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc is None or not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="rollcall-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def drop_scratch(spark: SparkSession) -> None:
    """Delete every folder that :func:`scratch_path` has named in this
    process. Call it when no result over a staged table is still to be read."""
    sc = _classic_context(spark)
    while _SCRATCH:
        path = _SCRATCH.pop()
        if sc is not None:
            target = sc._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
