"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings of a session made by ``build_session``. Only the time zone matters
# for results; ``use_utc`` sets it on sessions made elsewhere.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    # Skip recording the Python call site of every column; it nearly doubles
    # the time the driver needs to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "candlelake", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session with the settings the operators expect."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone: candle dates are UTC dates everywhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a session whose executors are threads of the driver may fall back to a fresh temporary
    folder, which goes when the process ends; elsewhere that folder would live on one machine, so
    the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext._jsc.sc().isLocal():
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder(spark.sparkContext.applicationId)


@functools.cache
def _local_folder(application_id: str) -> str:
    folder = tempfile.mkdtemp(prefix="candlelake-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return os.path.join(shared_dir(spark), "candlelake", f"{name}-{uuid.uuid4().hex}")
