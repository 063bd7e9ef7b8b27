"""Shared working directories for checkpoints and staged tables."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

from adpulse.sinks.files import make_temporary

_local: tempfile.TemporaryDirectory | None = None


def scratch_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may do without: there every task sees the same disk, and a
    temporary folder that goes away with the process is used.
    """
    global _local
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local is None:
        _local = tempfile.TemporaryDirectory(prefix="adpulse-")
    return Path(_local.name).as_uri()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path to write to, never handed out twice, gone when the session's process ends."""
    parent = f"{scratch_root(spark)}/adpulse/{label}-{uuid.uuid4().hex}"
    make_temporary(spark, parent)
    return f"{parent}/data"
