"""Where jobs put intermediate tables, carry tables and streaming checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master, where driver and
    executors share one disk, may fall back to a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="run-")
        context.setCheckpointDir(folder)
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created there yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
