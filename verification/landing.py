"""Folders that queries write to, so that readers and writers of files run over the provided tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def landing_folder(spark: SparkSession, name: str) -> str:
    """A new folder in spark.checkpoint.dir; where that is unset a local one, which only a local session may take."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tripmill-"))
        folder = context.getCheckpointDir()
    return f"{folder.rstrip('/')}/landed/{name}-{uuid.uuid4().hex}"
