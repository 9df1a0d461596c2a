"""Where jobs keep intermediate tables: the shared folder named by spark.checkpoint.dir."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder: ``spark.checkpoint.dir``, or where that is unset a folder
    in the warehouse, which every machine of a cluster reaches too."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    active = spark.sparkContext.getCheckpointDir()
    if configured:
        if not active:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if active:
        return active
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def workspace_path(spark: SparkSession, name: str) -> str:
    """A new path below the checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/halyard/{name}-{uuid.uuid4().hex}"
