"""The folder that driver and executors share, for what a query writes and reads back."""

from __future__ import annotations

import uuid
from tempfile import mkdtemp

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of its own for a local master without one, an error for a cluster without one."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or getattr(spark, "_parityline_shared", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = spark._parityline_shared = "file://" + mkdtemp(prefix="spark-parityline-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
