"""Cutting lineage in the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> None:
    """Sets a checkpoint folder if the session names none, and lets Python workers import this package."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="chunkscan-"))
    root = str(Path(__file__).resolve().parents[1])
    known = sc.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        sc.environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """``df`` from a checkpoint, written now or, if not ``eager``, by the first job that reads it; its partitions stay as they are."""
    prepare(df.sparkSession)
    return df.checkpoint(eager)
