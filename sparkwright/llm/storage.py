"""The folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` as the cluster names it.  Only where it is
    unset and the session runs in one process (tests) a folder is made."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set")
        named = os.path.join(tempfile.gettempdir(), f"shared-{uuid.uuid4().hex}")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def make_importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import this package however the
    driver found it.  On a cluster the package is installed or shipped."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage: ``df`` written once to the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
