"""Session-level helpers: the shared folder for lineage cuts and round-trip files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """Folder that every executor can reach: ``spark.checkpoint.dir`` as the
    cluster names it.  Only where that is unset and driver and executors are
    one process (local master, as in tests) a folder is made and registered."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set")
        root = tempfile.mkdtemp(prefix="sparkwright-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared root (never reused, never deleted here)."""
    return f"{shared_root(spark).rstrip('/')}/sparkwright/{name}-{uuid.uuid4().hex}"
