"""Folders that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir; only where that is unset and Spark runs in one process, a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local($|\[)", spark.conf.get("spark.master", "local")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
