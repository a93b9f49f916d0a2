"""Where intermediate tables go: the shared folder the cluster names."""

from __future__ import annotations

import re
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under ``spark.checkpoint.dir``, which all executors can reach.

    Only a local session without that setting falls back to a temporary folder.
    """
    base = spark.conf.get(SETTING, None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError(f"set {SETTING} to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="silverlake-")
        spark.conf.set(SETTING, base) if spark.conf.isModifiable(SETTING) else None
    return f"{base.rstrip('/')}/silverlake/{label}-{uuid4().hex}"


def staged(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` written to scratch and read back.

    Cuts the lineage, so that a lost executor costs one re-read and nothing is computed twice.
    """
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asked of the path's own file system; a read of what is not there would be a failed query."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
