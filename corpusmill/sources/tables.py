"""Parquet tables of one folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path that nothing has used, in the folder the cluster shares (spark.checkpoint.dir); where that is unset, in a new
    temporary folder of a local session, and an error on a cluster."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        shared = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared}/work/{label}-{uuid.uuid4().hex}"
