"""Intermediate tables that survive the loss of an executor.

Lineage is cut by writing Parquet under the folder that the cluster names in
``spark.checkpoint.dir``. Only where that setting is absent *and* the master is
local (tests, a laptop) is a temporary folder made instead.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared scratch folder of this session."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="sievework-"))
    return sc.getCheckpointDir().rstrip("/")


def stored(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` once to the shared folder and return a reader of that table."""
    path = f"{shared_dir(df.sparkSession)}/sievework/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
