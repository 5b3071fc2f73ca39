"""Shared scratch space for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"


def work_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only in local mode."""
    sc = spark.sparkContext
    folder = configured_dir(spark) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {_CONF} to a folder all executors can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="trendloom-"))
        folder = sc.getCheckpointDir()
    return folder.rstrip("/")


def configured_dir(spark: SparkSession) -> str | None:
    return spark.conf.get(_CONF, None) or spark.sparkContext.getConf().get(_CONF)


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the session's own scratch folder."""
    return f"{_session_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _session_folder(spark: SparkSession) -> str:
    """Created on first use and removed when the driver's file system closes."""
    folder = f"{work_dir(spark)}/trendloom-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.mkdirs(path):
        fs.deleteOnExit(path)
    return folder


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage and pins its rows.

    Columnar, so later readers still prune columns, and it survives the loss
    of any executor.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
