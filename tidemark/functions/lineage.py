"""Lineage cuts in the folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a temporary one only in local mode, where there is one machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back: what later jobs see is this one evaluation, and a lost executor loses nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
