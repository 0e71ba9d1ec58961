"""The folder that the driver and all executors share, and tables that are cut off there."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where it is unset, as in tests, a temporary one serves a local
    master; on a cluster that would be a folder of one machine, so it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="leafwork-")
    return folder


def cut(df: DataFrame) -> DataFrame:
    """The rows of df, made once and kept in the shared folder, so that a lost executor costs no recomputation.

    Spark deletes them with the DataFrame where spark.cleaner.referenceTracking.cleanCheckpoints is set.
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
