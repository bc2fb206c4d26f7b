"""Where intermediate results are cut off from their lineage."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``. Where it is unset a local session (as in tests) gets a
    temporary one; on a cluster that would be lost with its machine, so there it is an error."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir names no shared folder")
    own = tempfile.mkdtemp(prefix="checkpoints_")
    spark.sparkContext.setCheckpointDir(own)
    return own


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there; survives the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def forget(spark: SparkSession) -> None:
    """Remove what this application has cut off and written so far. For the end of a job, or between queries whose results
    were taken: DataFrames that go on from a cut can't be read any more. (Spark removes a cut by itself once nothing refers
    to it, where spark.cleaner.referenceTracking.cleanCheckpoints is set.)"""
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        p = spark._jvm.org.apache.hadoop.fs.Path(current.get())
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        for s in fs.listStatus(p) if fs.exists(p) else []:
            if s.getPath().getName().startswith("rdd-"):
                fs.delete(s.getPath(), True)
