"""Cutting the lineage of iterated DataFrames."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def cut(df: DataFrame) -> DataFrame:
    """The rows, kept in the shared checkpoint folder, so that what follows neither
    recomputes them nor depends on an executor's own disk.

    The folder is that of ``shared_folder``.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``. Only a session of one machine (master ``local``) may have
    none, and gets a temporary folder; on a cluster executors would each write to their own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="loomtrace-checkpoints-")
