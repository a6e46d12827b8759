"""The folder that all executors share, and rows that several jobs read, fixed there."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Where the setting is missing and all tasks run on this machine, as in tests, a temporary folder
    is set; on a cluster it is needed.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", "")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not named and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return named or sc._jsc.sc().getCheckpointDir().get()


def held(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read from there on.

    Later steps start from these rows, whatever is lost meanwhile.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()
