"""Intermediate results that must outlive a lost executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Of stored tables: a fifth smaller than the default, for some CPU time.
COMPRESSION = "zstd"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    It is the one the cluster names in ``spark.checkpoint.dir``, else the context's own.
    Only a local session with neither gets a temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="barfold-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def materialise(frame: DataFrame) -> DataFrame:
    """``frame``, computed once and read back from a table in the checkpoint folder.

    Columns stay columns there, so later reads take only the ones they use, and Spark
    knows the size.
    """
    path = f"{checkpoint_dir(frame.sparkSession)}/table-{uuid.uuid4().hex}"
    frame.write.parquet(path, compression=COMPRESSION)
    stored = frame.sparkSession.read.schema(frame.schema).parquet(path)
    stored._scratch = path
    return stored


def release(frame: DataFrame) -> None:
    """Delete the table of a frame that :func:`materialise` gave, once nothing will read it or what is built on it.

    So a loop of rounds, each stored, keeps its last table only. Other frames are left alone.
    """
    path = frame.__dict__.get("_scratch")
    if path:
        spark = frame.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
