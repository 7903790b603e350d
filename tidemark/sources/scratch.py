"""Intermediate results that several later steps read.

They are written as Parquet tables rather than cached: a written table survives the loss of
an executor, cuts the lineage, and gives the planner a true size for its join choices.
"""

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.errors import InputError


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the folder the cluster names in ``spark.checkpoint.dir``.

    Every session needs that setting, since a folder of one machine would not be seen by
    the others.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise InputError("spark.checkpoint.dir must name a shared folder for intermediate tables")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a scratch table and return a reader of that table."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*frames: DataFrame) -> None:
    """Delete the scratch tables that the frames read; other files are left alone."""
    for frame in frames:
        spark = frame.sparkSession
        shared = scratch_path(spark, "x").rpartition("/")[0]
        for folder in {name.rpartition("/")[0] for name in frame.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            below = spark._jvm.org.apache.hadoop.fs.Path(shared).toUri().getPath()
            ours = re.fullmatch(r".+-[0-9a-f]{32}", path.getName())
            if ours and path.toUri().getPath() == f"{below}/{path.getName()}":
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
