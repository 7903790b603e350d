"""Reading landed Parquet data; writing and rereading normalized rows."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import ENGINE_ERRORS, InputError


def read_eligible(spark: SparkSession, paths) -> DataFrame:
    """All leaf directories as one table, so a sequence split over roots is one sequence.

    The leaves are named one by one: the date column stays out of the row schema, and stray
    directories below the roots are not looked at.
    """
    try:
        return spark.read.parquet(*paths)
    except ENGINE_ERRORS as error:
        raise InputError(f"cannot read the eligible partitions: {error}") from error


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Add the file each row was read from. Use it directly on the frame that reads files."""
    return df.select("*", F.input_file_name().alias(name))


def cross_root_union(frames) -> DataFrame:
    """Frames of several roots as one bag of rows."""
    return reduce(lambda left, right: left.unionByName(right), frames)


def persist_normalized(normalized: DataFrame, path: str, overwrite: bool = True) -> None:
    """Write normalized rows as Parquet; without ``overwrite`` an existing path is an error."""
    try:
        normalized.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)
    except ENGINE_ERRORS as error:
        raise InputError(f"cannot write normalized rows to {path}: {error}") from error


def reload_normalized(spark: SparkSession, path: str) -> DataFrame:
    """Read normalized rows back, with their types made sure."""
    try:
        stored = spark.read.parquet(path)
        return stored.select(
            F.col("partition").cast("int").alias("partition"),
            F.col("offset").cast("bigint").alias("offset"),
            "metadata_json",
            "source_file",
        )
    except ENGINE_ERRORS as error:
        raise InputError(f"cannot read normalized rows from {path}: {error}") from error
