"""What files lie under a path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(
    spark: SparkSession, path: str | list[str], glob: str = "*", modified: bool = False
) -> DataFrame:
    """One row per file below `path`: `file_path`, `file_name`, `length`, and if asked for `modified`.

    Executors produce the rows; the files' content is not read. Like any Spark
    scan it leaves out names starting with `_` or `.`.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
    )
    return files.select(
        F.col("path").alias("file_path"),
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "length",
        *([F.col("modificationTime").alias("modified")] if modified else []),
    )


def name_collisions(files: DataFrame) -> DataFrame:
    """Base names that occur in more than one folder, from a `list_files` table.

    A flat copy would keep only one file of each.
    """
    return (
        files.groupBy("file_name")
        .agg(
            F.count(F.lit(1)).alias("n_files"),
            F.min("file_path").alias("first_path"),
            F.max("file_path").alias("last_path"),
        )
        .where(F.col("n_files") > 1)
    )
