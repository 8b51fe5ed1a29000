"""Delimited text and parquet datasets."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakestrata.sinks.versions import current_folder

#: Tasks a core that list the folders of a dataset.
LISTING_TASKS = 4


def read_delimited(
    spark: SparkSession,
    path: str,
    *,
    separator: str = ",",
    encoding: str = "utf-8",
    schema: T.StructType | str | None = None,
    infer: bool = True,
    **options: Any,
) -> DataFrame:
    """A directory of delimited text with a header row.

    Types are inferred from all rows, which reads the text once more. For large
    sources give `schema`, or `infer=False` to keep every column as text; either
    saves that pass.
    """
    reader = spark.read.options(header=True, sep=separator, encoding=encoding, **options)
    if schema is None:
        reader = reader.option("inferSchema", infer)
    else:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_layer(
    spark: SparkSession, path: str, *, schema: T.StructType | str | None = None
) -> DataFrame:
    """A parquet dataset of one layer; a partition date in its path comes back as a date.

    Of a dataset with versions it is the newest.
    """
    _list_in_few_tasks(spark)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(current_folder(spark, path) or path)


def _list_in_few_tasks(spark: SparkSession) -> None:
    """Let this session list folders in a few tasks a core, unless it was given a number.

    Spark would take a task for each of up to 10,000 folders, and a partitioned layer has one a day.
    """
    number = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    if spark.conf.get(number, None) is None:
        spark.conf.set(number, LISTING_TASKS * spark.sparkContext.defaultParallelism)


def preview(spark: SparkSession, path: str, lines: int = 20) -> DataFrame:
    """The first lines of one utf-8 text file as one column `value`; reads little more than these.

    Of a folder of several files they are those of whichever file Spark reads first.
    """
    return spark.read.text(path).limit(lines)
