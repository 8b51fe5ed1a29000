"""Parquet and delimited-text output."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.text import quoted
from lakestrata.sinks.sizing import deal_by_size
from lakestrata.sinks.versions import write_version


def cluster_for_write(df: DataFrame, partition_by: str) -> DataFrame:
    """Shuffle rows so that each partition value is written by few tasks.

    A rebalance does it: adaptive execution packs small values together, and
    splits a value that holds a large share of the rows at the advisory partition
    size. Without adaptive execution each value is written by one task, which
    makes few files but does not split a hot value: keep it on.
    """
    column = F.col(quoted(partition_by))
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return df.hint("rebalance", column)
    return df.repartition(column)


def write_layer(
    df: DataFrame,
    path: str,
    *,
    partition_by: str | None = None,
    clustered: bool = False,
    overwrite_partitions: str = "static",
    max_records_per_file: int = 0,
    versioned: bool = False,
    file_bytes: int | None = None,
) -> None:
    """Overwrite a parquet dataset, optionally partitioned by one column.

    `clustered=True` says the rows already come grouped by the partition column
    (for instance from a dataset partitioned by it) and writes without a
    shuffle. `overwrite_partitions="dynamic"` replaces only the partitions that
    occur in `df`; "static" replaces the whole dataset. `versioned=True` writes a
    new version of the dataset beside the old one, which stays readable until the new
    one is complete; `read_layer` reads the newest, `drop_versions` deletes others.

    `file_bytes` plans the files of a partitioned dataset: the bytes of each value are summed first,
    small values packed into tasks, and large ones split into files of about that
    size before compression. That is a second run of the plan of `df`: store a long one first.
    """
    if versioned:
        if overwrite_partitions != "static":
            raise ValueError("a version is the whole dataset: overwrite_partitions must be static")
        options = {
            "partition_by": partition_by,
            "clustered": clustered,
            "max_records_per_file": max_records_per_file,
            "file_bytes": file_bytes,
        }
        write_version(df.sparkSession, path, lambda folder: write_layer(df, folder, **options))
        return
    if partition_by is not None and file_bytes is not None:
        df = deal_by_size(df, partition_by, file_bytes)
    elif partition_by is not None and not clustered:
        df = cluster_for_write(df, partition_by)
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
        writer = writer.option("partitionOverwriteMode", overwrite_partitions)
    writer.parquet(path)


def write_delimited(
    df: DataFrame, path: str, *, separator: str = ";", header: bool = False, **options: Any
) -> None:
    """Overwrite a directory of delimited text; no header unless asked for."""
    df.write.mode("overwrite").options(sep=separator, header=header, **options).csv(path)
