"""Everything below a prefix as one dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakestrata.sources.concat import concat_by_name


def land_recursive(
    spark: SparkSession,
    path: str,
    glob: str = "*",
    provenance: str = "source_file",
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """All parquet files at any depth below `path`, with the base name each row came from.

    `schema` saves reading footers. No file is lost when base names repeat in several folders; see
    `name_collisions` for a report of these.
    """
    return concat_by_name(spark, path, glob=glob, provenance=provenance, schema=schema)
