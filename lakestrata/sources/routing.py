"""Choose the files of a dataset by their names."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.sources.concat import concat_by_name
from lakestrata.sources.files import list_files


def name_year(file_name: Column) -> Column:
    """The first run of four digits in a file name as int, null if there is none."""
    return F.regexp_extract(file_name, r"(\d{4})", 1).try_cast("int")


def _belongs(file_name: Column, prefix: str, years: tuple[int, int] | None) -> Column:
    condition = file_name.startswith(prefix)
    if years is not None:
        condition = condition & name_year(file_name).between(*years)
    return condition


def route_by_filename(
    df: DataFrame, file_column: str, prefix: str, years: tuple[int, int] | None = None
) -> DataFrame:
    """Rows whose file name has the prefix and, if given, a year from `years` (both included)."""
    return df.where(_belongs(F.col(file_column), prefix, years))


def read_route(
    spark: SparkSession,
    path: str,
    prefix: str,
    years: tuple[int, int] | None = None,
    provenance: str | None = None,
    schema: T.StructType | str | None = None,
    files: DataFrame | None = None,
) -> DataFrame:
    """The parquet files below `path` that belong to a route, concatenated by name.

    A glob picks them while listing. Where names have something between prefix
    and year, the glob is wider and a test of the name drops the other files
    before they are opened; Spark repeats that test on each row, so it is added
    only then. `files`, a `list_files` table of the path, saves a listing, and
    `schema` reading footers.
    """
    options = {"provenance": provenance, "schema": schema}
    if years is None:
        return concat_by_name(spark, path, glob=f"{prefix}*", **options)
    wanted = "{" + ",".join(str(year) for year in range(years[0], years[1] + 1)) + "}"
    if _year_follows(prefix, years):
        direct = reduce(
            or_, [F.col("file_name").startswith(f"{prefix}{y}") for y in range(years[0], years[1] + 1)]
        )
        listed = list_files(spark, path, f"{prefix}*") if files is None else files
        if route_by_filename(listed, "file_name", prefix, years).where(~direct).isEmpty():
            return concat_by_name(spark, path, glob=f"{prefix}{wanted}*", **options)
    return concat_by_name(
        spark,
        path,
        glob=f"{prefix}*{wanted}*",
        keep=lambda name: _belongs(name, prefix, years),
        **options,
    )


def _year_follows(prefix: str, years: tuple[int, int]) -> bool:
    """Whether the first four digits of a name made of prefix and year are that year."""
    return all(
        re.search("[0-9]{4}", f"{prefix}{year}").group() == str(year)
        for year in range(years[0], years[1] + 1)
    )
