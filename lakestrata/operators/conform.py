"""Bring a raw table to a layer's column names, defaults and partition date."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.text import quoted


def default_nulls(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Replace nulls by a literal; the column keeps (or widens to) its own type. NaN is not null."""
    return df.withColumns({c: F.coalesce(F.col(quoted(c)), F.lit(v)) for c, v in defaults.items()})


def with_partition_date(df: DataFrame, timestamp: str, name: str = "partition_date") -> DataFrame:
    return df.withColumn(name, F.col(quoted(timestamp)).cast("date"))


def conform(
    df: DataFrame,
    columns: Mapping[str, str],
    *,
    defaults: Mapping[str, Any] | None = None,
    partition_date_from: str | None = None,
    require_not_null: Iterable[str] = (),
) -> DataFrame:
    """Keep `columns` (source name -> layer name, in order) and nothing else.

    `defaults`, `partition_date_from` and `require_not_null` use layer names.
    Narrow: the projection and the null test reach the parquet scan.
    """
    out = df.select(*[F.col(quoted(source)).alias(name) for source, name in columns.items()])
    for name in require_not_null:
        out = out.where(F.col(quoted(name)).isNotNull())
    if defaults:
        out = default_nulls(out, defaults)
    if partition_date_from is not None:
        out = with_partition_date(out, partition_date_from)
    return out
