"""Grouped measures configured by a mapping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.numbers import format_measure, to_double
from lakestrata.functions.text import quoted

_AGGREGATES = {"avg": F.avg, "sum": F.sum}


def aggregate(
    df: DataFrame,
    key: str | Sequence[str],
    measures: Mapping[str, str],
    *,
    formatted: bool = True,
) -> DataFrame:
    """`measures` maps a column to "avg" or "sum"; the result columns are `avg_<column>` etc.

    Measures are read as doubles first, so unreadable text counts as null. The
    result is text with two decimals unless `formatted=False`. A null key is a
    group of its own. Both aggregates combine before the shuffle: a hot key
    costs one row per task.
    """
    if not measures:
        raise ValueError("no measures given")
    unknown = sorted(set(measures.values()) - set(_AGGREGATES))
    if unknown:
        raise ValueError(f"unknown aggregates {unknown}; known are {sorted(_AGGREGATES)}")
    results = []
    for column, kind in measures.items():
        value = _AGGREGATES[kind](quoted(column))
        results.append((format_measure(value) if formatted else value).alias(f"{kind}_{column}"))
    keys = [key] if isinstance(key, str) else list(key)
    return to_double(df, measures).groupBy(*map(quoted, keys)).agg(*results)
