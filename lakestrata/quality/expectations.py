"""What a column is expected to hold."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.text import quoted


@dataclass(frozen=True)
class Expectation:
    """`broken(df, column)` says whether a value that is not null breaks the rule.

    `column` may be the raw header of a normalised column.

    `unique_key` rules look at all rows of a key instead, and count nulls
    against success.
    """

    name: str
    column: str
    broken: Callable[[DataFrame, str], Column] | None = None
    unique_key: bool = False


def expect_match_regex(column: str, pattern: str) -> Expectation:
    return Expectation(
        "expect_column_values_to_match_regex",
        column,
        lambda df, name: ~F.col(quoted(name)).cast("string").rlike(pattern),
    )


def expect_length_equal(column: str, length: int) -> Expectation:
    return Expectation(
        "expect_column_value_lengths_to_equal",
        column,
        lambda df, name: F.length(F.col(quoted(name)).cast("string")) != length,
    )


def expect_type(column: str, type_name: str) -> Expectation:
    """The column's Spark type, e.g. "int"; decided by the schema, not by the values."""
    return Expectation(
        "expect_column_values_to_be_of_type",
        column,
        lambda df, name: F.lit(df.schema[name].dataType.simpleString() != type_name),
    )


def expect_unique_key(column: str) -> Expectation:
    return Expectation("expect_column_values_to_be_unique_key", column, unique_key=True)
