"""Numbers read from, and written as, text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.text import quoted

# A number has a digit or is a spelling of infinity or NaN.
_MAYBE_NUMBER = "[0-9]|[iI][nN][fF]|[nN][aA][nN]"


def to_double(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Cast to double; blank or unreadable text becomes null, also in ANSI mode.

    A failed parse costs an exception, so text that cannot be a number is not parsed.
    """

    def cast(name: str) -> Column:
        number = F.col(quoted(name)).try_cast("double")
        if isinstance(df.schema[name].dataType, T.StringType):
            return F.when(F.col(quoted(name)).rlike(_MAYBE_NUMBER), number)
        return number

    return df.withColumns({c: cast(c) for c in columns})


def format_measure(value: Column, decimals: int = 2) -> Column:
    """Text with thousands commas, e.g. 1,234,567.12."""
    return F.format_number(value, decimals)
