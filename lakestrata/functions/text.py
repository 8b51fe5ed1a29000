"""Cleaning of string values."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accented letters, and at the same position the letter each folds to.
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüç"
FOLDED = "aaaaaeeeeiiiiooooouuuuc"

# What is removed from an entity name - ASCII whitespace around it, and
# its group suffix to the end of the line.
WHITESPACE = " \t\n\u000b\f\r"
SUFFIXES = ["(conglomerado)", "- prudencial"]
SUFFIX_PATTERN = r"(\(conglomerado\)|- prudencial).*"

# What ends a line for a pattern; the last three are not whitespace, yet let `\s+$`
# match before them.
_LINE_ENDS = ["\n", "\r", "\u0085", "\u2028", "\u2029"]


def _null_only_with(source: Column, value: Column) -> Column:
    """`value`, which is null only where `source` is, written so that Spark knows it.

    Where a join on the value makes Spark infer a not-null filter, the filter then
    becomes a test of `source` that reaches the scan; else every value would be
    computed twice, once for the filter.
    """
    return F.when(source.isNotNull(), F.coalesce(value, F.lit("")))


def fold_accents(value: Column) -> Column:
    """Lower-case, then replace the accented letters above; any other letter stays."""
    lowered = F.lower(value)
    is_ascii = F.octet_length(value) == F.char_length(value)
    folded = F.when(is_ascii, lowered).otherwise(F.translate(lowered, ACCENTED, FOLDED))
    return _null_only_with(value, folded)


def normalize_values(df: DataFrame) -> DataFrame:
    """Lower-case and fold every string column, in one projection."""
    return df.select(
        *[
            fold_accents(F.col(quoted(field.name))).alias(field.name)
            if isinstance(field.dataType, T.StringType)
            else F.col(quoted(field.name))
            for field in df.schema.fields
        ]
    )


def entity_name(value: Column) -> Column:
    """Strip a name and cut its group suffix.

    The suffixes are matched in lower case, so fold the value first. A suffix
    runs to the end of its line: text after a line break is kept. Regular
    expressions run only on the values that need one.
    """
    odd_end = reduce(or_, [value.endswith(end) for end in _LINE_ENDS[2:]])
    stripped = F.when(odd_end, F.regexp_replace(value, r"^\s+|\s+$", "")).otherwise(
        F.btrim(value, F.lit(WHITESPACE))
    )
    has_suffix = reduce(or_, [value.contains(suffix) for suffix in SUFFIXES])
    has_lines = reduce(or_, [value.contains(end) for end in _LINE_ENDS])
    before_suffix = reduce(lambda text, suffix: F.substring_index(text, suffix, 1), SUFFIXES, stripped)
    cut = (
        F.when(~has_suffix, stripped)
        .when(has_lines, F.regexp_replace(stripped, SUFFIX_PATTERN, ""))
        .otherwise(before_suffix)
    )
    return _null_only_with(value, F.trim(cut))


def clean_entity_name(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, entity_name(F.col(quoted(column))))


def quoted(name: str) -> str:
    """The name as `F.col` takes it when it may hold a dot."""
    return "`" + name.replace("`", "``") + "`"
