"""Types of delimited text, found while it is parsed once."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.text import quoted
from lakestrata.sources.layers import read_delimited

#: What a value can be, narrowest first; a column's values are kept as a set of bits.
INT, LONG, DECIMAL, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << i for i in range(8))
_NUMBERS = INT | LONG | DECIMAL | DOUBLE
_MOST_DIGITS = 38
#: Digits that hold every int and every long.
_INT_DIGITS, _LONG_DIGITS = 10, 20
#: What Java takes for a number, and a little more: decimal or hexadecimal, between blanks.
_NUMBER = (
    r"^[\x00-\x20]*+[+-]?(?:(?:[0-9]++\.?[0-9]*+|\.[0-9]++)(?:[eE][+-]?[0-9]++)?|0[xX][0-9a-fA-F.]*+[pP][+-]?[0-9]++)"
    r"[fFdD]?[\x00-\x20]*+$"
)


def _digits(value: Column) -> Column:
    """Digits of a whole number without leading zeros, 1 at least."""
    return F.greatest(F.length(F.regexp_replace(value, r"^[+-]?0*|\.$", "")), F.lit(1))


def value_kind(value: Column) -> Column:
    """The narrowest type that holds a text value, as one bit; null for a null or empty value."""
    whole, pointed = value.rlike(r"^[+-]?[0-9]+$"), value.rlike(r"^[+-]?[0-9]+\.$")
    named = F.trim(value).isin("NaN", "Inf", "-Inf", "Infinity", "+Infinity", "-Infinity")
    exact = value.try_cast(T.DecimalType(_LONG_DIGITS, 0))
    held = F.when(_digits(value) <= _MOST_DIGITS, DECIMAL).otherwise(DOUBLE)
    return (
        F.when(value.isNull() | (value == ""), F.lit(None))
        .when(
            whole,
            F.when(F.length(value) < _INT_DIGITS, INT)
            .when(_digits(value) >= _LONG_DIGITS, held)
            .when(exact.between(-(1 << 31), (1 << 31) - 1), INT)
            .when(exact.between(-(1 << 63), (1 << 63) - 1), LONG)
            .otherwise(DECIMAL),
        )
        .when(pointed, held)
        # A cast that fails raises an error inside, which takes longer than all the rest.
        .when((value.rlike(_NUMBER) | named) & value.try_cast("double").isNotNull(), DOUBLE)
        .when(value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & value.try_cast("date").isNotNull(), DATE)
        .when(value.try_cast("timestamp").isNotNull(), TIMESTAMP)
        .when(F.lower(value).isin("true", "false"), BOOLEAN)
        .otherwise(TEXT)
    )


def kind_measures(df: DataFrame, kinds: Sequence[Column] | None = None) -> list[Column]:
    """Two aggregates a column that merge in any order: the kinds of its values, and the most digits of a decimal.

    `kinds` are columns that hold the kinds, where these were found before.
    """
    measures = []
    for i, name in enumerate(df.columns):
        value = F.col(quoted(name))
        kind = value_kind(value) if kinds is None else kinds[i]
        measures.append(F.bit_or(kind).alias(f"kinds_{i}"))
        measures.append(F.max(F.when(kind == DECIMAL, _digits(value))).alias(f"digits_{i}"))
    return measures


def merged_type(kinds: int | None, digits: int | None) -> T.DataType:
    """The type that holds all values of a column: numbers widen, a date and a timestamp give a timestamp, others text."""
    kinds = kinds or 0
    if kinds == 0 or kinds & TEXT:
        return T.StringType()
    if not kinds & ~_NUMBERS:
        if kinds & DOUBLE:
            return T.DoubleType()
        if kinds & DECIMAL:
            needed = _LONG_DIGITS if kinds & LONG else _INT_DIGITS if kinds & INT else 0
            return T.DecimalType(digits, 0) if digits >= needed else T.StringType()
        return T.LongType() if kinds & LONG else T.IntegerType()
    if not kinds & ~(DATE | TIMESTAMP):
        return T.TimestampType() if kinds & TIMESTAMP else T.DateType()
    return T.BooleanType() if kinds == BOOLEAN else T.StringType()


def merged_types(names: Collection[str], found: Mapping[str, Any]) -> T.StructType:
    return T.StructType(
        [T.StructField(n, merged_type(found[f"kinds_{i}"], found[f"digits_{i}"])) for i, n in enumerate(names)]
    )


def stage_delimited(
    spark: SparkSession,
    path: str,
    staging: str,
    *,
    separator: str = ",",
    encoding: str = "utf-8",
    keep_text: Callable[[str], bool] = lambda header: False,
    **options: Any,
) -> DataFrame:
    """A directory of delimited text with a header row and the types of its values, parsed once.

    The text goes as text to parquet below `staging`, and on the way each column's kinds of
    values are gathered: int, long, decimal, double, date, timestamp, boolean, text. The result reads
    that copy and casts. Types are those of Spark's own inference, which parses the text a
    second time; digits are ASCII digits. Columns whose header `keep_text` accepts stay text, as does a column
    without values. The caller deletes `staging` when the rows have been used.
    """
    raw = read_delimited(spark, path, separator=separator, encoding=encoding, infer=False, **options)
    names = raw.columns
    if not names:
        return raw
    plain = raw.toDF(*(f"c{i}" for i in range(len(names))))
    seen = Observation()
    # Kinds are found before they are observed, each once, and as an array, so that the code made for a row stays small.
    kinds = F.transform(F.array(*plain.columns), value_kind).alias("kinds")
    measures = kind_measures(plain, [F.col("kinds")[i] for i in range(len(names))])
    plain.select("*", kinds).observe(seen, *measures).select(plain.columns).write.parquet(staging)
    schema = merged_types(names, seen.get)
    copy = spark.read.schema(plain.schema).parquet(staging)
    return copy.select(
        *[
            (F.col(f"c{i}") if keep_text(f.name) else F.col(f"c{i}").try_cast(f.dataType)).alias(f.name)
            for i, f in enumerate(schema)
        ]
    )
