"""Validate a table against a suite of expectations; the outcome is a report table."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.naming import normalize_name
from lakestrata.functions.text import quoted
from lakestrata.operators.unify import union_by_name
from lakestrata.quality.expectations import Expectation

# Columns of a filed report; the last four name its folder.
_REPORT = """
    suite string, expectation string, column string, success boolean, element_count bigint,
    missing_count bigint, unexpected_count bigint, unexpected_percent double, report_date string,
    table string, year string, month string, day string
"""


class DataQualityError(Exception):
    """A suite with `on_failure="raise"` has failed."""


def suite_name(table: str) -> str:
    return f"dq_{table}"


def key_violations(df: DataFrame, key: str) -> DataFrame:
    """Values that break a primary key: null, or held by more than one row."""
    return (
        df.groupBy(quoted(key))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where((F.col("n_rows") > 1) | F.col(quoted(key)).isNull())
    )


def run_suite(df: DataFrame, suite: Sequence[Expectation], table: str) -> DataFrame:
    """One row per expectation. All row-wise rules share one aggregate over `df`.

    A key rule adds one grouped count. Nothing is computed until the report is read.
    """
    rowwise = [e for e in suite if not e.unique_key]
    reports = []
    if rowwise:
        reports.append(_report(df.agg(*_counts(df, rowwise)), rowwise, df, table))
    for expectation in suite:
        if expectation.unique_key:
            reports.append(_report(_key_counts(df, expectation), [expectation], df, table))
    if not reports:
        raise ValueError(f"the suite of {table} has no expectations")
    return union_by_name(*reports)


@dataclass
class SuiteWatch:
    """Counts taken while another action reads `df`."""

    df: DataFrame
    table: str
    suite: Sequence[Expectation]
    _source: DataFrame
    _observation: Observation = field(repr=False)

    def report(self) -> DataFrame:
        """The report; call it after the action. The counts are one row."""
        names = _count_names(self.suite)
        seen = self._observation.get
        row = [int(seen.get(name) or 0) for name in names]
        schema = T.StructType([T.StructField(name, T.LongType()) for name in names])
        counts = self._source.sparkSession.createDataFrame([row], schema)
        return _report(counts, self.suite, self._source, self.table)


def watch_suite(df: DataFrame, suite: Sequence[Expectation], table: str) -> SuiteWatch:
    """Validate `df` during the one action that writes it, without a scan of its own.

    Write the returned `.df` and let no shuffle follow it: the counts are then
    taken in the final tasks, and Spark counts each of these once even when
    one has to run again. Key rules need `run_suite`.
    """
    if any(e.unique_key for e in suite):
        raise ValueError("key rules cannot be watched; use run_suite for them")
    observation = Observation(suite_name(table))
    return SuiteWatch(df.observe(observation, *_counts(df, suite)), table, suite, df, observation)


def write_dq_report(
    report: DataFrame, path: str, run_date: datetime.date, mode: str = "overwrite"
) -> None:
    """JSON under `table=/year=/month=/day=`.

    A second run for a table and date replaces the first; `mode="append"` keeps both.
    """
    day = F.lit(run_date)
    dated = report.select(
        *report.columns,
        F.date_format(day, "yyyy-MM-dd").alias("report_date"),
        F.date_format(day, "yyyy").alias("year"),
        F.date_format(day, "MM").alias("month"),
        F.date_format(day, "dd").alias("day"),
    )
    (
        dated.coalesce(1)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("table", "year", "month", "day")
        .json(path)
    )


def read_dq_report(
    spark: SparkSession, path: str, table: str, run_date: datetime.date
) -> DataFrame:
    """The filed report of one table and date; other folders are not read."""
    day = {"year": "%Y", "month": "%m", "day": "%d"}
    report = spark.read.schema(_REPORT).json(path).where(F.col("table") == table)
    for column, pattern in day.items():
        report = report.where(F.col(column) == run_date.strftime(pattern))
    return report


def _count_names(suite: Sequence[Expectation]) -> list[str]:
    return ["elements"] + [f"{kind}_{i}" for i in range(len(suite)) for kind in ("missing", "unexpected")]


def _find(df: DataFrame, column: str) -> str | None:
    """The column of that name, or of its normalised name."""
    return next((c for c in (column, normalize_name(column)) if c in df.columns), None)


def _counts(df: DataFrame, suite: Sequence[Expectation]) -> list[Column]:
    counts = [F.count(F.lit(1)).alias("elements")]
    for i, expectation in enumerate(suite):
        name = _find(df, expectation.column)
        missing = unexpected = F.lit(False)
        if name is not None:
            missing = F.col(quoted(name)).isNull()
            unexpected = ~missing & expectation.broken(df, name)
        counts.append(F.count_if(missing).alias(f"missing_{i}"))
        counts.append(F.count_if(unexpected).alias(f"unexpected_{i}"))
    return counts


def _key_counts(df: DataFrame, expectation: Expectation) -> DataFrame:
    key = _find(df, expectation.column)
    if key is None:
        return df.agg(*_counts(df, [expectation]))
    groups = df.groupBy(F.col(quoted(key)).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    is_null = F.col("key").isNull()
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("elements"),
        F.coalesce(F.sum(F.when(is_null, F.col("n"))), F.lit(0)).alias("missing_0"),
        F.coalesce(F.sum(F.when(~is_null & (F.col("n") > 1), F.col("n"))), F.lit(0)).alias(
            "unexpected_0"
        ),
    )


def _report(
    counts: DataFrame, suite: Sequence[Expectation], df: DataFrame, table: str
) -> DataFrame:
    """Turn the one row of counts into one row per expectation."""
    rows = []
    for i, expectation in enumerate(suite):
        name = _find(df, expectation.column)
        known = name is not None
        missing, unexpected = F.col(f"missing_{i}"), F.col(f"unexpected_{i}")
        success = F.lit(known)
        if known:
            success = unexpected == 0
            if expectation.unique_key:
                success = success & (missing == 0)
            elif expectation.name == "expect_column_values_to_be_of_type":
                success = ~expectation.broken(df, name)
        # A column the table lacks has no counts.
        shown = (lambda c: c) if known else (lambda c: F.lit(None).cast("bigint"))
        present = F.col("elements") - missing
        rows.append(
            F.struct(
                F.lit(table).alias("table"),
                F.lit(suite_name(table)).alias("suite"),
                F.lit(expectation.name).alias("expectation"),
                F.lit(expectation.column).alias("column"),
                success.alias("success"),
                F.col("elements").alias("element_count"),
                shown(missing).alias("missing_count"),
                shown(unexpected).alias("unexpected_count"),
                F.when(present > 0, shown(unexpected) * 100.0 / present).alias(
                    "unexpected_percent"
                ),
            )
        )
    return counts.select(F.inline(F.array(*rows)))
