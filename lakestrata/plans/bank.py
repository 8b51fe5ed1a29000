"""Bank satisfaction: clean three text sources, aggregate and join them to one table."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata import storage
from lakestrata.functions import clean_entity_name, normalize_columns, normalize_values
from lakestrata.functions.naming import normalize_name
from lakestrata.operators import aggregate, join_entities, union_by_name
from lakestrata.plans.paths import require_apart
from lakestrata.quality import (
    DataQualityError,
    Expectation,
    expect_length_equal,
    expect_match_regex,
    expect_type,
    read_dq_report,
    run_suite,
    watch_suite,
    write_dq_report,
)
from lakestrata.sinks import write_layer
from lakestrata.sources import read_delimited, read_layer, stage_delimited


@dataclass(frozen=True)
class BankSource:
    separator: str
    encoding: str
    entity_column: str


# How each source is written, and the column that names the bank.
BANK_SOURCES = {
    "Reclamacoes": BankSource(";", "ISO-8859-1", "instituicao_financeira"),
    "Banco": BankSource("\t", "utf-8", "nome"),
    "Empregados": BankSource("|", "utf-8", "nome"),
}

# The expectations on each table, and on any other table.
SUITES = {
    "Empregados": [expect_match_regex("nome", r"^\D*$")],
    "Banco": [expect_length_equal("cnpj", 12)],
}
OTHER_SUITE = [expect_type("quantidade_total_de_clientes__ccs_e_scr", "int")]

#: Columns that identify a row; kept as text, so that leading zeros stay.
KEY_COLUMNS = ("cnpj",)

# The measures of the delivery table.
COMPLAINT_MEASURES = {
    "quantidade_total_de_reclamacoes": "sum",
    "quantidade_total_de_clientes__ccs_e_scr": "sum",
}
EMPLOYEE_MEASURES = {"geral": "avg", "remuneracao_e_beneficios": "avg"}


def suite_for(table: str) -> Sequence[Expectation]:
    return SUITES.get(table, OTHER_SUITE)


def clean_source(df: DataFrame, entity_column: str, legacy_upper_o: bool = False) -> DataFrame:
    """Normalise headers, then values, then the entity name. Narrow: one projection."""
    return clean_entity_name(
        normalize_values(normalize_columns(df, legacy_upper_o)), entity_column
    )


def clean_source_job(
    spark: SparkSession,
    source: str,
    target: str,
    report: str,
    run_date: datetime.date,
    *,
    table: str,
    separator: str | None = None,
    encoding: str | None = None,
    entity_column: str | None = None,
    schema: T.StructType | str | None = None,
    infer: bool = True,
    text_columns: Sequence[str] = KEY_COLUMNS,
    suite: Sequence[Expectation] | None = None,
    on_failure: str = "record",
    legacy_upper_o: bool = False,
) -> DataFrame:
    """Clean one delimited source into `target` and file its quality report.

    With `on_failure="record"` row checks ride on the write and key checks read
    the written layer, and data is written whatever they find. With "raise" they
    run first, and a failure leaves `target` as it was. The text is parsed once: where
    types are inferred it goes to a copy beside `target` first, which is deleted at the
    end. `text_columns` (normalised names) stay text where types are inferred, so
    that a key keeps its leading zeros. Returns the report.
    """
    if on_failure not in ("record", "raise"):
        raise ValueError('on_failure is "record" or "raise"')
    require_apart(target, source)
    known = BANK_SOURCES.get(table)
    if known is None and None in (separator, encoding, entity_column):
        raise ValueError(f"give separator, encoding and entity_column for the table {table}")
    reading = {
        "separator": known.separator if separator is None else separator,
        "encoding": known.encoding if encoding is None else encoding,
    }
    column = known.entity_column if entity_column is None else entity_column
    suite = suite_for(table) if suite is None else suite
    staging = made = None
    try:
        if schema is None and infer:
            folder = target.rstrip("/").rpartition("/")[0]
            made = folder if folder and not storage.exists(spark, folder) else None
            staging = f"{target.rstrip('/')}.staged-{uuid.uuid4().hex}"
            raw = stage_delimited(
                spark, source, staging, keep_text=lambda h: normalize_name(h, legacy_upper_o) in text_columns, **reading
            )
        else:
            raw = read_delimited(spark, source, schema=schema, infer=False, **reading)
        clean = clean_source(raw, column, legacy_upper_o)
        return _checked_write(clean, target, report, run_date, table, suite, on_failure)
    finally:
        if staging is not None:
            storage.delete(spark, staging)
        if made is not None and not storage.children(spark, made):
            storage.delete(spark, made)


def _checked_write(
    clean: DataFrame,
    target: str,
    report: str,
    run_date: datetime.date,
    table: str,
    suite: Sequence[Expectation],
    on_failure: str,
) -> DataFrame:
    """Write the cleaned rows, check them on the way (or before, to refuse them) and file the report."""
    spark = clean.sparkSession
    if on_failure == "raise":
        outcome = run_suite(clean, suite, table)
        write_dq_report(outcome, report, run_date)
        filed = read_dq_report(spark, report, table, run_date)
        if not filed.where(~F.col("success")).isEmpty():
            raise DataQualityError(f"{table}: see the report under {report}")
        write_layer(clean, target)
        return filed

    rowwise = [e for e in suite if not e.unique_key]
    watch = watch_suite(clean, rowwise, table)
    write_layer(watch.df, target)
    reports = [watch.report()] if rowwise else []
    if keys := [e for e in suite if e.unique_key]:
        reports.append(run_suite(read_layer(spark, target), keys, table))
    write_dq_report(union_by_name(*reports), report, run_date)
    return read_dq_report(spark, report, table, run_date)


def delivery_table(
    complaints: DataFrame,
    employees: DataFrame,
    banks: DataFrame,
    *,
    complaint_key: str = "instituicao_financeira",
    name_key: str = "nome",
    complaint_measures: dict[str, str] = COMPLAINT_MEASURES,
    employee_measures: dict[str, str] = EMPLOYEE_MEASURES,
) -> DataFrame:
    """Aggregate complaints and employees by bank, join both, then the bank's own columns.

    Both aggregates and the join between them use one shuffle per input. The
    banks are not aggregated and may repeat a name, so that join spreads hot names.
    """
    complaint_sums = aggregate(complaints, complaint_key, complaint_measures)
    employee_means = aggregate(employees, name_key, employee_measures)
    entities = join_entities(complaint_sums, employee_means, complaint_key, name_key)
    joined = join_entities(
        entities.drop(name_key), banks, complaint_key, name_key, spread_hot_keys=True
    )
    return joined.drop(name_key)


def delivery_table_job(
    spark: SparkSession, complaints: str, employees: str, banks: str, target: str
) -> None:
    require_apart(target, complaints, employees, banks)
    table = delivery_table(
        read_layer(spark, complaints), read_layer(spark, employees), read_layer(spark, banks)
    )
    write_layer(table, target)
