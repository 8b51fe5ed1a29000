"""Load the delivery table into a database."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import SparkSession

from lakestrata.quality import DataQualityError, key_violations
from lakestrata.sinks import DELIVERY_KEY, create_delivery, deliver_load, deliver_positional, write_jdbc
from lakestrata.sinks.transactional import delivery_table
from lakestrata.sources import concat_by_name, read_layer


def export_jdbc_job(
    spark: SparkSession,
    source: str,
    url: str,
    table: str,
    properties: Mapping[str, str],
    **options: Any,
) -> None:
    """Replace a database table by a parquet dataset."""
    write_jdbc(read_layer(spark, source), url, table, properties, **options)


def deliver_job(
    spark: SparkSession,
    source: str,
    url: str,
    table: str,
    properties: Mapping[str, str],
    *,
    variant: str = "append",
    check_key: bool = True,
    nulls_as_empty: bool = False,
    **options: Any,
) -> None:
    """Load all parquet files below `source`.

    "replace" writes them under their own column names into a new table.
    "append" loads them by position into the typed delivery table, after a check
    that the load itself does not break its primary key.
    """
    if variant not in ("replace", "append"):
        raise ValueError('variant is "replace" or "append"')
    rows = concat_by_name(spark, source)
    if variant == "replace":
        write_jdbc(rows, url, table, properties, mode="overwrite", **options)
        return
    delivery = deliver_positional(rows, nulls_as_empty=nulls_as_empty)
    if check_key and not key_violations(delivery, DELIVERY_KEY).isEmpty():
        raise DataQualityError(f"{DELIVERY_KEY} is null or repeated in {source}")
    write_jdbc(delivery, url, table, properties, mode="append", **options)


def deliver_files_job(
    spark: SparkSession,
    source: str,
    target: str,
    load_id: str,
    *,
    variant: str = "append",
    check_key: bool = True,
    nulls_as_empty: bool = False,
) -> bool:
    """Load all parquet files below `source` into the delivery table of files at `target`.

    "append" loads them by position into the table, which is created with the delivery types and
    key if there is none; "replace" does the same and replaces all rows;
    "create" drops the table and makes it anew with the files' own columns and no key. Rows appear
    at once and each once, also if tasks fail or the job runs again with the same `load_id`; returns
    whether it had anything to do.
    """
    if variant not in ("append", "replace", "create"):
        raise ValueError('variant is "append", "replace" or "create"')
    rows = concat_by_name(spark, source)
    if variant == "create":
        create_delivery(target, rows.schema, None)
        return deliver_load(rows, target, load_id)
    try:
        schema, _ = delivery_table(target)
    except FileNotFoundError:
        create_delivery(target)
        schema, _ = delivery_table(target)
    rows = deliver_positional(rows, schema, nulls_as_empty=nulls_as_empty)
    mode = "overwrite" if variant == "replace" else "append"
    return deliver_load(rows, target, load_id, mode=mode, check_key=check_key)
