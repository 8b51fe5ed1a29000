"""Database tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    *,
    mode: str = "overwrite",
    truncate: bool = False,
    connections: int | None = None,
    batch_size: int = 10_000,
    column_types: str | None = None,
) -> None:
    """Write from the executors, one transaction per task.

    `properties` carries user, password and driver and is never logged.
    `truncate=True` empties an existing table instead of dropping it, which
    keeps its types and primary key. `column_types` are the types of a table that
    is created, e.g. "cnpj varchar(14)". `connections` bounds the parallel writers;
    as it lowers the number of tasks, write a stored table rather than a long
    plan with it. A task that runs again after it had committed repeats its
    rows, so an append should meet a primary key.
    """
    options = {"truncate": str(truncate).lower(), "batchsize": str(batch_size)}
    if connections is not None:
        options["numPartitions"] = str(connections)
    if column_types is not None:
        options["createTableColumnTypes"] = column_types
    df.write.mode(mode).options(**options).jdbc(url, table, properties=dict(properties))
