"""Delivery tables in files, loaded in two phases: tasks stage, the driver's commit publishes."""

from __future__ import annotations

import json
import os
import re
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from lakestrata.functions.text import quoted
from lakestrata.sinks.delivery import DELIVERY_KEY, DELIVERY_SCHEMA

FORMAT = "lakestrata_delivery"
_TABLE, _COMMIT, _STAGING = "_table.json", "_commit.json", "_staging"
_LOAD = re.compile(r"load=(\d{8})")
_LOAD_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


class DeliveryConflict(RuntimeError):
    """Another load was published since this one looked at the target."""


class KeyViolation(ValueError):
    """A load would leave the delivery table with a null or repeated key."""


@dataclass(frozen=True)
class Load:
    """A published load: its place in the order of loads, its id, and whether it replaced all before it."""

    number: int
    load_id: str
    replaces: bool
    rows: int


def local_path(path: str) -> str:
    """A path as Python's own file functions take it."""
    if path.startswith("file:"):
        return "/" + path[len("file:") :].lstrip("/")
    if "://" in path:
        raise ValueError(f"{path}: a delivery table lies in a folder that the driver and all executors mount")
    return path


def create_delivery(
    path: str, schema: T.StructType = DELIVERY_SCHEMA, key: str | None = DELIVERY_KEY
) -> None:
    """Drop the delivery table at `path`, if there is one, and create it empty, with its types and its key.

    The old table stays readable until the new one takes its place.
    """
    path = local_path(path).rstrip("/")
    if key is not None and key not in schema.names:
        raise ValueError(f"the key {key} is no column of {schema.names}")
    made = f"{path}.{uuid.uuid4().hex}"
    os.makedirs(made)
    with open(f"{made}/{_TABLE}", "w", encoding="utf-8") as file:
        json.dump({"schema": schema.jsonValue(), "key": key}, file)
    if os.path.isdir(path):
        dropped = f"{path}.{uuid.uuid4().hex}"
        os.rename(path, dropped)
        os.rename(made, path)
        shutil.rmtree(dropped)
    else:
        os.rename(made, path)


def delivery_table(path: str) -> tuple[T.StructType, str | None]:
    """Types and key of the delivery table at `path`."""
    with open(f"{local_path(path)}/{_TABLE}", encoding="utf-8") as file:
        found = json.load(file)
    return T.StructType.fromJson(found["schema"]), found["key"]


def published_loads(path: str) -> list[Load]:
    """All published loads in their order, also those that a later one replaced."""
    path, loads = local_path(path), []
    for name in sorted(os.listdir(path)):
        if found := _LOAD.fullmatch(name):
            with open(f"{path}/{name}/{_COMMIT}", encoding="utf-8") as file:
                loads.append(Load(int(found[1]), **json.load(file)))
    return loads


def current_loads(path: str) -> list[Load]:
    """The loads that make up the table now."""
    loads = published_loads(path)
    first = max((i for i, load in enumerate(loads) if load.replaces), default=0)
    return loads[first:]


def read_delivery(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all published loads; what a running or failed load has staged is not among them."""
    schema, _ = delivery_table(path)
    folders = [f"{path.rstrip('/')}/load={load.number:08d}" for load in current_loads(path) if load.rows]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def drop_replaced(path: str) -> int:
    """Delete the loads that a later one replaced; how many there were. Running readers must have ended."""
    path = local_path(path)
    kept = {load.number for load in current_loads(path)}
    old = [load.number for load in published_loads(path) if load.number not in kept]
    for number in old:
        shutil.rmtree(f"{path}/load={number:08d}")
    return len(old)


@dataclass
class Staged(WriterCommitMessage):
    """What a task's successful attempt has written."""

    file: str | None
    rows: int


class DeliveryWriter(DataSourceArrowWriter):
    """Tasks write files of their own to a staging folder; the commit publishes it by one rename.

    A failed attempt's file is not among the messages and goes before the
    rename. Loads are numbered, and a folder can be renamed to a number only once, so of two
    loads that looked at the same table one fails. A load id that is published
    already is not published again.
    """

    def __init__(self, options: dict[str, str], schema: T.StructType, overwrite: bool):
        self.path, self.load_id = local_path(options["path"]).rstrip("/"), options["load_id"]
        self.seen = int(options["seen"])
        self.schema, self.overwrite = schema, overwrite
        self.staging = f"{self.path}/{_STAGING}/{self.load_id}-{options['attempt']}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        os.makedirs(self.staging, exist_ok=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.parquet"
        writer, rows = None, 0
        for batch in iterator:
            if batch.num_rows:
                writer = writer or pq.ParquetWriter(f"{self.staging}/{name}", batch.schema)
                writer.write_batch(batch)
                rows += batch.num_rows
        if writer is None:
            return Staged(None, 0)
        writer.close()
        return Staged(name, rows)

    def commit(self, messages: list[Staged | None]) -> None:
        if any(load.load_id == self.load_id for load in published_loads(self.path)):
            self.abort(messages)
            return
        os.makedirs(self.staging, exist_ok=True)
        good = {m.file for m in messages if m is not None and m.file}
        for name in os.listdir(self.staging):
            if name not in good:
                os.unlink(f"{self.staging}/{name}")
        found = {
            "load_id": self.load_id,
            "replaces": self.overwrite,
            "rows": sum(m.rows for m in messages if m is not None),
        }
        with open(f"{self.staging}/{_COMMIT}", "w", encoding="utf-8") as file:
            json.dump(found, file)
        try:
            # The folder is never empty, so the rename fails if the number is taken.
            os.rename(self.staging, f"{self.path}/load={self.seen + 1:08d}")
        except OSError as error:
            raise DeliveryConflict(f"load {self.seen + 1} of {self.path} is published already") from error

    def abort(self, messages: list[Staged | None]) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)


class DeliverySource(DataSource):
    """Spark's view of a delivery table as a sink; `deliver_load` sets its options."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return delivery_table(self.options["path"])[0]

    def writer(self, schema: T.StructType, overwrite: bool) -> DeliveryWriter:
        return DeliveryWriter(dict(self.options), schema, overwrite)


def _check_key(df: DataFrame, target: DataFrame | None, key: str) -> None:
    """Raise if a key is null, occurs twice, or is in the table already."""
    column = F.col(quoted(key))
    wrong = df.groupBy(column.alias("__key")).agg(F.count(F.lit(1)).alias("__n")).where("__key is null or __n > 1")
    wrong = wrong.select("__key")
    if target is not None:
        present = df.select(column.alias("__key")).join(target.select(column.alias("__key")), "__key", "left_semi")
        wrong = wrong.unionAll(present)
    found = wrong.limit(1).collect()
    if found:
        raise KeyViolation(f"{key}: {found[0][0]!r} would be null or repeated")


def deliver_load(
    df: DataFrame, path: str, load_id: str, *, mode: str = "append", check_key: bool = True, **options: Any
) -> bool:
    """Load `df` into the delivery table at `path`; False if this load was published before.

    All rows of a load appear at once, each of them once, whatever attempts its tasks
    took; `load_id` names the load, so a job that runs again with the same id adds
    nothing. `mode="overwrite"` replaces the rows of all loads before it. The columns must
    be those of the table, in order. With `check_key` a load is refused whose key is
    null or repeated in itself or, for an append, in the table; if another load is published
    meanwhile, the check no longer holds and `DeliveryConflict` is raised: run the load again.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError('mode is "append" or "overwrite"')
    if not _LOAD_ID.fullmatch(load_id):
        raise ValueError(f"a load id of letters, digits, dots, hyphens and underscores, not {load_id!r}")
    schema, key = delivery_table(path)
    given = [(f.name, f.dataType) for f in df.schema]
    if given != [(f.name, f.dataType) for f in schema]:
        raise AnalysisException(f"columns {given} are not those of the table {schema.simpleString()}")
    loads = published_loads(path)
    if any(load.load_id == load_id for load in loads):
        return False
    spark = df.sparkSession
    if check_key and key is not None:
        _check_key(df, read_delivery(spark, path) if mode == "append" and loads else None, key)
    spark.dataSource.register(DeliverySource)
    seen = max((load.number for load in loads), default=0)
    settings = {"path": path, "load_id": load_id, "seen": str(seen), "attempt": uuid.uuid4().hex}
    df.write.format(FORMAT).mode(mode).options(**settings, **options).save()
    return True
