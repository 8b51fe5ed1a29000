"""Schemas of many parquet files, read from their footers by Spark tasks."""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

#: Under this key Spark leaves the schema of what it wrote.
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
#: Footers that one task opens.
FILES_PER_TASK = 64


@dataclass
class FoundSchema:
    """A schema and what has it: folders in which every file does, and files of folders that hold several."""

    schema: T.StructType
    folders: list[str] = field(default_factory=list)
    files: list[str] = field(default_factory=list)
    n_files: int = 0


def _nullable(kind: T.DataType) -> T.DataType:
    """The type as a file scan gives it: everything may be null."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType))
    return kind


def _open(path: str) -> pq.ParquetFile:
    """A file by the path that Spark's scans give; local, or in a store that Arrow knows."""
    if path.startswith("file:"):
        return pq.ParquetFile("/" + path[len("file:") :].lstrip("/"), memory_map=True)
    system, name = pyarrow.fs.FileSystem.from_uri(quote(path.replace("s3a://", "s3://", 1), safe=":/"))
    return pq.ParquetFile(system.open_input_file(name))


def footer_schema(path: str) -> T.StructType:
    """The schema in a file's footer, as Spark's own reader sees it; only the footer is read."""
    with _open(path) as file:
        known = (file.schema_arrow.metadata or {}).get(_SPARK_SCHEMA)
        if known is not None:
            return _nullable(T.StructType.fromJson(json.loads(known)))
        # Timestamps of 96 bits have a time zone for Spark and none for Arrow.
        physical = {file.schema.column(i).path: file.schema.column(i).physical_type for i in range(len(file.schema))}
        fields = []
        for f in file.schema_arrow:
            kind = T.TimestampType() if physical.get(f.name) == "INT96" else from_arrow_type(f.type, prefer_timestamp_ntz=True)
            fields.append(T.StructField(f.name, _nullable(kind)))
        return T.StructType(fields)


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = batch.column(0).to_pylist()
        schemas = [footer_schema(p).json() for p in paths]
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(schemas, pa.string())], ["path", "schema"])


def footers(files: DataFrame) -> DataFrame:
    """One row per file of a `list_files` table: path, folder, schema (JSON). Tasks open the footers."""
    n = files.count()
    opened = files.select("file_path").repartition(n // FILES_PER_TASK + 1).mapInArrow(_footers, "path string, schema string")
    return opened.select("path", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"), "schema")


def file_schemas(files: DataFrame) -> list[FoundSchema]:
    """The different schemas of the files, widest use first, and where each is found.

    The driver gets a row per schema and folder. File names reach it only for folders whose
    files differ, as a scan of part of a folder has to name them.
    """
    opened = footers(files)
    counts = opened.groupBy("schema", "folder").agg(F.count(F.lit(1)).alias("n")).collect()
    by_folder = defaultdict(list)
    found: dict[str, FoundSchema] = {}
    for row in sorted(counts, key=lambda r: (r.schema, r.folder)):
        by_folder[row.folder].append(row.schema)
        own = found.setdefault(row.schema, FoundSchema(T.StructType.fromJson(json.loads(row.schema))))
        own.n_files += row.n
    mixed = [folder for folder, schemas in by_folder.items() if len(schemas) > 1]
    for folder, schemas in by_folder.items():
        if len(schemas) == 1:
            found[schemas[0]].folders.append(folder)
    if mixed:
        for row in opened.where(F.col("folder").isin(mixed)).select("path", "schema").toLocalIterator():
            found[row.schema].files.append(row.path)
    for own in found.values():
        own.files.sort()
    return sorted(found.values(), key=lambda x: (-x.n_files, x.schema.json()))
