"""Datasets whose overwrite is never seen half done: a folder a version, and a log that is added to last."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata import storage

_LOG, _DATA = "_versions", "data"
_ENTRY = "number long, folder string"


def _entries(spark: SparkSession, path: str) -> DataFrame | None:
    """The log of a versioned dataset, a row a version; None for any other path."""
    log = f"{path.rstrip('/')}/{_LOG}"
    return spark.read.schema(_ENTRY).json(log) if storage.exists(spark, log) else None


def versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and folder of every published version, the current one last; none if `path` has no versions."""
    log = _entries(spark, path)
    return [] if log is None else [tuple(r) for r in log.orderBy("number", "folder").collect()]


def current_folder(spark: SparkSession, path: str) -> str | None:
    """Where the rows of a versioned dataset lie now; None if `path` has no versions."""
    log = _entries(spark, path)
    last = None if log is None else log.orderBy(F.desc("number"), F.desc("folder")).first()
    return None if last is None else f"{path.rstrip('/')}/{_DATA}/{last.folder}"


def write_version(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Have `write` fill a new folder, then make that the dataset's current version; returns the folder.

    The log entry is one file that Spark's committer publishes by a rename, after
    the data is complete. Until then, and if the write dies, readers see the
    version before. Of two writers that meet each publishes whole versions; the higher
    number, then the later name in order, is current.
    """
    path = path.rstrip("/")
    number = max((n for n, _ in versions(spark, path)), default=0) + 1
    name = f"v{number:08d}-{uuid.uuid4().hex}"
    folder = f"{path}/{_DATA}/{name}"
    write(folder)
    entry = spark.createDataFrame([(number, name)], _ENTRY).coalesce(1)
    entry.write.mode("append").json(f"{path}/{_LOG}")
    return folder


def drop_versions(spark: SparkSession, path: str, keep: int = 1, abandoned: bool = False) -> list[str]:
    """Delete the data of all versions but the last `keep`; returns the folders' names.

    Readers of those versions must have ended. `abandoned=True` also deletes folders that
    no log entry names, which dead writers left; no writer may then be running.
    """
    if keep < 1:
        raise ValueError("the current version stays")
    published = [folder for _, folder in versions(spark, path)]
    kept, present = set(published[-keep:]), storage.children(spark, f"{path.rstrip('/')}/{_DATA}")
    old = [f for f in present if f not in kept and (abandoned or f in published)]
    for folder in old:
        storage.delete(spark, f"{path.rstrip('/')}/{_DATA}/{folder}")
    return old
