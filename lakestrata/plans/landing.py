"""Landing that copies only what is new: a ledger of files, and the rows of each in the batch that brought them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata import storage
from lakestrata.plans.paths import require_apart
from lakestrata.sources import concat_by_name, list_files
from lakestrata.sources.concat import one_scheme, read_files

_LEDGER, _DATA, _PATH = "_ledger", "data", "__source_path"
_ENTRY = "path string, length long, modified timestamp, batch long"


def _ledger(spark: SparkSession, target: str) -> DataFrame:
    """The newest entry of every file that was landed."""
    folder = f"{target.rstrip('/')}/{_LEDGER}"
    if not storage.exists(spark, folder):
        return spark.createDataFrame([], _ENTRY)
    entries = spark.read.schema(_ENTRY).parquet(folder)
    newest = entries.groupBy("path").agg(F.max(F.struct("batch", "length", "modified")).alias("e"))
    return newest.select("path", "e.length", "e.modified", "e.batch")


def land_new_job(spark: SparkSession, source: str, target: str, glob: str = "*") -> int:
    """Land the parquet files below `source` that are new or have changed since the last run; how many.

    A file has changed if its length or time has. Its rows take the place of those it
    had; files that are gone from `source` stay landed, as they do in a copy. Rows
    go to a batch of their own, and the ledger gets its entries after them in one write, so a
    run that dies leaves what was landed as it was, and the next run repeats its batch. One run at
    a time. Only the names of new files reach the driver, as a scan of them has to.
    """
    require_apart(target, source)
    target = target.rstrip("/")
    files = list_files(spark, source, glob, modified=True).withColumn("path", one_scheme(F.col("file_path")))
    known = _ledger(spark, target)
    same = ["path", "length", "modified"]
    new = files.join(known.select(*same), same, "left_anti").select("file_path", *same).collect()
    if not new:
        return 0
    batch = (known.agg(F.max("batch")).first()[0] or 0) + 1
    rows = read_files(spark, [r.file_path for r in new], _PATH)
    rows.write.mode("overwrite").parquet(f"{target}/{_DATA}/batch={batch}")
    entries = spark.createDataFrame([(r.path, r.length, r.modified, batch) for r in new], _ENTRY)
    entries.coalesce(1).write.mode("append").parquet(f"{target}/{_LEDGER}")
    return len(new)


def read_landed(spark: SparkSession, target: str, provenance: str = "source_file") -> DataFrame:
    """The rows of every landed file as it was last, with the base name each came from.

    They are those of one landing of all files (`land_recursive`).
    """
    target = target.rstrip("/")
    rows = concat_by_name(spark, f"{target}/{_DATA}")
    current = _ledger(spark, target).select(F.col("path").alias(_PATH), F.col("batch").cast("int").alias("batch"))
    kept = rows.withColumn("batch", F.col("batch").cast("int")).join(current, [_PATH, "batch"], "left_semi")
    return kept.withColumn(provenance, F.element_at(F.split(_PATH, "/"), -1)).drop(_PATH, "batch")
