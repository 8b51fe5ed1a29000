"""Row-wise concatenation of parquet files whose schemas differ."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.text import quoted
from lakestrata.operators.unify import union_by_name
from lakestrata.sources.files import list_files
from lakestrata.sources.footers import file_schemas

_PARTITION = r"^(.*?)/[^/=]+=[^/]*/"


def concat_by_name(
    spark: SparkSession,
    *paths: str,
    glob: str = "*",
    keep: Callable[[Column], Column] | None = None,
    provenance: str | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """All rows of all parquet files below `paths`, columns matched by name.

    A column a file lacks is null. Folders named `column=value` give that column,
    and filters on it skip folders; all other folders are read at any depth. If
    files disagree on a column's type, files of one schema are read together and
    the parts are united, which widens the type (bigint and double give double).
    `keep` is a condition on the file name; `provenance` names a column that is to
    hold the file name. `schema` gives the columns of the result, partition
    columns among them, and saves reading any footer.
    """
    parts = []
    for path in paths:
        files = list_files(spark, path, glob).select("file_path", _dataset(path).alias("base"))
        # The tops of partitioned datasets, one for a whole layer; null for files outside of any.
        bases = sorted(r.base or "" for r in files.select("base").distinct().collect())
        if not any(bases):
            parts.append(_merged(spark, [path], glob, keep, provenance, schema, base=None))
            continue
        parts += [_merged(spark, [b], glob, keep, provenance, schema, base=b) for b in bases if b]
        if "" in bases:
            folder = F.regexp_extract("file_path", "^(.*)/[^/]*$", 1)
            flat = [r[0] for r in files.where("base is null").select(folder).distinct().collect()]
            parts.append(_merged(spark, flat, glob, keep, provenance, schema, base=None, deep=False))
    return parts[0] if len(parts) == 1 else union_by_name(*parts)


def read_files(spark: SparkSession, files: list[str], path_column: str) -> DataFrame:
    """The rows of the named parquet files as `concat_by_name` unites them, each with the path it came from."""
    try:
        parts = [spark.read.option("mergeSchema", True).parquet(*files)]
    except (PySparkException, Py4JJavaError) as error:
        if not _cannot_merge(error):
            raise
        found = file_schemas(list_files(spark, files))
        wanted = set(files)
        parts = []
        for own in found:
            # Folders stand for files of theirs that were asked for.
            inside = [f for f in wanted if f.rpartition("/")[0] in own.folders] + [f for f in own.files if f in wanted]
            parts.append(spark.read.schema(own.schema).parquet(*sorted(inside)))
    path = _decoded(F.col("_metadata.file_path"))
    named = [df.select(*[quoted(c) for c in df.columns], one_scheme(path).alias(path_column)) for df in parts]
    return union_by_name(*named)


def one_scheme(path: Column) -> Column:
    """Local paths with one slash behind `file:`; Spark's listings and scans disagree."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def _dataset(path: str) -> Column:
    """The folder below (or at) `path` whose sub-folders are named `column=value`; null for other files."""
    root = path.rstrip("/")
    if root.startswith("file:"):
        root = "/" + root[len("file:") :].lstrip("/")
    after = F.instr("file_path", root) + len(root)
    below = F.substr("file_path", after)
    partitioned = (F.instr("file_path", root) > 0) & below.rlike(_PARTITION)
    base = F.concat(F.substr("file_path", F.lit(1), after - 1), F.regexp_extract(below, _PARTITION, 1))
    return F.when(partitioned, base)


def _merged(spark, paths, glob, keep, provenance, schema, base, deep=True) -> DataFrame:
    try:
        return _read(spark, paths, glob, keep, provenance, schema, base, deep)
    except (PySparkException, Py4JJavaError) as error:
        if not _cannot_merge(error):
            raise
    files = list_files(spark, paths, glob)
    if keep is not None:
        files = files.where(keep(F.col("file_name")))
    parts = []
    for found in file_schemas(files):
        if found.folders:
            parts.append(_read(spark, found.folders, glob, keep, provenance, found.schema, base, False))
        if found.files:
            parts.append(_read(spark, found.files, "*", None, provenance, found.schema, base, False))
    return union_by_name(*parts)


def _cannot_merge(error: Exception) -> bool:
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    return "CANNOT_MERGE_SCHEMAS" in (condition or str(error))


def _read(spark, paths, glob, keep, provenance, schema, base, deep) -> DataFrame:
    reader = spark.read.option("pathGlobFilter", glob)
    if base is not None:
        reader = reader.option("basePath", base)
    elif deep:
        reader = reader.option("recursiveFileLookup", True)
    if schema is None:
        reader = reader.option("mergeSchema", True)
    else:
        reader = reader.schema(schema)
    df = reader.parquet(*paths)
    name = _decoded(F.col("_metadata.file_name"))
    columns = [quoted(c) for c in df.columns]
    if keep is not None:
        df = df.where(keep(name))
    if provenance is not None:
        return df.select(*columns, name.alias(provenance))
    return df.select(*columns)


def _decoded(name: Column) -> Column:
    """Spark gives file names percent-encoded, with a plus sign as it is."""
    protected = F.replace(name, F.lit("+"), F.lit("%2B"))
    return F.when(name.contains("%"), F.url_decode(protected)).otherwise(name)
